"""Commerce summaries (family D) over canonical DataFrames.

* ``orders``:    ``order_id``, ``customer_id``, ``purchase_ts``
* ``customers``: ``customer_id``, ``country``
* ``reviews``:   ``score`` (text, as read from a CSV with stray values)
* ``order_items``: ``seller_id``, ``order_id``, ``price``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.timeparts import month_of, year_of
from tessera.operators.topk import top_k


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """#29 Orders per customer country, most first (JN-8, AGG-2, SRT-1).

    Orders are counted per customer before the join, so the join and its
    shuffle see one row per customer instead of one per order; a duplicated
    customer key multiplies its count exactly like the plain inner join.
    """
    per_customer = orders.groupBy("customer_id").agg(F.count("order_id").alias("__n"))
    joined = per_customer.join(customers.select("customer_id", "country"), "customer_id")
    counts = joined.groupBy("country").agg(F.sum("__n").cast("bigint").alias("total_orders"))
    return counts.orderBy(F.col("total_orders").desc(), F.col("country").asc())


def orders_by_year_month(orders: DataFrame) -> DataFrame:
    """#30 Orders per purchase year (ascending) and month (descending)."""
    dated = orders.filter(F.col("purchase_ts").isNotNull()).select(
        year_of("purchase_ts").alias("order_year"), month_of("purchase_ts").alias("order_month"),
        "order_id")
    counts = dated.groupBy("order_year", "order_month").agg(
        F.count("order_id").alias("total_orders"))
    return counts.orderBy(F.col("order_year").asc(), F.col("order_month").desc())


def _valid_scores(reviews: DataFrame, low: float, high: float) -> DataFrame:
    """Scores that parse as numbers inside [low, high] (FLT-10, CST-3).

    ``try_cast`` keeps ANSI mode on: text such as ``abc`` is NULL instead of a
    failed job, and ``4.0`` parses (an int cast would reject it)."""
    value = F.col("score").try_cast("double")
    return reviews.select(value.alias("score")).filter(
        F.col("score").isNotNull() & F.col("score").between(low, high))


def average_valid_score(reviews: DataFrame, low: float = 1.0, high: float = 5.0,
                        digits: int | None = 4) -> DataFrame:
    """#31 One row: the mean of the valid scores and how many there are."""
    mean = F.avg("score") if digits is None else F.round(F.avg("score"), digits)
    return _valid_scores(reviews, low, high).agg(
        mean.alias("avg_score"),
        F.count(F.lit(1)).alias("n_valid"))


def score_distribution(reviews: DataFrame, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """#32 Count per valid score, ascending (AGG-3, SRT-5)."""
    return (_valid_scores(reviews, low, high).groupBy("score")
            .agg(F.count(F.lit(1)).alias("total_reviews")).orderBy("score"))


def seller_ranking(order_items: DataFrame, k: int = 20) -> DataFrame:
    """#33 Sellers by revenue, then distinct orders, both descending; top k.

    Prices are summed as ``decimal(15,2)`` so the total is exact and
    independent of summation order; the distinct count is a single-distinct
    aggregate (two-level hash aggregate, no Expand)."""
    per_seller = order_items.groupBy("seller_id").agg(
        F.sum(F.col("price").cast("decimal(15,2)")).alias("__rev"),
        F.count_distinct("order_id").alias("order_count"))
    ranked = top_k(per_seller, [F.col("__rev").desc(), F.col("order_count").desc(),
                                F.col("seller_id").asc()], k)
    return ranked.select("seller_id", F.col("__rev").cast("decimal(15,2)").alias("total_revenue"),
                         F.col("order_count").cast("bigint").alias("order_count"))
