"""Dimension handling (JN-1..6): deterministic de-duplication and lookups.

A lookup built from a key/value map keeps one value per key, whereas a join
multiplies fact rows when the dimension repeats a key.  Every dimension used as
a lookup therefore goes through :func:`dedupe_dimension` first.  That is a
``groupBy(key)`` with a partial (map-side) ``min``; its output is already hash
partitioned on the key, so the following join on the same key reuses that
partitioning instead of shuffling the dimension a second time.

Broadcasting is left to the planner (``autoBroadcastJoinThreshold`` at plan
time, AQE at run time): both check the side's size and fall back to a
sort-merge join beyond it, which is what a dimension that grows with the data
needs.  A hint is given only where the caller asks for it.

The de-duplicating aggregate sits between the exchange and the join, which
keeps AQE from splitting a skewed partition of that join; lookups are
therefore joined to facts already reduced to one row per key, and facts that
have to stay rows go through :func:`join_once_per_key`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.writers import materialize

_ROW = "__first_row"
_FIXED_WIDTH = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date",
                "timestamp", "timestamp_ntz"}
_FOUND = "__found"


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def dedupe_dimension(df: DataFrame, key: str | Sequence[str],
                     order_by: str | Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest row by ``order_by`` then the other columns.

    Implemented as ``groupBy(key).agg(min(struct(...)))`` so that it is
    combined map-side (a key repeated a billion times costs one row per task);
    a single fixed-width value column uses a plain ``min`` (hash aggregate).
    """
    keys = _as_list(key)
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.select(*keys).distinct()
    types = dict(df.dtypes)
    if len(values) == 1 and types[values[0]] in _FIXED_WIDTH:
        # a single fixed-width value: plain min keeps the hash aggregate
        return df.groupBy(*keys).agg(F.min(values[0]).alias(values[0]))
    order = [c for c in _as_list(order_by or []) if c in values]
    fields = order + [c for c in values if c not in order]
    packed = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias(_ROW))
    return packed.select(*keys, *[F.col(f"{_ROW}.{c}").alias(c) for c in values])


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           value: str, default: str | Column | None = None,
           out: str | None = None, dedupe: bool = True,
           broadcast: bool = False) -> DataFrame:
    """Left lookup ``fact.fact_key -> dim.value`` with a default (JN-5).

    Fact rows are never dropped or multiplied.  ``broadcast=True`` is the
    caller's word that the dimension is a small table of fixed size; otherwise
    the planner decides from its size.
    """
    d = dim.select(F.col(dim_key).alias("__lk_key"), F.col(value).alias("__lk_val"))
    if dedupe:
        d = dedupe_dimension(d, "__lk_key")
    if broadcast:
        d = F.broadcast(d)
    joined = fact.join(d, fact[fact_key] == d["__lk_key"], "left")
    val = F.col("__lk_val")
    if default is not None:
        val = F.coalesce(val, default if isinstance(default, Column) else F.lit(default))
    name = out or value
    keep = [F.col(c) for c in fact.columns if c != name]
    return joined.select(*keep, val.alias(name))


def two_hop_lookup(fact: DataFrame, fact_user: str, users: DataFrame, user_key: str,
                   user_code: str, codes: DataFrame, code_key: str, code_name: str,
                   out: str = "label", missing_user: str = "Unknown",
                   measures: Sequence[str] | None = None) -> DataFrame:
    """``fact.user -> users.code -> codes.name`` (JN-6).

    An unknown code falls back to the code itself (as text); an unknown user
    gives ``missing_user``.  Both dimensions are de-duplicated first.

    With ``measures`` (additive columns such as partial sums and counts) the
    rows are re-aggregated per code between the two hops, so the second join
    sees one row per code - a code shared by a third of all users is not a
    hot key there - and the result has one row per code with ``out`` and the
    summed measures.
    """
    u = dedupe_dimension(
        users.select(F.col(user_key).alias("__u_key"), F.col(user_code).alias("__u_code")),
        "__u_key").withColumn(_FOUND, F.lit(True))
    c = dedupe_dimension(
        codes.select(F.col(code_key).cast("string").alias("__c_key"),
                     F.col(code_name).alias("__c_name")), "__c_key")
    step1 = fact.join(u, fact[fact_user] == u["__u_key"], "left")
    if measures:
        step1 = step1.groupBy(F.col("__u_code").cast("string").alias("__u_code"), _FOUND).agg(
            *[F.sum(m).alias(m) for m in measures])
    step2 = step1.join(c, step1["__u_code"].cast("string") == c["__c_key"], "left")
    label = (F.when(F.col(_FOUND).isNull(), F.lit(missing_user))
             .otherwise(F.coalesce(F.col("__c_name"), F.col("__u_code").cast("string"),
                                   F.lit(missing_user))))
    return step2.withColumn(out, label).drop("__u_key", "__u_code", _FOUND, "__c_key", "__c_name")


#: smallest share of the rows that the sketch of frequent keys can tell
KEY_SUPPORT = 1e-4
MAX_SALTS = 4096


def heavy_keys(fact: DataFrame, key: str, partitions: int, support: float = KEY_SUPPORT) -> DataFrame:
    """``(__key, __salts)`` of the keys that fill more than one of ``partitions``
    shuffle partitions, and how many they fill.

    Candidates come from a counting sketch (``freqItems``: a bounded number of
    counters per task, merged), which misses no key of a larger share than
    ``support`` but may name others; their rows are then counted exactly.  At
    most 1 / ``support`` keys, so the result may be broadcast.
    """
    keys = fact.select(F.col(key).alias("__key")).where("__key IS NOT NULL")
    named = keys.stat.freqItems(["__key"], support).select(F.explode(F.col("__key_freqItems")).alias("__key"))
    # the row count comes with the candidates' counts: one more aggregate of the key column
    is_named = F.broadcast(named.distinct().withColumn("__named", F.lit(True)))
    counts = (keys.join(is_named, "__key", "left")
              .groupBy(F.when(F.col("__named"), F.col("__key")).alias("__key")).agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))      # as few rows as candidates
    fills = F.ceil(F.col("n") * partitions / total)
    return (counts.withColumn("__salts", F.least(F.lit(MAX_SALTS), fills).cast("int"))
            .where("__key IS NOT NULL AND __salts > 1").select("__key", "__salts"))


def join_once_per_key(fact: DataFrame, dim: DataFrame, key: str, order_by: str | Sequence[str] | None = None,
                      how: str = "inner", partitions: int | None = None) -> DataFrame:
    """``fact`` joined to the one row per key that :func:`dedupe_dimension` keeps of ``dim``.

    The de-duplicated side cannot be split by AQE, so rows of heavy keys are
    dealt over several salts here and the kept row is repeated for each of
    them, after the de-duplication.  The other keys have one salt.  A row's
    salt comes from its values and its task, so a repeated task deals it alike.
    The heavy keys are counted (two aggregates of the key column) and written
    when the join is built.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how = {how!r}: a repeated dimension row may only be matched")
    spark = fact.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(materialize(heavy_keys(fact, key, partitions), spark, "heavy-keys"))
    own = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns], F.spark_partition_id())
    salted = (fact.withColumn("__hash", own).join(heavy, F.col(key) == F.col("__key"), "left")
              .withColumn("__salt", F.pmod("__hash", F.coalesce("__salts", F.lit(1))).cast("int"))
              .drop("__hash", "__key", "__salts"))
    kept = dedupe_dimension(dim, key, order_by).withColumnRenamed(key, "__dim_key")
    repeated = (kept.join(heavy, F.col("__dim_key") == F.col("__key"), "left")
                .withColumn("__dim_salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
                .drop("__key", "__salts"))
    on = (F.col(key) == F.col("__dim_key")) & (F.col("__salt") == F.col("__dim_salt"))
    return salted.join(repeated, on, how).drop("__salt", "__dim_key", "__dim_salt")
