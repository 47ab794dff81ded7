"""Ratings jobs (families A and C) over canonical DataFrames.

Canonical inputs (bindings rename real columns to these with a projection):

* ``ratings``: ``user_id``, ``item_id``, ``score`` (double), optional ``ts_text``
* ``items``:   ``item_id``, ``title``, optional ``tags`` (array<string>)
* ``users``:   ``user_id`` plus one attribute (``segment``, ``age`` or ``code``)
* ``codes``:   ``code``, ``name``

Shape of every plan: the fact table is first reduced to ``(sum, n)`` at the
finest key the question needs (partial + final hash aggregate, so a hot key is
combined map-side), and only then joined with dimensions, exploded or
re-aggregated.  Dimension lookups de-duplicate their key first
(:func:`tessera.operators.dims.dedupe_dimension`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.bands import UNKNOWN_LABEL, band
from tessera.functions.timeparts import epoch_year
from tessera.operators.dims import dedupe_dimension, join_once_per_key, lookup, two_hop_lookup
from tessera.operators.scores import (N, SUM, conditional_means, conditional_stats,
                                      merge_stats, min_support, ranked, score_stats, with_mean)
from tessera.operators.tags import explode_tags

# Default labels printed by the reference for a missing title.
UNKNOWN_TITLE = "Không rõ tên"


def _rounded(col: str, digits: int | None):
    """``round(col, digits)``; ``digits=None`` keeps the exact value."""
    return F.col(col) if digits is None else F.round(col, digits)


def _titles(items: DataFrame) -> DataFrame:
    return dedupe_dimension(items.select("item_id", "title"), "item_id")


def item_avg_score(ratings: DataFrame, items: DataFrame, digits: int = 4) -> DataFrame:
    """#1 Mean and count per item; items absent from the dimension vanish
    (inner join, JN-1 + AGG-1)."""
    stats = score_stats(ratings, "item_id", "score")
    joined = stats.filter(F.col(N) > 0).join(_titles(items), "item_id", "inner")
    return with_mean(joined, digits=digits).select("item_id", "title", "avg_score", "n_scores")


def best_item_min_support(ratings: DataFrame, items: DataFrame, min_n: int,
                          digits: int = 4) -> DataFrame:
    """#2 The item with the highest mean among items with >= ``min_n`` scores
    (inner with the dimension). Ties: smaller item id. None -> zero rows."""
    per_item = item_avg_score(ratings, items, digits=None)
    best = ranked(min_support(per_item, min_n), "avg_score", "item_id").limit(1)
    return best.select("item_id", "title", _rounded("avg_score", digits).alias("avg_score"),
                       "n_scores")


def item_ranking_min_support(ratings: DataFrame, items: DataFrame, min_n: int,
                             default_title: str = UNKNOWN_TITLE, digits: int = 4) -> DataFrame:
    """#3 Every item with >= ``min_n`` scores, best mean first; the title comes
    from a lookup with a default (JN-5), so no fact is lost."""
    stats = min_support(with_mean(score_stats(ratings, "item_id", "score"), digits=None),
                        min_n)
    named = lookup(stats, items, "item_id", "item_id", "title", default=default_title)
    out = named.select("item_id", "title", _rounded("avg_score", digits).alias("avg_score"),
                       "n_scores", F.col("avg_score").alias("__exact"))
    return out.orderBy(F.col("__exact").desc(), F.col("item_id").asc()).drop("__exact")


def ranking_with_summary(ratings: DataFrame, items: DataFrame, min_n: int,
                         default_title: str = UNKNOWN_TITLE, digits: int = 4) -> DataFrame:
    """#4 The ranking of #3 followed by the winner row, tagged by ``section``
    (UNION ALL, SET-1)."""
    stats = min_support(with_mean(score_stats(ratings, "item_id", "score"), digits=None),
                        min_n)
    named = lookup(stats, items, "item_id", "item_id", "title", default=default_title)
    rows = named.select(F.lit(0).alias("__part"), F.lit("ranking").alias("section"), "item_id", "title",
                        _rounded("avg_score", digits).alias("avg_score"), "n_scores",
                        F.col("avg_score").alias("__exact"))
    best = ranked(named, "avg_score", "item_id").limit(1).select(
        F.lit(1).alias("__part"), F.lit("best").alias("section"), "item_id", "title",
        _rounded("avg_score", digits).alias("avg_score"), "n_scores",
        F.col("avg_score").alias("__exact"))
    return rows.unionByName(best).orderBy("__part", F.col("__exact").desc(), "item_id") \
        .drop("__part", "__exact")


def tag_avg_score(ratings: DataFrame, items: DataFrame, default_tag: str | None = None,
                  digits: int = 4) -> DataFrame:
    """#5 / #6 Mean and count per tag of the item's multi-valued field.

    Facts are reduced per item, joined with the item tags, exploded, and the
    per-item ``(sum, n)`` are merged per tag (AGG-13): the explode multiplies
    one row per item, not one row per rating.  With ``default_tag`` the join
    is a left join and a fact whose item is unknown counts for that tag (#6).
    Duplicate tags of one item count twice.
    """
    stats = score_stats(ratings, "item_id", "score")
    # the same dimension row per key as the title lookups (smallest title)
    tags = dedupe_dimension(items.select("item_id", "title", "tags"), "item_id",
                            order_by="title").select("item_id", "tags")
    how = "inner" if default_tag is None else "left"
    joined = stats.join(tags, "item_id", how)
    exploded = explode_tags(joined, "tags", "tag", default=default_tag)
    return with_mean(merge_stats(exploded, "tag").filter(F.col(N) > 0), digits=digits)


def _wide(ratings: DataFrame, user_segments: DataFrame, items: DataFrame,
          segments: Sequence[str], names: Sequence[str], fill: float | None,
          digits: int | None, once: bool) -> DataFrame:
    rated = join_once_per_key(ratings, user_segments, "user_id") if once \
        else ratings.join(user_segments, "user_id", "inner")
    stats = conditional_stats(rated, "item_id", "segment", segments, "score", names)
    kept = _titles(items).join(stats, "item_id", "left")
    return conditional_means(kept, names, digits, fill)


def item_avg_by_segment_wide(ratings: DataFrame, users: DataFrame, items: DataFrame,
                             segments: Sequence[str], names: Sequence[str],
                             fill: float | None = None, digits: int = 4,
                             dedupe_users: bool = False) -> DataFrame:
    """#7 Per item of the dimension: the mean score of each fixed user segment
    as its own column (AGG-8); items without scores are kept with NULL (or
    ``fill``).

    The ratings join the users as a plain sort-merge join, so AQE can split
    the partition of a user key holding a large share of the ratings.
    ``dedupe_users=True`` keeps one segment per repeated user (a reducer that
    remembers one value per key); AQE cannot split that join, so heavy users
    are found and salted beforehand (:func:`join_once_per_key`).
    """
    return _wide(ratings, users.select("user_id", "segment"), items, segments, names, fill, digits,
                 dedupe_users)


def item_avg_by_segment_long(ratings: DataFrame, users: DataFrame, items: DataFrame,
                             default_title: str = UNKNOWN_LABEL,
                             digits: int = 4) -> DataFrame:
    """#8 One row per (item, segment) with its mean; title by lookup."""
    rated = ratings.join(users.select("user_id", "segment"), "user_id", "inner")
    stats = with_mean(score_stats(rated, ["item_id", "segment"], "score").filter(F.col(N) > 0),
                      digits=digits)
    named = lookup(stats, items, "item_id", "item_id", "title", default=default_title)
    return named.select("item_id", "segment", "avg_score", "title").orderBy("item_id", "segment")


def item_avg_by_band_wide(ratings: DataFrame, users: DataFrame, items: DataFrame,
                          edges: Sequence[float], labels: Sequence[str],
                          names: Sequence[str], digits: int = 4,
                          dedupe_users: bool = False) -> DataFrame:
    """#9 Right-closed bands of a numeric user attribute as columns; a band
    without scores is NULL (printed "NA" by the report).  ``dedupe_users``
    as in :func:`item_avg_by_segment_wide`."""
    ages = users.select("user_id", "age")
    if dedupe_users:       # the smallest age text, before it becomes a band
        ages = dedupe_dimension(ages, "user_id")
    banded = ages.select("user_id", band(F.col("age").try_cast("double"), edges, labels,
                                         closed="right").alias("segment"))
    return _wide(ratings, banded, items, labels, names, None, digits, dedupe_users)


def item_avg_by_band_long(ratings: DataFrame, users: DataFrame, items: DataFrame,
                          edges: Sequence[float], labels: Sequence[str],
                          default_band: str = UNKNOWN_LABEL,
                          default_title: str = UNKNOWN_LABEL, digits: int = 4) -> DataFrame:
    """#10 Left-closed bands (+ a default band for an unparseable attribute),
    one row per (item, band)."""
    banded = users.select("user_id", band(F.col("age").try_cast("double"), edges, labels,
                                          closed="left", default=default_band).alias("segment"))
    out = item_avg_by_segment_long(ratings, banded, items, default_title, digits)
    return out.withColumnRenamed("segment", "band")


def avg_score_by_two_hop_label(ratings: DataFrame, users: DataFrame, codes: DataFrame,
                               missing_user: str = UNKNOWN_LABEL, digits: int = 4) -> DataFrame:
    """#11 Mean and count per label reached user -> code -> name; an unknown
    code falls back to the code, an unknown user to ``missing_user``.

    Ratings are reduced per user before the first lookup and re-reduced per
    code before the second, so neither join sees a hot key."""
    per_user = score_stats(ratings, "user_id", "score")
    labelled = two_hop_lookup(per_user, "user_id", users, "user_id", "code",
                              codes, "code", "name", out="label", missing_user=missing_user,
                              measures=[SUM, N])
    stats = merge_stats(labelled, "label").filter(F.col(N) > 0)
    return with_mean(stats, digits=digits).orderBy(F.col("avg_score").desc(), "label")


def avg_score_by_epoch_year(ratings: DataFrame, default_year: str = UNKNOWN_LABEL,
                            digits: int = 4) -> DataFrame:
    """#12 Mean and count per calendar year (UTC) of an epoch-seconds text;
    text that is not an integer goes to ``default_year``."""
    yearly = ratings.select(epoch_year("ts_text", default_year).alias("year"), "score")
    return with_mean(score_stats(yearly, "year", "score").filter(F.col(N) > 0),
                     digits=digits).orderBy("year")
