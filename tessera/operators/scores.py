"""Grouped score statistics (AGG-1, AGG-8, AGG-9, AGG-13, FLT-9).

Means are carried as ``(score_sum, score_n)`` so that they can be computed at
the finest grain first (pre-aggregation before a join or an explode) and
merged later: the mean of a tag equals the sum of its items' sums over the
sum of their counts.  Every ``groupBy`` here is split by Catalyst into a
partial and a final aggregate, so a hot key is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM = "score_sum"
N = "score_n"


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def score_stats(df: DataFrame, keys: str | Sequence[str], score: str | Column) -> DataFrame:
    """``(keys..., score_sum, score_n)``; NULL scores are ignored."""
    s = F.col(score) if isinstance(score, str) else score
    return df.groupBy(*_as_list(keys)).agg(F.sum(s).alias(SUM), F.count(s).alias(N))


def merge_stats(stats: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Re-aggregate partial ``(score_sum, score_n)`` rows to a coarser key."""
    return stats.groupBy(*_as_list(keys)).agg(F.sum(SUM).alias(SUM), F.sum(N).alias(N))


def with_mean(stats: DataFrame, avg_col: str = "avg_score", n_col: str = "n_scores",
              digits: int | None = 4) -> DataFrame:
    """Finish ``(score_sum, score_n)`` into a mean and a count column."""
    mean = F.col(SUM) / F.col(N)
    if digits is not None:
        mean = F.round(mean, digits)
    keep = [c for c in stats.columns if c not in (SUM, N)]
    return stats.select(*keep, mean.alias(avg_col), F.col(N).cast("bigint").alias(n_col))


def mean_by(df: DataFrame, keys: str | Sequence[str], score: str | Column,
            avg_col: str = "avg_score", n_col: str = "n_scores",
            digits: int | None = 4) -> DataFrame:
    """Mean and count of ``score`` per key (AGG-1)."""
    return with_mean(score_stats(df, keys, score), avg_col, n_col, digits)


def min_support(df: DataFrame, min_n: int, n_col: str = "n_scores") -> DataFrame:
    """HAVING count >= k (FLT-9)."""
    return df.filter(F.col(n_col) >= F.lit(min_n))


def ranked(df: DataFrame, avg_col: str, tie_break: str | Sequence[str]) -> DataFrame:
    """Sorted by mean descending; the key breaks ties (SRT-1)."""
    return df.orderBy(F.col(avg_col).desc(), *[F.col(c).asc() for c in _as_list(tie_break)])


def best_with_support(df: DataFrame, min_n: int, avg_col: str, n_col: str,
                      tie_break: str | Sequence[str]) -> DataFrame:
    """Top-1 mean among rows with at least ``min_n`` scores (AGG-9).

    ``orderBy().limit(1)`` is planned as ``TakeOrderedAndProject``: each task
    keeps its best row, the driver merges one row per task.  No qualifying
    row -> empty result.
    """
    return ranked(min_support(df, min_n, n_col), avg_col, tie_break).limit(1)


def conditional_stats(df: DataFrame, keys: str | Sequence[str], category: str | Column,
                      values: Sequence[str], score: str | Column,
                      names: Sequence[str]) -> DataFrame:
    """Per key and per fixed category value: partial (sum, n) columns (AGG-8).

    One aggregate with ``sum(when(cat == v, x))`` per value: a single shuffle,
    unlike ``pivot`` which plans two aggregate stages.
    """
    cat = F.col(category) if isinstance(category, str) else category
    s = F.col(score) if isinstance(score, str) else score
    aggs = []
    for v, name in zip(values, names):
        hit = F.when(cat == F.lit(v), s)
        aggs += [F.sum(hit).alias(f"{name}__sum"), F.count(hit).alias(f"{name}__n")]
    return df.groupBy(*_as_list(keys)).agg(*aggs)


def conditional_means(stats: DataFrame, names: Sequence[str], digits: int | None = 4,
                      fill: float | None = None) -> DataFrame:
    """Finish :func:`conditional_stats` into one mean column per category.

    A category without scores is NULL (or ``fill`` when given).
    """
    out = stats
    for name in names:
        mean = F.when(F.col(f"{name}__n") > 0, F.col(f"{name}__sum") / F.col(f"{name}__n"))
        if digits is not None:
            mean = F.round(mean, digits)
        if fill is not None:
            mean = F.coalesce(mean, F.lit(float(fill)))
        out = out.withColumn(name, mean).drop(f"{name}__sum", f"{name}__n")
    return out
