"""Top-k (LIM-1, WIN-1, WIN-2). A tie-break column is mandatory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """Global top-k: planned as ``TakeOrderedAndProject`` (per-task top-k, then
    a k-row merge) - no full sort, no single-partition shuffle of all rows."""
    return df.orderBy(*_cols(order)).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                    k: int, rank_col: str | None = None) -> DataFrame:
    """Top-k rows per group via ``row_number``.

    Catalyst adds a partial ``WindowGroupLimit`` before the exchange, so a
    group holding most rows ships at most k rows per map task.
    """
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    ranked = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    if rank_col:
        return ranked.withColumnRenamed("__rn", rank_col)
    return ranked.drop("__rn")
