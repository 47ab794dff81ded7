"""Table profiles (SNK-6, AGG-4): schema report and distinct-entity counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: name, position, Spark type, nullability, non-NULL
    count and exact distinct count.

    Each column is its own single-distinct aggregate (a two-level hash
    aggregate, no ``Expand``) reading only that column from a columnar scan;
    the branches are combined with ``unionByName``.
    """
    cols = list(columns or df.columns)
    fields = {f.name: f for f in df.schema.fields}
    parts = []
    for pos, name in enumerate(cols, start=1):
        f = fields[name]
        parts.append(df.select(name).agg(
            F.count(F.col(name)).alias("non_null"),
            F.count_distinct(F.col(name)).alias("n_distinct"),
        ).select(
            F.lit(name).alias("column_name"),
            F.lit(pos).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(bool(f.nullable)).alias("nullable"),
            F.col("non_null").cast("bigint").alias("non_null"),
            F.col("n_distinct").cast("bigint").alias("n_distinct"),
        ))
    return reduce(DataFrame.unionByName, parts)


def entity_counts(entities: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Exact distinct count per (name, table, column): one row per entity.

    Each branch is its own aggregate; no cross join combines them.
    """
    parts = [df.agg(F.count_distinct(F.col(col)).cast("bigint").alias("n"))
             .select(F.lit(name).alias("entity"), "n")
             for name, df, col in entities]
    return reduce(DataFrame.unionByName, parts)
