"""Multi-valued fields (SHP-1, UDF-4, UDF-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_tags(df: DataFrame, tags: str | Column, out: str = "tag",
                 default: str | None = None) -> DataFrame:
    """One row per tag (duplicates kept).

    ``default`` replaces a missing (NULL) tag array, e.g. a fact whose item
    is absent from the dimension after a left join.
    """
    arr = F.col(tags) if isinstance(tags, str) else tags
    if default is not None:
        arr = F.coalesce(arr, F.array(F.lit(default)))
    drop = [tags] if isinstance(tags, str) else []
    return df.select("*", F.explode(arr).alias(out)).drop(*drop)
