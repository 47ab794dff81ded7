"""Sinks (SNK-1..4, SNK-2 materialisation)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path


def write_key_value_text(df: DataFrame, key: str, value: str, path: str,
                         mode: str = "errorifexists") -> None:
    """``key<TAB>value`` part files (SNK-1).  NULL is written as an empty field;
    a field that holds a tab or a line break fails the job, as it could not be
    read back."""
    parts = [_plain(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]", c)
             for c in (key, value)]
    (df.select(F.concat(parts[0], F.lit("\t"), parts[1]).alias("value"))
     .write.mode(mode).text(path))


def _plain(col, forbidden: str, name: str):
    """The column, or an error where it matches ``forbidden``."""
    return F.when(col.rlike(forbidden), F.raise_error(
        F.lit(f"column {name} holds a separator or a line break"))).otherwise(col)


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = False,
                    quoted: bool = False, mode: str = "errorifexists",
                    partition_by: Sequence[str] | None = None) -> None:
    """``;``/``,`` delimited part files (SNK-3). ``quoted`` writes a quoted
    multi-line-safe CSV readable by ``read_quoted_multiline``: fields holding
    the separator, a quote or a line break are quoted, an empty string is
    written as ``""`` and NULL as nothing.  ``partition_by`` writes one
    ``col=value`` folder per value in a single pass over ``df``."""
    if not quoted:
        stop = "[" + re.escape(sep) + "\r\n]"
        df = df.select(*[_plain(F.col(f"`{c}`"), stop, c).alias(c) if kind == "string" else f"`{c}`"
                         for c, kind in df.dtypes])
    w = df.write.mode(mode).option("sep", sep).option("header", str(header).lower())
    w = w.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if quoted:
        w = w.option("quote", '"').option("escape", '"')
    else:
        # empty strings are written as nothing, like NULL, and read back as NULL
        w = w.option("quote", "\u0000").option("emptyValue", "")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_report(lines: DataFrame, path: str, single_file: bool = False,
                 mode: str = "errorifexists") -> None:
    """Formatted text lines (SNK-4).

    ``single_file`` funnels the rows through one task and is meant only for
    small, already aggregated reports.
    """
    df = lines.coalesce(1) if single_file else lines
    df.write.mode(mode).text(path)


def materialize(df: DataFrame, spark: SparkSession, name: str,
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared checkpoint folder and read it back
    (SNK-2): a reusable stage that cuts lineage and survives executor loss."""
    path = scratch_path(spark, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
