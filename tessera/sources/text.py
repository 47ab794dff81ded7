"""Headerless positional text (SRC-1, SRC-2, SRC-4, SRC-5, SRC-9).

``spark.read.text`` keeps one row per line and splits large uncompressed
files across tasks; everything else is column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.strings import java_trim, split_java

VALID = "is_valid"


def parse_positional(lines: DataFrame, fields: Sequence[tuple[str, str]], min_fields: int,
                     sep: str = ",", limit: int = -1, trim_fields: bool = True,
                     line_col: str = "value") -> DataFrame:
    """Lines -> typed columns plus an ``is_valid`` flag.

    A line is valid when, after a Java-style trim, it is not blank, it has at
    least ``min_fields`` fields once trailing empty fields are dropped (Java
    ``split``), and every non-string field parses (``try_cast``).
    ``limit > 0`` keeps the rest of the line in the last field.
    """
    line = java_trim(line_col)
    parts = split_java(line, sep, limit)
    cols: list[Column] = []
    ok = (F.length(line) > 0) & (F.size(parts) >= F.lit(min_fields))
    for i, (name, dtype) in enumerate(fields):
        raw = F.try_element_at(parts, F.lit(i + 1))
        raw = java_trim(raw) if trim_fields else raw
        if dtype == "string":
            value = raw
        else:
            value = raw.try_cast(dtype)
            if i < min_fields:
                ok = ok & value.isNotNull()
        cols.append(value.alias(name))
    return lines.select(*cols, F.coalesce(ok, F.lit(False)).alias(VALID))


def read_delimited_tolerant(spark: SparkSession, path: str | Sequence[str],
                            fields: Sequence[tuple[str, str]], min_fields: int,
                            sep: str = ",", limit: int = -1,
                            trim_fields: bool = True) -> DataFrame:
    """Keep good rows, drop blank/short/unparseable ones (SRC-1/2, FLT-1..3)."""
    lines = spark.read.text(path)
    parsed = parse_positional(lines, fields, min_fields, sep, limit, trim_fields)
    return parsed.filter(F.col(VALID)).drop(VALID)


def malformed_count(spark: SparkSession, path: str | Sequence[str],
                    fields: Sequence[tuple[str, str]], min_fields: int,
                    sep: str = ",", limit: int = -1) -> DataFrame:
    """One row: how many lines the tolerant reader keeps and drops."""
    parsed = parse_positional(spark.read.text(path), fields, min_fields, sep, limit)
    return parsed.agg(F.count_if(F.col(VALID)).alias("kept"),
                      F.count_if(~F.col(VALID)).alias("malformed"))


def read_wordlist(spark: SparkSession, path: str | Sequence[str],
                  col: str = "stopword") -> DataFrame:
    """One word per line (SRC-9): trimmed, non-empty, distinct."""
    words = spark.read.text(path).select(java_trim("value").alias(col))
    return words.filter(F.length(col) > 0).distinct()
