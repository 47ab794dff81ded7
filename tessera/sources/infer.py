"""Column types of a delimited file with a header, from one distributed pass
that also counts its rows (SRC-10).

Each cell's text has a type: integer, long, decimal (a larger whole number),
double, date, timestamp, boolean or text.  A column's type is the least one
that holds all of them, so types form a lattice, and a column's state is the
set of types seen: one bit each, merged by ``bit_or`` in one aggregate over
the text, in any order and any number of tasks.

The result equals Spark's own inference, but for this.  Spark carries the
type so far from cell to cell, so a bare number such as ``2020`` in a column of
dates is a date if it comes after one in the same task and text if it comes
before.  Here it is always text.  Digits are ASCII ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(8))
_NUMBER = INT | LONG | DECIMAL | DOUBLE
#: digits that a whole number of these types may need when merged with a decimal
_DIGITS = {INT: 10, LONG: 20}


def _digits(c: Column) -> Column:
    """Significant digits of a whole number's text."""
    return F.greatest(F.lit(1), F.length(F.regexp_replace(c, r"^[+-]?0*|\.$", "")))


def cell_type(c: Column) -> Column:
    """The type of a cell's text as one bit; 0 for NULL."""
    whole = c.rlike(r"^[+-]?[0-9]+\z")
    # the cast reads these in any case of letters, the reader only as written here
    named = c.rlike(r"(?i)^\s*[+-]?(nan|inf|infinity)\s*\z")
    as_written = c.rlike(r"^\s*[+-]?(NaN|Infinity)\s*\z") | c.isin("Inf", "-Inf")
    return (F.when(c.isNull(), 0)
            .when(whole & c.try_cast("int").isNotNull(), INT)
            .when(whole & c.try_cast("bigint").isNotNull(), LONG)
            .when(c.rlike(r"^[+-]?[0-9]+\.?\z") & (_digits(c) <= 38), DECIMAL)
            .when(F.when(named, as_written).otherwise(c.try_cast("double").isNotNull()), DOUBLE)
            .when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & c.try_cast("date").isNotNull(), DATE)
            .when(c.try_cast("timestamp").isNotNull(), TIMESTAMP)
            .when(F.lower(c).isin("true", "false"), BOOLEAN)
            .otherwise(TEXT))


def merged_type(seen: int, digits: int | None, timestamp: DataType) -> DataType:
    """The type that holds all types of the set ``seen``; text for none."""
    if seen and not seen & ~_NUMBER:
        if seen & DOUBLE:
            return DoubleType()
        if seen & DECIMAL:
            need = max([digits or 1, *(n for bit, n in _DIGITS.items() if seen & bit)])
            return DecimalType(need, 0) if need <= 38 else DoubleType()
        return LongType() if seen & LONG else IntegerType()
    if seen == DATE:
        return DateType()
    if seen and not seen & ~(DATE | TIMESTAMP):
        return timestamp
    return BooleanType() if seen == BOOLEAN else StringType()


def infer_types(text: DataFrame) -> tuple[StructType, int]:
    """(schema, rows) of a table of text columns, by one aggregate."""
    names = text.columns
    cells = text.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    aggregates = []
    for k in range(len(names)):
        c = F.col(f"c{k}")
        kind = cell_type(c)
        aggregates += [F.bit_or(kind).alias(f"t{k}"),
                       F.max(F.when(kind == DECIMAL, _digits(c))).alias(f"d{k}")]
    row = cells.agg(F.count(F.lit(1)).alias("rows"), *aggregates).first()
    zoned = text.sparkSession.conf.get("spark.sql.timestampType", "TIMESTAMP_LTZ") != "TIMESTAMP_NTZ"
    stamp = TimestampType() if zoned else TimestampNTZType()
    return StructType([StructField(c, merged_type(row[f"t{k}"] or 0, row[f"d{k}"], stamp))
                       for k, c in enumerate(names)]), row["rows"]


def read_header_one_pass(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                         multi_line: bool = False) -> tuple[DataFrame, int]:
    """(table, rows): a file with a header under its inferred types, and its
    number of rows.  The inference runs at once, the read is lazy."""
    reader = spark.read.options(sep=sep, header="true", multiLine=str(multi_line).lower(),
                                quote='"', escape='"')
    schema, rows = infer_types(reader.csv(path))
    return reader.schema(schema).csv(path), rows
