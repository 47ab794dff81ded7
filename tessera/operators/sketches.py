"""A mergeable sketch of a distribution: counts of log-linear buckets.

A whole number is put into the bucket of its leading ``bits`` + 1 binary
digits, and the bucket is named by the number nearest to zero in it.  So a
value read from the sketch has its sign and is nearer to zero by less than
2^-``bits`` of itself (exact below 2^(``bits`` + 1)); its rank is exact.  A sketch has at most
2 * 64 * 2^``bits`` rows a key, whatever the key's rows: they are combined in
each task, sketches are stored as tables, and merging is adding counts, in any
order and grouping.  Nothing is random.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def bucket(value: Column, bits: int) -> Column:
    """The bucket of a whole number of less than 63 binary digits."""
    size = F.abs(value.cast("long"))
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - (bits + 1))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)
    return F.when(value < 0, -low).otherwise(low)


def sketch(df: DataFrame, keys: Sequence[str], value: str, bits: int = 7) -> DataFrame:
    """keys, ``bucket`` and ``n``; null values are left out, null keys are a key of their own."""
    if not 0 <= bits <= 20:
        raise ValueError(f"bits = {bits}")
    known = df.where(F.col(f"`{value}`").isNotNull())
    return (known.groupBy(*_names(keys), bucket(F.col(f"`{value}`"), bits).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merged(sketches: DataFrame | Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One sketch per key out of one or more tables of sketches (of equal ``bits``), finer keys included."""
    if not isinstance(sketches, DataFrame):
        sketches = reduce(DataFrame.unionByName, [s.select(*_names(keys), "bucket", "n") for s in sketches])
    return sketches.groupBy(*_names(keys), "bucket").agg(F.sum("n").alias("n"))


def sketched_percentiles(sketches: DataFrame, keys: Sequence[str], fractions: Mapping[str, float]) -> DataFrame:
    """Per key its count ``n`` and, per name, the bucket of the value at place
    ceil(fraction * n) (at least 1): the exact percentile within the sketch's error."""
    by = Window.partitionBy(*_names(keys)).orderBy("bucket")
    upto, whole = F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, 0)), F.sum("n").over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = merged(sketches, keys).withColumn("__upto", upto).withColumn("__total", whole)
    place = {n: F.greatest(F.lit(1), F.ceil(F.lit(float(f)) * F.col("__total"))) for n, f in fractions.items()}
    return (rows.groupBy(*_names(keys))
            .agg(F.max("__total").alias("__n"),
                 *[F.min(F.when(F.col("__upto") >= p, F.col("bucket"))).alias(n) for n, p in place.items()])
            .withColumnRenamed("__n", "n"))
