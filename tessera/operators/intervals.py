"""Range joins as equi-joins: intervals in cells of their own size.

An interval [start, end) of whole numbers lies in at most two cells of the
smallest power of two that is not below its length (its level).  A point lies
in one cell of every level, so it probes the levels in use: at most 64, in
practice those of the lengths that occur, found by one small aggregate.  Point
and interval then meet by (keys, level, cell), in one cell only, and their
bounds are compared exactly.  Long intervals are cheap (few cells of a high
level), so neither side is copied in proportion to length and nothing is
compared across cells.  Two intervals meet at the larger of their levels; the
cell that holds the later of the two starts gives the pair.

The join is a plain equi-join after the cells: Spark chooses the strategy, and
AQE splits a cell in which many rows meet.  Empty and reversed intervals, and
nulls in keys or bounds, match nothing; equal rows match row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _packed(df: DataFrame, keys: Sequence[str], start: Column, end: Column, row: str) -> DataFrame:
    """k0.., s, e and the row as a struct, of the rows that can match."""
    plain = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    rows = df.select(*plain, start.cast("bigint").alias(f"{row}_s"), end.cast("bigint").alias(f"{row}_e"),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row))
    known = F.col(f"{row}_s") < F.col(f"{row}_e")       # null bounds too: not true
    for i in range(len(keys)):
        known = known & F.col(f"k{i}").isNotNull()
    rows = rows.where(known)
    length = F.col(f"{row}_e") - F.col(f"{row}_s")
    # the smallest level with 2^level >= length: the bits of length - 1
    bits = F.when(length == 1, F.lit(0)).otherwise(F.length(F.bin(length - 1)))
    return rows.withColumn(f"{row}_level", bits.cast("int"))


def _levels(rows: DataFrame, level: str) -> list[int]:
    """Levels in use: at most 64 numbers."""
    return sorted(r[0] for r in rows.select(level).distinct().collect())


def _in_cells(rows: DataFrame, row: str, level: Column) -> DataFrame:
    """One row per cell of ``level`` that the interval lies in."""
    first, last = F.col(f"{row}_s"), F.col(f"{row}_e") - 1
    return (rows.withColumn("level", level)
            .withColumn("cell", F.explode(F.sequence(F.call_function("shiftright", first, F.col("level")),
                                                     F.call_function("shiftright", last, F.col("level"))))))


def _unpacked(pairs: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    names = {c: prefix + c for c in right.columns if c not in keys}
    clash = sorted(set(names.values()) & set(left.columns))
    if clash:
        raise ValueError(f"both sides give {clash}; choose another prefix")
    return pairs.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns],
                        *[F.col(f"r.`{c}`").alias(n) for c, n in names.items()])


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 left_bounds: tuple[Column, Column], right_bounds: tuple[Column, Column],
                 prefix: str = "right_") -> DataFrame:
    """Pairs of rows of equal ``keys`` (may be none) whose intervals [start, end) overlap.

    Bounds are columns of whole numbers.  The left columns come out as they
    are, the right ones other than the keys under ``prefix``.
    """
    a, b = (_packed(left, keys, *left_bounds, "l"), _packed(right, keys, *right_bounds, "r"))
    ks = [f"k{i}" for i in range(len(keys))]

    def raised(rows: DataFrame, row: str, levels: list[int], above: bool) -> DataFrame:
        """The interval in cells of each level in use on the other side that is not lower
        (``above``: higher) than its own."""
        own = F.col(f"{row}_level")
        wide = F.filter(F.array(*[F.lit(v) for v in levels]).cast("array<int>"),
                        lambda v: (v > own) if above else (v >= own))
        return _in_cells(rows.withColumn("__up", F.explode(wide)), row, F.col("__up")).drop("__up")

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        later = F.greatest("l_s", "r_s")
        return (x.join(y, [*ks, "level", "cell"])
                .where((F.col("l_s") < F.col("r_e")) & (F.col("r_s") < F.col("l_e"))
                       & (F.call_function("shiftright", later, F.col("level")) == F.col("cell")))
                .select("l", "r"))

    pairs = met(raised(a, "l", _levels(b, "r_level"), False), _in_cells(b, "r", F.col("r_level"))).unionAll(
        met(_in_cells(a, "l", F.col("l_level")), raised(b, "r", _levels(a, "l_level"), True)))
    return _unpacked(pairs, left, right, keys, prefix)


def point_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], point: Column,
               bounds: tuple[Column, Column], prefix: str = "right_") -> DataFrame:
    """Pairs of a point and an interval [start, end) of equal ``keys`` that holds it."""
    a = _packed(points, keys, point, point + 1, "l")
    b = _packed(intervals, keys, *bounds, "r")
    ks = [f"k{i}" for i in range(len(keys))]
    levels = F.array(*[F.lit(v) for v in _levels(b, "r_level")]).cast("array<int>")
    probes = a.withColumn("level", F.explode(levels)).withColumn(
        "cell", F.call_function("shiftright", F.col("l_s"), F.col("level")))
    pairs = (probes.join(_in_cells(b, "r", F.col("r_level")), [*ks, "level", "cell"])
             .where((F.col("r_s") <= F.col("l_s")) & (F.col("l_s") < F.col("r_e"))).select("l", "r"))
    return _unpacked(pairs, points, intervals, keys, prefix)
