"""Quoted multi-line CSV read in parallel within each file (SRC-7).

Spark reads a multi-line CSV file in one task, as a record may begin anywhere
and only the quotes before a byte tell whether it lies inside a field.  Here a
file is read as physical lines, which Spark's text source splits into byte
ranges, and three steps make records of them:

1. Every range is read under both hypotheses, its first line beginning inside
   or outside a quoted field, and tells where it ends under each and whether a
   record begins in it.  That is one small row per range.
2. A window over each file's ranges composes these in order (a range that ends
   alike under both settles the state, one that swaps it is counted), so every
   range gets its true first state and the range in which the record that is
   open at its beginning began.
3. The ranges are read again, cut into records at the lines that begin outside
   a field, and parsed by Spark's own CSV parser (``from_csv``).  Only pieces of
   records that cross a range border are shuffled, to be put together.

The rows of step 1 are broadcast while there are at most ``BROADCAST_RANGES``;
beyond, lines are dealt by range and sorted back into order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.csv import quoted_options
from tessera.sources.writers import materialize

BROADCAST_RANGES = 1_000_000


class LineStates:
    """Whether a quoted field is open after a physical line, for either state before it."""

    def __init__(self, sep: str) -> None:
        if len(sep) != 1 or sep in '"\r\n':
            raise ValueError(f"separator {sep!r}: one character that is no quote or line break")
        s = re.escape(sep)
        # after the closing quote: the separator, or text up to it (as the parser has it)
        rest = f'(?:[^"{s}][^{s}]*)?'
        field = f'(?:"[^"]*(?:""[^"]*)*"{rest}|[^"{s}][^{s}]*)?'
        left_open = f'(?:{field}{s})*"[^"]*(?:""[^"]*)*$'
        self.outside = f"^{left_open}"
        self.inside = f'^[^"]*(?:""[^"]*)*(?:$|"{rest}{s}{left_open})'

    def after(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(open after a line begun outside, open after a line begun inside)."""
        return tuple(pc.match_substring_regex(lines, p).to_numpy(zero_copy_only=False)
                     for p in (self.outside, self.inside))

    def before(self, lines: pa.Array, state: bool) -> tuple[np.ndarray, bool]:
        """Whether a field is open before each line, and after the last one."""
        out, ins = self.after(lines)
        settles = out == ins
        swaps = np.cumsum(out & ~ins)
        at = np.maximum.accumulate(np.where(settles, np.arange(len(out)), -1))
        known = np.maximum(at, 0)
        after = np.where(at >= 0, out[known] ^ (((swaps - swaps[known]) & 1) == 1),
                         state ^ ((swaps & 1) == 1))
        return np.concatenate(([state], after[:-1])), bool(after[-1])


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file, range, line: physical lines without their line feed, each with its byte range's start."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("range"),
                    F.col("value").cast("binary").alias("line")))


def _runs(batch: pa.RecordBatch):
    """(file, range, first row, end row) of the ranges of a batch."""
    file, start = (batch.column(k).to_numpy() for k in (0, 1))
    new = np.flatnonzero(np.concatenate(([True], (file[1:] != file[:-1]) | (start[1:] != start[:-1]))))
    for a, b in zip(new.tolist(), [*new.tolist()[1:], len(file)]):
        yield int(file[a]), int(start[a]), a, b


_RANGE = ("file bigint, range bigint, if_outside boolean, if_inside boolean, "
          "starts_outside boolean, starts_inside boolean, crlf boolean")


def _range_states(lines: DataFrame, states: LineStates) -> DataFrame:
    """One row per range: the state at its end, and whether a record begins in
    it, under either state at its beginning; whether its first line ends in CR."""
    def run(batches):
        now = None

        def row():
            (file, start), ends, starts, crlf = now
            return pa.RecordBatch.from_pylist([{
                "file": file, "range": start, "if_outside": ends[0], "if_inside": ends[1],
                "starts_outside": starts[0], "starts_inside": starts[1], "crlf": crlf}], schema)

        schema = pa.schema([("file", pa.int64()), ("range", pa.int64())] + [
            (k, pa.bool_()) for k in ("if_outside", "if_inside", "starts_outside", "starts_inside", "crlf")])
        for batch in batches:
            if not batch.num_rows:
                continue
            for file, start, a, b in _runs(batch):
                part = batch.column(2).slice(a, b - a)
                if now is None or now[0] != (file, start):
                    if now is not None:
                        yield row()
                    now = ((file, start), [False, True], [False, False], part[0].as_py().endswith(b"\r"))
                blank = _blank(part)
                for k in (0, 1):
                    before, now[1][k] = states.before(part, now[1][k])
                    now[2][k] = now[2][k] or bool((~before & ~blank).any())
        if now is not None:
            yield row()

    return lines.mapInArrow(run, _RANGE)


def _blank(lines: pa.Array) -> np.ndarray:
    return pc.is_in(lines, pa.array([b"", b"\r"], pa.binary())).to_numpy(zero_copy_only=False)


def _composed(ranges: DataFrame) -> DataFrame:
    """file, range, inside (the state at its beginning), owner (the range in which
    the record open there began), crlf (of the file's first line)."""
    own = Window.partitionBy("file").orderBy("range")
    up_to = own.rowsBetween(Window.unboundedPreceding, 0)
    earlier = own.rowsBetween(Window.unboundedPreceding, -1)
    swap = F.col("if_outside") & ~F.col("if_inside")
    settled = F.when(F.col("if_outside") == F.col("if_inside"),
                     F.struct(F.col("if_outside").alias("state"), F.col("swaps").alias("swaps")))
    odd = F.when(F.col("last").isNull(), F.col("before") % 2 == 1).otherwise(
        F.col("last.state") != ((F.col("before") - F.col("last.swaps")) % 2 == 1))
    return (ranges.withColumn("swaps", F.sum(swap.cast("long")).over(up_to))
            .withColumn("before", F.coalesce(F.sum(swap.cast("long")).over(earlier), F.lit(0)))
            .withColumn("last", F.last(settled, ignorenulls=True).over(earlier))
            .withColumn("inside", odd)
            .withColumn("starts", F.when(F.col("inside"), F.col("starts_inside"))
                        .otherwise(F.col("starts_outside")))
            .withColumn("owner", F.last(F.when(F.col("starts"), F.col("range")), ignorenulls=True).over(earlier))
            .withColumn("crlf", F.first("crlf").over(up_to))
            .select("file", "range", "inside", "owner", "crlf"))


_PIECE = "file bigint, owner bigint, range bigint, whole boolean, first boolean, crlf boolean, record binary"


def _pieces(lines: DataFrame, states: LineStates) -> DataFrame:
    """Records, and pieces of those that cross a border.  ``first``: the file's first."""
    names = ["file", "owner", "range", "whole", "first", "crlf", "record"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    class Cut:
        """The record that is open at the place reached in a range."""

        def __init__(self, file, start, inside, owner, crlf) -> None:
            self.file, self.start, self.owner, self.crlf = file, start, owner, crlf
            self.state, self.lines, self.here = inside, [], not inside
            self.unseen = owner is None      # no record of the file has begun before

        def take(self) -> list[tuple]:
            """The open record, complete in what is known of its end."""
            if not self.lines:
                return []
            record = b"\n".join(self.lines)
            blank = self.here and record in (b"", b"\r")
            first = self.here and self.unseen and not blank
            self.unseen = self.unseen and not first
            row = (self.file, self.start if self.here else self.owner, self.start, self.here, first,
                   self.crlf, record)
            self.lines, self.here = [], True
            return [] if blank else [row]

        def end(self) -> list[tuple]:
            rows = self.take()
            # left open: the rest is in the ranges that follow
            return [(*r[:3], r[3] and not self.state, *r[4:]) for r in rows]

    def run(batches):
        now, key = None, None
        for batch in batches:
            rows: list[tuple] = []
            for file, start, a, b in _runs(batch) if batch.num_rows else ():
                if key != (file, start):
                    rows += now.end() if now is not None else []
                    key = file, start
                    now = Cut(file, start, *(batch.column(k)[a].as_py() for k in (3, 4, 5)))
                part = batch.column(2).slice(a, b - a)
                before, now.state = states.before(part, now.state)
                begin = np.flatnonzero(~before)
                text = part.to_pylist()
                edges = [0, *begin.tolist(), len(text)]
                now.lines += text[:edges[1]]
                for s, e in zip(edges[1:-1], edges[2:]):
                    rows += now.take()
                    now.lines = text[s:e]
            yield batch_of(rows)
        if now is not None:
            yield batch_of(now.end())

    return lines.mapInArrow(run, _PIECE)


def split_records(spark: SparkSession, path: str | Sequence[str], sep: str = ";") -> DataFrame:
    """first, record: the CSV records of the files as text; ``first`` marks each file's first."""
    states = LineStates(sep)
    lines = _lines(spark, path)
    ranges = materialize(_composed(_range_states(lines, states)), spark, "csv-ranges")
    known = ranges.withColumn("known", F.lit(True))
    if ranges.count() <= BROADCAST_RANGES:
        joined = lines.join(F.broadcast(known), ["file", "range"], "left")
    else:
        joined = (lines.withColumn("place", F.monotonically_increasing_id())
                  .join(known, ["file", "range"], "left").repartition("file", "range")
                  .sortWithinPartitions("file", "range", "place"))
    checked = F.when(F.col("known").isNull(), F.raise_error(F.lit(
        "the file is split otherwise than when the reader was made"))).otherwise(F.col("inside"))
    pieces = _pieces(joined.select("file", "range", "line", checked.alias("inside"), "owner", "crlf"), states)
    whole = pieces.where("whole").select("first", "crlf", F.col("record").cast("string").alias("record"))
    crossing = (pieces.where("NOT whole").groupBy("file", "owner").agg(
        F.max("first").alias("first"), F.first("crlf").alias("crlf"),
        F.sort_array(F.collect_list(F.struct("range", F.col("record").cast("string").alias("record"))))
        .alias("parts"))
        .select("first", "crlf", F.array_join(F.col("parts.record"), "\n").alias("record")))
    plain = F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")
    return whole.unionByName(crossing).select(
        "first", F.when(F.col("crlf"), plain).otherwise(F.col("record")).alias("record"))


def read_quoted_split(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
                      sep: str = ";", header: bool = True) -> DataFrame:
    """:func:`~tessera.sources.csv.read_quoted_multiline`, with many tasks per file.

    The rows are the same; their order is not kept.  Line ends are LF, or CRLF
    as told by the first line of a file (then also inside fields, as Spark
    reads them).  A job runs when the reader is made, and the files have to be
    read under the split settings of that moment (checked).
    """
    records = split_records(spark, path, sep)
    if header:
        records = records.where("NOT first")
    else:
        records = records.withColumn("record", F.when(F.col("first"), F.regexp_replace(
            "record", "^﻿", "")).otherwise(F.col("record")))
    fields = spark.createDataFrame([], schema).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    options = quoted_options(sep) | {"lineSep": "\n"}
    return records.select(F.from_csv("record", ddl, options).alias("row")).select(
        *[F.col("row").getField(f.name).alias(f.name) for f in fields])
