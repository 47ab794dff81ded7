"""Ordered work per key in which a key may hold any share of the rows.

A window partitioned by key puts all rows of a key into one task.  Here the
rows are range partitioned by (key, order) and written once with the number of
their range (``__part``), so a hot key is spread over as many ranges as it
fills.  Windows run per (range, key); what a row needs from other ranges comes
from a small table: only the first and the last key of a range can go on in
another one, so that table has at most two rows a range, whatever the data.

Costs: one range shuffle (with Spark's sampling of its bounds), one written
copy of the columns in use, one shuffle by (range, key) for the windows.

Rows that are equal in key and order columns are taken in the order of a hash
of all their columns, so results do not depend on how tasks were dealt; fully
equal rows may end up in different ranges and are interchangeable.  Null keys
form a group of their own; nulls in order columns come first, or last in
descending order.  Empty inputs give empty results.  Columns whose
names begin with two underscores are reserved for the helpers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.writers import materialize

PART = "__part"
_TIE = "__tie"
_AT = "__at"
#: lag/lead offsets up to which the rows at the ends of ranges are broadcast
SMALL_OFFSET = 8


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _meet(rows: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` joined to ``small`` on equal (or both null) columns ``on``; small's copies go."""
    renamed = small.select(*[F.col(f"`{c}`").alias(f"__on{on.index(c)}" if c in on else c)
                             for c in small.columns])
    cond = F.lit(True)
    for i, c in enumerate(on):
        cond = cond & F.col(f"`{c}`").eqNullSafe(F.col(f"__on{i}"))
    return rows.join(renamed, cond, how).drop(*[f"__on{i}" for i in range(len(on))])


@dataclass(frozen=True)
class Ordered:
    """Rows written by range of (keys, order); see :func:`in_ranges`."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    descending: bool
    edges: DataFrame            # the first and the last key of each range

    @property
    def _place(self) -> list[Column]:
        return _quoted([*self.order, _TIE])

    @property
    def _local(self):
        by = [c.desc_nulls_last() if self.descending else c.asc_nulls_first() for c in self._place]
        return Window.partitionBy(PART, *_quoted(self.keys)).orderBy(*by)

    def _with(self, rows: DataFrame) -> Ordered:
        return replace(self, rows=rows)

    @property
    def _whole(self):
        return self._local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def _edge_rows(self) -> DataFrame:
        """Rows of the keys that are first or last in some range (at most two keys a range)."""
        return _meet(self.rows, F.broadcast(self.edges), self.keys, "left_semi")

    def _spread(self, rows: DataFrame, per_range: DataFrame, merged: Mapping[str, Column]) -> DataFrame:
        """``rows`` with ``merged``: window results over a key's rows of ``per_range``."""
        small = per_range.select(PART, *_quoted(self.keys), *[c.alias(n) for n, c in merged.items()])
        return _meet(rows, F.broadcast(small), [PART, *self.keys])     # at most two rows a range

    def _ranges_before(self):
        return (Window.partitionBy(*_quoted(self.keys)).orderBy(PART)
                .rowsBetween(Window.unboundedPreceding, -1))

    def _other_ranges(self):
        return (Window.partitionBy(*_quoted(self.keys)).orderBy(PART)
                .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))

    def running(self, measures: Mapping[str, tuple[str, str | Column]], own: bool = True) -> Ordered:
        """Adds running measures, each row included unless not ``own``: name -> (function, column).

        Functions: ``sum``, ``count``, ``min``, ``max`` and ``last`` (the
        latest non-null value).  Nulls are skipped; a sum, min, max or last of
        nothing is null.  Sums of doubles depend on the ranges in their last
        bits; integers and decimals do not.
        """
        upto = self._local.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
        before = self._ranges_before()
        local, whole, merged, out = {}, {}, {}, {}
        for i, (name, (kind, column)) in enumerate(measures.items()):
            c = F.col(f"`{column}`") if isinstance(column, str) else column
            mine, far = f"__l{i}", f"__m{i}"
            if kind in ("sum", "count", "min", "max"):
                fn = getattr(F, kind)
                local[mine], whole[far] = fn(c).over(upto), fn(c)
            elif kind == "last":
                local[mine] = F.last(c, ignorenulls=True).over(upto)
                by = F.when(c.isNotNull(), F.struct(*self._place))
                whole[far] = (F.min_by if self.descending else F.max_by)(c, by)
            else:
                raise ValueError(f"no running {kind!r}")
            a, b = F.col(mine), F.col(far)
            if kind in ("sum", "count"):
                merged[far] = F.sum(far).over(before)
                out[name] = F.coalesce(a + b, a, b)
            elif kind == "last":
                merged[far] = F.last(far, ignorenulls=True).over(before)
                out[name] = F.coalesce(a, b)
            else:
                merged[far] = getattr(F, kind)(far).over(before)
                out[name] = (F.least if kind == "min" else F.greatest)(a, b)
        names = [c for c in self.rows.columns if c not in measures]
        ends = (self._edge_rows().groupBy(PART, *_quoted(self.keys))
                .agg(*[c.alias(n) for n, c in whole.items()]))
        rows = self.rows.select("*", *[c.alias(n) for n, c in local.items()])
        rows = self._spread(rows, ends, merged)
        return self._with(rows.select(*_quoted(names), *[c.alias(n) for n, c in out.items()]))

    def shifted(self, measures: Mapping[str, tuple[str, int]]) -> Ordered:
        """Adds values of other rows of the key: name -> (column, offset); an offset
        below zero is a lag, above zero a lead.  Null where there is no such row."""
        reach = max(abs(k) for _, k in measures.values())

        def moved(column: str, k: int, over) -> Column:
            c = F.col(f"`{column}`")
            return F.lag(c, -k).over(over) if k < 0 else F.lead(c, k).over(over)

        def placed(rows: DataFrame) -> DataFrame:
            return rows.select("*", F.row_number().over(self._local).alias(_AT),
                               F.count(F.lit(1)).over(self._whole).alias("__n"))

        # the first and last rows of a key in each range: between two of them that are within
        # reach of a range's end no row is missing, so shifting among them alone is exact
        ends = placed(self._edge_rows()).where((F.col(_AT) <= reach) | (F.col("__n") - F.col(_AT) < reach))
        among = Window.partitionBy(*_quoted(self.keys)).orderBy(PART, _AT)
        far = ends.select(PART, *_quoted(self.keys), _AT, F.lit(True).alias("__end"),
                          *[moved(c, k, among).alias(f"__f{i}") for i, (c, k) in enumerate(measures.values())])
        if reach <= SMALL_OFFSET:
            far = F.broadcast(far)          # at most 4 * SMALL_OFFSET rows a range
        names = [c for c in self.rows.columns if c not in measures]
        rows = placed(self.rows).select("*", *[moved(c, k, self._local).alias(f"__l{i}")
                                               for i, (c, k) in enumerate(measures.values())])
        rows = _meet(rows, far, [PART, *self.keys, _AT])
        out = []
        for i, (name, (_, k)) in enumerate(measures.items()):
            outside = F.col(_AT) <= -k if k < 0 else F.col("__n") - F.col(_AT) < k
            out.append(F.when(F.col("__end") & outside, F.col(f"__f{i}"))
                       .otherwise(F.col(f"__l{i}")).alias(name))
        return self._with(rows.select(*_quoted(names), *out))

    def ranked(self, rank: str = "rank", total: str | None = None) -> Ordered:
        """Adds each row's place in its key, from 1, and the key's row count."""
        ends = self._edge_rows().groupBy(PART, *_quoted(self.keys)).agg(F.count(F.lit(1)).alias("__m"))
        rows = self.rows.select("*", F.row_number().over(self._local).alias(_AT),
                                F.count(F.lit(1)).over(self._whole).alias("__n"))
        rows = self._spread(rows, ends, {"__before": F.sum("__m").over(self._ranges_before()),
                                         "__all": F.sum("__m").over(self._other_ranges())})
        out = [(F.col(_AT) + F.coalesce("__before", F.lit(0))).alias(rank)]
        if total:
            out.append(F.coalesce("__all", "__n").alias(total))
        names = [c for c in self.rows.columns if c not in (rank, total)]
        return self._with(rows.select(*_quoted(names), *out))

    def result(self) -> DataFrame:
        return self.rows.drop(PART, _TIE)


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False,
              ranges: int | None = None) -> Ordered:
    """``df`` range partitioned by (keys, order) and written with each row's range.

    ``ranges`` is the shuffle partition count unless given.  Rows equal in key
    and order are split between ranges too, by their hash and map task.
    """
    taken = [c for c in df.columns if c.startswith("__")]
    if taken:
        raise ValueError(f"reserved column names: {taken}")
    spark, keys, order = df.sparkSession, list(keys), list(order)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn(_TIE, F.xxhash64(*_quoted(df.columns))).withColumn("__task", F.spark_partition_id())
    place = [c.desc_nulls_last() if descending else c.asc_nulls_first() for c in _quoted([*order, _TIE])]
    dealt = (tied.repartitionByRange(ranges, *_quoted(keys), *place, F.col("__task"))
             .drop("__task").withColumn(PART, F.spark_partition_id()))
    rows = materialize(dealt, spark, "ranges")
    key = F.struct(*_quoted(keys))
    ends = rows.groupBy(PART).agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))
    edges = ends.select(F.explode(F.array("__lo", "__hi")).alias("__k")).select("__k.*").distinct()
    return Ordered(rows, keys, order, descending, materialize(edges, spark, "range-ends"))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str,
              direction: str = "backward", exact: bool = True, tolerance: Column | None = None,
              prefix: str = "right_", ranges: int | None = None) -> DataFrame:
    """Each left row with the right row of its key that is nearest in time on one side.

    ``backward`` takes the latest right row not after the left one, ``forward``
    the earliest not before it; without ``exact`` equal times do not match.
    ``tolerance`` (a number or interval column) bounds the distance in time.
    Right rows that are equal in key and time count as one, the greatest by
    their other columns.  A null key or time matches nothing.  Every left row
    comes out once, with the right columns other than the keys under
    ``prefix``, null without a match.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction = {direction!r}")
    keys = list(keys)
    values = [c for c in right.columns if c not in (*keys, time)]
    names = [prefix + c for c in right.columns if c not in keys]
    clash = sorted(set(names) & set(left.columns))
    if clash:
        raise ValueError(f"both sides give {clash}; choose another prefix")
    known = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (*keys, time)))
    if values:
        known = (known.groupBy(*_quoted([*keys, time])).agg(F.max(F.struct(*_quoted(values))).alias("__v"))
                 .select(*_quoted([*keys, time]), *[F.col(f"__v.`{c}`").alias(c) for c in values]))
    else:
        known = known.distinct()
    plain = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    right_row, left_row = F.struct(*_quoted([time, *values])), F.struct(*_quoted(left.columns))
    # right rows come first at equal times if these match, last if not
    forward = direction == "forward"
    side = 0 if exact != forward else 1
    r = known.select(*plain, F.col(f"`{time}`").alias("t"), F.lit(side).alias("side"), right_row.alias("r"))
    q = left.select(*plain, F.col(f"`{time}`").alias("t"), F.lit(1 - side).alias("side"), left_row.alias("l"))
    both = q.unionByName(r, allowMissingColumns=True)
    found = (in_ranges(both, [f"k{i}" for i in range(len(keys))], ["t", "side"], forward, ranges)
             .running({"found": ("last", "r")}).rows.where("l IS NOT NULL"))
    mine, its = F.col(f"l.`{time}`"), F.col(f"found.`{time}`")
    near = mine.isNotNull()
    if tolerance is not None:
        near = near & ((its <= mine + tolerance) if forward else (mine <= its + tolerance))
    return found.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns],
                        *[F.when(near, F.col(f"found.`{c}`")).alias(n)
                          for c, n in zip([c for c in right.columns if c not in keys], names)])


def with_sessions(events: DataFrame, keys: Sequence[str], time: str, gap: Column,
                  session: str = "session_start", ranges: int | None = None) -> DataFrame:
    """``events`` with the start of its session: a row opens one if its key's previous
    row is more than ``gap`` (a number or interval column) earlier.  Rows without a
    time belong to no session (null)."""
    timed = in_ranges(events, keys, [time], ranges=ranges).shifted({"__prev": (time, -1)})
    t, prev = F.col(f"`{time}`"), F.col("__prev")
    opens = F.when(prev.isNull() | (t > prev + gap), t)
    starts = timed.running({session: ("max", opens)}).result().drop("__prev")
    return starts.withColumn(session, F.when(t.isNotNull(), F.col(f"`{session}`")))


def sessions(events: DataFrame, keys: Sequence[str], time: str, gap: Column,
             ranges: int | None = None) -> DataFrame:
    """One row per session: keys, session_start, session_end, n_events.  Rows are combined
    in each task before the shuffle, so one endless session is no hot group."""
    used = events.select(*_quoted([*keys, time])).where(f"`{time}` IS NOT NULL")
    return (with_sessions(used, keys, time, gap, ranges=ranges)
            .groupBy(*_quoted(keys), "session_start")
            .agg(F.max(f"`{time}`").alias("session_end"), F.count(F.lit(1)).alias("n_events")))


def merged_sessions(pieces: DataFrame, keys: Sequence[str], gap: int, ranges: int | None = None) -> DataFrame:
    """Sessions out of partial ones: rows (keys, session_start, session_end, n_events), long, of a
    key that overlap or lie at most ``gap`` apart become one.  A single event is a piece of no
    length.  The result may be merged again with further pieces."""
    placed = (in_ranges(pieces, keys, ["session_start"], ranges=ranges)
              .running({"__prev": ("max", "session_end")}, own=False))
    t, prev = F.col("session_start"), F.col("__prev")
    opens = F.when(prev.isNull() | (t > prev + gap), t)
    return (placed.running({"__first": ("max", opens)}).result()
            .groupBy(*_quoted(keys), F.col("__first").alias("session_start"))
            .agg(F.max("session_end").alias("session_end"), F.sum("n_events").alias("n_events")))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      fractions: Mapping[str, float], ranges: int | None = None) -> DataFrame:
    """One row per key: its count ``n`` of non-null values and, per name, the value at
    place ceil(fraction * n) (at least 1) in ascending order: an exact percentile, of no
    more memory than a range whatever a key's size.  Keys without a value give no row."""
    ranked = (in_ranges(df.select(*_quoted([*keys, value])).where(f"`{value}` IS NOT NULL"), keys, [value],
                        ranges=ranges).ranked("__rank", "__total").result())
    place = {n: F.greatest(F.lit(1), F.ceil(F.lit(float(f)) * F.col("__total"))) for n, f in fractions.items()}
    wanted = F.lit(False)
    for p in place.values():
        wanted = wanted | (F.col("__rank") == p)
    return (ranked.where(wanted).groupBy(*_quoted(keys))
            .agg(F.max("__total").alias("n"),
                 *[F.max(F.when(F.col("__rank") == p, F.col(f"`{value}`"))).alias(n) for n, p in place.items()]))
