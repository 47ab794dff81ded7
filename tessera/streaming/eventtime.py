"""Event-time windows and sessions over a stream, late rows kept as a side output.

Spark's own watermarked aggregate drops late rows without a trace and keeps a
session's rows of one key in one task.  Here each micro-batch is folded by a
plain batch job (``foreachBatch``) into tables under ``root``:

* ``state/batch=N``  what is open after batch N and what batch N closed;
* ``late/batch=N``   what came too late;
* ``clock/batch=N``  the greatest event time of batches 0 to N, written last.

The watermark of a batch is the greatest time of the batches before it less
``delay``, so it never goes back and a row's fate depends only on the order in
which rows arrived.  Batch N reads the tables of batch N - 1 and writes only
its own, in overwrite mode: a batch that is run again after a failure gives
the same tables, and a reader takes no batch without a clock.  The state holds
what the watermark has not passed, not the stream; a batch reads its own rows
once and what was open.  Only the clock, one number, comes to the driver.

Times are whole numbers (microseconds, say).  A row without a time belongs to
no window and no session and is kept with the late ones.  A batch without rows
leaves the clock as it is.  Null keys are a key of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.ordered import merged_sessions

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


class _Folded:
    """A stream folded batch by batch; see the module's text."""

    def __init__(self, root: str, keys: Sequence[str], time: str, delay: int):
        self.root, self.keys, self.time, self.delay = root.rstrip("/"), list(keys), time, delay

    # --- tables

    def _path(self, table: str, batch: int) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def _clock(self, spark: SparkSession, batch: int) -> int | None:
        if batch < 0:
            return None
        return spark.read.parquet(self._path("clock", batch)).first()["latest"]

    def last_batch(self, spark: SparkSession) -> int | None:
        """The last whole batch; None before the first."""
        try:
            return spark.read.option("basePath", f"{self.root}/clock").parquet(
                f"{self.root}/clock/batch=*").agg(F.max("batch")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _read(self, spark: SparkSession, table: str) -> DataFrame:
        last = self.last_batch(spark)
        if last is None:
            raise ValueError(f"no batch has been folded into {self.root}")
        return (spark.read.option("basePath", f"{self.root}/{table}")
                .parquet(f"{self.root}/{table}/batch=*").where(F.col("batch") <= last))

    def closed(self, spark: SparkSession) -> DataFrame:
        """What the watermark has passed; these rows change no more."""
        return self._read(spark, "state").where("closed").drop("closed", "batch")

    def open(self, spark: SparkSession) -> DataFrame:
        """What may still grow."""
        last = self.last_batch(spark)
        return self._read(spark, "state").where((F.col("batch") == last) & ~F.col("closed")).drop("closed", "batch")

    # --- one batch

    def fold(self, rows: DataFrame, batch: int) -> None:
        """Batch ``batch`` of the stream, the one after the last or that one again."""
        spark = rows.sparkSession
        before = self._clock(spark, batch - 1)
        mark = None if before is None else before - self.delay
        opened = None
        if batch > 0:
            opened = spark.read.parquet(self._path("state", batch - 1)).where("NOT closed").drop("closed")
        taken = self._take(rows, batch)
        latest = taken.agg(F.max("__latest")).first()[0]
        known = [t for t in (before, latest) if t is not None]
        latest = max(known) if known else None
        late, state = self._split(taken, opened, mark)
        late.write.mode("overwrite").parquet(self._path("late", batch))
        done = F.lit(False) if latest is None else self._done(latest - self.delay)
        state.withColumn("closed", done).write.mode("overwrite").parquet(self._path("state", batch))
        (spark.range(1).select(F.lit(latest).cast("long").alias("latest"))
         .write.mode("overwrite").parquet(self._path("clock", batch)))

    def _stored(self, taken: DataFrame, batch: int) -> DataFrame:
        """The batch as later steps need it, computed once."""
        path = self._path("taken", batch)
        taken.write.mode("overwrite").parquet(path)
        return taken.sparkSession.read.schema(taken.schema).parquet(path)

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """The streaming query; ``checkpoint`` and ``root`` belong together."""
        writer = stream.writeStream.foreachBatch(self.fold).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now
                else writer.trigger(processingTime="1 minute")).start()


class EventWindows(_Folded):
    """Measures per key and window of event time.

    Windows are [start, start + length), one at every multiple of ``slide``
    (``length`` unless given, else a divisor of it).  ``measures`` maps names to
    (``sum``, ``count``, ``min`` or ``max``, column).  A window is closed once
    the watermark reaches its end; a row is late for a window whose end is at
    or before the watermark of the row's batch.  Rows are combined by pane (one
    slide) in each task before the shuffle, so a key of any share costs a row a
    task and pane.  Closed and open windows never share a (key, window); merged
    with the late rows they hold every row exactly once per window.
    """

    def __init__(self, root: str, keys: Sequence[str], time: str, measures: Mapping[str, tuple[str, str]],
                 length: int, delay: int, slide: int | None = None):
        super().__init__(root, keys, time, delay)
        self.length, self.slide = length, slide or length
        if length <= 0 or self.slide <= 0 or length % self.slide:
            raise ValueError(f"a window of {length} is no multiple of its slide {self.slide}")
        unknown = sorted({kind for kind, _ in measures.values()} - set(_MERGE))
        if unknown:
            raise ValueError(f"no merge for {unknown}")
        clash = sorted({"window_start", "closed", "batch", "__latest"} & {*keys, *measures})
        if clash:
            raise ValueError(f"reserved column names: {clash}")
        self.measures = dict(measures)

    def _merged(self, df: DataFrame) -> DataFrame:
        return (df.groupBy(*[F.col(f"`{k}`") for k in self.keys], "window_start")
                .agg(*[_MERGE[kind](f"`{n}`").alias(n) for n, (kind, _) in self.measures.items()]))

    def _take(self, rows: DataFrame, batch: int) -> DataFrame:
        t = F.col(f"`{self.time}`").cast("long")
        panes = (rows.groupBy(*[F.col(f"`{k}`") for k in self.keys],
                              (t - F.pmod(t, F.lit(self.slide))).alias("__pane"))
                 .agg(F.max(t).alias("__latest"),
                      *[getattr(F, kind)(f"`{c}`").alias(n) for n, (kind, c) in self.measures.items()]))
        return self._stored(panes, batch)

    def _split(self, taken: DataFrame, opened: DataFrame | None, mark: int | None):
        starts = F.sequence(F.col("__pane") - (self.length - self.slide), F.col("__pane"), F.lit(self.slide))
        windows = taken.select(*[F.col(f"`{k}`") for k in self.keys],
                               F.explode_outer(starts).alias("window_start"),
                               *[F.col(f"`{n}`") for n in self.measures])
        past = F.col("window_start").isNull()
        if mark is not None:
            past = past | (F.col("window_start") + self.length <= mark)
        kept = windows.where(~past)
        return self._merged(windows.where(past)), self._merged(kept if opened is None else kept.unionByName(opened))

    def _done(self, mark: int):
        return F.col("window_start") + self.length <= mark

    def late(self, spark: SparkSession) -> DataFrame:
        """Measures of the late rows by key and missed window (null: rows without a time)."""
        return self._merged(self._read(spark, "late"))


class EventSessions(_Folded):
    """Sessions per key: rows of a key at most ``gap`` apart (session_start, session_end, n_events).

    A row before the watermark of its batch is late; a session is closed once
    its end lies more than ``gap`` before the watermark, so that no row in time
    can reach it.  Closed and open sessions together are those that a batch job
    finds over all rows in time.  A batch's rows and the open sessions are
    merged over ranges of (key, time): a key of any share is no single task.
    """

    def __init__(self, root: str, keys: Sequence[str], time: str, gap: int, delay: int):
        super().__init__(root, keys, time, delay)
        clash = sorted({"session_start", "session_end", "n_events", "n_late", "closed", "batch"} & set(keys))
        if clash:
            raise ValueError(f"reserved column names: {clash}")
        self.gap = gap

    def _take(self, rows: DataFrame, batch: int) -> DataFrame:
        keys, t = [F.col(f"`{k}`") for k in self.keys], F.col(f"`{self.time}`").cast("long")
        return self._stored(rows.groupBy(*keys, t.alias("__latest")).agg(F.count(F.lit(1)).alias("n_events")), batch)

    def _split(self, taken: DataFrame, opened: DataFrame | None, mark: int | None):
        keys, t = [F.col(f"`{k}`") for k in self.keys], F.col("__latest")
        past = t.isNull() if mark is None else t.isNull() | (t < mark)
        late = taken.where(past).select(*keys, t.alias("event_time"), F.col("n_events").alias("n_late"))
        pieces = taken.where(~past).select(*keys, t.alias("session_start"), t.alias("session_end"), "n_events")
        if opened is not None:
            pieces = pieces.unionByName(opened)
        return late, merged_sessions(pieces, self.keys, self.gap)

    def _done(self, mark: int):
        return F.col("session_end") + self.gap < mark

    def late(self, spark: SparkSession) -> DataFrame:
        """Late rows: keys, event_time (null: rows without a time) and how many there were."""
        return (self._read(spark, "late").groupBy(*[F.col(f"`{k}`") for k in self.keys], "event_time")
                .agg(F.sum("n_late").alias("n_late")))
