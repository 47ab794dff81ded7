"""Streamed windows and sessions against brute force; the sketch within its error."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators.ordered import merged_sessions
from tessera.operators.sketches import bucket, merged, sketch, sketched_percentiles
from tessera.session import scratch_path
from tessera.streaming import EventSessions, EventWindows

RND = random.Random(11)
SCHEMA = "k string, t long, v long"
DELAY, LENGTH, SLIDE, GAP = 20, 30, 10, 7


def _batches():
    """Batches that move on in time, with stragglers, a hot key, ties, nulls and an empty batch."""
    out = []
    for b in range(5):
        rows = []
        for _ in range(0 if b == 3 else 60):
            t = b * 40 + RND.randrange(40) - RND.choice([0, 0, 0, 30, 70])
            rows.append((RND.choice(["hot", "hot", "a", "b", None]), RND.choice([t, t, t, t, None])
                         if b == 2 else t, RND.choice([None, *range(-5, 50)])))
        out.append(rows + rows[:2])
    return out


BATCHES = _batches()


def _marked(delay=DELAY):
    """(row, watermark of its batch) and the last watermark."""
    latest, rows = None, []
    for batch in BATCHES:
        mark = None if latest is None else latest - delay
        rows += [(r, mark) for r in batch]
        latest = max([t for t in (latest, *(r[1] for r in batch)) if t is not None])
    return rows, latest - delay


def _run(spark, folded):
    source, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ckpt")
    for i, batch in enumerate(BATCHES):
        if batch:
            spark.createDataFrame(batch, SCHEMA).repartition(2).write.mode("append").parquet(source)
            folded.start(spark.readStream.schema(SCHEMA).parquet(source), ckpt).awaitTermination(120)
    return folded


def _groups(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def windows(spark):
    return _run(spark, EventWindows(scratch_path(spark, "t-win"), ["k"], "t", {
        "n": ("count", "t"), "total": ("sum", "v"), "least": ("min", "v"), "most": ("max", "v")},
        LENGTH, DELAY, SLIDE))


@pytest.fixture(scope="module")
def streamed_sessions(spark):
    return _run(spark, EventSessions(scratch_path(spark, "t-ses"), ["k"], "t", GAP, DELAY))


def _brute_windows():
    rows, last = _marked()
    out = {"closed": defaultdict(list), "open": defaultdict(list), "late": defaultdict(list)}
    for (k, t, v), mark in rows:
        if t is None:
            out["late"][k, None].append((t, v))
            continue
        first = t - t % SLIDE
        for start in range(first - LENGTH + SLIDE, first + 1, SLIDE):
            fate = ("late" if mark is not None and start + LENGTH <= mark
                    else "closed" if start + LENGTH <= last else "open")
            out[fate][k, start].append((t, v))
    def row(key, group):
        known = [v for _, v in group if v is not None]
        return (*key, sum(t is not None for t, _ in group), sum(known) if known else None,
                min(known, default=None), max(known, default=None))
    return {f: sorted((row(k, g) for k, g in d.items()), key=repr) for f, d in out.items()}


@pytest.mark.parametrize("fate", ["closed", "open", "late"])
def test_windows_against_brute_force(spark, windows, fate):
    got = _groups(getattr(windows, fate)(spark), "k", "window_start", "n", "total", "least", "most")
    want = _brute_windows()[fate]
    assert want and got == want


def test_closed_open_and_late_windows_hold_the_whole_batch_job(spark, windows):
    parts = [getattr(windows, f)(spark).where("window_start IS NOT NULL").select("k", "window_start", "n")
             for f in ("closed", "open", "late")]
    got = _groups(parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("k", "window_start")
                  .agg(F.sum("n").alias("n")), "k", "window_start", "n")
    want = Counter()
    for batch in BATCHES:
        for k, t, _ in batch:
            for i in range(LENGTH // SLIDE if t is not None else 0):
                want[k, t - t % SLIDE - i * SLIDE] += 1
    assert got == sorted(((*key, n) for key, n in want.items()), key=repr)


def _brute_sessions(times):
    out = []
    for k in set(times):
        for t in sorted(times[k]):
            if out and out[-1][0] == k and t - out[-1][2] <= GAP:
                out[-1] = (k, out[-1][1], t, out[-1][3] + 1)
            else:
                out.append((k, t, t, 1))
    return out


def test_sessions_against_a_batch_job_over_the_rows_in_time(spark, streamed_sessions):
    rows, last = _marked()
    on_time, late = defaultdict(list), Counter()
    for (k, t, _), mark in rows:
        if t is None or mark is not None and t < mark:
            late[k, t] += 1
        else:
            on_time[k].append(t)
    want = _brute_sessions(on_time)
    cols = ("k", "session_start", "session_end", "n_events")
    assert late and any(s[2] + GAP < last for s in want)
    assert _groups(streamed_sessions.closed(spark), *cols) == sorted(
        (s for s in want if s[2] + GAP < last), key=repr)
    assert _groups(streamed_sessions.open(spark), *cols) == sorted(
        (s for s in want if s[2] + GAP >= last), key=repr)
    assert _groups(streamed_sessions.late(spark), "k", "event_time", "n_late") == sorted(
        ((*key, n) for key, n in late.items()), key=repr)


def test_a_batch_folded_again_changes_nothing(spark, windows, streamed_sessions):
    for folded in (windows, streamed_sessions):
        before = [_groups(getattr(folded, f)(spark), "*") for f in ("closed", "open", "late")]
        last = folded.last_batch(spark)
        folded.fold(spark.createDataFrame([r for r in BATCHES if r][-1], SCHEMA), last)
        assert [_groups(getattr(folded, f)(spark), "*") for f in ("closed", "open", "late")] == before


def test_batches_without_rows_or_times(spark):
    w = EventWindows(scratch_path(spark, "t-none"), ["k"], "t", {"n": ("count", "v")}, 10, 5)
    assert w.last_batch(spark) is None
    with pytest.raises(ValueError, match="no batch"):
        w.closed(spark)
    w.fold(spark.createDataFrame([], SCHEMA), 0)
    w.fold(spark.createDataFrame([("a", None, 1)], SCHEMA), 1)
    w.fold(spark.createDataFrame([("a", 3, 1), ("a", 30, None)], SCHEMA), 2)
    assert _groups(w.closed(spark), "*") == [("a", 0, 1)]
    assert _groups(w.open(spark), "*") == [("a", 30, 0)]
    assert _groups(w.late(spark), "*") == [("a", None, 1)]


def test_wrong_windows_are_refused():
    with pytest.raises(ValueError, match="multiple"):
        EventWindows("/x", ["k"], "t", {"n": ("count", "v")}, 10, 5, 3)
    with pytest.raises(ValueError, match="merge"):
        EventWindows("/x", ["k"], "t", {"n": ("avg", "v")}, 10, 5)
    with pytest.raises(ValueError, match="reserved"):
        EventWindows("/x", ["closed"], "t", {"n": ("count", "v")}, 10, 5)
    with pytest.raises(ValueError, match="reserved"):
        EventSessions("/x", ["n_events"], "t", 5, 5)


def test_sessions_merged_in_any_grouping(spark):
    times = {k: [RND.randrange(2000) for _ in range(n)] for k, n in (("hot", 400), ("a", 50), (None, 20))}
    rows = [(k, t, t, 1) for k, ts in times.items() for t in ts]
    RND.shuffle(rows)
    schema = "k string, session_start long, session_end long, n_events long"
    halves = [merged_sessions(spark.createDataFrame(part, schema), ["k"], GAP, ranges=5)
              for part in (rows[:200], rows[200:])]
    got = merged_sessions(halves[0].unionByName(halves[1]), ["k"], GAP, ranges=5)
    assert _groups(got, "k", "session_start", "session_end", "n_events") == sorted(_brute_sessions(times), key=repr)


@pytest.mark.parametrize("bits", [0, 3, 7])
def test_sketch_keeps_rank_and_relative_error(spark, bits):
    values = {"hot": [int(RND.lognormvariate(5, 3)) - 20 for _ in range(2000)], None: [0, -1, 7, 7],
              "wide": [2 ** 61, -2 ** 61 - 1, 1, 0, None]}
    rows = [(k, i % 3, v) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame([*rows, ("nothing", 0, None)], "k string, g int, v long").repartition(4)
    fine = sketch(df, ["k", "g"], "v", bits)
    parts = [fine.where(f"g = {g}") for g in range(3)]
    places = {"lo": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "hi": 1.0}
    got = {r["k"]: r for r in sketched_percentiles(merged(parts, ["k"]), ["k"], places).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        known = sorted(v for v in vs if v is not None)
        assert got[k]["n"] == len(known)
        for name, f in places.items():
            exact = known[max(1, -int(-f * len(known) // 1)) - 1]
            low = got[k][name]
            assert abs(low) <= abs(exact) and abs(exact - low) * 2 ** bits <= abs(exact) and low * exact >= 0
            if abs(exact) < 2 ** (bits + 1):
                assert low == exact
    assert fine.groupBy("k", "g").count().agg(F.max("count")).first()[0] <= 2 * 64 * 2 ** bits
    assert sketch(df.limit(0), ["k"], "v").count() == 0
    assert df.select(bucket(F.lit(None).cast("long"), bits).alias("b")).first()["b"] is None
