"""Ordered work over hot keys, interval joins and cubes against brute force."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tessera.operators.cube import cube, grouping_sets, rollup
from tessera.operators.intervals import overlap_join, point_join
from tessera.operators.ordered import (PART, asof_join, exact_percentiles, in_ranges, sessions,
                                       with_sessions)

RND = random.Random(5)
LEFT = [(RND.choice([1, 1, 1, 2, 3, None]), RND.choice([None, *range(40)]), i) for i in range(300)]
RIGHT = [(RND.choice([1, 1, 1, 2, 4, None]), RND.choice([None, *range(40)]), i) for i in range(100)]


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame(LEFT, "k int, t int, i int").repartition(3)


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame(RIGHT, "k int, t int, i int").repartition(2)


def counted(df, *cols):
    return Counter(map(tuple, df.select(*cols).collect()))


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof_join(left, right, direction, exact, tolerance):
    got = asof_join(left, right, ["k"], "t", direction, exact,
                    None if tolerance is None else F.lit(tolerance), ranges=7)
    want = Counter()
    for k, t, i in LEFT:
        best = (None, None)
        if k is not None and t is not None:
            sign = 1 if direction == "backward" else -1
            own = [(sign * rt, v) for rk, rt, v in RIGHT if rk == k and rt is not None
                   and (sign * rt < sign * t or exact and rt == t)]
            if own and (tolerance is None or sign * t - max(own)[0] <= tolerance):
                best = (sign * max(own)[0], max(own)[1])
        want[(k, t, i, *best)] += 1
    assert counted(got, "k", "t", "i", "right_t", "right_i") == want


def test_asof_join_of_empty_sides_and_clashes(left, right):
    assert asof_join(left, right.limit(0), ["k"], "t").where("right_t IS NULL").count() == len(LEFT)
    assert asof_join(left.limit(0), right, ["k"], "t").count() == 0
    with pytest.raises(ValueError, match="prefix"):
        asof_join(left, right, ["k"], "t", prefix="")
    with pytest.raises(ValueError, match="direction"):
        asof_join(left, right, ["k"], "t", direction="nearest")
    with pytest.raises(ValueError, match="reserved"):
        in_ranges(left.withColumn("__x", F.lit(1)), ["k"], ["t"])


def test_asof_join_on_names_with_dots(spark):
    a = spark.createDataFrame([(1, 5, "x")], "`k.y` int, `at t` int, l string")
    b = spark.createDataFrame([(1, 4, "r")], "`k.y` int, `at t` int, r string")
    assert [tuple(r) for r in asof_join(a, b, ["k.y"], "at t").collect()] == [(1, 5, "x", 4, "r")]


@pytest.mark.parametrize("descending", [False, True])
def test_running_shifted_and_ranked(left, descending):
    got = (in_ranges(left, ["k"], ["t", "i"], descending, ranges=9)
           .running({"s": ("sum", "i"), "n": ("count", "t"), "lo": ("min", "i"), "seen": ("last", "t")})
           .shifted({"before": ("i", -2), "after": ("i", 3)}).ranked("place", "of").result())
    want = Counter()
    for k in {r[0] for r in LEFT}:
        own = sorted((r for r in LEFT if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]),
                     reverse=descending)
        for j, r in enumerate(own):
            upto = own[:j + 1]
            times = [x[1] for x in upto if x[1] is not None]
            want[(*r, sum(x[2] for x in upto), len(times), min(x[2] for x in upto),
                  times[-1] if times else None, own[j - 2][2] if j > 1 else None,
                  own[j + 3][2] if j + 3 < len(own) else None, j + 1, len(own))] += 1
    assert counted(got, "k", "t", "i", "s", "n", "lo", "seen", "before", "after", "place", "of") == want


def test_a_hot_key_and_equal_rows_are_spread_over_ranges(spark):
    rows = spark.range(0, 30000, 1, 12).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id").cast("int")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("t"))
    o = in_ranges(rows, ["k"], ["t"], ranges=10)
    sizes = [r[0] for r in o.rows.groupBy(PART).count().select("count").collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 30000 / 10
    # a key's carried rows are at most two a range
    assert o.edges.count() <= 20
    hot = o.ranked("place", "of").result().where("k = 7")
    assert hot.agg(F.countDistinct("place"), F.max("place"), F.min("of")).first()[:] == (20000, 20000, 20000)


def test_sessions(left, spark):
    got = Counter(map(tuple, sessions(left, ["k"], "t", F.lit(1), ranges=8).collect()))
    want = Counter()
    for k in {r[0] for r in LEFT}:
        times = sorted(r[1] for r in LEFT if r[0] == k and r[1] is not None)
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] > 1:
                want[(k, run[0], run[-1], len(run))] += 1
                run = []
            run.append(t)
        want[(k, run[0], run[-1], len(run))] += 1
    assert got == want
    marked = with_sessions(left, ["k"], "t", F.lit(1), ranges=8)
    assert marked.count() == len(LEFT) and marked.where("session_start IS NULL AND t IS NOT NULL").count() == 0
    assert marked.where("session_start IS NOT NULL AND t IS NULL").count() == 0
    times = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0,0,0,0,h) AS at "
                      "FROM VALUES (0), (1), (5) v(h)")
    spans = sessions(times, ["k"], "at", F.expr("INTERVAL 2 HOURS"))
    assert sorted(r["n_events"] for r in spans.collect()) == [1, 2]
    assert sessions(left.limit(0), ["k"], "t", F.lit(1)).count() == 0


def test_exact_percentiles(left):
    shares = {"low": 0.0, "mid": 0.5, "high": 0.9, "top": 1.0}
    got = {r["k"]: r for r in exact_percentiles(left, ["k"], "t", shares, ranges=6).collect()}
    for k in {r[0] for r in LEFT}:
        own = sorted(r[1] for r in LEFT if r[0] == k and r[1] is not None)
        assert got[k]["n"] == len(own)
        for name, f in shares.items():
            place = max(1, -int(-(f * len(own)) // 1))
            assert got[k][name] == own[place - 1]


def spans(n, lengths):
    return [(RND.choice([1, 1, 2, None]), s := RND.choice([None, *range(-50, 50)]),
             None if s is None else s + RND.choice(lengths), i) for i in range(n)]


A, B = spans(90, [-1, 0, 1, 2, 3, 5, 8, 40, 1000, 1 << 40]), spans(80, [0, 1, 2, 3, 4, 30, 500])


def holds(x):
    return x[1] is not None and x[1] < x[2]


@pytest.mark.parametrize("keys", [["k"], []])
def test_interval_joins(spark, keys):
    schema = "k int, s bigint, e bigint, i int"
    a, b = spark.createDataFrame(A, schema), spark.createDataFrame(B, schema)
    bounds = (F.col("s"), F.col("e"))

    def same(x, y):
        return not keys or x[0] is not None and x[0] == y[0]

    assert counted(overlap_join(a, b, keys, bounds, bounds), "i", "right_i") == Counter(
        (x[3], y[3]) for x in A for y in B
        if same(x, y) and holds(x) and holds(y) and x[1] < y[2] and y[1] < x[2])
    assert counted(point_join(a, b, keys, F.col("s"), bounds), "i", "right_i") == Counter(
        (x[3], y[3]) for x in A for y in B
        if same(x, y) and x[1] is not None and holds(y) and y[1] <= x[1] < y[2])
    for x, y in ((a.limit(0), b), (a, b.limit(0))):
        assert overlap_join(x, y, keys, bounds, bounds).count() == 0
        assert point_join(x, y, keys, F.col("s"), bounds).count() == 0
    with pytest.raises(ValueError, match="prefix"):
        overlap_join(a, b, keys, bounds, bounds, prefix="")


def test_interval_join_needs_no_nested_loop(spark):
    b = spark.createDataFrame(B, "k int, s bigint, e bigint, i int")
    bounds = (F.col("s"), F.col("e"))
    plan = point_join(b, b, [], F.col("s"), bounds)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cube_and_rollup(spark):
    rows = [(RND.choice(["a", "b", None]), RND.choice([1, 2, None]), RND.choice(["x", "y"]),
             RND.choice([None, 1, 5, 9])) for _ in range(200)]
    df = spark.createDataFrame(rows, "p string, q int, r string, v int")
    dims = ["p", "q", "r"]

    def brute(sets):
        out = Counter()
        for s in sets:
            groups = {}
            for row in rows:
                groups.setdefault(tuple(row[i] if d in s else None for i, d in enumerate(dims)), []).append(row[3])
            for key, vs in groups.items():
                known = [v for v in vs if v is not None]
                bits = sum(4 >> i for i, d in enumerate(dims) if d not in s)
                out[(*key, bits, sum(known) if known else None, len(vs))] += 1
        return out

    every = [c for k in range(4) for c in combinations(dims, k)]
    assert Counter(map(tuple, cube(df, dims, {"total": F.col("v")}).collect())) == brute(every)
    assert Counter(map(tuple, rollup(df, dims, {"total": F.col("v")}).collect())) == brute(
        [dims[:k] for k in range(4)])
    some = [("p", "r"), ("q",)]
    assert Counter(map(tuple, grouping_sets(df, dims, some, {"total": F.col("v")}).collect())) == brute(some)
    assert [tuple(r) for r in cube(df.limit(0), dims, {"total": F.col("v")}).collect()] == [
        (None, None, None, 7, None, 0)]
    with pytest.raises(ValueError, match="dimensions"):
        grouping_sets(df, dims, [("z",)], {})


def test_running_measures_of_the_rows_before(left):
    got = (in_ranges(left, ["k"], ["t", "i"], ranges=7)
           .running({"s": ("sum", "i"), "n": ("count", "i"), "m": ("max", "i"), "l": ("last", "i")}, own=False).result())
    want, seen = Counter(), {}
    for k, t, i in sorted(LEFT, key=lambda r: (r[1] is not None, r[1], r[2])):
        own = seen.setdefault(k, [])
        want[(k, t, i, sum(own) if own else None, len(own), max(own, default=None), own[-1] if own else None)] += 1
        own.append(i)
    assert counted(got, "k", "t", "i", "s", "n", "m", "l") == want
