"""Cubes, rollups and grouping sets over additive measures.

The rows are read once, for the finest grouping; every coarser grouping is
summed from its smallest finer one, so raw rows are not expanded per grouping.
Each grouping that another one is made from is written to the shared folder.
Sizes are estimated by one aggregate over the finest grouping.  A null in a
dimension is a value of its own; ``grouping_id`` tells it from "all values"
(bit i from the right is set where the i-th dimension from the right is
summed over).  Empty input: no rows, except one for the grand total, whose
sums are null and whose count is 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.writers import materialize

#: 2^10 groupings are the most a cube may ask for
MAX_DIMENSIONS = 10


def grouping_sets(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]],
                  sums: Mapping[str, Column], count: str = "n") -> DataFrame:
    """Sums and row counts of each set of ``dims``: dims, grouping_id, sums, count."""
    dims = list(dims)
    unknown = sorted({d for s in sets for d in s} - set(dims))
    if unknown or not 1 <= len(dims) <= MAX_DIMENSIONS:
        raise ValueError(f"1 to {MAX_DIMENSIONS} dimensions, of which the sets are made: {unknown or len(dims)}")
    spark, names = df.sparkSession, [*sums, count]
    wanted = sorted({frozenset(s) for s in sets}, key=lambda s: (-len(s), sorted(s)))
    measures = [F.sum(c).alias(n) for n, c in sums.items()]
    plain = [F.col(f"`{d}`") for d in dims]
    finest = materialize(df.groupBy(*plain).agg(*measures, F.count(F.lit(1)).alias(count)), spark, "cube")
    # an array, not a struct: a struct with nulls would not be counted alike
    key = {s: F.array(*[F.coalesce(F.col(f"`{d}`").cast("string"), F.lit("\0")) for d in dims if d in s])
           for s in wanted}
    sizes = dict(zip(wanted, finest.agg(*[F.approx_count_distinct(F.xxhash64(k)) for k in key.values()]).first())) \
        if wanted else {}
    parent: dict[frozenset, frozenset | None] = {}
    for s in wanted:
        finer = [p for p in parent if s < p]
        parent[s] = min(finer, key=lambda p: (sizes[p], len(p), sorted(p)), default=None)
    made: dict[frozenset, DataFrame] = {}
    out = []
    for s in wanted:
        source = finest if parent[s] is None else made[parent[s]]
        if s == frozenset(dims):
            rows = finest
        else:
            total = F.coalesce(F.sum(count), F.lit(0)) if not s else F.sum(count)
            rows = source.groupBy(*[F.col(f"`{d}`") for d in dims if d in s]).agg(
                *[F.sum(f"`{n}`").alias(n) for n in sums], total.alias(count))
            if s in parent.values():
                rows = materialize(rows, spark, "cube")
        made[s] = rows
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s)
        types = {f.name: f.dataType for f in finest.schema.fields}
        out.append(rows.select(*[F.col(f"`{d}`") if d in s else F.lit(None).cast(types[d]).alias(d) for d in dims],
                               F.lit(bits).cast("bigint").alias("grouping_id"),
                               *[F.col(f"`{n}`") for n in names]))
    return reduce(DataFrame.unionByName, out)


def cube(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column], count: str = "n") -> DataFrame:
    """Every subset of ``dims``."""
    return grouping_sets(df, dims, [c for k in range(len(dims) + 1) for c in combinations(dims, k)], sums, count)


def rollup(df: DataFrame, dims: Sequence[str], sums: Mapping[str, Column], count: str = "n") -> DataFrame:
    """Every prefix of ``dims``."""
    return grouping_sets(df, dims, [dims[:k] for k in range(len(dims) + 1)], sums, count)
