"""Near-duplicates by SimHash, linked through BK-trees.

A fingerprint bit is 1 if over half of a text's shingle hashes (XXH64, seed 42)
have it.  Fingerprints at ``radius`` = 2 or fewer differing bits are linked;
components of links are the groups.

Search.  Of four 16-bit blocks at least two are untouched by two differing
bits, so linked fingerprints share the value of one of the six pairs of
blocks.  Each pair value is a shard; a shard's distinct fingerprints form one
BK-tree (children keyed by the integer Hamming distance to their parent) and
each fingerprint follows only the edges within the radius.  Shards over
``SHARD_ROWS`` are divided again by pairs of the four bytes that are left of
the other two blocks, which leaves 16 free bits, so no tree exceeds 65,536
nodes whatever the input.  Instead of broadcasting trees, which would grow
with the corpus, each is built in the one task that holds its shard.  A shard
gives each member its smallest linked representative (a star), never pairs.

Defined results: a null or empty text has fingerprint zero, linked like any
other; texts of fewer words than a shingle use the whole word sequence; rows
of equal doc_id are fingerprinted one by one and each returned; a null doc_id
is returned and belongs to its component but never names it, unless all are
null.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import (U64, bound_tables, bounded_batches, joined, slices_of, words_of,
                                xxh64_spans)
from tessera.sources.writers import materialize

SHARD_ROWS = 1024
#: byte -> eight 8-bit counters, one for each bit
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], U64)


def _sum_rows(a: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of the (non-empty) row ranges of ``a``."""
    return np.add.reduceat(a, begin, axis=0) if len(begin) else a[:0]


def fingerprints_of(buf: np.ndarray, off: np.ndarray, words: int = 3, seed: int = 42) -> np.ndarray:
    """SimHash of each row of a slice."""
    w = words_of(buf, off)
    out = np.zeros(len(off) - 1, U64)
    flat, at, size = joined(w)
    n = w.counts
    live = np.flatnonzero(n)
    if len(live) == 0:
        return out
    shingles = np.maximum(n[live] - words + 1, 1)
    begin = np.concatenate(([0], np.cumsum(shingles)))
    head = np.arange(begin[-1]) - np.repeat(begin[:-1] - w.first[live], shingles)
    tail = head + np.repeat(np.minimum(n[live], words), shingles) - 1
    h = xxh64_spans(flat, at[head], at[tail] + size[tail] - at[head], seed)
    # ones per bit and row: 8-bit counters over runs of at most 255 shingles, then 32-bit sums
    runs = -(-shingles // 255)
    run_first = np.concatenate(([0], np.cumsum(runs)))
    run_at = np.repeat(begin[:-1], runs) + 255 * (
        np.arange(run_first[-1]) - np.repeat(run_first[:-1], runs))
    lanes = h.view(np.uint8).reshape(-1, 8)
    bits = np.zeros(len(live), U64)
    for byte in range(8):
        part = np.add.reduceat(_SPREAD[lanes[:, byte]], run_at)
        ones = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int32),
                               run_first[:-1], axis=0)
        over = (2 * ones > shingles[:, None]).astype(np.uint8)
        bits |= np.packbits(over, axis=1, bitorder="little")[:, 0].astype(U64) << U64(8 * byte)
    out[live] = bits
    return out


def fingerprints(docs: DataFrame, words: int = 3, *more: str) -> DataFrame:
    """(doc_id, further columns, fp): the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            parts = [fingerprints_of(buf, off, words) for _, _, buf, off
                     in slices_of(batch.column(1))]
            fp = np.concatenate(parts) if parts else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(fp.view(np.int64))],
                names=["doc_id", *more, "fp"])
    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in more)
    return bound_tables(docs, "doc_id", "text", *more).mapInArrow(
        run, f"doc_id bigint, {kinds}fp bigint")


class BKTree:
    """Integers by Hamming distance; each child hangs on its distance to the parent."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add_and_find(self, x: int, radius: int) -> list[int]:
        """Nodes within the radius of ``x``, which becomes a node itself."""
        found: list[int] = []
        new = len(self.value)
        if new:
            value, children = self.value, self.children
            stack = [0]
            while stack:
                i = stack.pop()
                d = (x ^ value[i]).bit_count()
                if d <= radius:
                    found.append(i)
                for edge, child in children[i].items():
                    if d - radius <= edge <= d + radius:
                        stack.append(child)
            i = 0
            while (d := (x ^ value[i]).bit_count()) in children[i]:
                i = children[i][d]
            children[i][d] = new
        self.value.append(x)
        self.children.append({})
        return found


def shard_stars(members: list[int], radius: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest fingerprint of its component in the shard), itself left out."""
    tree, root = BKTree(), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = sorted(set(members))
    for n, x in enumerate(order):
        root.append(n)
        for i in tree.add_and_find(x & 0xFFFFFFFFFFFFFFFF, radius):
            a, b = top(i), top(n)
            if a != b:
                root[max(a, b)] = min(a, b)
    return [(order[i], order[top(i)]) for i in range(len(order)) if top(i) != i]


def _stars(shards: DataFrame, radius: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [p for m in batch.column(0).to_pylist() for p in shard_stars(m, radius)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in found], pa.int64()),
                 pa.array([p[1] for p in found], pa.int64())], names=["u", "v"])
    return shards.select("members").mapInArrow(run, "u bigint, v bigint")


def _part(col, widths_shifts) -> F.Column:
    """The named bit fields of an integer column, one above the other."""
    out, at = F.lit(0).cast("long"), 0
    for width, shift in widths_shifts:
        field = F.shiftrightunsigned(col, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(field, at))
        at += width
    return out


def links(fps: DataFrame, spark: SparkSession, radius: int = 2) -> DataFrame:
    """Links (u, v) between distinct fingerprints that connect exactly those
    connected by distances of at most ``radius`` (2)."""
    if radius > 2:
        raise ValueError("the four blocks cover a radius of 2 at most")
    pairs = list(combinations(range(4), 2))
    fp = F.col("fp")
    keyed = fps.select(fp, F.explode(F.array(*[
        F.struct(F.lit(i).alias("pair"), _part(fp, [(16, 16 * b) for b in p]).alias("value"))
        for i, p in enumerate(pairs)])).alias("k")).select("fp", "k.pair", "k.value")
    sizes = keyed.groupBy("pair", "value").agg(F.count("*").alias("n")).where("n > 1")
    crowded = materialize(keyed.join(sizes, ["pair", "value"]), spark, "simhash-shards")
    small = (crowded.where(F.col("n") <= SHARD_ROWS).groupBy("pair", "value")
             .agg(F.collect_list("fp").alias("members")))
    # large shards: the other two blocks as four bytes, of which two bits leave two untouched
    rest = F.lit(0).cast("long")
    for i, p in enumerate(pairs):
        other = [b for b in range(4) if b not in p]
        rest = F.when(F.col("pair") == i, _part(fp, [(16, 16 * b) for b in other])).otherwise(rest)
    large = (crowded.where(F.col("n") > SHARD_ROWS).withColumn("rest", rest)
             .select("fp", "pair", "value", F.explode(F.array(*[
                 F.struct(F.lit(i).alias("pair2"),
                          _part(F.col("rest"), [(8, 8 * b) for b in p]).alias("value2"))
                 for i, p in enumerate(pairs)])).alias("k"))
             .groupBy("pair", "value", "k.pair2", "k.value2")
             .agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1))
    return _stars(small.select("members").unionByName(large.select("members")), radius).distinct()


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): the smallest node that it reaches.

    Alternating large and small stars: each round is a few aggregations and
    joins over the edges, written to the shared folder; no component is ever
    gathered in one place.
    """
    def canonical(e):
        return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
                .where("u != v").distinct()

    def star(e, larger: bool):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            if larger else e
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
                    .select("u", F.least("u", "m").alias("m"))
        near = both.join(least, "u")
        if larger:
            return canonical(near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        return canonical(near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                         .unionByName(least.select("u", F.col("m").alias("v"))))

    def state(e):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = materialize(canonical(edges), spark, "components")
    before = state(edges)
    while before[0]:
        edges = materialize(star(star(edges, True), False), spark, "components")
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
                             .distinct())


def _rooted(classes: DataFrame, spark: SparkSession, radius: int) -> DataFrame:
    """``classes`` (one row for each fp) with the ``root`` of each fingerprint's component."""
    found = components(links(classes.select("fp"), spark, radius), spark)
    return (classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
            .select(*classes.columns, F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    prints = materialize(fingerprints(docs, words), spark, "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = _rooted(classes, spark, radius)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """Rows of ``docs`` (all its columns), one of each group: that of the smallest
    doc_id (null ids last); of several texts of that id, that of the smallest
    hash; of rows of equal id and text, one.

    A row is known by a hash of its id and text.  Groups are settled on these
    and fingerprints; the texts are shuffled once, by that hash, and only after
    each task has left one row of each.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(docs["text"], F.lit("")))
    # the columns go along as one struct, so their names meet no others
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"],
                        docs["text"], F.unhex(F.md5(own)).alias("key"))
    prints = materialize(fingerprints(keyed.select("doc_id", "text", "key"), words, "key"), spark, "simhash-prints")
    order = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "key")
    classes = prints.groupBy("fp").agg(F.min(order).alias("least"))
    keep = (_rooted(classes, spark, radius).groupBy("root").agg(F.min("least").alias("least"))
            .select("least.key"))
    copies = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    # an inner join: a semi join would be moved below the window, where copies meet in one task
    return (keyed.select("row", "key").withColumn("place", F.row_number().over(copies)).where("place = 1")
            .join(keep, "key").select("row.*"))
