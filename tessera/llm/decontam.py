"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-cased runs of letters and digits.  A document and
a benchmark item meet where they share a seed, ``MIN_TILE`` = 4 consecutive
tokens.  Where the shared seeds could cover enough of the item, running
Karp-Rabin matching marks the longest non-overlapping common runs (tiles) of
at least that length, longest first, whatever their order, so a reordered
passage is caught too.  An item leaks if tiles cover at least ``COVERAGE`` = 0.5
of its tokens; an item shorter than a seed leaks if it occurs whole.

The benchmark is the query set: it is taken in blocks of about
``BLOCK_BYTES`` of text, and each block's seeds go to all tasks (a bounded
broadcast) for one scan of the documents, which is written to the shared folder
before the next block is loaded, so a larger benchmark costs more scans and
never more memory.

Defined results: null or empty texts share nothing, and an item without tokens
leaks nowhere; repeated rows, documents or items, each give their own rows; a
document with several leaked items gives one row for each.
"""

from __future__ import annotations

from collections import defaultdict
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import (as_strings, bound_tables, bounded_batches, slices_of, span_hash,
                                window_hash, words_of)
from tessera.sources.writers import materialize

MIN_TILE = 4
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
_MOD = (1 << 61) - 1
_BASE = 1_000_003

#: everything but ASCII letters, digits and the bytes of other letters
GAP = np.ones(256, bool)
GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _prefixes(x: list[int]) -> list[int]:
    """Karp-Rabin hash of every prefix."""
    out = [0]
    for v in x:
        out.append((out[-1] * _BASE + v) % _MOD)
    return out


def _next_used(used: list[bool]) -> list[int]:
    """Of each position, the first used one from it on."""
    out = [len(used)] * (len(used) + 1)
    for i in range(len(used) - 1, -1, -1):
        out[i] = i if used[i] else out[i + 1]
    return out


class _Marks:
    """Used positions of one side; a tile's positions know its bounds."""

    def __init__(self, used: list[bool]) -> None:
        self.used = used
        self.lo, self.hi = list(range(len(used))), list(range(1, len(used) + 1))

    def mark(self, start: int, size: int) -> None:
        end = start + size
        self.used[start:end] = [True] * size
        self.lo[start:end], self.hi[start:end] = [start] * size, [end] * size


def greedy_tiles(pattern: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """(pattern start, text start, length) of the tiles: again and again the longest
    common run of unmarked tokens, of equal ones the first in the pattern, then in the text.

    Tokens are compared as integers; negative ones in ``text`` match nothing.
    The search length runs down from half the shorter side to ``least``; at each
    length equal windows are linked only where a match begins, so a token that
    repeats a thousand times costs its places and not their pairs, and a match's
    length is found by bisection over prefix hashes.  A match that a longer tile
    cut is put back with what is left of it.
    """
    n, m = len(pattern), len(text)
    tiles: list[tuple[int, int, int]] = []
    if min(n, m) < least:
        return tiles
    p, t = _Marks([False] * n), _Marks([v < 0 for v in text])
    hash_p, hash_t = _prefixes(pattern), _prefixes(text)
    powers = [1]
    for _ in range(min(n, m)):
        powers.append(powers[-1] * _BASE % _MOD)

    def window(prefix: list[int], start: int, size: int) -> int:
        return (prefix[start + size] - prefix[start] * powers[size]) % _MOD

    def common(i: int, j: int, known: int, most: int) -> int:
        """Length of the match at (i, j), ``known`` to ``most``."""
        lo, hi = known, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if window(hash_p, i, mid) == window(hash_t, j, mid):
                lo = mid
            else:
                hi = mid - 1
        if pattern[i:i + lo] == text[j:j + lo]:
            return lo
        lo = 0                  # two windows of one hash
        while lo < most and pattern[i + lo] == text[j + lo]:
            lo += 1
        return lo

    def matches(size: int) -> list[tuple[int, int, int]]:
        end_p, end_t = _next_used(p.used), _next_used(t.used)
        # places by hash, then by the token before them (none: a match begins there in any case)
        free: dict[int, dict[int | None, list[int]]] = {}
        for i in range(n - size + 1):
            if end_p[i] >= i + size:
                before = None if i == 0 or p.used[i - 1] else pattern[i - 1]
                free.setdefault(window(hash_p, i, size), {}).setdefault(before, []).append(i)
        found = []
        for j in range(m - size + 1) if free else ():
            if end_t[j] < j + size:
                continue
            before = None if j == 0 or t.used[j - 1] else text[j - 1]
            for token, places in free.get(window(hash_t, j, size), {}).items():
                if token is not None and token == before:
                    continue        # not the start of a maximal match
                for i in places:
                    k = common(i, j, size, min(end_p[i] - i, end_t[j] - j))
                    if k >= size:
                        found.append((-k, i, j))
        return found

    size = max(least, min(n, m) // 2)
    while True:
        heap = matches(size)
        heapify(heap)
        while heap:
            k, i, j = heappop(heap)
            a, b = 0, -k
            # a tile marked by now is no shorter, so it covers one end of what it cuts
            while a < b and (p.used[i + a] or t.used[j + a]):
                a = max(p.hi[i + a] - i if p.used[i + a] else 0, t.hi[j + a] - j if t.used[j + a] else 0)
            while a < b and (p.used[i + b - 1] or t.used[j + b - 1]):
                b = min(p.lo[i + b - 1] - i if p.used[i + b - 1] else b,
                        t.lo[j + b - 1] - j if t.used[j + b - 1] else b)
            if b - a == -k:
                p.mark(i, b)
                t.mark(j, b)
                tiles.append((i, j, b))
            elif b - a >= size:
                heappush(heap, (a - b, i + a, j + a))
        if size == least:
            return tiles
        size = max(least, size // 2)


def _tokens(column):
    """Slices of a column's lower-cased copy: (first row, words, token hashes)."""
    low = pc.utf8_lower(as_strings(column))
    for lo, _, buf, off in slices_of(low):
        w = words_of(buf, off, GAP)
        yield lo, w, span_hash(w.buf, w.start, w.end)


class Items:
    """A block of benchmark items with their seeds, by seed length."""

    def __init__(self, ids: list, texts: list) -> None:
        self.ids, self.tokens = [], []
        rows = iter(ids)
        for _, w, h in _tokens(pa.array(texts, pa.string())):
            for a, b in zip(w.first[:-1], w.first[1:]):
                i = next(rows)
                if b > a:
                    self.ids.append(i)
                    self.tokens.append(h[a:b])
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        sizes = np.array([len(t) for t in self.tokens], np.int64)
        for size in sorted(set(np.minimum(sizes, MIN_TILE).tolist())):
            mine = np.flatnonzero(np.minimum(sizes, MIN_TILE) == size)
            flat = np.concatenate([self.tokens[i] for i in mine])
            first = np.concatenate(([0], np.cumsum(sizes[mine])))
            at, h = window_hash(flat, first, size)
            where = np.searchsorted(first, at, side="right") - 1
            order = np.argsort(h, kind="stable")
            self.seeds[size] = (h[order], mine[where][order], (at - first[where])[order])

    def leaks(self, h: np.ndarray, first: np.ndarray, coverage: float):
        """(row, item, coverage, tiles, longest) of the leaked items of each row of a slice."""
        for size, (seeds, item, place) in self.seeds.items():
            at, v = window_hash(h, first, size)
            lo = np.searchsorted(seeds, v)
            hit = np.flatnonzero((lo < len(seeds)) & (seeds[np.minimum(lo, len(seeds) - 1)] == v))
            if not len(hit):
                continue
            row = np.searchsorted(first, at[hit], side="right") - 1
            cuts = np.flatnonzero(np.diff(row)) + 1
            for mine in np.split(np.arange(len(hit)), cuts):
                yield from self._row(int(row[mine[0]]), h, at[hit[mine]], v[hit[mine]], size, coverage)

    def _row(self, row: int, h, at, v, size: int, coverage: float):
        seeds, item, place = self.seeds[size]
        distinct = np.unique(v)
        lo, hi = np.searchsorted(seeds, distinct), np.searchsorted(seeds, distinct, side="right")
        by_item = defaultdict(list)
        for a, b in zip(lo.tolist(), hi.tolist()):
            for s in range(a, b):
                by_item[int(item[s])].append(s)
        for i, own in by_item.items():
            tokens = self.tokens[i]
            could = np.zeros(len(tokens) + 1, np.int64)
            starts = place[own]
            np.add.at(could, starts, 1)
            np.add.at(could, starts + size, -1)
            if np.count_nonzero(np.cumsum(could[:-1])) < coverage * len(tokens):
                continue
            # the document's runs that shared seeds cover, apart from each other
            runs = at[np.isin(v, seeds[own])]
            text, end = [], None
            for p in runs.tolist():
                if end is not None and p > end:
                    text.append(-1)
                text += h[p if end is None else max(p, end):p + size].tolist()
                end = p + size
            tiles = greedy_tiles(tokens.tolist(), text, size)
            share = sum(k for _, _, k in tiles) / len(tokens)
            if share >= coverage:
                yield row, i, share, len(tiles), max(k for _, _, k in tiles)


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark's rows in blocks of at most ``BLOCK_BYTES`` and one text.

    Rows are dealt out evenly, equal ones too, and each share is cut by its running size.
    """
    rows = bound_tables(benchmark, "item_id", "text").where("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = -(-size // BLOCK_BYTES)
    if shares <= 1:
        return [rows]
    before = Window.partitionBy("share").orderBy("item_id", "text").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = F.floor(F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)) / BLOCK_BYTES)
    dealt = materialize(rows.repartition(shares).withColumn("share", F.spark_partition_id())
                        .withColumn("cut", cut), benchmark.sparkSession, "benchmark",
                        partition_by=["share", "cut"])
    return [dealt.where((F.col("share") == r["share"]) & (F.col("cut") == r["cut"]))
            for r in dealt.select("share", "cut").distinct().orderBy("share", "cut").collect()]


def _items(rows: DataFrame) -> Items:
    got = rows.select("item_id", "text").collect()
    return Items([r["item_id"] for r in got], [r["text"] for r in got])


def _by_block(blocks: list[DataFrame], scan) -> list[DataFrame]:
    """``scan(items)`` of every block.  Of several blocks only one is held at a
    time: each scan is written out before the next block is loaded."""
    out = []
    for rows in blocks:
        items = _items(rows)
        if items.ids:
            found = scan(items)
            del items
            out.append(materialize(found, rows.sparkSession, "leaks") if len(blocks) > 1 else found)
            del found
    return out


_FOUND = "doc_id bigint, item_id bigint, coverage double, n_tiles bigint, longest bigint"


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text) and leaked item of
    ``benchmark`` (item_id, text): the share of the item's tokens in tiles,
    their number and the longest one's tokens."""
    bounded_batches(docs.sparkSession)
    source = bound_tables(docs, "doc_id", "text")

    def scan(items: Items) -> DataFrame:
        def run(batches):
            for batch in batches:
                out = []
                for lo, w, h in _tokens(batch.column(1)):
                    for row, i, share, n, longest in items.leaks(h, w.first, coverage):
                        out.append((lo + row, items.ids[i], share, n, longest))
                rows, ids, share, n, longest = zip(*out) if out else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, pa.int64()),
                     pa.array(share, pa.float64()), pa.array(n, pa.int64()),
                     pa.array(longest, pa.int64())],
                    names=["doc_id", "item_id", "coverage", "n_tiles", "longest"])
        return source.mapInArrow(run, _FOUND)

    out = None
    for found in _by_block(_blocks(benchmark), scan):
        out = found if out is None else out.unionByName(found)
    return source.where("false").selectExpr(
        "doc_id", "0L item_id", "0D coverage", "0L n_tiles", "0L longest") if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Rows of ``docs`` (all its columns) in which no benchmark item leaks.

    One block filters the rows as they are read.  Of several blocks each gives
    the digests of the texts with leaks, as these depend on the text alone.
    """
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")
    schema = docs.schema

    def leaky(items: Items, column) -> np.ndarray:
        bad = np.zeros(len(column), bool)
        for lo, w, h in _tokens(column):
            for row, *_ in items.leaks(h, w.first, coverage):
                bad[lo + row] = True
        return bad

    def clean(items: Items) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(~leaky(items, batch.column(at))))
        return docs.mapInArrow(run, schema)

    digest = F.unhex(F.md5(F.coalesce(docs["text"], F.lit(""))))

    def scan(items: Items) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield batch.select([0]).filter(pa.array(leaky(items, batch.column(1))))
        return docs.select(digest.alias("_text"), docs["text"]).mapInArrow(run, "_text binary")

    blocks = _blocks(benchmark)
    if len(blocks) == 1:
        return (_by_block(blocks, clean) or [docs])[0]
    found = _by_block(blocks, scan)
    if not found:
        return docs
    leaked = found[0]
    for more in found[1:]:
        leaked = leaked.unionByName(more)
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), digest.alias("_text"))
    return held.join(leaked.distinct(), "_text", "left_anti").select("row.*")
