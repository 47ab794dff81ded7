"""Ranked lexical search by dense blocked matrix products.

Every document is scored for every item of a stated query set (a benchmark).
A query block's distinct terms are its vocabulary.  One scan of the documents
tokenises whole texts and keeps, for each document, its term count and the
occurrences of vocabulary terms (postings, written as Parquet).  Corpus counts
(documents, terms, and documents per vocabulary term) are summed by Spark from
these.  Then each task multiplies dense tiles in float64: item weights (items
times a compact run of the vocabulary) by document impacts (the same run times
documents).  A run ends before its largest possible sum reaches 2^53, so every
product is an exact integer; the runs' products are added as 64-bit integers.

A tile keeps, of each item, every document whose score reaches its k-th
largest, equal scores included, and orders them by score, then id; so no tie is
cut by chance.  Each task carries on k rows an item; Spark takes the k best of
them, first within shares of the tasks, then over all.

The queries go in blocks of ``BLOCK_BYTES`` of text, of which one is held at a
time; its vocabulary is the only thing sent to all tasks.  Terms are compared
as byte strings, not by hash.

Defined results: a null or empty text has no terms and no rank; rows of equal
id are documents (or items) of their own; among equal scores a null id comes
last; an item whose terms no document holds has no rows; without documents or
items there are none.  Further columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import (LOWER, Words, as_strings, bound_tables, bounded_batches, slices_of,
                                words_of)
from tessera.sources.writers import materialize

BLOCK_BYTES = 4 << 20
TILE_DOCS = 512
TILE_ITEMS = 256
TILE_TERMS = 4096
SHARES = 64
#: an impact is (10^9 tf) div (1000 tf + 8 m) with m of 10 or more: below 10^6
IMPACT_BOUND = 10 ** 6
EXACT = 1 << 53

#: bytes between terms: ASCII without letters and digits
TERM_GAP = np.zeros(256, bool)
TERM_GAP[:128] = True
TERM_GAP[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def terms_of(buf: np.ndarray, off: np.ndarray) -> tuple[Words, pa.Array]:
    """The terms of a slice, A-Z lower-cased, as spans and as an Arrow array."""
    w = words_of(LOWER[buf], off, TERM_GAP)
    ends = np.concatenate(([0], np.cumsum(w.end - w.start))).astype(np.int32)
    solid = w.buf[~TERM_GAP[w.buf]]
    return w, pa.Array.from_buffers(pa.binary(), len(w.start),
                                    [None, pa.py_buffer(ends), pa.py_buffer(solid)])


class Block:
    """Items of one block: per item its distinct vocabulary numbers."""

    def __init__(self, ids: list, texts: list) -> None:
        self.ids = ids
        terms, rows = [], []
        for lo, _, buf, off in slices_of(pa.array(texts, pa.string())):
            w, found = terms_of(buf, off)
            terms.append(found)
            rows.append(w.row_of() + lo)
        flat = pa.concat_arrays(terms) if terms else pa.array([], pa.binary())
        self.vocabulary = pc.unique(flat)
        number = pc.index_in(flat, self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        both = np.unique(row * max(1, len(self.vocabulary)) + number)
        self.row, self.term = np.divmod(both, max(1, len(self.vocabulary)))

    def tiles(self, weight: np.ndarray) -> Iterator[tuple[int, int, list]]:
        """(first item, end item, [(terms, weights)]) of each item tile, its
        vocabulary in runs whose sums stay exact."""
        for lo in range(0, len(self.ids), TILE_ITEMS):
            hi = min(lo + TILE_ITEMS, len(self.ids))
            a, b = np.searchsorted(self.row, [lo, hi])
            row, term = self.row[a:b] - lo, self.term[a:b]
            use = weight[term] > 0
            row, term = row[use], term[use]
            own = np.unique(term)
            runs = []
            for s, e in exact_runs(weight[own]):
                mine = own[s:e]
                at = np.searchsorted(mine, term)
                inside = (at < len(mine)) & (mine[np.minimum(at, len(mine) - 1)] == term)
                dense = np.zeros((hi - lo, len(mine)))
                dense[row[inside], at[inside]] = weight[term[inside]]
                runs.append((mine, dense))
            yield lo, hi, runs


def exact_runs(weight: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of at most ``TILE_TERMS`` weights whose products with any impacts sum to less than 2^53."""
    s = 0
    total = np.concatenate(([0], np.cumsum(weight)))
    while s < len(weight):
        e = int(np.searchsorted(total, total[s] + (EXACT - 1) // IMPACT_BOUND, side="right")) - 1
        e = max(s + 1, min(e, s + TILE_TERMS, len(weight)))
        yield s, e
        s = e


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


_POSTED = "ids array<bigint>, sizes array<bigint>, at array<int>, term array<int>, tf array<bigint>"


def _postings(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Packed rows of documents with a term: ids, term counts, and (row, term, tf)."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, off in slices_of(batch.column(1)):
                w, flat = terms_of(buf, off)
                number = pc.index_in(flat, vocabulary)
                known = pc.is_valid(number).to_numpy(zero_copy_only=False)
                number = pc.fill_null(number, 0).to_numpy(zero_copy_only=False).astype(np.int64)
                held = np.flatnonzero(w.counts > 0)
                row = np.searchsorted(held, w.row_of()[known])       # a tile's rows are consecutive
                width = max(1, len(vocabulary))
                both, tf = np.unique(row * width + number[known], return_counts=True)
                row, term = np.divmod(both, width)
                tile = np.minimum(np.arange(0, len(held) + TILE_DOCS, TILE_DOCS), len(held))
                cuts = np.searchsorted(row, tile)
                kept = ids.take(pa.array(held + lo)), pa.array(w.counts[held])
                found = (pa.array((row % TILE_DOCS).astype(np.int32)), pa.array(term.astype(np.int32)),
                         pa.array(tf))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(c.astype(np.int32)), v)
                     for c, vs in ((tile, kept), (cuts, found)) for v in vs],
                    names=["ids", "sizes", "at", "term", "tf"])

    return bound_tables(docs, "doc_id", "text").mapInArrow(run, _POSTED)


def _flat(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column (null elements: the largest integer)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = pc.fill_null(column.flatten(), np.iinfo(kind).max).to_numpy(zero_copy_only=False)
    off = np.concatenate(([0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))))
    return values.astype(kind), off.astype(np.int64)


def _counts(posted: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents and terms of the corpus, and documents per vocabulary number."""
    def run(batches):
        df = np.zeros(width, np.int64)
        for batch in batches:
            df += np.bincount(_flat(batch.column(0), np.int32)[0], minlength=width)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], names=["term", "df"])

    total = posted.agg(F.sum(F.size("sizes").cast("long")),
                       F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    df = np.zeros(width, np.int64)
    for r in posted.select("term").mapInArrow(run, "term bigint, df bigint") \
                   .groupBy("term").agg(F.sum("df").alias("df")).collect():     # the block's terms at most
        df[r["term"]] = r["df"]
    return int(total[0] or 0), int(total[1] or 0), df


def best_of(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, id, score) of the k best positive documents of each row of
    ``score``, ordered by item, score (highest first) and id."""
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
    else:
        least = np.zeros(len(score), np.int64)
    item, doc = np.nonzero(score >= np.maximum(least, 1)[:, None])      # ties stay
    return first_of(item, ids[doc], score[item, doc], k)


def first_of(item: np.ndarray, doc: np.ndarray, score: np.ndarray, k: int):
    """The first k of each item by score, then id."""
    order = np.lexsort((doc, -score, item))
    item, doc, score = item[order], doc[order], score[order]
    begin = np.searchsorted(item, item)
    keep = np.arange(len(item)) - begin < k
    return item[keep], doc[keep], score[keep]


_NULL_ID = np.iinfo(np.int64).max


def _search_block(posted: DataFrame, block: Block, k: int) -> DataFrame:
    """(number, item_id, doc_id, score): the k best of each item, by task share."""
    n, length, df = _counts(posted, len(block.vocabulary))
    weight = weights(df, n)
    weight[df == 0] = 0

    def run(batches):
        tiles = list(block.tiles(weight))
        place = np.full(max(1, len(weight)), -1, np.int64)
        empty = np.zeros(0, np.int64)
        best = [(empty, empty, empty) for _ in tiles]
        for batch in batches:
            ids, ids_off = _flat(batch.column(0), np.int64)
            size, _ = _flat(batch.column(1), np.int64)
            at, off = _flat(batch.column(2), np.int32)
            term, _ = _flat(batch.column(3), np.int32)
            tf, _ = _flat(batch.column(4), np.int64)
            for r in range(len(ids_off) - 1):
                d = slice(ids_off[r], ids_off[r + 1])
                p = slice(off[r], off[r + 1])
                m = 10 + 90 * size[d] * n // length
                impact = 10 ** 9 * tf[p] // (1000 * tf[p] + 8 * m[at[p]])
                for t, (lo, hi, runs) in enumerate(tiles):
                    score = np.zeros((hi - lo, len(m)), np.int64)
                    for own, dense in runs:
                        place[own] = np.arange(len(own))
                        here = place[term[p]]
                        use = here >= 0
                        place[own] = -1
                        tile = np.zeros((len(own), len(m)))
                        tile[here[use], at[p][use]] = impact[use]
                        score += (dense @ tile).astype(np.int64)
                    found = best_of(score, ids[d], k)
                    best[t] = first_of(*(np.concatenate(x) for x in zip(best[t], found)), k)
        for (lo, _, _), (item, doc, score) in zip(tiles, best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item + lo), pa.array([block.ids[i + lo] for i in item], pa.int64()),
                 pa.array(doc, mask=doc == _NULL_ID), pa.array(score)],
                names=["number", "item_id", "doc_id", "score"])

    found = posted.mapInArrow(run, "number bigint, item_id bigint, doc_id bigint, score bigint")
    by = F.desc("score"), F.asc_nulls_last("doc_id")
    share = Window.partitionBy("number", "share").orderBy(*by)
    return (found.withColumn("share", F.spark_partition_id() % SHARES)
            .withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*by)))
            .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))


def query_blocks(queries: DataFrame, limit: int) -> Iterator[tuple[list, list]]:
    """(ids, texts) of blocks of at most ``limit`` bytes or one text, streamed to
    the driver block by block."""
    rows = bound_tables(queries, "item_id", "text").where("text IS NOT NULL")
    ids, texts, held = [], [], 0
    for r in rows.toLocalIterator():
        size = len(r["text"].encode())
        if held and held + size > limit:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        held += size
    if ids:
        yield ids, texts


def search(docs: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of ``docs``
    (doc_id, text) for every row of ``queries`` (item_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for ids, texts in query_blocks(queries, block_bytes):
        block = Block(ids, texts)
        posted = materialize(_postings(docs, block.vocabulary), spark, "search-postings")
        out = out.unionByName(materialize(_search_block(posted, block, k), spark, "search-best"))
    return out
