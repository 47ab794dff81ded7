"""Exact removal of long repeated passages by fixed-block anchors.

A window is ``window`` = 35 consecutive words.  Any window holds a whole
aligned block of 18 words ((35 + 1) / 2) of its own document, wherever it
starts.  So every document's non-overlapping 18-word blocks are the reference
index, and every rolling 18-word window of every document probes it.  A probe
that meets a block of another place is an anchor; only the 35-word windows
around anchors can be repeats, and they are compared whole: a window whose
word sequence starts at two or more places is part of a maximal exact repeat,
and the union of such windows is removed.

Both comparisons use one primitive, ``_repeated``: chunks of documents send
each shard (a range of hash values) their distinct values, the shard counts
them, and the chunk gets back the values found repeated.  A value costs one
entry per chunk however often it occurs, so a passage that a third of all
documents share is summed before the shuffle; no pair of documents is ever
formed, and no list grows with a passage's popularity beyond the chunk count.
Sequences are compared by 64-bit hash; the anchors by 48 bits, which can only
add windows to compare.

Defined results: null and empty texts have no words (n_words 0, the hash of
the empty string); repeated rows, of equal doc_id too, are different places;
a document of fewer than 35 words loses nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import (PACKED, U64, bounded_batches, joined, pack, row_slices, span_hash,
                                unpack, window_hash, words_of)
from tessera.sources.writers import materialize

CHUNK_BYTES = 6 << 20
SHARD_VALUES = 1_500_000
_REQUEST = "shard int, chunk bigint, low binary, counts binary, flags binary"


def _parts(ids: bytes, offs: bytes, data: bytes):
    """Slices of a packed chunk: (first document, words, word hashes)."""
    _, buf, off = unpack(ids, offs, data)
    for lo, hi in row_slices(off):
        w = words_of(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        yield lo, w, span_hash(w.buf, w.start, w.end)


def _send(chunk: int, values: list[np.ndarray], marked: list[np.ndarray], bits: int, shards: int):
    """A chunk's distinct values, one request for each shard (a range of values).

    A value of ``bits`` bits is sent as its low 32 bits, sorted, with the count
    of values under each higher prefix.  Two flags tell whether it occurs more
    than once in the chunk and whether an occurrence is marked.
    """
    v = np.concatenate(values) if values else np.zeros(0, U64)
    m = np.concatenate(marked) if marked else np.zeros(0, bool)
    order = np.argsort(v, kind="stable")
    v, m = v[order], m[order]
    begin = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.zeros(0, int)
    many = np.diff(np.concatenate((begin, [len(v)]))) > 1
    mark = np.maximum.reduceat(m, begin) if len(v) else m
    v = v[begin]
    flags = many.astype(np.uint8) | (mark.astype(np.uint8) << 1)
    width = -(-(1 << bits) // shards)
    edges = np.searchsorted(v, np.array([min(width * s, (1 << bits) - 1) for s in range(shards)], U64))
    edges = np.append(edges, len(v))
    for s in range(shards):
        a, b = edges[s], edges[s + 1]
        if a < b:
            high = v[a:b] >> U64(32)
            prefix, n = np.unique(high, return_counts=True)
            head = np.concatenate((prefix, n.astype(U64)))
            yield (s, chunk, v[a:b].astype(np.uint32).tobytes(), head.tobytes(),
                   np.packbits(np.stack((flags[a:b] & 1, flags[a:b] >> 1))).tobytes())


def _read(low: bytes, counts: bytes, flags: bytes):
    low32 = np.frombuffer(low, np.uint32).astype(U64)
    head = np.frombuffer(counts, U64)
    half = len(head) // 2
    v = (np.repeat(head[:half], head[half:].astype(np.int64)) << U64(32)) | low32
    both = np.unpackbits(np.frombuffer(flags, np.uint8), count=2 * len(v)).astype(bool)
    return v, both[:len(v)], both[len(v):]


def _repeated(requests: DataFrame, need_mark: bool) -> DataFrame:
    """(chunk, hits): each chunk's values that occur twice or more over all
    chunks, with ``need_mark`` only those of which an occurrence is marked."""
    def count(key, frames: pd.DataFrame) -> pd.DataFrame:
        pieces = [_read(*r) for r in zip(frames["low"], frames["counts"], frames["flags"])]
        v = np.concatenate([p[0] for p in pieces])
        order = np.argsort(v, kind="stable")
        s = v[order]
        begin = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        hit = np.diff(np.append(begin, len(s))) > 1
        hit |= np.maximum.reduceat(np.concatenate([p[1] for p in pieces])[order], begin)
        if need_mark:
            hit &= np.maximum.reduceat(np.concatenate([p[2] for p in pieces])[order], begin)
        wanted = s[begin][hit]
        out = []
        for chunk, (values, _, _) in zip(frames["chunk"], pieces):
            at = np.searchsorted(wanted, values)
            at[at == len(wanted)] = 0
            mine = values[wanted[at] == values] if len(wanted) else values[:0]
            if len(mine):
                out.append((chunk, mine.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "hits"])

    return requests.groupBy("shard").applyInPandas(count, "chunk bigint, hits binary")


def _requests(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["shard", "chunk", "low", "counts", "flags"])


def _hits(frame: pd.DataFrame) -> np.ndarray:
    if not len(frame):
        return np.zeros(0, U64)
    return np.sort(np.concatenate([np.frombuffer(h, U64) for h in frame["hits"]]))


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted) or not len(values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(wanted, values)
    at[at == len(wanted)] = 0
    return wanted[at] == values


def repeat_spans(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text",
                 keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; ``kept`` too (the
    kept words, joined by one space) with ``keep_text``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    block = (window + 1) // 2
    cut = U64(16)      # anchors are compared by the upper 48 bits

    packed = materialize(pack(docs, key, text, CHUNK_BYTES), spark, "repeats-packed")
    size = packed.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shards = max(1, min(1 << 20, int(size * 0.4) // SHARD_VALUES + 1))

    def probes(batches):
        for batch in batches:
            for chunk, *row in zip(*(c.to_pylist() for c in batch.columns)):
                values, marks = [], []
                for _, w, h in _parts(*row):
                    at, v = window_hash(h, w.first, block)
                    values.append(v >> cut)
                    marks.append((at - w.first[:-1][w.row_of()[at]]) % block == 0)
                yield _requests(list(_send(chunk, values, marks, 48, shards)))

    anchors = _repeated(packed.mapInArrow(probes, _REQUEST), True)

    def windows(key_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        wanted = _hits(right)
        values = []
        for _, row in left.iterrows():
            for _, w, h in _parts(row["ids"], row["offs"], row["data"]):
                at, v = window_hash(h, w.first, block)
                hit = at[_among(v >> cut, wanted)]
                starts, long = window_hash(h, w.first, window)
                # a window starting at s holds anchors from s to s + window - block
                before = np.zeros(len(h) + 1, np.int64)
                before[hit + 1] = 1
                before = np.cumsum(before)
                near = before[starts + window - block + 1] > before[starts]
                values.append(long[near])
        rows = _send(int(key_[0]), values, [np.zeros(len(v), bool) for v in values], 64, shards)
        return pd.DataFrame(list(rows), columns=["shard", "chunk", "low", "counts", "flags"])

    # chunks without an anchor meet only an empty side
    found = _repeated(packed.groupBy("chunk").cogroup(anchors.groupBy("chunk"))
                      .applyInPandas(windows, _REQUEST), False)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (
        ", kept string" if keep_text else "")

    def remove(key_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        wanted = _hits(right)
        out = []
        for _, row in left.iterrows():
            ids, _, _ = unpack(row["ids"], row["offs"], b"")
            for lo, w, h in _parts(row["ids"], row["offs"], row["data"]):
                starts, v = window_hash(h, w.first, window)
                hit = starts[_among(v, wanted)]
                cover = np.zeros(len(h) + 1, np.int64)
                cover[hit] += 1
                cover[hit + window] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                flat, at, size = joined(w, lower=False)
                lost = np.concatenate(([0], np.cumsum(gone)))
                raw = flat.tobytes()
                stay = np.repeat(~gone, size + 1) if len(h) else np.zeros(0, bool)
                for i in range(len(w.first) - 1):
                    a, b = w.first[i], w.first[i + 1]
                    removed = int(lost[b] - lost[a])
                    if a == b:
                        kept = b""
                    else:
                        s, e = at[a], at[b - 1] + size[b - 1] + 1
                        kept = raw[s:e] if not removed else flat[s:e][stay[s:e]].tobytes()
                        kept = kept[:-1]
                    out.append((ids[lo + i], int(b - a), removed, hashlib.sha256(kept).hexdigest(),
                                *([kept.decode()] if keep_text else [])))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else [])]
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({"doc_id": "Int64"})

    return (packed.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInPandas(remove, schema))
