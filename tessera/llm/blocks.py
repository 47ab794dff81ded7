"""Array helpers shared by the text operators.

A column of texts is taken as one byte buffer with row offsets (that is how
Arrow stores it), cut into slices of bounded size, and tokenised and hashed
with array operations, so no Python object is made per word.  A single text
longer than the slice size forms a slice of its own.

Words are ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes; a null text has none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 1 << 21
LONG_SPAN = 256
U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE_BYTES = U64(0x9E3779B97F4A7C15)
_BASE_WORDS = U64(0xD1342543DE82EF95)
#: masks of the lowest 0 to 8 bytes
_KEEP_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], U64)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded size: the texts of a batch are in memory at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def bound_tables(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: further ones (also of clashing names) go no further."""
    return df.select(*[df[c] for c in columns])


def as_strings(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the row offsets into them."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def row_slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def slices_of(column, limit: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets) of each slice of a column."""
    data, off = buffer_of(as_strings(column))
    for lo, hi in row_slices(off, limit):
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


@dataclass
class Words:
    """Words of one slice: byte spans, and the first word of each row."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(buf: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> Words:
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(buf, none, none, np.zeros(len(off), np.int64))
    solid = ~gap[buf]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | cut[1:n]
    closes[:-1] &= ~solid[1:] | cut[1:n]
    start = np.flatnonzero(opens)
    return Words(buf, start, np.flatnonzero(closes) + 1, np.searchsorted(start, off))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift-multiply), so that every bit depends on all."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans hash alike anywhere.

    Eight bytes at a time, mixed after each, so that no difference cancels out
    as it does in a polynomial; spans of over ``LONG_SPAN`` bytes go to XXH3.
    """
    size = end - start
    lanes = np.ndarray((len(buf) + 1,), "<u8", np.concatenate((buf, np.zeros(8, np.uint8))), 0, (1,))
    out = mix(size.astype(U64) + _BASE_BYTES)
    long = np.flatnonzero(size > LONG_SPAN)
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN)) if len(long) else np.flatnonzero(size > 0)
    at, left = start[live], size[live]
    while len(live):
        word = lanes[at] & _KEEP_BYTES[np.minimum(left, 8)]
        out[live] = mix(out[live] ^ (word * _BASE_WORDS))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    if len(long):
        raw = memoryview(np.ascontiguousarray(buf))
        for k in long.tolist():
            out[k] ^= U64(xxhash.xxh3_64_intdigest(raw[int(start[k]):int(end[k])], 1))
    return out


def window_hash(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of every window of k consecutive words of one row.

    Windows of twice the length are mixed of two neighbours, over and over, and
    those of length k of the powers of two in it.
    """
    n = len(h)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero(np.arange(n) + k <= last)
    out, done, length = np.full(len(at), U64(k)), 0, 1
    while True:
        if k & length:
            out = mix(out * _BASE_WORDS + h[at + done])
            done += length
        if 2 * length > k:
            return at, out
        h = mix(h[:-length] * _BASE_WORDS + h[length:])
        length *= 2


def joined(words: Words, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, A-Z lower-cased or not, with one space after each: bytes, starts, lengths."""
    size = words.end - words.start
    if len(size) == 0:
        return np.zeros(0, np.uint8), size, size
    at = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(at[-1], 0x20, np.uint8)
    solid = np.ones(at[-1], bool)
    solid[at[1:] - 1] = False
    text = words.buf[~SPACE[words.buf]]
    out[solid] = LOWER[text] if lower else text
    return out, at[:-1], size


# XXH64: fixed values of the published algorithm
_P1, _P2, _P3, _P4, _P5 = (U64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
    0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rot(x, r):
    return (x << U64(r)) | (x >> U64(64 - r))


def _round(acc, lane):
    return _rot(acc + lane * _P2, 31) * _P1


def xxh64_spans(buf: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of each byte span.  Spans of one length are hashed together;
    the few of over 200 bytes go to the library one by one."""
    out = np.zeros(len(start), U64)
    if len(start) == 0:
        return out
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    lanes = np.ascontiguousarray(np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,)))
    order = np.argsort(size, kind="stable")
    lengths, begin = np.unique(size[order], return_index=True)
    seed64 = U64(seed)
    with np.errstate(over="ignore"):
        for length, a, b in zip(lengths.tolist(), begin, [*begin[1:], len(order)]):
            rows = order[a:b]
            if length > 200:
                raw = buf.tobytes()
                for r in rows.tolist():
                    s = int(start[r])
                    out[r] = xxhash.xxh64_intdigest(raw[s:s + length], seed)
                continue
            p = start[rows].astype(np.int64)
            done = 0
            if length >= 32:
                v = [np.full(len(p), x, U64) for x in
                     (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
                while done + 32 <= length:
                    v = [_round(x, lanes[p + (done + 8 * k)]) for k, x in enumerate(v)]
                    done += 32
                h = _rot(v[0], 1) + _rot(v[1], 7) + _rot(v[2], 12) + _rot(v[3], 18)
                for x in v:
                    h = (h ^ _round(U64(0), x)) * _P1 + _P4
            else:
                h = np.full(len(p), seed64 + _P5, U64)
            h = h + U64(length)
            while done + 8 <= length:
                h = _rot(h ^ _round(U64(0), lanes[p + done]), 27) * _P1 + _P4
                done += 8
            if done + 4 <= length:
                h = _rot(h ^ ((lanes[p + done] & U64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
                done += 4
            while done < length:
                h = _rot(h ^ (buf[p + done].astype(U64) * _P5), 11) * _P1
                done += 1
            h = (h ^ (h >> U64(33))) * _P2
            h = (h ^ (h >> U64(29))) * _P3
            out[rows] = h ^ (h >> U64(32))
    return out


# Chunks: documents packed into compressed rows of bounded size, written once
# and then read by several passes that must see the same grouping.

PACKED = "chunk bigint, ids binary, offs binary, data binary"


def pack(docs: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    """Rows of at most ``limit`` text bytes (or one document) of ``docs``.

    Null keys are kept (as a JSON null); the chunk number is unique.
    """
    def run(batches):
        from pyspark import TaskContext
        squeeze = zstandard.ZstdCompressor(level=3)
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[bytes] = []
        sizes: list[int] = []

        def flush(number):
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([json.dumps(ids).encode()], pa.binary()),
                pa.array([np.cumsum([0, *sizes], dtype=np.int64).tobytes()], pa.binary()),
                pa.array([squeeze.compress(b"".join(parts))], pa.binary())],
                names=["chunk", "ids", "offs", "data"])

        held = 0
        for batch in batches:
            data, off = buffer_of(as_strings(batch.column(1)))
            keys = batch.column(0).to_pylist()
            for lo, hi in row_slices(off, limit):
                size = int(off[hi] - off[lo])
                if held and held + size > limit:
                    yield flush(number)
                    number, held = number + 1, 0
                    ids, parts, sizes = [], [], []
                ids += keys[lo:hi]
                parts.append(data[off[lo]:off[hi]].tobytes())
                sizes += np.diff(off[lo:hi + 1]).tolist()
                held += size + 1
        if ids:
            yield flush(number)

    return bound_tables(docs, key, text).mapInArrow(run, PACKED)


def unpack(ids: bytes, offs: bytes, data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(keys, bytes, offsets) of a packed row."""
    raw = zstandard.ZstdDecompressor().decompress(data) if data else b""
    return json.loads(ids), np.frombuffer(raw, np.uint8), np.frombuffer(offs, np.int64)
