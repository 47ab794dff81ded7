"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts of up to ``ORDER`` = 5 bytes, learned from
the training documents and kept as tables: the count of every (context, next
byte), and below it those of its suffixes.  The probability of a byte comes
from the longest context that has seen it; each longer one is left by an
escape, estimated as t / (n + t) from its t distinct and n all followers, and
what a left context has seen is excluded from the counts of the next one.
Beyond the empty context the bytes not seen are alike.  Texts have A-Z
lower-cased and end with a symbol of their own (0xFF, which UTF-8 never uses),
which also stands for what is before a text.

Everything that grows with the corpus is shuffled and aggregated by Spark.
Documents are packed into chunks of bounded size; each chunk asks once for its
distinct words and byte strings with their counts in its training rows, packed
into one row per bucket, and these questions are written.  Words are dealt to
buckets by their hash (64 bits tell words apart), byte strings by the last
three bytes of their context, so that a bucket holds all strings of its
contexts of three bytes or more: it sums them, computes their log probabilities
and answers, in one exchange.  All that a bucket needs of other contexts are
the counts of the three-byte strings of the training text, a table of at most
2^24 rows whatever the corpus.  A chunk gets back one value for each of its own
questions, in their order, so no answer repeats its key; rows of questions and
answers hold a key or more each, so there are never more than keys.

The base score is that of single words with one added to every count.

Defined results: null and empty texts are their end alone; a document without
id has the remainder of the empty text; without training rows every byte is
one of 256 alike and every word costs nothing; repeated rows count repeatedly.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import (LOWER, U64, bounded_batches, mix, pack, row_slices, span_hash,
                                unpack, words_of)
from tessera.sources.writers import materialize

ORDER = 5
END = 0xFF
CHUNK_BYTES = 12 << 20
HELD_OUT = (7, 2)      # crc32(doc_id as text) mod 7 = 2
BUCKET_KEYS = 400_000
_WORD, _BYTES, _TRIPLES = 0, 1, 2
#: the end of a text as a word: the hash of no bytes at all
_END_WORD = span_hash(np.zeros(1, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))


def is_held_out(doc_id) -> bool:
    modulus, rest = HELD_OUT
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == rest


def byte_strings(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of every byte of the rows and of their ends: the ``ORDER``
    bytes before it and the byte itself, as one integer."""
    size = np.diff(off)
    out = np.full(int(size.sum()) + (ORDER + 1) * len(size), END, np.uint8)
    begin = off[:-1] + (ORDER + 1) * np.arange(len(size)) + ORDER
    row = np.repeat(np.arange(len(size)), size)
    out[np.arange(len(buf)) + (begin - off[:-1])[row]] = LOWER[buf]
    code = np.zeros(len(out), np.int64)
    for back in range(ORDER, -1, -1):
        code <<= 8
        code[back:] |= out[:len(out) - back]
    row = np.repeat(np.arange(len(size)), size + 1)
    at = np.arange(len(row)) + ORDER * (row + 1)
    return row, code[at]


def _sums(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their summed numbers."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[begin], np.add.reduceat(n[order], begin)


def _parts(ids: bytes, offs: bytes, data: bytes, kinds=(_WORD, _BYTES)):
    """Slices of a chunk: doc ids, and (rows, keys) of each kind asked for."""
    keys, buf, off = unpack(ids, offs, data)
    for lo, hi in row_slices(off, 1 << 19):
        low, own = LOWER[buf[off[lo]:off[hi]]], off[lo:hi + 1] - off[lo]
        found = {}
        if _WORD in kinds:
            w = words_of(low, own)
            found[_WORD] = (np.concatenate((w.row_of(), np.arange(hi - lo))),
                            np.concatenate((span_hash(w.buf, w.start, w.end),
                                            np.repeat(_END_WORD, hi - lo))).view(np.int64))
        if _BYTES in kinds:
            found[_BYTES] = byte_strings(low, own)
        yield keys[lo:hi], found


def _bucket_of(key: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    """Words by their hash, byte strings by the last three bytes of their context."""
    place = key.view(U64) if kind == _WORD else ((key >> 8) & 0xFFFFFF).view(U64)
    return (mix(place + U64(1)) % U64(buckets)).astype(np.int32)


def _counted(key: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their number in training."""
    if not len(key):
        return key, np.zeros(0, np.int64)
    if int(key.min()) >= 0 and not int(key.max()) >> 62:
        both = np.sort((key << 1) | train)       # one sort of plain integers
        key, train = both >> 1, both & 1
    else:
        order = np.argsort(key)
        key, train = key[order], train[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[begin], np.add.reduceat(train.astype(np.int64), begin)


def _distinct(ids: bytes, offs: bytes, data: bytes, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a chunk, ascending, with their number in its training rows."""
    held = []
    for docs, found in _parts(ids, offs, data, (kind,)):
        train = np.array([not is_held_out(i) for i in docs], bool)
        row, key = found[kind]
        held.append(_counted(key, train[row]))
        if len(held) == 8:
            held = [_sums(*(np.concatenate(x) for x in zip(*held)))]
    return _sums(*(np.concatenate(x) for x in zip(*held)))


def _row_sums(row: np.ndarray, key: np.ndarray, rows: int, table, value) -> list[np.ndarray]:
    """Sums per row of each function of the keys' values in ``table``, which has all of them.

    Each distinct key is looked up once, in ascending order.
    """
    order = np.argsort(key)
    key, row = key[order], row[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else order
    found = _look_up(*table, key[begin])
    number = np.diff(np.append(begin, len(key)))
    return [np.bincount(row, np.repeat(f(found), number), rows) for f in value]


# Packed integers: the bytes of each place together, so that the many zeros compress

def _pack_ints(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack_ints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel()


_QUESTIONS = "kind int, bucket int, chunk bigint, size int, keys binary, counts binary"


def _questions(packed: DataFrame, buckets: dict[int, int]) -> DataFrame:
    """The distinct keys of every chunk with their counts: a row per kind and
    bucket, keys ascending; and a row with the chunk's three-byte strings."""
    def run(batches):
        for batch in batches:
            for chunk, *text in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                for kind, parts in buckets.items():
                    key, n = _distinct(*text, kind)
                    if kind == _BYTES:
                        triple, c = _sums(key[n > 0] & 0xFFFFFF, n[n > 0])
                        out.append((_TRIPLES, -1, chunk, len(triple), _pack_ints(triple), _pack_ints(c)))
                    bucket = _bucket_of(key, kind, parts)
                    order = np.argsort(bucket, kind="stable")
                    key, n = key[order], n[order]
                    cut = np.searchsorted(bucket[order], np.arange(parts + 1))
                    for b in np.flatnonzero(np.diff(cut)).tolist():
                        k = key[cut[b]:cut[b + 1]]
                        out.append((kind, b, chunk, len(k), _pack_ints(np.diff(k, prepend=np.int64(0))),
                                    _pack_ints(n[cut[b]:cut[b + 1]])))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["kind", "bucket", "chunk", "size", "keys", "counts"])
    return packed.mapInArrow(run, _QUESTIONS)


def _asked(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's distinct keys with their sums, which of them each question asks, and the questions' ends."""
    key = np.concatenate([np.cumsum(_unpack_ints(k)) for k in frame["keys"]])
    n = np.concatenate([_unpack_ints(c) for c in frame["counts"]])
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    return key[order][begin], np.add.reduceat(n[order], begin), which, np.cumsum(frame["size"].to_numpy())


_ANSWERS = "chunk bigint, kind int, bucket int, data binary, tokens bigint, words bigint"


def _answers(frame: pd.DataFrame, values: np.ndarray, ends: np.ndarray, pack_) -> pd.DataFrame:
    """One row per chunk: its values in the order of its keys."""
    return pd.DataFrame({"chunk": frame["chunk"], "kind": frame["kind"], "bucket": frame["bucket"],
                         "data": [pack_(v) for v in np.split(values, ends[:-1])],
                         "tokens": np.int64(0), "words": np.int64(0)})


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Values of the asked keys, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def _word_counts(questions: DataFrame) -> DataFrame:
    """Answers: the count of each word in training.  One row of each bucket has
    the bucket's training tokens and distinct training words."""
    def count(frame: pd.DataFrame) -> pd.DataFrame:
        _, n, which, ends = _asked(frame)
        out = _answers(frame, n[which], ends, _pack_ints)
        out.loc[out.index[0], ["tokens", "words"]] = int(n.sum()), int((n > 0).sum())
        return out
    return questions.where(F.col("kind") == _WORD).groupBy("bucket").applyInPandas(count, _ANSWERS)


class Level:
    """Strings of one length with their counts, and the contexts that they have."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray) -> None:
        self.g, self.c = strings, counts
        self.x, self.n = _sums(strings >> 8, counts)
        self.t = np.unique(strings >> 8, return_counts=True)[1]

    def seen_in(self, longer: Level) -> np.ndarray:
        """For each context of ``longer``, the counts here of what it has seen."""
        size = 8 * (self.size + 1)
        c = _look_up(self.g, self.c, longer.g & ((1 << size) - 1))
        return _sums(longer.g >> 8, c)[1]

    size = 0


def _levels(strings: np.ndarray, counts: np.ndarray, top: int, low: int) -> dict[int, Level]:
    out = {}
    for k in range(top, low - 1, -1):
        out[k] = Level(*_sums(strings & ((1 << (8 * (k + 1))) - 1), counts))
        out[k].size = k
    return out


def log_probabilities(strings: np.ndarray, counts: np.ndarray, triples: tuple) -> np.ndarray:
    """log10 probability of the last byte of each string after the others.

    ``strings`` hold all those of each three-byte context end that they have
    (ascending), ``counts`` their numbers in training (0 for others), and
    ``triples`` the three-byte strings of all training text with their counts.
    """
    level = _levels(*triples, 2, 0)
    level |= _levels(strings[counts > 0], counts[counts > 0], ORDER, 3)
    t0 = len(level[0].g)
    score = np.full(len(strings), -np.log10(max(1, 256 - t0)))
    for k in range(ORDER + 1):
        own = level[k]
        context = (strings >> 8) & ((1 << (8 * k)) - 1)
        n, t = _look_up(own.x, own.n, context), _look_up(own.x, own.t, context)
        if k < ORDER:       # what the longer context has seen is excluded
            longer = level[k + 1]
            wider = (strings >> 8) & ((1 << (8 * (k + 1))) - 1)
            n = n - _look_up(longer.x, own.seen_in(longer), wider)
            t = t - _look_up(longer.x, longer.t, wider)
        c = _look_up(own.g, own.c, strings & ((1 << (8 * (k + 1))) - 1))
        den = np.maximum(n + t, 1)
        # with nothing left to exclude from, the escape is certain
        escape = np.where(n + t > 0, np.log10(np.maximum(t, 1) / den), 0.0)
        score = np.where(c > 0, np.log10(np.maximum(c, 1) / den), escape + score)
    return score


def _triples(questions: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The three-byte strings of the training text with their counts: at most 2^24 rows."""
    def run(batches):
        for batch in batches:
            for keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_unpack_ints(keys)), pa.array(_unpack_ints(counts))], names=["g", "c"])

    total = (questions.where(F.col("kind") == _TRIPLES).select("keys", "counts")
             .mapInArrow(run, "g bigint, c bigint").groupBy("g").agg(F.sum("c").alias("c")).toArrow())
    g, c = (total.column(k).to_numpy() for k in (0, 1))
    order = np.argsort(g)
    return g[order], c[order]


def _byte_scores(questions: DataFrame) -> DataFrame:
    """Answers: the log probability of each byte string."""
    triples = _triples(questions)

    def score(frame: pd.DataFrame) -> pd.DataFrame:
        strings, n, which, ends = _asked(frame)
        values = log_probabilities(strings, n, triples)
        return _answers(frame, values[which], ends, lambda v: v.tobytes())
    return questions.where(F.col("kind") == _BYTES).groupBy("bucket").applyInPandas(score, _ANSWERS)


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    packed = materialize(pack(docs, "doc_id", "text", CHUNK_BYTES), spark, "ppm-packed")
    size = packed.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    # a compressed byte asks about 0.12 strings and 0.05 words
    buckets = {_WORD: max(8, int(size * 0.05) // BUCKET_KEYS), _BYTES: max(8, int(size * 0.12) // BUCKET_KEYS)}
    questions = materialize(_questions(packed, buckets), spark, "ppm-questions")
    words = materialize(_word_counts(questions), spark, "ppm-words")
    train_tokens, vocabulary = (int(x or 0) for x in words.agg(F.sum("tokens"), F.sum("words")).first())
    answers = words.unionByName(_byte_scores(questions)).select("chunk", "kind", "bucket", "data")

    def score(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, chunk in left.iterrows():
            row = chunk["ids"], chunk["offs"], chunk["data"]
            table = {}
            for kind, read in ((_WORD, _unpack_ints), (_BYTES, lambda d: np.frombuffer(d, np.float64))):
                keys, _ = _distinct(*row, kind)
                mine = right[right["kind"] == kind].sort_values("bucket")
                at = np.argsort(_bucket_of(keys, kind, buckets[kind]), kind="stable")
                table[kind] = keys, np.empty(len(keys), np.float64)
                table[kind][1][at] = np.concatenate([read(d) for d in mine["data"]])
            for ids, found in _parts(*row):
                rows = len(ids)
                known, base = _row_sums(*found[_WORD], rows, table[_WORD], (
                    lambda c: c > 0,
                    lambda c: np.log10((c + 1) / (train_tokens + vocabulary + 1))))
                model, = _row_sums(*found[_BYTES], rows, table[_BYTES], (lambda v: v,))
                out.append(pd.DataFrame({
                    "doc_id": pd.array(ids, "Int64"), "held_out": [is_held_out(i) for i in ids],
                    "n_tokens": np.bincount(found[_WORD][0], minlength=rows),
                    "n_known": known.astype(np.int64),
                    "train_tokens": np.full(rows, train_tokens, np.int64), "base_score": base,
                    "score": model}))
        return pd.concat(out, ignore_index=True)

    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
               "train_tokens bigint, base_score double, score double")
