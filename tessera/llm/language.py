"""Language identification: sparse multinomial logistic regression on TF-IDF
weighted character n-grams, trained by follow-the-regularised-leader.

Features.  A text is lower-cased (by character), every run of other than
letters becomes one space, and a space stands at both ends.  Its n-grams of 1
to 3 characters fall into ``BUCKETS`` buckets by hash.  A feature is a bucket's
share of the text's n-grams times its inverse document frequency,
ln((1 + N) / (1 + df)) + 1, times ``SCALE``.  N and df are counted by Spark
over all rows that may be learned from.

Training.  At most ``PER_LANGUAGE`` rows of a language (on average: chosen by a
hash of id and text) are learned from, whole texts, dealt to ``SHARDS`` shards
by that hash.  In each of ``ROUNDS`` rounds every shard runs FTRL-proximal with
elastic-net penalties (``L1`` makes most weights zero, ``L2`` shrinks the rest)
over its rows, one by one in order of the hash, from the mean state of the
round before; so the result does not depend on how Spark deals the rows.  The
mean state, of buckets times languages, is all that the driver holds.

Calibration.  A tenth of the chosen rows is not trained on.  On them the
temperature by which logits are divided is chosen from a fixed grid by least
log loss, summed by Spark.

Prediction is a sum over the text's n-grams of one table's rows, so a text of
any length costs its length alone.

Only rows whose crc32(doc_id as text) mod 4 is not 2 and whose language is not
null are learned from; id, language and source are no inputs of a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score
0, as is every text where nothing can be learned; with one language it is that
one with score 1; equal scores go to the first language by name; a null id
counts as an empty one; rows of equal id are predicted one by one.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import as_strings, bound_tables, bounded_batches, buffer_of, row_slices
from tessera.sources.writers import materialize

BUCKETS = 1 << 16
GRAMS = (1, 2, 3)
PER_LANGUAGE = 2000
SHARDS = 8
BLOCK = 1 << 12
ROUNDS = 3
SCALE = 100.0
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.05, 0.05
TEMPERATURES = tuple(float(t) for t in np.geomspace(0.05, 20, 121))
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
_SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """For each code point the lower-cased letter (of one character), or a space."""
    table = np.full(sys.maxunicode + 1, _SPACE, np.uint32)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def characters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The normalised characters of a slice's texts, and row offsets into them."""
    points = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
    whole = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[off]
    rows = len(off) - 1
    # a space before each row and one after the last
    at = whole + np.arange(rows + 1)
    low = np.full(len(points) + rows + 1, _SPACE, np.uint32)
    solid = np.ones(len(low), bool)
    solid[at] = False
    low[solid] = _letters()[points]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != _SPACE) | (low[:-1] != _SPACE)
    # the space before a row stays although the text before it ended with one
    first = np.concatenate(([0], np.cumsum(keep)))
    text = low[keep]
    begin = np.where(keep[at], first[at], first[at] - 1)
    return text, begin


def grams(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram of a slice, one order after the other; rows ascend."""
    text, begin = characters(buf, off)
    rows = len(off) - 1
    for n in GRAMS:
        code = np.zeros(max(0, len(text) - n + 1), np.uint64)
        for k in range(n):
            code = (code ^ text[k:len(text) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        # a row's n-grams start at its leading space and end at the next row's
        count = np.maximum(begin[1:] - begin[:-1] + 2 - n, 0)
        count[begin[1:] == begin[:-1]] = 0
        at = _starts(begin[:-1], count)
        yield np.repeat(np.arange(rows), count), (code[at] >> np.uint64(7)).astype(np.int64) % BUCKETS


def _starts(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(count)))
    return np.arange(total[-1]) + np.repeat(begin - total[:-1], count)


def lettered(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each row has a letter."""
    _, begin = characters(buf, off)
    return begin[1:] > begin[:-1]


def _slices(column):
    data, off = buffer_of(as_strings(column))
    for lo, hi in row_slices(off, SLICE_BYTES):
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of column ``text``, and how many of them hold each bucket."""
    def run(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for lo, hi, buf, off in _slices(batch.column(0)):
                n += hi - lo
                parts = list(grams(buf, off))
                ends = [np.searchsorted(row, np.arange(hi - lo + 1)) for row, _ in parts]
                for r in range(hi - lo):
                    held = np.zeros(BUCKETS, bool)
                    for (_, bucket), e in zip(parts, ends):
                        held[bucket[e[r]:e[r + 1]]] = True
                    df += held
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(df[used], n))], names=["bucket", "df"])

    out, n = np.zeros(BUCKETS, np.int64), 0
    for r in texts.select("text").mapInArrow(run, "bucket bigint, df bigint") \
                  .groupBy("bucket").agg(F.sum("df").alias("df")).collect():      # BUCKETS rows at most
        if r["bucket"] < 0:
            n = r["df"]
        else:
            out[r["bucket"]] = r["df"]
    return n, out


def counted(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, buckets, numbers) of the rows of a slice: each row's distinct buckets."""
    row, bucket = (np.concatenate(x) for x in zip(*grams(buf, off)))
    both, n = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, bucket = np.divmod(both, BUCKETS)
    return np.searchsorted(row, np.arange(len(off))), bucket, n


def packed(bucket: np.ndarray, n: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        bucket.astype(np.uint16).tobytes() + n.astype(np.uint32).tobytes())


def unpacked(data: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, feature values) of a packed row."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    rows = len(raw) // 6
    bucket = np.frombuffer(raw, np.uint16, rows).astype(np.int64)
    n = np.frombuffer(raw, np.uint32, rows, 2 * rows).astype(np.float64)
    return bucket, SCALE * n / max(1.0, n.sum()) * idf[bucket]


class Ftrl:
    """FTRL-proximal state of a softmax regression: z and n per bucket and class."""

    def __init__(self, z: np.ndarray, n: np.ndarray) -> None:
        self.z, self.n = z, n

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / rate)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One example of distinct buckets."""
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _round(rows: DataFrame, state: Ftrl, idf: np.ndarray, classes: int) -> Ftrl:
    """The mean state of all shards after one more pass over their rows.

    States are averaged by Spark, ``BLOCK`` buckets at a time.
    """
    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        own = Ftrl(state.z.copy(), state.n.copy())
        frame = frame.sort_values(["place", "label"])
        for data, label in zip(frame["data"], frame["label"]):
            own.learn(*unpacked(data, idf), int(label))
        return pd.DataFrame([(int(frame["shard"].iloc[0]), k, own.z[k:k + BLOCK].tobytes(),
                              own.n[k:k + BLOCK].tobytes()) for k in range(0, BUCKETS, BLOCK)],
                            columns=["shard", "block", "z", "n"])

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        return pd.DataFrame([(frame["block"].iloc[0], *(
            np.mean([np.frombuffer(v, np.float64) for v in frame[k]], axis=0).tobytes() for k in ("z", "n")))],
            columns=["block", "z", "n"])

    done = (rows.groupBy("shard").applyInPandas(learn, "shard int, block int, z binary, n binary")
            .groupBy("block").applyInPandas(mean, "block int, z binary, n binary").orderBy("block").collect())
    if not done:
        return state
    return Ftrl(*(np.concatenate([np.frombuffer(r[k], np.float64) for r in done]).reshape(BUCKETS, classes)
                  for k in ("z", "n")))


class Model:
    """Languages, inverse document frequencies, weights and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, w: np.ndarray, temperature: float) -> None:
        self.languages, self.temperature = languages, temperature
        self.table = SCALE * idf[:, None] * w

    def logits(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """One row of logits, not yet divided by the temperature, per text."""
        rows = len(off) - 1
        out, number = np.zeros((rows, len(self.languages))), np.zeros(rows)
        for row, bucket in grams(buf, off):
            number += np.bincount(row, minlength=rows)
            for c in range(len(self.languages)):
                out[:, c] += np.bincount(row, self.table[:, c][bucket], rows)
        return out / np.maximum(number, 1)[:, None]


def learnable(docs: DataFrame) -> DataFrame:
    """text, lang and place (a hash) of the rows that may be learned from."""
    docs = bound_tables(docs, "doc_id", "text", "lang")
    own = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.where("text IS NOT NULL AND lang IS NOT NULL").where(own % 4 != 2).select(
        "text", "lang", F.xxhash64("doc_id", "text").alias("place"))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of the learnable rows of ``docs`` (doc_id, text, lang).  Runs its jobs at once."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = learnable(docs)
    number = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not number:
        return None
    languages = sorted(number)
    if len(languages) == 1:
        return Model(languages, np.zeros(BUCKETS), np.zeros((BUCKETS, 1)), 1.0)
    n, df = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    share = F.create_map(*[F.lit(v) for k in languages for v in (k, min(1.0, per_language / number[k]))])
    label = F.create_map(*[F.lit(v) for i, k in enumerate(languages) for v in (k, i)])
    chosen = rows.where(F.pmod("place", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)) \
                 .select("text", label[F.col("lang")].alias("label"), "place")

    def encode(batches):
        for batch in batches:
            for lo, hi, buf, off in _slices(batch.column(0)):
                first, at, n = counted(buf, off)
                data = [packed(at[a:b], n[a:b]) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in (1, 2)), pa.array(data, pa.binary())],
                    names=["label", "place", "data"])

    table = chosen.mapInArrow(encode, "label int, place bigint, data binary")
    part = F.pmod(F.xxhash64("place"), F.lit(10 * SHARDS))
    table = materialize(table.withColumn("shard", (F.floor(part / 10)).cast("int"))
                        .withColumn("spare", part % 10 == 9), spark, "language-rows")
    state = Ftrl(*(np.zeros((BUCKETS, len(languages))) for _ in range(2)))
    for _ in range(ROUNDS):
        state = _round(table.where("NOT spare").drop("spare"), state, idf, len(languages))
    w = state.weights()
    return Model(languages, idf, w, _temperature(table.where("spare"), w, idf))


def _temperature(rows: DataFrame, w: np.ndarray, idf: np.ndarray) -> float:
    """The temperature of least log loss on rows that the weights have not seen (1 without any)."""
    def run(batches):
        loss = np.zeros(len(TEMPERATURES))
        seen = 0
        for batch in batches:
            for data, label in zip(*(batch.column(k).to_pylist() for k in ("data", "label"))):
                at, x = unpacked(data, idf)
                logits = x @ w[at]
                scaled = logits[None, :] / np.array(TEMPERATURES)[:, None]
                top = scaled.max(axis=1)
                loss += top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - scaled[:, label]
                seen += 1
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(loss))), pa.array(loss)], names=["i", "loss"])

    best = rows.select("data", "label").mapInArrow(run, "i bigint, loss double").groupBy("i").agg(
        F.sum("loss").alias("loss")).orderBy(F.round("loss", 6), "i").limit(1).collect()
    return TEMPERATURES[best[0]["i"]] if best else 1.0


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in _slices(batch.column(1)):
                text = lettered(buf, off) if model is not None else np.zeros(hi - lo, bool)
                best, score = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
                if model is not None:
                    p = softmax(model.logits(buf, off) / model.temperature)
                    best = p.argmax(axis=1)
                    score = np.where(text, p[np.arange(hi - lo), best], 0.0)
                names = [model.languages[b] if t else UNKNOWN for b, t in zip(best, text)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"])

    out = bound_tables(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def language(docs: DataFrame) -> DataFrame:
    """``predict`` by the model of ``docs`` (doc_id, text, lang)."""
    return predict(docs, train(docs))
