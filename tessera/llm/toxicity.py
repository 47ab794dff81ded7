"""Toxicity: boosted trees over dense features, with isotonic calibration.

The lexicon is learned, not given: words and word beginnings (4 to 7 bytes, so
that inflected forms count) whose document frequency among toxic training rows
far exceeds that among the others.  Dense features of a text: lexicon
densities and weights, nearness of second-person words, capitals,
punctuation, and words disguised by inner digits or symbols.  Gradient-boosted
trees are fitted on rows that the lexicon has not seen, and isotonic
regression maps their output to a rate on rows that neither has seen.

Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2,
on a sample of about ``SAMPLE`` labelled rows chosen by a hash of the id; every
text is scored.  Half of the sample gives the lexicon, of at most ``LEXICON``
terms (the strongest; a parameter of the model, like its trees), three tenths
the trees and two tenths the calibration, at every size.  Training runs its
jobs at once.  Labels, language, source and id are no inputs of a score.

Defined results: a null text is an empty one and gets the score of its
features; labels without a verdict are left out and repeated labels of one id
count as toxic if any is; where the sample, its rows for the trees or those for
the calibration have labels of only one kind, the score is the sample's rate (0
without labels); repeated rows are scored alike; texts of any length are scored
whole, slice by slice; columns of any names go along as one struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tessera.llm.blocks import (SPACE, U64, as_strings, bound_tables, bounded_batches, buffer_of,
                                row_slices, span_hash, words_of)
from tessera.sources.writers import materialize

SAMPLE = 40_000
LEXICON = 400
PREFIXES = (4, 5, 6, 7)
THRESHOLD = 0.3
# this library's own list
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen "
                 "tu te toi ton ta tes vous votre vos tú ti contigo usted ustedes vosotros "
                 "vuestro su").split()
FEATURES = ("hits", "hit_density", "weak_hits", "weak_density", "top_weight", "weight",
            "second_person", "near_second_person", "capitals", "capital_words", "shouts",
            "punctuation", "symbols", "disguised", "disguised_hits", "log_words")

LETTER_GAP = np.ones(256, bool)
LETTER_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_KIND = {"upper": range(65, 91), "shout": b"!?", "punct": b".,;:'\"()-", "symbol": b"#$%&*+/<=>@[]^_{|}~"}
_TABLE = {k: np.isin(np.arange(256), list(v)) for k, v in _KIND.items()}
#: look-alike digits and symbols of disguised words
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a",
                        "$": "s", "!": "i", "|": "l", "+": "t"})


def _text_hash(parts: list[bytes]) -> np.ndarray:
    buf = np.frombuffer(b"".join(parts), np.uint8)
    end = np.cumsum([len(p) for p in parts], dtype=np.int64)
    return span_hash(buf, np.concatenate(([0], end[:-1])).astype(np.int64), end)


def _terms(w) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word index, hash) of every word and of each longer word's beginnings."""
    out = [(np.arange(len(w.start)), span_hash(w.buf, w.start, w.end))]
    for k in PREFIXES:
        at = np.flatnonzero(w.end - w.start > k)
        # a beginning is a term of its own, apart from a word of the same letters
        out.append((at, span_hash(w.buf, w.start[at], w.start[at] + k) ^ U64(k)))
    return out


def _slices(column):
    """(rows, bytes, offsets) of a column and of its lower-cased copy, slice by slice."""
    raw = as_strings(column)
    data, off = buffer_of(raw)
    low, low_off = buffer_of(pc.utf8_lower(raw))
    for lo, hi in row_slices(off, 1 << 20):
        yield (data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo],
               low[low_off[lo]:low_off[hi]], low_off[lo:hi + 1] - low_off[lo])


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents that hold each term, summed per batch before the shuffle."""
    def run(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            done = 0
            for _, _, low, off in _slices(batch.column(0)):
                w = words_of(low, off, LETTER_GAP)
                row = w.row_of()
                parts = [(row[at], h) for at, h in _terms(w)]
                r = np.concatenate([p[0] for p in parts])
                h = np.concatenate([p[1] for p in parts])
                order = np.lexsort((r, h))
                r, h = r[order], h[order]
                if len(h):
                    new = np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])))
                    r, h = r[new], h[new]
                    begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                    bad = np.add.reduceat(toxic[done + r].astype(np.int64), begin)
                    total = np.diff(np.append(begin, len(h)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[begin].view(np.int64)), pa.array(bad), pa.array(total - bad)],
                        names=["term", "toxic", "clean"])
                done += len(off) - 1
    return rows.select("text", "toxic").mapInArrow(run, "term bigint, toxic bigint, clean bigint") \
               .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame) -> tuple[list[int], list[float], list[bool]]:
    """At most ``LEXICON`` terms: hashes, log-odds weights, and which are well supported."""
    n = rows.agg(F.sum("toxic"), F.count("*")).first()
    bad, good = (n[0] or 0), n[1] - (n[0] or 0)
    weight = F.log(((F.col("toxic") + 0.5) / (bad + 1)) / ((F.col("clean") + 0.5) / (good + 1)))
    best = (_term_counts(rows).where("toxic >= 3").withColumn("w", weight).where("w > 1.5")
            .withColumn("gain", F.col("w") * F.col("toxic"))
            .orderBy(F.desc("gain"), "term").limit(LEXICON).collect())
    return ([r["term"] for r in best], [float(r["w"]) for r in best],
            [r["toxic"] >= max(5, 0.02 * bad) for r in best])


class Lexicon:
    def __init__(self, terms: list[int], weights: list[float], strong: list[bool]) -> None:
        h = np.array(terms, np.int64).view(U64) if terms else np.zeros(0, U64)
        order = np.argsort(h)
        self.h, self.w = h[order], np.array(weights, float)[order]
        self.strong = np.array(strong, bool)[order]
        self.you = np.sort(_text_hash([s.encode() for s in SECOND_PERSON]))

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight or 0, well supported) of each hash."""
        if not len(self.h) or not len(h):
            return np.zeros(len(h)), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        return np.where(hit, self.w[at], 0.0), hit & self.strong[at]

    def of_words(self, w) -> tuple[np.ndarray, np.ndarray]:
        weight, strong = np.zeros(len(w.start)), np.zeros(len(w.start), bool)
        for at, h in _terms(w):
            x, s = self.look(h)
            weight[at] = np.maximum(weight[at], x)
            strong[at] |= s
        return weight, strong


def _per_row(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=float)))
    return total[first[1:]] - total[first[:-1]]


def features_of(raw, off, low, low_off, lexicon: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` per text of a slice."""
    rows = len(off) - 1
    w = words_of(low, low_off, LETTER_GAP)
    n = np.maximum(w.counts, 1).astype(float)
    weight, strong = lexicon.of_words(w)
    whole = span_hash(w.buf, w.start, w.end)
    at = np.minimum(np.searchsorted(lexicon.you, whole), len(lexicon.you) - 1)
    you = lexicon.you[at] == whole if len(whole) else np.zeros(0, bool)
    # second-person words within five words of each hit, in the same text
    seen = np.concatenate(([0], np.cumsum(you)))
    row = w.row_of()
    i = np.arange(len(w.start))
    near = (seen[np.minimum(i + 6, w.first[1:][row])] > seen[np.maximum(i - 5, w.first[:-1][row])]) \
        if len(i) else np.zeros(0, bool)
    top = np.zeros(rows)
    np.maximum.at(top, row[weight > 0], weight[weight > 0])
    size = np.maximum(np.diff(off), 1).astype(float)
    share = {k: _per_row(off, t[raw]) / size for k, t in _TABLE.items()}
    spaced = words_of(raw, off, SPACE)
    tokens = np.maximum(spaced.counts, 1).astype(float)
    # whole words of two or more capitals; words with a digit or symbol between letters
    caps = np.concatenate(([0], np.cumsum(_TABLE["upper"][raw])))
    letters = np.concatenate(([0], np.cumsum(~LETTER_GAP[raw])))
    up = caps[spaced.end] - caps[spaced.start]
    let = letters[spaced.end] - letters[spaced.start]
    loud = (up == let) & (up >= 2)
    inner = np.zeros(len(raw) + 1, np.int64)
    if len(raw) > 2:
        gap = LETTER_GAP[raw]
        odd = gap & ~SPACE[raw] & ~np.isin(raw, np.frombuffer(b"'-", np.uint8))
        inner[2:len(raw)] = np.cumsum(odd[1:-1] & ~gap[:-2] & ~gap[2:])
        inner[len(raw)] = inner[len(raw) - 1]
    disguised = inner[spaced.end - 1] > inner[np.minimum(spaced.start + 1, spaced.end - 1)] \
        if len(spaced.start) else np.zeros(0, bool)
    found = np.zeros(rows)
    which = np.flatnonzero(disguised)
    if len(which):
        text = raw.tobytes()
        plain = [text[a:b].decode("utf-8", "ignore").lower().translate(_PLAIN)
                 for a, b in zip(spaced.start[which].tolist(), spaced.end[which].tolist())]
        plain = ["".join(c for c in p if c.isalpha()).encode() for p in plain]
        end = np.cumsum([len(p) for p in plain], dtype=np.int64)
        joined = np.frombuffer(b"".join(plain), np.uint8)
        bare = words_of(joined, np.concatenate(([0], end)), LETTER_GAP)
        hit, _ = lexicon.of_words(bare)
        np.add.at(found, spaced.row_of()[which][bare.row_of()[hit > 0]], 1)
    hits = _per_row(w.first, strong)
    weak = _per_row(w.first, (weight > 0) & ~strong)
    return np.stack([
        hits, hits / n, weak, weak / n, top, _per_row(w.first, weight) / np.sqrt(n),
        _per_row(w.first, you) / n, _per_row(w.first, near & (weight > 0)),
        share["upper"], _per_row(spaced.first, loud) / tokens, share["shout"], share["punct"],
        share["symbol"], _per_row(spaced.first, disguised) / tokens, found, np.log1p(w.counts)], 1)


#: names of what is added beside the rows, which are held in one struct
_ROW, _COLUMNS = "__row", [f"__{k}" for k in FEATURES]


def _featured(rows: DataFrame, lexicon) -> DataFrame:
    """Every row as one struct ``__row``, and the features of its ``text``."""
    def run(batches):
        words = Lexicon(*lexicon)
        for batch in batches:
            parts = [features_of(*s, words) for s in _slices(batch.column(1))]
            f = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(f[:, i]) for i in range(len(FEATURES))],
                names=[_ROW, *_COLUMNS])

    source = rows.select(F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias(_ROW), rows["text"])
    schema = StructType([source.schema[0], *(StructField(c, DoubleType()) for c in _COLUMNS)])
    return source.mapInArrow(run, schema)


def remainder(doc_id, modulus: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(lexicon, fitted model or None, rate): the model adds ``tree_score`` and ``rate`` columns."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = (labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .where(remainder(F.col("doc_id"), 4) != 2)
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("double").alias("toxic")))
    n = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))
    chosen = known.where(place < 1_000_000 * min(1.0, sample / max(1, n))) \
                  .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(20)))
    # about ``sample`` ids and verdicts: a bounded broadcast
    rows = materialize(bound_tables(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
                       .select("doc_id", "text", "toxic", "part"), spark, "toxicity-rows")
    rate = rows.agg(F.avg("toxic")).first()[0] or 0.0
    if rate in (0.0, 1.0):
        return ([], [], []), None, rate
    lexicon = learn_lexicon(rows.where("part < 10"))
    table = materialize(_featured(rows.select("toxic", "part", "text"), lexicon).select(
        "__row.toxic", "__row.part", *_COLUMNS), spark, "toxicity-features")
    fit, spare = table.where("part >= 10 AND part < 16"), table.where("part >= 16")
    if any(t.select("toxic").distinct().count() < 2 for t in (fit, spare)):
        return ([], [], []), None, rate
    trees = Pipeline(stages=[
        VectorAssembler(inputCols=_COLUMNS, outputCol="__vector"),
        GBTClassifier(featuresCol="__vector", labelCol="toxic", maxIter=15, maxDepth=3, stepSize=0.3,
                      minInstancesPerNode=2, seed=7)]).fit(fit)
    scale = IsotonicRegression(featuresCol="probability", featureIndex=1, labelCol="toxic",
                               predictionCol="__rate").fit(trees.transform(spare))
    return lexicon, (trees, scale), rate


def score(docs: DataFrame, trained) -> DataFrame:
    """Every row of ``docs`` as one struct ``__row``, and its ``__score``."""
    bounded_batches(docs.sparkSession)
    lexicon, model, rate = trained
    if model is None:
        return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(_ROW),
                           F.lit(float(rate)).alias("__score"))
    trees, scale = model
    out = scale.transform(trees.transform(_featured(docs, lexicon)))
    # a hundredth of the trees' own output keeps order within a calibrated step
    tree = vector_to_array("probability")[1]
    return out.select(_ROW, F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), 0.99 * F.col("__rate") + 0.01 * tree)).alias("__score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""
    scored = score(bound_tables(docs, "doc_id", "text"), train(docs, labels))
    return scored.select(
        "__row.doc_id", (remainder(F.col("__row.doc_id"), 4) == 2).alias("held_out"),
        F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` (all its columns) below the threshold."""
    return score(docs, train(docs, labels)).where(F.col("__score") < THRESHOLD).select("__row.*")
