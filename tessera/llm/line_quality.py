"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per text: words ``[^\\x20\\x09-\\x0D]+``, their code points, symbol characters,
lines repeated inside the text, and words in three-word windows that occur
twice or more.  Across texts: each line is normalised (A-Z and other capitals
lowered, digits to 0, white space collapsed) and hashed, the distinct
documents that hold it are counted per host, and lines at the limits count as
removed: in ``MAX_DOCS`` documents of the host or more, or in ``MIN_DOCS`` or
more that are one in ``ONE_IN`` of the host's or more.  A document of which
such lines held over ``MAX_LOST`` of the word characters is depleted and
rejected.

Every row is a document, copies included.  Rows of a line are aggregated by
(host, text, line) before any row meets another, copies as a number, so neither
a hot host, nor a hot line, nor a group of copies is gathered; these rows are
written once and read for the counts and for the verdicts.

Defined results: a null text is an empty one (no words, fails the base rule);
a null host is a host of its own; repeated rows each get their result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.writers import materialize

MIN_WORDS = 50
MIN_DOCS = 20
ONE_IN = 100
MAX_DOCS = 1000
MAX_LOST = 0.5
GAP = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words that lie in windows of ``size`` words which occur twice or more.

    Window hashes are sorted beside their positions; equal neighbours are the
    repeats, and the sorted positions of those give the words covered.
    """
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(size)]))

    def covered(at):
        step = F.transform(at, lambda p, i: F.least(F.lit(size), F.coalesce(
            F.get(at, i + 1) - p, F.lit(size))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeats(h):
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return _let(placed, lambda s: _let(F.sort_array(F.transform(
            F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])), covered))

    return _let(words, lambda w: F.when(F.size(w) <= size, F.lit(0).cast("long")).otherwise(
        _let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h),
                                          F.lit(0).cast("long")).otherwise(repeats(h)))))


def measures(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, host, digest of the text, and the text's own counts (and the text)."""
    text = F.coalesce("text", F.lit(""))
    # one array per row: the words, bound once
    counts = _let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    lines = _let(F.filter(F.split(text, "\n"), lambda x: x.rlike(SOLID)),
                 lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    return docs.select("doc_id", F.col("source").alias("host"), F.unhex(F.md5(text)).alias("digest"),
                       counts.alias("c"), symbols.cast("long").alias("n_symbols"),
                       lines.alias("n_dup_lines"), *([text.alias("text")] if keep_text else []))


def _line_hash(line: Column) -> Column:
    """Hash of the normalised line."""
    return F.xxhash64(F.lower(F.regexp_replace(F.regexp_replace(
        F.btrim(line, F.lit(" \t\r\u000b\f")), r"[0-9]", "0"), GAP, " ")))


def _host() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("host")


def _lines(text: Column) -> Column:
    """The lines with a word: hash, characters, and 1 for the first of equal ones, else 0."""
    found = F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(SOLID)), lambda x: F.struct(
        _line_hash(x).alias("line"), F.length(F.regexp_replace(x, GAP, "")).alias("chars")))
    return _let(F.sort_array(found), lambda s: F.transform(s, lambda x, i: F.struct(
        x["line"].alias("line"), x["chars"].alias("chars"),
        F.when(F.get(s, i - 1)["line"] == x["line"], 0).otherwise(1).alias("documents"))))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, one_in: int = ONE_IN,
                   max_docs: int = MAX_DOCS) -> tuple[DataFrame, DataFrame]:
    """(lines by host, text and line, with the documents of that text and their
    characters; lines at the limits by host and line)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(_host(), F.unhex(F.md5(text)).alias("digest"), F.explode(_lines(text)).alias("x"))
    held = materialize(rows.groupBy("host", "digest", F.col("x.line").alias("line")).agg(
        F.sum("x.chars").alias("chars"), F.sum("x.documents").alias("documents")),
        docs.sparkSession, "lines")
    n = held.groupBy("host", "line").agg(F.sum("documents").alias("n")).where(F.col("n") >= min(min_docs, max_docs))
    total = docs.groupBy(_host()).agg(F.count("*").alias("total"))
    over = n.join(total, "host").where((F.col("n") >= max_docs) | (
        (F.col("n") >= min_docs) & (F.col("n") * one_in >= F.col("total"))))
    return held, over.select("host", "line")


def _without(text: str, gone: str) -> Column:
    """The text without lines whose hashes are in ``gone``; lines without words stay."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~(
        x.rlike(SOLID) & F.array_contains(F.col(gone), _line_hash(x))))
    return F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))


def line_quality(docs: DataFrame, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS,
                 one_in: int = ONE_IN, max_docs: int = MAX_DOCS, max_lost: float = MAX_LOST,
                 keep_text: bool = False) -> DataFrame:
    """The counts and verdicts of every row of ``docs`` (doc_id, text, source); with
    ``keep_text`` also the text without its frequent lines of rows that are kept
    (null for others), else the query's columns alone."""
    docs = docs.select(docs["doc_id"], docs["text"], docs["source"])
    held, over = frequent_lines(docs, min_docs, one_in, max_docs)
    # copies of a text add to the same sums: each has its share
    lost = held.join(over, ["host", "line"]).groupBy("host", "digest").agg(
        F.sum(F.expr("chars div documents")).alias("lost"), F.collect_set("line").alias("gone"))
    own = measures(docs, keep_text).withColumn("host", F.coalesce(F.concat(F.lit("="), F.col("host")), F.lit("-")))
    out = own.join(lost, ["host", "digest"], "left").select(
        "doc_id", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words",
        F.coalesce("lost", F.lit(0)).cast("long").alias("line_chars_removed"),
        *([_without("text", "gone").alias("clean_text")] if keep_text else []))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed")
        & (F.col("line_chars_removed") <= max_lost * F.col("word_chars")))
    return out.withColumn("clean_text", F.when(F.col("kept"), F.col("clean_text"))) if keep_text else out
