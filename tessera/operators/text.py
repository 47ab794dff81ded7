"""Review text pipeline (family B): clean, tokenise, drop stopwords, rebuild,
count words and rows, top-k words per group.

Table shape used throughout (all strings): ``id, review, aspect, category,
sentiment`` (extra columns are carried along).  Design:

* Cleaning and tokenising are row-local, code-generated expressions
  (``regexp_replace``, ``btrim``, ``lower``, ``split``, ``array_remove``).
* Removing stopwords commutes with grouping by word, so the word-count jobs
  aggregate every token (partial + final hash aggregate: a hot word is
  combined map-side) and drop the stopwords from the *aggregated* words - a
  filter on distinct words instead of a check on every token.
* Whether a review keeps any word is ``size(array_except(tokens, stop)) > 0``
  (code-generated); row counts then shuffle only the key columns.
* The per-token form (:func:`tokenize_reviews` + :func:`remove_stopwords`) uses
  a left-anti join whose stopword side is broadcast only when its size is
  bounded (a word list).
* Stopwords are either a literal word list (``Sequence[str]``) or a DataFrame
  with a ``stopword`` column (read from a file); the latter goes through
  joins instead of literal expressions, so nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.strings import clean_review, not_in, sql_list, tokens, without_words
from tessera.operators.topk import top_k, top_k_per_group

KEYS = ("id", "aspect", "category", "sentiment")
WORDS = "words"
Stopwords = Sequence[str] | DataFrame


def clean_reviews(df: DataFrame, header_id: str | None = "id") -> DataFrame:
    """Drop NULL id/review rows and a repeated header row; clean the review text."""
    cond = F.col("id").isNotNull() & F.col("review").isNotNull()
    if header_id is not None:
        cond = cond & (F.col("id") != F.lit(header_id))
    return df.filter(cond).withColumn("review", clean_review("review"))


def tokenize_reviews(cleaned: DataFrame, sep: str = " ") -> DataFrame:
    """One row per non-empty token, with its 0-based position in the review."""
    others = [c for c in cleaned.columns if c != "review"]
    out = cleaned.select(*others, F.posexplode_outer(tokens("review", sep)).alias("pos", "word"))
    return out.filter(F.col("word").isNotNull())


def remove_stopwords(token_rows: DataFrame, stopwords: Stopwords, word_col: str = "word",
                     broadcast: bool = False) -> DataFrame:
    """Rows whose word is not a stopword (JN-7), as a left-anti join.

    The planner chooses the join from the list's size; ``broadcast=True`` is
    the caller's word that it is a short list.  A NULL stopword never removes
    anything (unlike ``NOT IN``).  A literal list is applied as an ``IN``-set
    filter.
    """
    if not isinstance(stopwords, DataFrame):
        return token_rows.filter(not_in(word_col, stopwords)) if stopwords else token_rows
    stop = stopwords.select(F.col("stopword").alias("__stop")).filter(F.col("__stop").isNotNull())
    stop = F.broadcast(stop) if broadcast else stop
    return token_rows.join(stop, token_rows[word_col] == stop["__stop"], "left_anti")


def review_tokens(cleaned: DataFrame, sep: str = " ") -> DataFrame:
    """Per review row: the array of all its tokens, in text order (row-local)."""
    return cleaned.withColumn(WORDS, tokens("review", sep)).drop("review")


def tokens_of_cleaned_table(cleaned_table: DataFrame) -> DataFrame:
    """A stored cleaned table (``review`` = ``a,b,c``) back to token arrays."""
    return cleaned_table.withColumn(WORDS, tokens("review", ",")).drop("review")


def _has_word(stopwords: Sequence[str]) -> Column:
    if not stopwords:
        return F.size(WORDS) > 0
    return F.expr(f"size(array_except(`{WORDS}`, array({sql_list(stopwords)}))) > 0")


def rebuild_clean_text(token_rows: DataFrame, stopwords: Stopwords,
                       broadcast: bool = False) -> DataFrame:
    """The cleaned table: non-stopword words joined by ``,`` per (id, aspect,
    category, sentiment); a review whose words were all stopwords disappears.
    Rows sharing a key are merged in a deterministic order (by their text).

    The grouping shuffles the cleaned text once - it is the output.  Of a list
    read from a file, only the stopwords that a key's reviews hold are brought
    to that key, whatever the length of the list.
    """
    if isinstance(stopwords, DataFrame):
        return _rebuild_by_key(token_rows, stopwords, broadcast)
    words = without_words(WORDS, stopwords)
    per_row = token_rows.select(*KEYS, F.array_join(words, ",").alias("__text"))
    # Empty texts are dropped inside the aggregate (collect_list skips NULL)
    # and empty groups after it, so no filter on the text is pushed down.
    text = F.when(F.col("__text") != "", F.col("__text"))
    merged = per_row.groupBy(*KEYS).agg(F.sort_array(F.collect_list(text)).alias("__parts"))
    return merged.filter(F.size("__parts") > 0).select(
        "id", F.array_join("__parts", ",").alias("review"), "aspect", "category", "sentiment")


def _rebuild_by_key(token_rows: DataFrame, stopwords: DataFrame, broadcast: bool) -> DataFrame:
    """:func:`rebuild_clean_text` with a list of any length.  The distinct words of
    each row are looked up in the list; those found meet the rows' words where
    the rows of a key are merged, which shuffles both once."""
    distinct = token_rows.withColumn(WORDS, F.array_distinct(WORDS))
    stop = stopwords.select(F.col("stopword").alias("word"))
    stop = F.broadcast(stop) if broadcast else stop
    found = _explode_words(distinct, *KEYS).join(stop, "word", "left_semi")
    both = token_rows.select(*KEYS, WORDS).unionByName(found, allowMissingColumns=True)
    merged = both.groupBy(*KEYS).agg(F.collect_list(WORDS).alias("__rows"),
                                     F.collect_set("word").alias("__found"))
    kept = lambda words: F.filter(words, lambda w: ~F.array_contains("__found", w))
    texts = F.transform("__rows", lambda words: F.array_join(kept(words), ","))
    merged = merged.select(*KEYS, F.sort_array(F.filter(texts, lambda t: t != "")).alias("__parts"))
    return merged.filter(F.size("__parts") > 0).select(
        "id", F.array_join("__parts", ",").alias("review"), "aspect", "category", "sentiment")


def cleaned_keys(token_rows: DataFrame, stopwords: Stopwords, broadcast: bool = False) -> DataFrame:
    """The rows of the cleaned table without their text: distinct keys of the
    reviews that keep at least one non-stopword word.  Only key columns are
    shuffled.

    Without a ``sentiment`` column the keys are (id, aspect, category); when
    sentiment is a lookup on id this gives the same rows, and the lookup can
    then be joined to the keys instead of to the text."""
    keys = [c for c in KEYS if c in token_rows.columns]
    if isinstance(stopwords, DataFrame):
        toks = _explode_words(token_rows, *keys)
        return remove_stopwords(toks, stopwords, broadcast=broadcast).select(*keys).distinct()
    # The test is aggregated (max) and filtered after the aggregate, so it is
    # computed once, next to the tokenising, and never pushed below it.
    flagged = token_rows.select(*keys, _has_word(stopwords).alias("__has"))
    return (flagged.groupBy(*keys).agg(F.max("__has").alias("__has"))
            .filter(F.col("__has")).drop("__has"))


def _explode_words(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per token.  ``explode_outer`` + a filter on the generated word:
    a plain ``explode`` makes Catalyst infer ``size(words) > 0`` and push that
    - i.e. the whole cleaning expression - below the preceding exchange."""
    out = rows.select(*keep, F.explode_outer(WORDS).alias("word"))
    return out.filter(F.col("word").isNotNull())


def _not_null(*cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def word_count(token_rows: DataFrame, stopwords: Stopwords, broadcast: bool = False) -> DataFrame:
    """Frequency of every non-stopword word over reviews with text, category
    and aspect.  Stopwords are removed from the aggregated words."""
    rows = token_rows.filter(_not_null("category", "aspect"))
    counts = _explode_words(rows).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    return remove_stopwords(counts, stopwords, broadcast=broadcast)


def top_words(token_rows: DataFrame, stopwords: Stopwords, k: int = 5) -> DataFrame:
    """Global top-k words by frequency (ties: word ascending)."""
    return top_k(word_count(token_rows, stopwords), [F.col("freq").desc(), F.col("word").asc()], k)


def count_rows_by(keys_df: DataFrame, group: str) -> DataFrame:
    """Cleaned rows per ``group`` (category or aspect); rows need a category
    and an aspect, and only non-NULL ids are counted."""
    rows = keys_df.filter(_not_null("category", "aspect"))
    return rows.groupBy(group).agg(F.count("id").alias("total"))


def count_by_aspect_sentiment(keys_df: DataFrame) -> DataFrame:
    rows = keys_df.filter(_not_null("aspect", "sentiment"))
    return rows.groupBy("aspect", "sentiment").agg(F.count(F.lit(1)).alias("total"))


def top_aspect(keys_df: DataFrame, sentiment: str) -> DataFrame:
    """The aspect with the most rows of one sentiment (ties: aspect ascending)."""
    counts = count_by_aspect_sentiment(keys_df).filter(F.col("sentiment") == F.lit(sentiment))
    return top_k(counts, [F.col("total").desc(), F.col("aspect").asc()], 1)


def category_word_counts(token_rows: DataFrame, stopwords: Stopwords,
                         sentiment: str | None = None, broadcast: bool = False) -> DataFrame:
    """(category, word, freq) without stopwords; optionally only reviews of
    one sentiment."""
    need = ["category"] + (["sentiment"] if sentiment is not None else [])
    rows = token_rows.filter(_not_null(*need))
    if sentiment is not None:
        rows = rows.filter(F.col("sentiment") == F.lit(sentiment))
    counts = (_explode_words(rows, "category")
              .groupBy("category", "word").agg(F.count(F.lit(1)).alias("freq")))
    return remove_stopwords(counts, stopwords, broadcast=broadcast)


def top_words_by_category(token_rows: DataFrame, stopwords: Stopwords, k: int = 5,
                          sentiment: str | None = None) -> DataFrame:
    """Top-k words per category by frequency (ties: word ascending)."""
    counts = category_word_counts(token_rows, stopwords, sentiment)
    return top_k_per_group(counts, ["category"], [F.col("freq").desc(), F.col("word").asc()], k)
