"""Report lines, hand-over files and text layouts bound to the test tables.

The lines of every report format are made from the unrounded means of their
job.  Files are written by Spark to a fresh folder under the shared
``spark.checkpoint.dir`` and read back, as in :mod:`tessera.plans.ingest`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.strings import last_field, split_tags, split_title_fields
from tessera.operators import text as T
from tessera.plans import bindings as B
from tessera.plans import ratings as R
from tessera.plans import reports as L
from tessera.session import scratch_path
from tessera.sources.tables import load
from tessera.sources.text import read_delimited_tolerant, read_wordlist
from tessera.sources.writers import materialize, write_report

UNMET_SUPPORT = 1 << 62      # more scores than any item has


def _item_means(spark: SparkSession, d: str) -> DataFrame:
    return R.item_avg_score(B.ratings(spark, d), B.items(spark, d), digits=None)


def _best_item(spark: SparkSession, d: str, min_n: int) -> DataFrame:
    return R.best_item_min_support(B.ratings(spark, d), B.items(spark, d), min_n, digits=None)


def _tag_means(spark: SparkSession, d: str, default: str | None = None) -> DataFrame:
    return R.tag_avg_score(B.ratings(spark, d), B.items(spark, d), default, digits=None)


# ------------------------------------------------------- lines in Java formatting
def q_report_item_means(spark, d):
    return L.item_mean_lines(_item_means(spark, d))


def q_report_best_item(spark, d):
    return L.best_item_lines(_best_item(spark, d, B.MIN_SUPPORT), B.MIN_SUPPORT)


def q_report_best_item_unmet(spark, d):
    """SNK-8: no item has the support, so there is no winner and no line."""
    return L.best_item_lines(_best_item(spark, d, UNMET_SUPPORT), UNMET_SUPPORT)


def q_report_tag_means(spark, d):
    return L.tag_mean_lines(_tag_means(spark, d))


def q_report_segment_means(spark, d):
    wide = R.item_avg_by_segment_wide(
        B.ratings(spark, d), B.users(spark, d), B.items(spark, d), B.STATUS_SEGMENTS,
        B.STATUS_COLUMNS, digits=None)
    return L.segment_means_lines(wide, *B.STATUS_COLUMNS)


def q_report_band_means(spark, d):
    wide = R.item_avg_by_band_wide(
        B.ratings(spark, d), B.users(spark, d), B.items(spark, d), B.PRICE_EDGES,
        B.PRICE_BANDS_RIGHT, B.PRICE_BAND_COLUMNS, digits=None)
    return L.band_means_lines(wide, B.PRICE_BANDS_RIGHT, B.PRICE_BAND_COLUMNS)


# ----------------------------------------------------- lines in Python formatting
def q_report_ranking(spark, d):
    ranking = R.item_ranking_min_support(B.ratings(spark, d), B.items(spark, d), B.MIN_SUPPORT,
                                         digits=None)
    return L.ranking_lines(ranking).select("item_id", "line")


def q_report_summary(spark, d):
    return L.summary_lines(_best_item(spark, d, B.MIN_SUPPORT))


def q_report_tags(spark, d):
    return L.tag_lines(_tag_means(spark, d, "Unknown")).select("tag", "line")


def q_report_segments(spark, d):
    return L.gender_lines(R.item_avg_by_segment_long(
        B.ratings(spark, d), B.users(spark, d), B.items(spark, d), digits=None))


def q_report_labels(spark, d):
    by_label = R.avg_score_by_two_hop_label(B.ratings(spark, d), B.users(spark, d),
                                            B.codes(spark, d), digits=None)
    return L.occupation_lines(by_label).select("label", "line")


def _year_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.year_lines(R.avg_score_by_epoch_year(B.ratings(spark, d), digits=None))


def q_report_years(spark, d):
    return _year_lines(spark, d)


# ------------------------------------------------------------- files and layouts
def q_single_file_report(spark, d):
    """SNK-4: the year lines (one a year) as one text file, read back."""
    path = scratch_path(spark, "years")
    write_report(_year_lines(spark, d).orderBy("year").select("line"), path, single_file=True)
    return spark.read.text(path).withColumnRenamed("value", "line")


def q_staged_category_counts(spark, d):
    """SNK-2: the review keys as a stored stage, counted per category."""
    keys = materialize(T.cleaned_keys(B.word_rows(spark, d), B.STOPWORDS), spark, "keys")
    return T.count_rows_by(keys, "category")


def q_rebuild_with_stopword_file(spark, d):
    """SRC-9: the stopwords as a file of one word a line, read and removed from
    the reviews; the same answer as #16."""
    path = scratch_path(spark, "stopwords")
    B.stopword_table(spark).withColumnRenamed("stopword", "value").write.text(path)
    rows = B.with_sentiment(B.word_rows(spark, d), spark, d)
    return T.rebuild_clean_text(rows, read_wordlist(spark, path))


def _item_lines(spark: SparkSession, d: str, name: str, *fields) -> str:
    """``part`` as comma-separated lines of the fields; returns the folder."""
    line = fields[0]
    for f in fields[1:]:
        line = F.concat(line, F.lit(","), f)
    path = scratch_path(spark, name)
    load(spark, d, "part").select(line.alias("value")).write.text(path)
    return path


def q_read_limited_split(spark, d):
    """SRC-2: ``id,name,type,brand`` lines split into three fields, so that the
    last one keeps its comma."""
    path = _item_lines(spark, d, "limited", F.col("p_partkey").cast("string"), F.col("p_name"),
                       F.col("p_type"), F.col("p_brand"))
    return read_delimited_tolerant(
        spark, path, (("item_id", "bigint"), ("title", "string"), ("rest", "string")),
        min_fields=3, limit=3)


def q_title_with_commas(spark, d):
    """STR-4, UDF-4: ``id,name,brand,tag|tag`` lines whose title holds a comma."""
    path = _item_lines(spark, d, "titles", F.col("p_partkey").cast("string"), F.col("p_name"),
                       F.col("p_brand"), F.replace("p_name", F.lit(" "), F.lit("|")))
    item, title, _ = split_title_fields("value")
    last = last_field("value")
    return spark.read.text(path).select(
        item.cast("bigint").alias("item_id"), title.alias("title"), last.alias("tags"),
        F.explode(split_tags(last)).alias("tag"))


REPORT_QUERIES = {
    "report_item_means": q_report_item_means,
    "report_best_item": q_report_best_item,
    "report_best_item_unmet": q_report_best_item_unmet,
    "report_tag_means": q_report_tag_means,
    "report_segment_means": q_report_segment_means,
    "report_band_means": q_report_band_means,
    "report_ranking": q_report_ranking,
    "report_summary": q_report_summary,
    "report_tags": q_report_tags,
    "report_segments": q_report_segments,
    "report_labels": q_report_labels,
    "report_years": q_report_years,
    "single_file_report": q_single_file_report,
    "staged_category_counts": q_staged_category_counts,
    "rebuild_with_stopword_file": q_rebuild_with_stopword_file,
    "read_limited_split": q_read_limited_split,
    "title_with_commas": q_title_with_commas,
}
