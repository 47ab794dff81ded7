"""Text reports in the line formats of the reference's jobs (STR-11..14).

Each function projects a job result to a ``line`` column (plus the columns
the lines are ordered by); write it with
:func:`tessera.sources.writers.write_report`.  Two rounding conventions
exist: the MapReduce jobs print with Java ``%.2f`` (:func:`fixed2`), the RDD
jobs with Python ``:.2f`` (:func:`python_fixed`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.report import fixed2, left_justify, or_label, python_fixed, thousands

# Line formats of the reference's reports.
# MapReduce jobs (Java formatting):
ITEM_MEAN_LINE = "%s\tAverage Rating: %s (Total Ratings: %d)"
BEST_ITEM_LINE = ("%s\tis the highest rated movie with an average rating of %s "
                  "among movies with at least %d ratings")
TAG_MEAN_LINE = "%s \tAvg: %s,  Count: %d"
SEGMENT_MEANS_LINE = "%s:\tMale: %s, Female: %s"
BAND_MEANS_LINE = "%s:\t[%s]"
MISSING_MEAN = "NA"
# RDD jobs (Python formatting):
RANKING_LINE = "%s, %s, %s, %d"
SUMMARY_RULE = "--------------------------------------------------"
SUMMARY_TITLE = "KET QUA: PHIM CO DIEM TRUNG BINH CAO NHAT"
SUMMARY_ID = "ID phim: %s"
SUMMARY_NAME = "Ten phim: %s"
SUMMARY_MEAN = "Diem trung binh: %s / 5.0"
SUMMARY_COUNT = "So luot danh gia: %d luot"
TAG_LINE = "Thể loại: %s | Điểm TB: %s | Tổng lượt rating: %d"
GENDER_LINE = "ID: %s | Giới tính: %s | Điểm TB: %s | Phim: %s"
AGE_LINE = "ID: %s | Nhóm tuổi: %s | Điểm TB: %s | Phim: %s"
OCCUPATION_LINE = "Nghề nghiệp: %s | Điểm TB: %s | Tổng số lượt đánh giá: %s"
YEAR_LINE = "Năm: %s | Điểm TB: %s | Tổng số lượt đánh giá: %s"


# ----------------------------------------------------- MapReduce-style lines
def item_mean_lines(item_means: DataFrame) -> DataFrame:
    """``item_avg_score`` rows -> ``title<TAB>Average Rating: x.xx (Total Ratings: n)``."""
    return item_means.select("item_id", F.format_string(
        ITEM_MEAN_LINE, "title", fixed2("avg_score"), "n_scores").alias("line"))


def best_item_lines(best: DataFrame, min_n: int) -> DataFrame:
    """``best_item_min_support`` row -> the winner line (no row, no line)."""
    return best.select(F.format_string(BEST_ITEM_LINE, "title", fixed2("avg_score"),
                                       F.lit(min_n)).alias("line"))


def tag_mean_lines(tag_means: DataFrame) -> DataFrame:
    """``tag_avg_score`` rows -> ``tag <TAB>Avg: x.xx,  Count: n``."""
    return tag_means.select("tag", F.format_string(
        TAG_MEAN_LINE, "tag", fixed2("avg_score"), "n_scores").alias("line"))


def segment_means_lines(wide: DataFrame, male: str = "male", female: str = "female",
                        fill: float = 0.0) -> DataFrame:
    """Two-segment wide means -> ``title:<TAB>Male: x.xx, Female: y.yy`` (a
    missing mean prints as ``fill``, 0.00 like the reference)."""
    m = F.coalesce(F.col(male), F.lit(fill))
    f = F.coalesce(F.col(female), F.lit(fill))
    return wide.select("item_id", F.format_string(
        SEGMENT_MEANS_LINE, "title", fixed2(m), fixed2(f)).alias("line"))


def band_means_lines(wide: DataFrame, labels: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Band-wide means -> ``title:<TAB>[label: x.xx, label: NA, ...]``."""
    parts = [F.concat(F.lit(f"{lab}: "), or_label(n, MISSING_MEAN)) for lab, n in
             zip(labels, names)]
    return wide.select("item_id", F.format_string(
        BAND_MEANS_LINE, "title", F.concat_ws(", ", *parts)).alias("line"))


# ---------------------------------------------------------- RDD-style lines
def ranking_lines(ranking: DataFrame) -> DataFrame:
    """Ranking rows -> ``id, title, x.xx, n`` with the exact mean ordering."""
    return ranking.select("item_id", "avg_score", F.format_string(
        RANKING_LINE, "item_id", "title", python_fixed("avg_score"), "n_scores").alias("line"))


def summary_lines(best: DataFrame) -> DataFrame:
    """The winner block printed after the ranking: one row per line, with
    ``line_no`` giving the order."""
    lines = [F.lit(""), F.lit(SUMMARY_RULE), F.lit(SUMMARY_TITLE),
             F.format_string(SUMMARY_ID, "item_id"), F.format_string(SUMMARY_NAME, "title"),
             F.format_string(SUMMARY_MEAN, python_fixed("avg_score")),
             F.format_string(SUMMARY_COUNT, "n_scores"), F.lit(SUMMARY_RULE)]
    block = best.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))
    return block


def tag_lines(tag_means: DataFrame) -> DataFrame:
    return tag_means.select("tag", "avg_score", F.format_string(
        TAG_LINE, left_justify("tag", 15), python_fixed("avg_score"), "n_scores").alias("line"))


def gender_lines(long: DataFrame) -> DataFrame:
    return long.select("item_id", "segment", F.format_string(
        GENDER_LINE, left_justify(F.col("item_id").cast("string"), 5), "segment",
        python_fixed("avg_score"), "title").alias("line"))


def age_lines(long: DataFrame) -> DataFrame:
    return long.select("item_id", "band", F.format_string(
        AGE_LINE, left_justify(F.col("item_id").cast("string"), 5), left_justify("band", 8),
        python_fixed("avg_score"), "title").alias("line"))


def occupation_lines(by_label: DataFrame) -> DataFrame:
    return by_label.select("label", "avg_score", F.format_string(
        OCCUPATION_LINE, left_justify("label", 15), python_fixed("avg_score"),
        thousands("n_scores")).alias("line"))


def year_lines(by_year: DataFrame) -> DataFrame:
    return by_year.select("year", F.format_string(
        YEAR_LINE, "year", python_fixed("avg_score"), thousands("n_scores")).alias("line"))
