"""The report functions regenerate the recorded RDD-job outputs exactly: each
recorded line is parsed into its values, the values go through
``tessera.plans.reports``, and the text must come out identical (padding,
two-decimal rounding, thousands separators, the winner block)."""

import os
import re

import pytest

from tessera.plans import reports as RP

HERE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


def _lines(i):
    with open(os.path.join(HERE, f"recorded_rdd_report_{i}.txt"), encoding="utf-8") as f:
        return f.read().split("\n")[:-1]


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_ranking_and_winner_block(spark):
    lines = _lines(1)
    ranking = [ln for ln in lines if re.match(r"^\d+, ", ln)]
    rows = []
    for ln in ranking:
        m = re.match(r"^(\d+), (.*), ([0-9.]+), (\d+)$", ln)
        rows.append((m.group(1), m.group(2), float(m.group(3)), int(m.group(4))))
    df = _df(spark, rows, "item_id string, title string, avg_score double, n_scores bigint")
    got = [r["line"] for r in RP.ranking_lines(df).collect()]
    assert got == ranking
    block = [r["line"] for r in RP.summary_lines(df.limit(1)).orderBy("line_no").collect()]
    assert block == lines[len(ranking):]


@pytest.mark.parametrize("i, pattern, schema, fn", [
    (2, r"^Thể loại: (.*?) +\| Điểm TB: ([0-9.]+) \| Tổng lượt rating: (\d+)$",
     "tag string, avg_score double, n_scores bigint", RP.tag_lines),
    (5, r"^Nghề nghiệp: (.*?) +\| Điểm TB: ([0-9.]+) \| Tổng số lượt đánh giá: ([\d,]+)$",
     "label string, avg_score double, n_scores bigint", RP.occupation_lines),
    (6, r"^Năm: (\S+) \| Điểm TB: ([0-9.]+) \| Tổng số lượt đánh giá: ([\d,]+)$",
     "year string, avg_score double, n_scores bigint", RP.year_lines),
])
def test_grouped_reports(spark, i, pattern, schema, fn):
    lines = _lines(i)
    rows = []
    for ln in lines:
        m = re.match(pattern, ln)
        rows.append((m.group(1), float(m.group(2)), int(m.group(3).replace(",", ""))))
    got = [r["line"] for r in fn(_df(spark, rows, schema)).collect()]
    assert got == lines


@pytest.mark.parametrize("i, label, col, fn", [
    (3, "Giới tính", "segment", RP.gender_lines),
    (4, "Nhóm tuổi", "band", RP.age_lines),
])
def test_per_item_reports(spark, i, label, col, fn):
    lines = _lines(i)
    rows = []
    for ln in lines:
        m = re.match(rf"^ID: (\d+) +\| {label}: (.*?) +\| Điểm TB: ([0-9.]+) \| Phim: (.*)$", ln)
        rows.append((int(m.group(1)), m.group(2), float(m.group(3)), m.group(4)))
    df = _df(spark, rows, f"item_id bigint, {col} string, avg_score double, title string")
    assert [r["line"] for r in fn(df).collect()] == lines


def test_tag_mean_lines_of_the_mapreduce_job(spark):
    with open(os.path.join(HERE, "recorded_tag_means.txt"), encoding="utf-8") as f:
        lines = f.read().split("\n")[:-1]
    rows = []
    for ln in lines:
        m = re.match(r"^(.*) \tAvg: ([0-9.]+),  Count: (\d+)$", ln)
        rows.append((m.group(1), float(m.group(2)), int(m.group(3))))
    df = _df(spark, rows, "tag string, avg_score double, n_scores bigint")
    assert [r["line"] for r in RP.tag_mean_lines(df).collect()] == lines
