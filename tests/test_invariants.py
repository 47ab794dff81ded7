"""Cross-job invariants on the test tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.plans import QUERIES
from tessera.plans import bindings as B
from tessera.sources.tables import load


@pytest.fixture(scope="module")
def q():
    return QUERIES


def total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_order_totals_agree(spark, sf_small, q):
    n_orders = dict(tuple(r) for r in q["entity_counts"](spark, sf_small).collect())["orders"]
    assert total(q["orders_by_country"](spark, sf_small), "total_orders") == n_orders
    assert total(q["orders_by_year_month"](spark, sf_small), "total_orders") == n_orders


def test_score_histogram_weighted_mean_is_the_mean(spark, sf_small, q):
    hist = q["score_distribution"](spark, sf_small).collect()
    mean = q["average_valid_score"](spark, sf_small).first()
    n = sum(r["total_reviews"] for r in hist)
    assert n == mean["n_valid"]
    assert round(sum(r["score"] * r["total_reviews"] for r in hist) / n, 4) == mean["avg_score"]


def test_row_counts_by_category_and_aspect_agree(spark, sf_small, q):
    a = total(q["count_by_category"](spark, sf_small), "total")
    b = total(q["count_by_aspect"](spark, sf_small), "total")
    c = q["rebuild_clean_text"](spark, sf_small).count()
    assert a == b == c


def test_every_rating_lands_in_one_label_and_one_year(spark, sf_small, q):
    n = load(spark, sf_small, "lineitem").count()
    # the added scores land in a label and in the Unknown year, and their item in no title
    m = n + B.EXTRA_SCORES
    assert total(q["avg_score_by_two_hop_label"](spark, sf_small), "n_scores") == m
    assert total(q["avg_score_by_epoch_year"](spark, sf_small), "n_scores") == m
    assert total(q["item_avg_score"](spark, sf_small), "n_scores") == n


def test_tag_counts_multiply_item_counts(spark, sf_small, q):
    per_item = q["item_avg_score"](spark, sf_small).select(
        "n_scores", F.size(F.filter(F.split("title", " "), lambda x: x != "")).alias("k"))
    expect = per_item.agg(F.sum(F.col("n_scores") * F.col("k"))).first()[0]
    assert total(q["tag_avg_score"](spark, sf_small), "n_scores") == expect


def test_word_counts_agree_with_top_words(spark, sf_small, q):
    wc = q["word_count"](spark, sf_small)
    top = q["top_words"](spark, sf_small).collect()
    best = wc.orderBy(F.col("freq").desc(), F.col("word")).limit(5).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in best]
    by_cat = q["top_words_by_category"](spark, sf_small)
    assert by_cat.groupBy("category").count().agg(F.max("count")).first()[0] <= 5
