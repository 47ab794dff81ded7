"""Command line: run a family of jobs on the reference's input files and write
their outputs in the reference's formats.

    python -m tessera.cli ratings  --input DIR --output DIR [--min-support 5]
    python -m tessera.cli reviews  --input hotel-review.csv --stopwords stopwords.txt --output DIR
    python -m tessera.cli commerce --input DIR --output DIR

On a cluster, submit the module with ``spark-submit`` so the session (and its
``spark.checkpoint.dir``) comes from the cluster.  Per-item outputs are
written sorted across many part files; outputs whose size is bounded by a
small number of groups are written as one file.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.bands import (LEFT_CLOSED_AGE_EDGES, LEFT_CLOSED_AGE_LABELS,
                                     RIGHT_CLOSED_AGE_EDGES, RIGHT_CLOSED_AGE_LABELS)
from tessera.operators import text as T
from tessera.operators.profile import entity_counts, schema_profile
from tessera.plans import commerce as C
from tessera.plans import ratings as R
from tessera.plans import reports as RP
from tessera.sources import datasets as D
from tessera.sources.writers import materialize, write_delimited, write_report

BAND_COLUMNS = ("band_0_18", "band_18_35", "band_35_50", "band_50_plus")
TOP_K = 5
TOP_SELLERS = 20


def _lines(df: DataFrame, path: str, order: list, single_file: bool) -> None:
    write_report(df.orderBy(*order).select(F.col("line").alias("value")), path,
                 single_file=single_file)


def run_ratings(spark: SparkSession, src: str, out: str, min_support: int) -> None:
    # every input feeds several reports: parse the text once into parquet
    ratings = materialize(D.read_ratings(spark, os.path.join(src, "ratings_*.txt")), spark,
                          "cli-ratings")
    movies = materialize(D.read_movies(spark, os.path.join(src, "movies.txt")), spark,
                         "cli-movies")
    users = materialize(D.read_users(spark, os.path.join(src, "users.txt")), spark, "cli-users")
    occupations = materialize(D.read_occupations(spark, os.path.join(src, "occupation.txt")),
                              spark, "cli-occupations")
    o = lambda name: os.path.join(out, name)

    means = R.item_avg_score(ratings, movies, digits=None)
    _lines(RP.item_mean_lines(means), o("item_means"), ["item_id"], False)
    best = R.best_item_min_support(ratings, movies, min_support, digits=None)
    _lines(RP.best_item_lines(best, min_support), o("best_item"), ["line"], True)
    _lines(RP.tag_mean_lines(R.tag_avg_score(ratings, movies, digits=None)),
           o("tag_means"), ["tag"], True)
    # the MapReduce jobs remember one gender and one age per user
    wide = R.item_avg_by_segment_wide(ratings, users, movies, ["M", "F"], ["male", "female"],
                                      digits=None, dedupe_users=True)
    _lines(RP.segment_means_lines(wide), o("segment_means"), ["item_id"], False)
    bands = R.item_avg_by_band_wide(ratings, users, movies, RIGHT_CLOSED_AGE_EDGES,
                                    RIGHT_CLOSED_AGE_LABELS, BAND_COLUMNS, digits=None,
                                    dedupe_users=True)
    _lines(RP.band_means_lines(bands, RIGHT_CLOSED_AGE_LABELS, BAND_COLUMNS), o("band_means"),
           ["item_id"], False)

    ranking = R.item_ranking_min_support(ratings, movies, min_support, digits=None)
    rank_lines = RP.ranking_lines(ranking).select(
        F.lit(0).alias("part"), (-F.col("avg_score")).alias("k1"),
        F.col("item_id").cast("string").alias("k2"), "line")
    summary = RP.summary_lines(ranking.limit(1)).select(
        F.lit(1).alias("part"), F.col("line_no").cast("double").alias("k1"),
        F.lit("").alias("k2"), "line")
    _lines(rank_lines.unionByName(summary), o("ranking"), ["part", "k1", "k2"], False)
    _lines(RP.tag_lines(R.tag_avg_score(ratings, movies, default_tag="Unknown", digits=None)),
           o("genres"), [F.col("avg_score").desc(), "tag"], True)
    gender = R.item_avg_by_segment_long(ratings, users, movies, digits=None)
    _lines(RP.gender_lines(gender), o("gender"), ["item_id", "segment"], False)
    age = R.item_avg_by_band_long(ratings, users, movies, LEFT_CLOSED_AGE_EDGES,
                                  LEFT_CLOSED_AGE_LABELS, digits=None)
    _lines(RP.age_lines(age), o("age"), ["item_id", "band"], False)
    labels = R.avg_score_by_two_hop_label(ratings, users, occupations, digits=None)
    _lines(RP.occupation_lines(labels), o("occupation"), [F.col("avg_score").desc(), "label"],
           True)
    _lines(RP.year_lines(R.avg_score_by_epoch_year(ratings, digits=None)), o("year"), ["year"],
           True)


def run_reviews(spark: SparkSession, src: str, stopwords_path: str, out: str) -> None:
    reviews = D.read_hotel_reviews(spark, src)
    stop = D.read_stopwords(spark, stopwords_path)
    o = lambda name: os.path.join(out, name)
    toks = T.review_tokens(T.clean_reviews(reviews))
    table = T.rebuild_clean_text(toks, stop)
    write_delimited(table, o("cleaned_data"), sep=";")
    # the other jobs read the stored cleaned table, as the reference does
    stored = D.read_cleaned_reviews(spark, o("cleaned_data"))
    words = T.tokens_of_cleaned_table(stored)
    keys = stored.select(*T.KEYS)

    def csv(df: DataFrame, name: str, order: list) -> None:
        write_delimited(df.orderBy(*order).coalesce(1), o(name), sep=",")

    csv(T.top_words(words, [], TOP_K), "top_words", [F.col("freq").desc(), "word"])
    csv(T.count_rows_by(keys, "category"), "category", ["category"])
    csv(T.count_rows_by(keys, "aspect"), "aspect", ["aspect"])
    csv(T.top_aspect(keys, "negative"), "most_negative_aspect", ["aspect"])
    csv(T.top_aspect(keys, "positive"), "most_positive_aspect", ["aspect"])
    by_freq = ["category", F.col("freq").desc(), "word"]
    csv(T.top_words_by_category(words, [], TOP_K, "positive"), "top_positive_words", by_freq)
    csv(T.top_words_by_category(words, [], TOP_K, "negative"), "top_negative_words", by_freq)
    csv(T.top_words_by_category(words, [], TOP_K), "top_related_words", by_freq)


def run_commerce(spark: SparkSession, src: str, out: str) -> None:
    def t(name: str, **kw) -> DataFrame:
        # each table feeds several results: parse the CSV once into parquet
        table = D.read_commerce_table(spark, os.path.join(src, f"{name}.csv"), name, **kw)
        return materialize(table, spark, f"cli-{name}")

    customers, items = t("Customer_List"), t("Order_Items")
    orders, reviews = t("Orders"), t("Order_Reviews", free_text=True)
    o = lambda name: os.path.join(out, name)

    def csv(df: DataFrame, name: str) -> None:
        write_delimited(df.coalesce(1), o(name), sep=",", header=True)

    tables = [("Customer_List", customers), ("Order_Items", items), ("Orders", orders),
              ("Order_Reviews", reviews)]
    try:
        tables.append(("Products", t("Products")))
    except AnalysisException:  # the products table is only profiled when present
        pass
    for name, df in tables:
        csv(schema_profile(df), f"schema_{name}")
    csv(entity_counts([("orders", orders, "Order_ID"), ("customers", customers, "Subscriber_ID"),
                       ("sellers", items, "Seller_ID")]), "entity_counts")
    o_df = orders.select(F.col("Order_ID").alias("order_id"),
                         F.col("Customer_Trx_ID").alias("customer_id"),
                         F.col("Order_Purchase_Timestamp").alias("purchase_ts"))
    c_df = customers.select(F.col("Customer_Trx_ID").alias("customer_id"),
                            F.col("Customer_Country").alias("country"))
    csv(C.orders_by_country(o_df, c_df), "orders_by_country")
    csv(C.orders_by_year_month(o_df), "orders_by_year_month")
    scores = reviews.select(F.col("Review_Score").cast("string").alias("score"))
    csv(C.average_valid_score(scores), "average_valid_score")
    csv(C.score_distribution(scores), "score_distribution")
    i_df = items.select(F.col("Seller_ID").alias("seller_id"), F.col("Order_ID").alias("order_id"),
                        F.col("Price").alias("price"))
    csv(C.seller_ranking(i_df, TOP_SELLERS), "seller_ranking")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="family", required=True)
    r = sub.add_parser("ratings")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--min-support", type=int, default=5)
    v = sub.add_parser("reviews")
    v.add_argument("--input", required=True)
    v.add_argument("--stopwords", required=True)
    v.add_argument("--output", required=True)
    c = sub.add_parser("commerce")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    args = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tessera-{args.family}").getOrCreate()
    if args.family == "ratings":
        run_ratings(spark, args.input, args.output, args.min_support)
    elif args.family == "reviews":
        run_reviews(spark, args.input, args.stopwords, args.output)
    else:
        run_commerce(spark, args.input, args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
