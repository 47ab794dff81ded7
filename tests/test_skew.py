"""A key holding a third of all rows: the ratings jobs stay correct and the
hot join partition is split by adaptive execution."""

import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.operators.dims import dedupe_dimension, heavy_keys, join_once_per_key
from tessera.plans import ratings as R
from tessera.sources.tables import load

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not available")
    li = load(spark, SF, "lineitem")
    hot = li.select("l_orderkey").orderBy("l_orderkey").first()[0]
    # every third lineitem row now belongs to one order
    sk = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(hot))
                       .otherwise(F.col("l_orderkey")))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-skew-"), "lineitem")
    sk.repartition(8).write.parquet(path)
    return path


def test_hot_order_key_is_split_and_results_match(spark, skewed):
    li = spark.read.parquet(skewed)
    ratings = li.select(F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                        F.col("l_quantity").alias("score"))
    orders = load(spark, SF, "orders").select(F.col("o_orderkey").alias("user_id"),
                                              F.col("o_orderstatus").alias("segment"))
    items = load(spark, SF, "part").select(F.col("p_partkey").alias("item_id"),
                                           F.col("p_name").alias("title"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = R.item_avg_by_segment_wide(ratings, orders, items, ["F", "O"], ["f", "o"])
        got = sorted(tuple(r) for r in df.collect())
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final

    con = duckdb.connect()
    want = con.execute(f"""
        SELECT i.item_id, i.title,
          CASE WHEN fn > 0 THEN round(fs / fn, 4) END, CASE WHEN on_ > 0 THEN round(os_ / on_, 4) END
        FROM (SELECT p_partkey AS item_id, min(p_name) AS title
              FROM read_parquet('{SF}/part.parquet') GROUP BY 1) i
        LEFT JOIN (SELECT l.l_partkey AS item_id,
              sum(CASE WHEN o_orderstatus = 'F' THEN l_quantity END) AS fs,
              count(CASE WHEN o_orderstatus = 'F' THEN l_quantity END) AS fn,
              sum(CASE WHEN o_orderstatus = 'O' THEN l_quantity END) AS os_,
              count(CASE WHEN o_orderstatus = 'O' THEN l_quantity END) AS on_
            FROM read_parquet('{skewed}/*.parquet') l
            JOIN read_parquet('{SF}/orders.parquet') o ON l.l_orderkey = o.o_orderkey
            GROUP BY 1) s USING (item_id)""").fetchall()
    assert got == sorted(want)


def once_inputs(spark, skewed):
    ratings = spark.read.parquet(skewed).select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("score"))
    orders = load(spark, SF, "orders").select(F.col("o_orderkey").alias("user_id"),
                                              F.col("o_orderstatus").alias("segment"))
    again = orders.withColumn("segment", F.lit("Z"))       # every user twice, the smaller one counts
    return ratings, orders.unionByName(again)


def test_hot_key_of_a_deduplicated_join_is_dealt_over_partitions(spark, skewed):
    ratings, users = once_inputs(spark, skewed)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        heavy = heavy_keys(ratings, "user_id", 32).collect()
        hot = ratings.groupBy("user_id").count().orderBy(F.desc("count")).first()
        assert [r["__key"] for r in heavy] == [hot["user_id"]] and heavy[0]["__salts"] > 5
        salted = join_once_per_key(ratings, users, "user_id")
        plain = ratings.join(dedupe_dimension(users, "user_id"), "user_id")
        size = {name: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
                for name, df in (("salted", salted), ("plain", plain))}
        total = sum(size["plain"])
        assert sum(size["salted"]) == total
        assert max(size["plain"]) > total / 4 and max(size["salted"]) < total / 6
        cols = ("user_id", "item_id", "score", "segment")
        assert sorted(tuple(r[c] for c in cols) for r in salted.collect()) == sorted(
            tuple(r[c] for c in cols) for r in plain.collect())
        wide = R.item_avg_by_segment_wide(ratings, users, items_of(spark), ["F", "O"], ["f", "o"],
                                          dedupe_users=True)
        same = R.item_avg_by_segment_wide(ratings, users.where("segment <> 'Z'"), items_of(spark),
                                          ["F", "O"], ["f", "o"])
        assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, same.collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def items_of(spark):
    return load(spark, SF, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def test_join_once_per_key_with_nulls_and_without_heavy_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k long, salts string")
    dim = spark.createDataFrame([(1, "y"), (1, "x"), (2, None), (None, "n"), (9, "z")], "k long, v string")
    for partitions in (1, 1000):
        got = sorted((tuple(r) for r in join_once_per_key(fact, dim, "k", partitions=partitions).collect()), key=repr)
        assert got == [(1, "a", "x"), (1, "a", "x"), (2, "b", None)]
        left = join_once_per_key(fact, dim, "k", how="left", partitions=partitions)
        assert left.columns == ["k", "salts", "v"] and left.count() == 5
    assert join_once_per_key(fact.where("false"), dim, "k").count() == 0
    assert join_once_per_key(fact, dim.where("false"), "k").count() == 0
    with pytest.raises(ValueError):
        join_once_per_key(fact, dim, "k", how="full")
