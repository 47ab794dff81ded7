"""Relational building blocks and the ratings jobs on small fixtures."""

from tessera.operators.dims import dedupe_dimension, lookup, two_hop_lookup
from tessera.operators.scores import (best_with_support, conditional_means, conditional_stats,
                                      mean_by)
from tessera.operators.topk import top_k_per_group
from tessera.plans import ratings as R

from conftest import rows

RATINGS = [  # user, item, score, epoch text
    ("u1", "m1", 5.0, "978307200"), ("u2", "m1", 3.0, "978307200"), ("u3", "m1", 4.0, "x"),
    ("u1", "m2", 2.0, "946684800"), ("u2", "m2", 4.0, "946684800"),
    ("u1", "m9", 1.0, "946684800"),          # item missing from the dimension
    ("u9", "m2", 3.0, "946684800"),          # user missing from the users table
]
ITEMS = [("m1", "Alpha", ["Drama", "War"]), ("m2", "Beta", ["Drama"]),
         ("m2", "Beta dup", ["Comedy"]),     # duplicated dimension key
         ("m3", "Gamma", ["Drama"])]         # item without ratings
USERS = [("u1", "M", "17", "c1"), ("u2", "F", "35", "c2"), ("u3", "M", "x", "c7")]
CODES = [("c1", "writer"), ("c2", "artist")]


def frames(spark):
    r = spark.createDataFrame(RATINGS, "user_id string, item_id string, score double, ts_text string")
    i = spark.createDataFrame(ITEMS, "item_id string, title string, tags array<string>")
    u = spark.createDataFrame(USERS, "user_id string, segment string, age string, code string")
    c = spark.createDataFrame(CODES, "code string, name string")
    return r, i, u, c


def test_dedupe_dimension_is_deterministic(spark):
    _, items, _, _ = frames(spark)
    got = rows(dedupe_dimension(items.select("item_id", "title"), "item_id"))
    assert got == [("m1", "Alpha"), ("m2", "Beta"), ("m3", "Gamma")]


def test_lookup_never_multiplies_or_drops(spark):
    r, items, _, _ = frames(spark)
    out = lookup(r, items, "item_id", "item_id", "title", default="?")
    assert out.count() == len(RATINGS)
    assert sorted(set(x[0] for x in rows(out, "title"))) == ["?", "Alpha", "Beta"]


def test_two_hop_lookup_fallbacks(spark):
    r, _, u, c = frames(spark)
    out = two_hop_lookup(r, "user_id", u, "user_id", "code", c, "code", "name")
    got = sorted(set(rows(out, "user_id", "label")))
    assert got == [("u1", "writer"), ("u2", "artist"), ("u3", "c7"), ("u9", "Unknown")]


def test_mean_by_and_best_with_support(spark):
    r, *_ = frames(spark)
    stats = mean_by(r, "item_id", "score")
    assert rows(stats) == [("m1", 4.0, 3), ("m2", 3.0, 3), ("m9", 1.0, 1)]
    assert rows(best_with_support(stats, 3, "avg_score", "n_scores", "item_id")) == [("m1", 4.0, 3)]
    # no item qualifies -> zero rows, never a placeholder row
    assert best_with_support(stats, 10, "avg_score", "n_scores", "item_id").count() == 0


def test_conditional_means_missing_is_null(spark):
    r, _, u, _ = frames(spark)
    rated = r.join(u, "user_id")
    st = conditional_stats(rated, "item_id", "segment", ["M", "F"], "score", ["male", "female"])
    got = rows(conditional_means(st, ["male", "female"]))
    assert got == [("m1", 4.5, 3.0), ("m2", 2.0, 4.0), ("m9", 1.0, None)]


def test_top_k_per_group_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "w", 2)],
                               "g string, k string, n int")
    from pyspark.sql import functions as F
    got = rows(top_k_per_group(df, ["g"], [F.col("n").desc(), F.col("k")], 1))
    assert got == [("a", "x", 3), ("b", "w", 2)]


def test_item_jobs(spark):
    r, i, u, c = frames(spark)
    assert rows(R.item_avg_score(r, i)) == [("m1", "Alpha", 4.0, 3), ("m2", "Beta", 3.0, 3)]
    assert rows(R.best_item_min_support(r, i, 3)) == [("m1", "Alpha", 4.0, 3)]
    assert rows(R.item_ranking_min_support(r, i, 1, default_title="none")) == [
        ("m1", "Alpha", 4.0, 3), ("m2", "Beta", 3.0, 3), ("m9", "none", 1.0, 1)]
    summary = rows(R.ranking_with_summary(r, i, 3))
    assert summary == [("best", "m1", "Alpha", 4.0, 3), ("ranking", "m1", "Alpha", 4.0, 3),
                       ("ranking", "m2", "Beta", 3.0, 3)]


def test_tag_jobs(spark):
    r, i, _, _ = frames(spark)
    # m1 ratings count for Drama and War, m2 (deduped to "Beta") for Drama
    assert rows(R.tag_avg_score(r, i)) == [("Drama", 3.5, 6), ("War", 4.0, 3)]
    assert rows(R.tag_avg_score(r, i, default_tag="Unknown")) == [
        ("Drama", 3.5, 6), ("Unknown", 1.0, 1), ("War", 4.0, 3)]


def test_segment_and_band_jobs(spark):
    r, i, u, c = frames(spark)
    wide = rows(R.item_avg_by_segment_wide(r, u, i, ["M", "F"], ["male", "female"]))
    # dimension-preserving: m3 has no ratings, m9 is not in the dimension
    assert wide == [("m1", "Alpha", 4.5, 3.0), ("m2", "Beta", 2.0, 4.0), ("m3", "Gamma", None, None)]
    long = rows(R.item_avg_by_segment_long(r, u, i))
    assert long == [("m1", "F", 3.0, "Alpha"), ("m1", "M", 4.5, "Alpha"), ("m2", "F", 4.0, "Beta"),
                    ("m2", "M", 2.0, "Beta"), ("m9", "M", 1.0, "Unknown")]
    bw = rows(R.item_avg_by_band_wide(r, u, i, [18, 35, 50], ["0-18", "18-35", "35-50", "50+"],
                                      ["b1", "b2", "b3", "b4"]))
    assert bw == [("m1", "Alpha", 5.0, 3.0, None, None), ("m2", "Beta", 2.0, 4.0, None, None),
                  ("m3", "Gamma", None, None, None, None)]
    bl = rows(R.item_avg_by_band_long(r, u, i, [18, 35, 50], ["<18", "18-34", "35-49", "50+"]))
    assert bl == [("m1", "35-49", 3.0, "Alpha"), ("m1", "<18", 5.0, "Alpha"),
                  ("m1", "Unknown", 4.0, "Alpha"), ("m2", "35-49", 4.0, "Beta"),
                  ("m2", "<18", 2.0, "Beta"), ("m9", "<18", 1.0, "Unknown")]


def test_label_and_year_jobs(spark):
    r, i, u, c = frames(spark)
    assert rows(R.avg_score_by_two_hop_label(r, u, c)) == [
        ("Unknown", 3.0, 1), ("artist", 3.5, 2), ("c7", 4.0, 1), ("writer", round(8 / 3, 4), 3)]
    assert rows(R.avg_score_by_epoch_year(r)) == [("2000", 2.5, 4), ("2001", 4.0, 2),
                                                   ("Unknown", 4.0, 1)]


def test_lookup_is_hinted_only_on_request(spark):
    from tessera.operators.dims import lookup

    fact = spark.range(5000).withColumnRenamed("id", "k")
    dim = spark.range(10).selectExpr("id", "id AS v")

    def plan(**kw):
        return lookup(fact, dim, "k", "id", "v", **kw)._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in plan(broadcast=True)
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_items_without_any_score_have_no_mean(spark):
    r = spark.createDataFrame([(1, "a", None, "0"), (1, "b", 2.0, "0")],
                              "user_id long, item_id string, score double, ts_text string")
    i = spark.createDataFrame([("a", "A"), ("b", "B")], "item_id string, title string")
    assert [x["item_id"] for x in R.item_avg_score(r, i).collect()] == ["b"]


def test_ranking_with_summary_is_sorted(spark, sf_small):
    from tessera.plans import bindings as B

    out = B.q_ranking_with_summary(spark, sf_small).collect()
    ranking = [x for x in out if x["section"] == "ranking"]
    assert [x["avg_score"] for x in ranking] == sorted((x["avg_score"] for x in ranking), reverse=True)
    assert out[-1]["section"] == "best" and out[-1]["item_id"] == ranking[0]["item_id"]


def test_writers_keep_nulls_and_reject_separators(spark, tmp_path):
    import pytest
    from tessera.sources.writers import write_delimited, write_key_value_text

    df = spark.createDataFrame([("b", None), (None, "2.0"), ("", "x")], "k string, v string")
    write_key_value_text(df, "k", "v", str(tmp_path / "kv"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "kv")).collect()) == [
        "\t2.0", "\tx", "b\t"]
    write_delimited(df, str(tmp_path / "d"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "d")).collect()) == [
        ";2.0", ";x", "b;"]
    for bad in ("a\tb", "a;b"):
        one = spark.createDataFrame([(bad, "1")], "k string, v string")
        with pytest.raises(Exception):
            write_key_value_text(one, "k", "v", str(tmp_path / "x1"))
            write_delimited(one, str(tmp_path / "x2"))


def test_schema_profile_counts_nulls_and_distincts(spark):
    from tessera.operators.profile import entity_counts, schema_profile

    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b")], "k int, v string")
    got = {r["column_name"]: (r["position"], r["data_type"], r["non_null"], r["n_distinct"])
           for r in schema_profile(df).collect()}
    assert got == {"k": (1, "int", 3, 2), "v": (2, "string", 3, 2)}
    counts = dict(tuple(r) for r in entity_counts([("keys", df, "k"), ("values", df, "v")])
                  .collect())
    assert counts == {"keys": 2, "values": 2}


def test_scale_conf_for_100_tb():
    from tessera.session import scale_conf

    conf = scale_conf(100 * 1024 ** 4, total_cores=8000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    # 30 TB of shuffle at 256 MB per partition, rounded up to whole waves
    assert parts % 8000 == 0 and 30 * 1024 ** 4 / parts <= 256 * 1024 ** 2
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(10 * 1024 ** 2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"      # two waves minimum
