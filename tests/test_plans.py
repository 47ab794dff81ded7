"""Physical plan assertions: the shapes the jobs are designed to get."""

import pytest

from tessera.plans import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return QUERIES


def test_stopword_removal_is_broadcast_anti_join(spark, sf_small, qs):
    p = plan(qs["remove_stopwords"](spark, sf_small))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_per_group_top_k_has_window_group_limit(spark, sf_small, qs):
    p = plan(qs["top_words_by_category"](spark, sf_small))
    # the partial limit runs map-side, below the exchange on the category
    final_at = p.index("WindowGroupLimit")
    exchange_at = p.index("Exchange hashpartitioning(category")
    partial_at = p.index("WindowGroupLimit", exchange_at)
    assert final_at < exchange_at < partial_at
    assert "Partial" in p[partial_at:p.index("\n", partial_at)]


@pytest.mark.parametrize("name", ["best_item_min_support", "top_words", "seller_ranking"])
def test_global_top_k_is_take_ordered(spark, sf_small, qs, name):
    assert "TakeOrderedAndProject" in plan(qs[name](spark, sf_small))


def test_no_python_udf_or_cartesian_product(spark, sf_small, qs):
    for name, fn in qs.items():
        if name.startswith("read_"):
            continue  # these write their input first; their plans are plain scans
        p = plan(fn(spark, sf_small))
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_scans_read_only_needed_columns(spark, sf_small, qs):
    df = qs["item_avg_score"](spark, sf_small)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p


def test_fact_is_aggregated_before_the_dimension_join(spark, sf_small, qs):
    # the partial aggregate on lineitem sits below the join with part
    p = qs["tag_avg_score"](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
    join_at = p.index("Join ")
    assert "Aggregate [item_id" in p[join_at:] or "Aggregate [l_partkey" in p[join_at:]


def test_dimension_dedupe_partitioning_is_reused(spark, sf_small, qs):
    """dedupe (groupBy key) + join on the same key: with sort-merge joins the
    deduplicated side is not shuffled a second time."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(qs["item_avg_score"](spark, sf_small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in p
    # lineitem partial agg exchange + part dedupe exchange; none added for the join
    assert p.count("Exchange hashpartitioning") == 2
