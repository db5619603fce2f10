"""What the plans must and must not hold."""

import re

import pytest

from weirflow import catalog

SF = "/root/testdata/sf0.001"
QUERIES = catalog.queries()

# building these starts Spark jobs (marks, checkpoints, models); their operators are covered by others
EAGER = {"checkpoint_next", "checkpoint_upsert", "downline_closure", "sponsored_signups", "sponsored_orders",
         "phrases", "phrase_tokens", "usage_features", "als_top5", "als_rmse", "lda_topics",
         "cdc_stream", "upsert_stream", "export_per_client", "batched_lookup", "cdc_ordered", "state_upsert", "svd_facts", "svd_rmse",
         "keyed_log", "append_posted", "posted_faults", "rows_by_characters", "distinct_sketches", "refine_cycle"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_QUERIES = {"compress_long", "database_rows", "gunzip_column", "decrypt_lines"}
PYTHON_NODES = r"EvalPython|ArrowPython|MapInPandas|FlatMapGroupsInPandas"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_needless_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name in PYTHON_QUERIES or not re.search(PYTHON_NODES, plan)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["adjacent_windows"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in plan


def test_first_version_is_pruned_before_the_shuffle(spark):
    plan = plan_of(QUERIES["latest_version"](spark, SF))
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and exchange < partial  # printed top down


@pytest.mark.parametrize("name", ["lifetime_value", "year_cohort_value", "days_to_first_sale", "fast_starters", "order_mix"])
def test_reports_aggregate_by_hash_before_they_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "SortAggregate" not in plan and "partial_count" in plan


def test_join_keys_keep_the_lane(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["downline_generations"](spark, SF))
        assert re.search(r"SortMergeJoin \[client_partition_id#\d+L, _anchor#\d+L, _lane#\d+L\]", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ancestors_are_filtered_before_they_are_unfolded(spark):
    plan = plan_of(QUERIES["sponsored_orders"](spark, SF))
    unfold, near = plan.index("Generate posexplode"), plan.index("lambdafunction((timestampdiff(DAY")
    assert unfold < near  # printed top down: the filter stands below


def test_six_generations_are_three_joins(spark, monkeypatch):
    from weirflow.operators import tree

    steps, step = [], tree._step
    monkeypatch.setattr(tree, "_step", lambda *a: steps.append(1) or step(*a))
    edges = spark.createDataFrame([(1, u, u - 1) for u in range(1, 9)], "client_partition_id long, user_id long, sponsor_id long")
    assert max(len(r.path) for r in tree.sponsor_paths(edges, 6).collect()) == 6 and len(steps) == 3
