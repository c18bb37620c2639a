"""What the plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, scd, state
from changeflow.plans.queries import QUERIES
from changeflow.sources.samples import seed_cdc, seed_feed
from changeflow.sources.storage import new_folder

BATCH = sorted(n for n in QUERIES if "stream" not in n and n not in ("available_now_rerun", "fan_out"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange hashpartitioning", plan_of(df)))


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan


@pytest.fixture(scope="module")
def stored(spark):
    raw, feed = new_folder(spark, "plan-raw"), new_folder(spark, "plan-feed")
    seed_cdc(spark).write.parquet(raw)
    seed_feed(spark).write.parquet(feed)
    return spark.read.parquet(raw), spark.read.parquet(feed)


def test_dimension_is_one_exchange_and_one_sort(stored):
    spec = scd.Scd2(["machine_id"], ["updated_at", "_commit_version"], ["site"], "operation = 'DELETE'")
    dim = scd.apply_changes_scd2(stored[0], spec)
    assert exchanges(dim) == 1
    assert plan_of(dim).count("Sort [") == 1
    # The untracked name is not read.
    assert "ReadSchema: struct<machine_id:bigint,site:string,operation:string,updated_at" in plan_of(dim)


def test_folds_are_one_exchange_with_map_side_combine(stored):
    feed = stored[1]
    for df in (
        state.fold_feed(feed, ["machine_id"]),
        changes.latest_by_key(feed, ["machine_id"]),
        changes.pair_images(feed, ["machine_id"]),
        changes.incremental_aggregate(feed, ["site"], {"total": "machine_id"}),
    ):
        assert exchanges(df) == 1
        assert "partial_" in plan_of(df)


def test_row_number_is_limited_before_the_exchange(stored):
    plan = plan_of(changes.dedupe_latest(stored[1], ["machine_id"]))
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def test_apply_shuffles_state_and_batch_once(stored):
    feed = stored[1]
    path = new_folder(feed.sparkSession, "plan-state")
    state.fold_feed(feed, ["machine_id"]).write.parquet(path)
    held = feed.sparkSession.read.parquet(path)
    assert exchanges(state.apply_changes_scd1(held, feed, ["machine_id"])) == 1


def test_change_types_reach_the_scan(stored):
    rows = changes.filter_change_type(stored[1], ["insert", "delete"]).select("machine_id", F.lit(1))
    assert "PushedFilters: [In(_change_type, [delete,insert])]" in plan_of(rows)


def test_a_step_joins_twice(spark):
    spec = scd.Scd2(["k"], ["at"], ["v"], "op = 'D'")
    dims, batches = new_folder(spark, "plan-step-dim"), new_folder(spark, "plan-step-batch")
    spark.range(50).selectExpr("id AS k", "'a' AS v", "1 AS start_date", "CAST(NULL AS INT) AS end_date", "true AS is_current").write.parquet(dims)
    spark.range(50).selectExpr("id AS k", "'b' AS v", "'U' AS op", "2 AS at").write.parquet(batches)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stepped = scd.scd2_step(spark.read.parquet(dims), spark.read.parquet(batches), spec)
        plan = plan_of(stepped)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2
    assert exchanges(stepped) <= 3


def test_partial_replication_folds_stored_changes(spark, sf_dir):
    plan = plan_of(QUERIES["partial_replication"](spark, sf_dir))
    assert "column_versions" in plan and "Window" not in plan and "events.parquet" not in plan
