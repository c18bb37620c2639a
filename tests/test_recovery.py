from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, recovery, state
from changeflow.plans.batch import run_batch
from changeflow.sources import commits as ledger
from changeflow.sources.samples import seed_feed
from pyspark.sql.types import LongType, StringType, StructField, StructType

COMMITS = "source string, version bigint, timestamp timestamp, operation string, feed_enabled boolean, retained boolean"
DAY = datetime(2026, 1, 1)
KEYS = ["id"]


def commits(spark, versions, source="a", off=(), lost=(), op="WRITE", ops=None):
    rows = [
        (source, v, DAY + timedelta(hours=v), (ops or {}).get(v, op), v not in off, v not in lost)
        for v in versions
    ]
    return spark.createDataFrame(rows, COMMITS)


def health(spark, made, last, **options):
    progress = spark.createDataFrame([("a", last)], "source string, last_version bigint")
    r = recovery.feed_health(made, progress, **options).first()
    return r["status"], r["issues"]


def test_health_statuses(spark):
    every = commits(spark, range(1, 201))
    assert health(spark, every, 100) == ("OK", "")
    assert health(spark, every, 99) == ("HIGH_LAG", "HIGH_LAG")
    assert health(spark, every, 99, max_lag=150) == ("OK", "")
    assert health(spark, every, 200) == ("OK", "")
    lost = commits(spark, range(1, 201), lost=range(1, 51))
    assert health(spark, lost, 49) == ("VERSION_LOST", "VERSION_LOST,HIGH_LAG")
    assert health(spark, lost, 50, max_lag=999) == ("OK", "")
    off_now = commits(spark, range(1, 11), off=[10])
    assert health(spark, off_now, 10) == ("FEED_DISABLED", "FEED_DISABLED")
    gap = commits(spark, range(1, 11), off=[4, 5])
    assert health(spark, gap, 3) == ("FEED_DISABLED", "FEED_DISABLED")
    assert health(spark, gap, 5) == ("OK", "")
    quiet_gap = commits(spark, range(1, 11), off=[4, 5], op="OPTIMIZE")
    assert health(spark, quiet_gap, 3) == ("OK", "")


def test_a_source_without_commits_is_not_healthy(spark):
    assert health(spark, commits(spark, range(1, 4), source="b"), 1)[0] == "FEED_DISABLED"


def test_guard_stops_before_the_batch(spark):
    progress = spark.createDataFrame([("a", 1)], "source string, last_version bigint")
    bad = recovery.feed_health(commits(spark, range(1, 201)), progress)
    with pytest.raises(RuntimeError, match="HIGH_LAG"):
        recovery.guarded_batch(bad, lambda: pytest.fail("the batch ran"))
    good = recovery.feed_health(commits(spark, range(1, 3)), progress)
    assert recovery.guarded_batch(good, lambda: "ran") == "ran"


def test_lag_and_share_of_retention(spark):
    progress = spark.createDataFrame([("a", 110)], "source string, last_version bigint")
    r = recovery.processing_lag(commits(spark, range(1, 201), lost=range(1, 101)), progress).first()
    assert (r["lag"], r["retention_used_percent"], r["alert"]) == (90, 90, True)


def test_ranges_and_gaps(spark):
    made = commits(
        spark,
        range(1, 11),
        off=[3, 4, 8],
        op="OPTIMIZE",
        ops={3: "INSERT", 4: "UPDATE", 9: "WRITE"},
    )
    got = sorted((r["first_version"], r["last_version"], r["feed_enabled"], r["commits"]) for r in ledger.feed_enabled_ranges(made).collect())
    assert got == [(1, 2, True, 2), (3, 4, False, 2), (5, 7, True, 3), (8, 8, False, 1), (9, 10, True, 2)]
    gaps = ledger.gap_window(made).collect()
    assert [(g["first_version"], g["last_version"], g["inserts"], g["updates"], g["insert_only"]) for g in gaps] == [(3, 4, 1, 1, False)]
    assert ledger.latest_commit(made).first()["version"] == 10
    assert [r["version"] for r in ledger.commit_history(made, 2, 4).collect()] == [3, 4]
    assert ledger.latest_version(made.where("1 = 0")) == 0


def snapshots(spark):
    pre = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, value string")
    post = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d")], "id bigint, value string")
    return pre, post


def test_gap_repair_gives_the_net_change(spark):
    pre, post = snapshots(spark)
    made = commits(spark, range(1, 6), off=[3, 4], ops={3: "UPDATE", 4: "DELETE"})
    fixed = recovery.gap_repair(pre, post, KEYS, ["value"], ledger.gap_window(made), made)
    got = sorted((r["id"], r["_change_type"], r["value"]) for r in fixed.collect())
    assert got == [(2, "update_postimage", "c"), (2, "update_preimage", "b"), (3, "delete", None), (4, "insert", "d")]
    assert {(r["_commit_version"], r["_commit_timestamp"], r["synthetic"]) for r in fixed.collect()} == {
        (4, DAY + timedelta(hours=4), True)
    }
    held = pre.withColumn("last_commit_version", F.lit(2).cast("bigint")).withColumn("is_deleted", F.lit(False))
    after = state.current_snapshot(state.apply_changes_scd1(held, fixed.drop("synthetic"), KEYS))
    assert changes.reconcile(after.select("id", "value"), post).isEmpty()


def test_gap_of_inserts_gives_inserts(spark):
    pre, post = snapshots(spark)
    grown = pre.unionByName(post.where("id = 4"))
    made = commits(spark, range(1, 6), off=[3, 4], op="INSERT")
    fixed = recovery.gap_repair(pre, grown, KEYS, ["value"], ledger.gap_window(made), made)
    assert [(r["id"], r["_change_type"]) for r in fixed.collect()] == [(4, "insert")]
    with pytest.raises(ValueError, match="no gap"):
        recovery.gap_repair(pre, post, KEYS, ["value"], ledger.gap_window(commits(spark, range(1, 6))), made)


def test_baseline_has_one_version(spark):
    feed = seed_feed(spark)
    made = commits(spark, range(1, 6), source="customers")
    base = recovery.rebaseline(feed, made, ["machine_id"])
    assert base.version == 5
    assert [(r["machine_id"], r["last_commit_version"]) for r in base.snapshot.orderBy("machine_id").collect()] == [(41, 5), (42, 5)]
    assert [tuple(r) for r in base.progress("customers").collect()] == [("customers", 5)]


def test_replay_finds_nothing_for_a_right_apply(spark):
    feed = seed_feed(spark)
    assert recovery.replay_check(feed, ["machine_id"], [1, 2, 3]).isEmpty()


def test_replay_of_a_row_that_comes_back_in_the_version_of_its_delete(spark):
    rows = [(3, "a", "insert", 1), (3, "a", "delete", 2), (3, "b", "insert", 2), (5, "x", "insert", 1), (5, "x", "delete", 3)]
    feed = spark.createDataFrame([(*r, DAY) for r in rows], "id bigint, value string, _change_type string, _commit_version bigint, _commit_timestamp timestamp")
    assert recovery.replay_check(feed, KEYS, [1, 2]).isEmpty()
    final = recovery.replayed_state(feed, KEYS, [1, 2])
    assert [(r["id"], r["value"], r["last_commit_version"]) for r in final.collect()] == [(3, "b", 2)]


def test_full_batch_moves_state_and_watermark(spark):
    feed = seed_feed(spark)
    made = commits(spark, range(1, 6), source="customers")
    progress = spark.createDataFrame([("customers", 1), ("other", 7)], "source string, last_version bigint")
    start = state.fold_feed(feed.where("_commit_version <= 1"), ["machine_id"]).drop("remark")
    expected = StructType([StructField("machine_id", LongType()), StructField("site", StringType())])
    result = run_batch("customers", feed, made, start, progress, ["machine_id"], expected)
    assert {(r["machine_id"], r["site"], r["is_deleted"]) for r in result.state.collect()} == {
        (41, "Oslo", False), (42, "Bonn", False), (43, None, True),
    }
    assert {tuple(r) for r in result.progress.collect()} == {("customers", 5), ("other", 7)}
    again = run_batch("customers", feed, made, result.state, progress, ["machine_id"], expected)
    assert changes.reconcile(result.state, again.state).isEmpty()
