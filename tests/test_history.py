from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, history, scd
from changeflow.sources.samples import seed_feed
from changeflow.sources.storage import new_folder, shared_folder

KEYS = ["machine_id"]


def test_history_of_the_fixture(spark):
    rows = history.history_rows(seed_feed(spark), F.lit(datetime(2026, 3, 1)))
    assert rows.count() == 10
    assert rows.where("machine_id = 42").count() == 3
    assert {r["commit_date"] for r in rows.where("_commit_version = 2").collect()} == {date(2025, 5, 14)}


def test_scd2_effect_drops_the_untracked_update(spark):
    kept = changes.scd2_effect(seed_feed(spark), KEYS, ["site"])
    got = sorted((r["machine_id"], r["_change_type"]) for r in kept.collect())
    assert got == [(41, "insert"), (42, "delete"), (42, "insert"), (42, "insert"), (43, "delete"), (43, "insert")]


def test_changed_columns(spark):
    got = {(r["machine_id"], tuple(r["changed"])) for r in changes.changed_columns(seed_feed(spark), KEYS).collect()}
    assert got == {(41, ("remark",)), (43, ())}


def test_widening_keeps_old_rows_null_and_refuses_a_new_type(spark):
    old = seed_feed(spark)
    wide = history.widen_and_append(old, old.withColumn("warranty", F.lit("gold")))
    assert wide.columns[-1] == "warranty"
    assert wide.where("warranty IS NULL").count() == 10
    with pytest.raises(ValueError, match="site is string"):
        history.widen_and_append(old, old.withColumn("site", F.lit(1)))


def test_widened_files_are_read_under_all_columns(spark):
    path = new_folder(spark, "widened")
    old = seed_feed(spark)
    history.append_widening(old, path)
    history.append_widening(old.withColumn("warranty", F.lit("gold")), path)
    got = history.read_widened(spark, path)
    assert got.count() == 20 and got.where("warranty = 'gold'").count() == 10


def test_audit_reads_only_its_dates(spark):
    path = new_folder(spark, "audit")
    history.write_partitioned_history(seed_feed(spark), path, KEYS)
    found = history.history_audit(spark.read.parquet(path), date(2025, 5, 15), date(2025, 5, 16), machine_id=42)
    assert sorted(r["_change_type"] for r in found.collect()) == ["delete", "insert"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(commit_date" in plan
    assert "PushedFilters: [IsNotNull(machine_id), EqualTo(machine_id,42)]" in plan


def test_monthly_partitions(spark):
    months = history.with_commit_date(seed_feed(spark), "month").select("commit_date").distinct().collect()
    assert [r[0] for r in months] == [date(2025, 5, 1)]


def test_append_only_audit_counts_copies(spark):
    before = seed_feed(spark)
    doubled = before.unionByName(before)
    assert history.append_only_audit(before, doubled).isEmpty()
    assert history.append_only_audit(doubled, before).count() == 10
    later = before.withColumn("extra", F.lit(1))
    assert history.append_only_audit(before, later).isEmpty()


def test_history_beside_dimension(spark):
    feed = seed_feed(spark).where("_commit_version <> 3")  # two rows of one version have no order here
    spec = scd.Scd2(KEYS, ["_commit_version"], ["site"], "_change_type = 'delete'")
    dim = scd.apply_changes_scd2(feed, spec)
    got = {r["machine_id"]: (r["history_events"], r["dimension_rows"]) for r in history.history_vs_scd2(feed, dim, KEYS).collect()}
    assert got == {41: (3, 1), 42: (1, 1), 43: (4, 1)}


def test_busy_days_ask_for_months(spark):
    advice = history.retention_profile(seed_feed(spark), busy_day=1).select("advice").distinct().collect()
    assert [r[0] for r in advice] == ["monthly"]
    profile = {(r["grain"], str(r["period"])): (r["rows"], r["rows_so_far"]) for r in history.retention_profile(seed_feed(spark)).collect()}
    assert profile[("month", "2025-05-01")] == (10, 10)
    assert profile[("day", "2025-05-15")] == (2, 5)


def test_snapshot_with_another_schema(spark):
    path = new_folder(spark, "snapshot")
    history.publish_snapshot(seed_feed(spark), path)
    again = history.publish_snapshot(spark.range(3), path)
    assert again.columns == ["id"] and again.count() == 3


class Session:
    """The parts of a session that name the shared folder."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None
        self.conf = self.sparkContext = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.setting or default

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


def test_shared_folder_follows_the_session(spark):
    named = Session("spark://host", "hdfs://shared/work/")
    assert shared_folder(named) == "hdfs://shared/work"
    assert new_folder(named, "x").startswith("hdfs://shared/work/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host"))
    local = Session("local[8]")
    assert shared_folder(local) == shared_folder(local) == local.folder
