"""Cases that lost, doubled or mixed up rows once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from changeflow.functions import session_rules
from changeflow.functions.ordered import KeyOrder
from changeflow.operators import changes, recovery, scd, security, state
from changeflow.plans.batch import run_batch
from changeflow.sources import commits as ledger
from changeflow.sources import feed as reading
from changeflow.sources.storage import new_folder
from changeflow.streaming import consumers, sinks

DAY = datetime(2025, 3, 4)
FEED = "k bigint, v string, _change_type string, _commit_version bigint, _commit_timestamp timestamp"
COMMITS = "source string, version bigint, timestamp timestamp, operation string, feed_enabled boolean, retained boolean"
PROGRESS = "source string, last_version bigint"


def feed_of(spark, *rows):
    return spark.createDataFrame([(*r, DAY) for r in rows], FEED)


def commits_of(spark, *rows):
    return spark.createDataFrame([(s, v, DAY, op, on, kept) for s, v, op, on, kept in rows], COMMITS)


@pytest.fixture()
def job(spark):
    base = new_folder(spark, "mended")
    return sinks.Job(f"{base}/sink", f"{base}/checkpoints")


@pytest.mark.parametrize("name", ["a\\\\", "x\\\\', 'platform-admins", "it's", 'q"q', "-- c", "') AS z --", "é"])
def test_group_names_are_only_names(spark, name):
    session_rules.install(spark, [name])
    row = spark.createDataFrame([(name,)], "g string").selectExpr(
        "is_group_member(g) AS own", "is_group_member('platform-admins') AS bypass", "size(reader_groups) AS n"
    )
    assert tuple(row.first()) == (True, False, 1)
    session_rules.sign_in(spark, [])


def test_two_batches_of_one_version_in_any_order(spark):
    delete, insert = feed_of(spark, (1, "a", "delete", 5)), feed_of(spark, (1, "b", "insert", 5))
    start = state.fold_feed(feed_of(spark, (1, "a", "insert", 1)), ["k"])
    results = []
    for batches in ([delete, insert], [insert, delete], [delete.union(insert)], [delete, insert, delete]):
        held = start
        for batch in batches:
            held = state.apply_changes_scd1(held, batch, ["k"])
        results.append([tuple(r) for r in held.collect()])
    assert all(r == [(1, "b", 5, False)] for r in results)


@pytest.mark.parametrize("kind", ["upsert", None])
def test_unknown_change_types_are_refused(spark, kind):
    feed = feed_of(spark, (1, "a", "insert", 1), (2, "b", kind, 2))
    for result in (
        changes.incremental_aggregate(feed, ["v"], {}),
        state.fold_feed(feed, ["k"]),
        changes.latest_by_key(feed, ["k"]),
    ):
        with pytest.raises(Exception, match="unknown change type"):
            result.collect()


def test_a_second_gap_is_refused(spark):
    commits = commits_of(spark, ("s", 1, "INSERT", True, True), ("s", 2, "UPDATE", False, True), ("s", 3, "UPDATE", True, True), ("s", 4, "DELETE", False, True))
    empty = spark.createDataFrame([], "k bigint, v string")
    with pytest.raises(ValueError, match="more than one gap"):
        recovery.gap_repair(empty, empty, ["k"], ["v"], ledger.gap_window(commits), commits)
    one = ledger.gap_window(commits).where("first_version = 2")
    pre, post = (spark.createDataFrame([(1, x)], "k bigint, v string") for x in "ab")
    fixed = recovery.gap_repair(pre, post, ["k"], ["v"], one, commits)
    assert {(r["_change_type"], r["_commit_version"]) for r in fixed.collect()} == {("update_preimage", 2), ("update_postimage", 2)}


def test_ledgers_of_several_sources(spark):
    commits = commits_of(spark, ("a", 1, "INSERT", True, True), ("b", 900, "INSERT", True, True))
    feed = feed_of(spark, (1, "x", "insert", 1))
    assert ledger.latest_version(commits, "a") == 1 and ledger.latest_commit(commits, "b").first()["version"] == 900
    assert recovery.rebaseline(feed, commits, ["k"], "a").version == 1
    for call in (
        lambda: ledger.latest_version(commits),
        lambda: ledger.latest_commit(commits).collect(),
        lambda: recovery.rebaseline(feed, commits, ["k"]),
        lambda: reading.changes_since(feed, commits, DAY).collect(),
        lambda: ledger.since_commit(feed, "_commit_timestamp", commits, 1).collect(),
    ):
        with pytest.raises(Exception, match="several sources"):
            call()
    assert ledger.latest_version(commits.limit(0)) == 0 and ledger.latest_commit(commits.limit(0)).isEmpty()


def test_all_unhealthy_sources_are_counted(spark):
    health = spark.createDataFrame([(f"s{i:02}", i, "HIGH_LAG", "HIGH_LAG", "run it") for i in range(30)], "source string, last_version bigint, status string, issues string, action string")
    with pytest.raises(recovery.UnhealthyError, match="HIGH_LAG: 30 sources, s00 first") as stopped:
        recovery.guarded_batch(health, lambda: health)
    assert stopped.value.unhealthy.count() == 30
    with pytest.raises(recovery.UnhealthyError, match="no source was checked"):
        recovery.guarded_batch(health.limit(0), lambda: health)
    fine = health.withColumn("status", F.lit("OK"))
    assert recovery.guarded_batch(fine, lambda: health) is health


def test_first_batch_of_a_source(spark):
    feed = feed_of(spark, (1, "a", "insert", 1), (2, "b", "insert", 2))
    shape = StructType([StructField("k", LongType()), StructField("v", StringType())])
    progress = spark.createDataFrame([("other", 9)], PROGRESS)
    start = state.empty_state(spark, feed, ["k"])
    whole = commits_of(spark, ("new", 1, "INSERT", True, True), ("new", 2, "INSERT", True, True))
    result = run_batch("new", feed, whole, start, progress, ["k"], shape)
    assert {tuple(r) for r in result.progress.collect()} == {("other", 9), ("new", 2)}
    assert result.state.count() == 2
    broken = commits_of(spark, ("new", 1, "INSERT", True, False), ("new", 2, "INSERT", False, False))
    with pytest.raises(recovery.UnhealthyError, match="FEED_DISABLED,VERSION_LOST: 1 sources, new first"):
        run_batch("new", feed, broken, start, progress, ["k"], shape)


def test_recovery_in_the_middle_of_a_commit(spark, job):
    path, rows = new_folder(spark, "feed"), feed_of(spark, (1, "a", "insert", 1), (2, "b", "insert", 2), (3, "c", "insert", 2))
    rows.where("k < 3").coalesce(1).write.parquet(path)
    consumers.append_available(reading.stream_changes(spark, path, rows.schema, 0), job, ["k"])
    rows.where("k = 3").coalesce(1).write.mode("append").parquet(path)
    again = consumers.recover_stream(spark, path, rows.schema, job, ["k"])
    assert sorted(r["k"] for r in sinks.read_feed_sink(spark, job.sink).collect()) == [1, 2, 3]
    assert tuple(consumers.sink_report(spark, job.sink).first()) == (3, 2)
    consumers.recover_stream(spark, path, rows.schema, again, ["k"])
    assert sorted(r["k"] for r in sinks.read_feed_sink(spark, job.sink).collect()) == [1, 2, 3]


def test_a_stream_goes_on_after_compaction(spark, job):
    path, rows = new_folder(spark, "feed"), feed_of(spark, (1, "a", "insert", 1), (2, "b", "insert", 2))
    rows.where("k = 1").write.parquet(path)
    consumers.stream_apply_scd1(reading.stream_changes(spark, path, rows.schema, 0), job, ["k"])
    base = new_folder(spark, "compact")
    small = sinks.Job(f"{base}/sink", f"{base}/checkpoints")
    consumers.compact_state(spark, job.sink, ["k"], small)
    later = new_folder(spark, "later")
    rows.where("k = 2").write.parquet(later)
    consumers.stream_apply_scd1(reading.stream_changes(spark, later, rows.schema, 0), small, ["k"])
    assert sorted(r["k"] for r in consumers.read_state(spark, small.sink, ["k"]).collect()) == [1, 2]


def test_a_column_that_comes_later_is_kept(spark, job):
    rows = feed_of(spark, (1, "a", "insert", 1))
    wide = feed_of(spark, (2, "b", "insert", 2)).withColumn("extra", F.lit("e"))
    for i, part in enumerate((rows, wide)):
        path = new_folder(spark, "feed")
        part.write.parquet(path)
        step = sinks.Job(job.sink, job.checkpoints, i + 1)
        consumers.stream_apply_scd1(reading.stream_changes(spark, path, part.schema, 0), step, ["k"])
    found = {r["k"]: r["extra"] for r in consumers.read_state(spark, job.sink, ["k"]).collect()}
    assert found == {1: None, 2: "e"}


def test_metrics_after_a_lost_checkpoint(spark, job):
    path, rows = new_folder(spark, "feed"), feed_of(spark, (1, "a", "insert", 1))
    rows.write.parquet(path)
    for step in (job, job.recovered()):
        consumers.stream_metrics(reading.stream_changes(spark, path, rows.schema, 0), step, ["v"], {})
    assert [tuple(r) for r in consumers.read_metrics(spark, job.sink, ["v"]).collect()] == [("a", 1)]


def test_an_always_on_consumer_starts_and_stops(spark, job):
    path, rows = new_folder(spark, "feed"), feed_of(spark, (1, "a", "insert", 1))
    rows.write.parquet(path)
    running = consumers.append_available(reading.stream_changes(spark, path, rows.schema, 0), job, ["k"], every="1 second")
    try:
        assert running.isActive
        running.processAllAvailable()
        assert sinks.read_feed_sink(spark, job.sink).count() == 1
    finally:
        running.stop()
    assert not running.isActive


def test_map_columns_are_paired_and_compared(spark):
    columns = FEED.replace("v string", "v map<string,int>")
    rows = [(1, {"a": 1, "b": 2}, "update_preimage", 2, DAY), (1, {"b": 2, "a": 1}, "update_postimage", 2, DAY), (2, {"a": 1}, "update_preimage", 2, DAY), (2, {"a": 3}, "update_postimage", 2, DAY)]
    feed = spark.createDataFrame(rows, columns)
    assert changes.pair_images(feed, ["k"]).count() == 2
    assert {(r["k"], tuple(r["changed"])) for r in changes.changed_columns(feed, ["k"]).collect()} == {(1, ()), (2, ("v",))}
    assert [r["k"] for r in changes.scd2_effect(feed, ["k"], ["v"]).collect()] == [2]


@pytest.mark.parametrize("places", [2, 4, 50, 1000])
def test_coarse_orders_of_a_hot_key(spark, places):
    rows = spark.range(60_000).select(F.lit(1).alias("k"), F.pmod("id", F.lit(places)).alias("at"))
    limit = 1_000
    spark.conf.set("changeflow.hotKeyRows", str(limit))
    try:
        order = KeyOrder(rows, ["k"], ["at"])
        cuts = [c["at"] for r in order.cuts.collect() for c in r["cuts"]]
        assert len(cuts) == len(set(cuts)) and (places > 4 or len(cuts) >= places - 1)
        spread = KeyOrder(rows.withColumn("tie", F.monotonically_increasing_id()), ["k"], ["at", "tie"])
        parted = spread.with_last_known(rows.withColumn("tie", F.monotonically_increasing_id()), F.col("at"), "x")
        sizes = [r["count"] for r in parted.groupBy("__part").count().collect()]
        assert max(sizes) <= 2 * limit and sum(sizes) == 60_000
    finally:
        spark.conf.unset("changeflow.hotKeyRows")


def test_as_of_with_facts_that_share_a_date(spark):
    dim = spark.createDataFrame([(1, "a", 1, 5, 1), (1, "b", 5, None, 2)], "k int, v string, __START_AT int, __END_AT int, __START_VERSION int")
    facts = spark.range(5_000).select(F.lit(1).alias("k"), F.col("id"), (F.pmod("id", F.lit(3)) * 3).cast("int").alias("at"))
    spark.conf.set("changeflow.hotKeyRows", "200")
    try:
        got = scd.as_of_dimension(facts, dim, ["k"], "at", ["v"]).groupBy("at", "dim_v").count().collect()
    finally:
        spark.conf.unset("changeflow.hotKeyRows")
    assert {tuple(r) for r in got} == {(0, None, 1667), (3, "a", 1667), (6, "b", 1666)}


def test_order_of_ordered_feed_and_composite_order(spark):
    feed = feed_of(spark, *[(i * 7 % 10, "x", "insert", i * 3 % 10) for i in range(10)])
    assert [r["_commit_version"] for r in reading.ordered_feed(feed).collect()] == list(range(10))
    assert [r["k"] for r in reading.ordered_feed(feed, "k").collect()] == list(range(10))
    pairs = spark.createDataFrame([(2, 1), (1, 9), (1, 2), (2, 0)], "a int, b int")
    assert [tuple(r) for r in scd.composite_order(pairs, ["a", "b"]).collect()] == [(1, 2), (1, 9), (2, 0), (2, 1)]


def test_policies_are_aimed(spark):
    people = security.tag_columns(spark.createDataFrame([("NSW", "1")], "state string, tfn string"), {"tfn": "pii"})
    policy = security.TagPolicy("p", "pii", "mask", "HR", scope="hr", applies_to=("guests",))
    for table, groups, expected in (("hr.people", ["guests"], "XXX"), ("hr.people", ["staff"], "1"), ("hrx.people", ["guests"], "1"), ("hr", ["guests"], "XXX")):
        assert security.apply_tag_policies(people, [policy], groups, table).first()["tfn"] == expected


def test_a_step_leaves_past_rows_alone(spark):
    columns = "k bigint, v string, start_date int, end_date int, is_current boolean"
    dim = spark.createDataFrame([(1, "a", 1, 2, False), (1, "b", 2, None, True), (2, "x", 1, 3, False)], columns)
    batch = spark.createDataFrame([(1, "c", "U", 5), (2, "y", "I", 6)], "k bigint, v string, op string, at int")
    spec = scd.Scd2(["k"], ["at"], ["v"], "op = 'D'")
    got = {tuple(r) for r in scd.scd2_step(dim, batch, spec).collect()}
    assert got == {(1, "a", 1, 2, False), (2, "x", 1, 3, False), (1, "b", 2, 5, False), (1, "c", 5, None, True), (2, "y", 6, None, True)}


def test_replay_finds_an_apply_that_depends_on_arrival(spark, monkeypatch):
    feed = feed_of(spark, *[(k, "a", kind, v) for k in range(8) for kind, v in (("insert", 1), ("delete", 2), ("insert", 2))])
    assert recovery.replay_check(feed, ["k"], [1]).isEmpty()
    right = recovery.apply_changes_scd1

    def state_wins_ties(held, batch, keys):
        newer = batch.join(held.select(*keys, F.col("last_commit_version").alias("seen")), keys, "left")
        return right(held, newer.where("seen IS NULL OR _commit_version > seen").drop("seen"), keys)

    monkeypatch.setattr(recovery, "apply_changes_scd1", state_wins_ties)
    assert not recovery.replay_check(feed, ["k"], [1]).isEmpty()
