"""Digests before rows, folds in tiers, metrics as state, partial changes, ranges in SQL."""

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, digest, history, recovery, scd, state
from changeflow.sources import feed as reading
from changeflow.sources.samples import seed_feed
from changeflow.sources.storage import children, new_folder
from changeflow.streaming import consumers, sinks, tiers

KEYS = ["machine_id"]


def levels():
    return [[F.to_date("_commit_timestamp")], ["_commit_version"]]


@pytest.fixture
def job(spark):
    base = new_folder(spark, "job")
    return sinks.Job(f"{base}/sink", f"{base}/checkpoints")


def wide_feed(spark, days=20, per_day=30):
    return spark.range(days * per_day).select(
        (F.col("id") % 7).alias("machine_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 11)).alias("site"),
        F.when(F.col("id") % 9 > 0, F.col("id") % 3).alias("weight"),
        F.lit("insert").alias("_change_type"),
        (F.col("id") + 1).alias("_commit_version"),
        F.timestamp_seconds(F.col("id") / per_day * 86400 + 1_700_000_000).alias("_commit_timestamp"),
    )


def test_digests_find_what_rows_find(spark):
    before = wide_feed(spark).union(wide_feed(spark).where("_commit_version = 77"))
    # One row lost, one changed, one that only swaps NULL between columns, one copy less.
    after = before.where("_commit_version <> 31").withColumn(
        "site", F.when(F.col("_commit_version") == 301, "other").otherwise(F.col("site"))
    )
    after = after.where("_commit_version <> 77").union(before.where("_commit_version = 77").limit(1))
    plain, levelled = changes.reconcile(before, after), changes.reconcile(before, after, levels())
    assert plain.count() == 4 and changes.reconcile(plain, levelled).isEmpty()
    assert history.append_only_audit(before, after, levels()).count() == 3
    groups = digest.differing_groups(before, after, ["_commit_version"])
    assert sorted(r[0] for r in groups.collect()) == [31, 77, 301]
    assert digest.group_digests(before, ["machine_id"]).agg(F.sum("rows")).first()[0] == before.count()


def test_null_groups_and_swapped_nulls_differ(spark):
    a = spark.createDataFrame([(None, "x", None), (1, "y", "z")], "k int, p string, q string")
    b = spark.createDataFrame([(None, None, "x"), (1, "y", "z")], "k int, p string, q string")
    assert [r.k for r in digest.differing_groups(a, b, ["k"]).toDF("k").collect()] == [None]
    assert changes.reconcile(a, b, [["k"]]).count() == 2


def test_no_rows_are_compared_where_digests_agree(spark):
    path = new_folder(spark, "history")
    wide_feed(spark).write.parquet(path)
    stored = spark.read.parquet(path)
    audit = history.append_only_audit(stored, stored.select("*"), levels())
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    assert audit.isEmpty() and "Relation" not in plan
    again = stored.withColumn("site", F.when(F.col("_commit_version") == 5, "x").otherwise(F.col("site")))
    found = history.append_only_audit(stored, again, levels())
    assert [r["_commit_version"] for r in found.collect()] == [5]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_tiers_keep_few_folders(spark, job):
    feed = wide_feed(spark, 5, 10)
    for n in range(50):
        rows = feed.where(F.col("_commit_version") == n + 1)
        tiers.fold_tiers(spark, job, n, lambda x: state.fold_states(x, KEYS), fanout=3)
        state.fold_feed(rows, KEYS).write.mode("overwrite").parquet(job.folder(n))
    live = tiers.live_folders(spark, job.sink)
    assert len(live) <= 2 * 4 + 3 and any("size=27" in f for f in live)
    assert len(children(spark, f"{job.sink}/run=1")) >= 50
    whole = state.fold_feed(feed, KEYS)
    assert changes.reconcile(consumers.read_state(spark, job.sink, KEYS).select(*whole.columns), whole).isEmpty()
    # Half a fold, without its mark, is as good as none.
    broken = new_folder(spark, "broken")
    half = sinks.Job(f"{broken}/sink", "")
    for n in range(3):
        state.fold_feed(feed.where(F.col("_commit_version") == n + 1), KEYS).write.parquet(half.folder(n))
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{half.sink}_folds/run=1/size=3/start=0")
    assert tiers.live_folders(spark, half.sink) == [half.folder(n) for n in range(3)]


def test_a_state_stream_folds_while_it_runs(spark, job):
    feed, path = wide_feed(spark, 2, 5), new_folder(spark, "feed")
    for v in range(1, 11):
        feed.where(F.col("_commit_version") == v).coalesce(1).write.mode("append").parquet(path)
    consumers.stream_apply_scd1(reading.stream_changes(spark, path, feed.schema, 0, 1), job, KEYS, fanout=2)
    live = tiers.live_folders(spark, job.sink)
    assert len(live) < 10 and any("size=8" in f for f in live)
    whole = state.fold_feed(feed, KEYS)
    assert changes.reconcile(consumers.read_state(spark, job.sink, KEYS).select(*whole.columns), whole).isEmpty()


def test_live_metrics_never_fall_back(spark, job):
    feed = seed_feed(spark).withColumn("amount", F.col("machine_id").cast("decimal(18,0)"))
    path, group, measures = new_folder(spark, "feed"), ["site"], {"total": "amount"}
    versions = feed.agg(F.max("_commit_version")).first()[0]
    for v in range(1, versions + 1):
        feed.where(F.col("_commit_version") == v).coalesce(1).write.mode("append").parquet(path)
    expected = {tuple(r) for r in changes.incremental_aggregate(feed, group, measures).collect()}

    def totals():
        return {tuple(r) for r in consumers.read_live_metrics(spark, job.sink, group).collect()}

    def stream(first):
        return reading.stream_changes(spark, path, feed.schema, first, 1)

    consumers.stream_live_metrics(stream(0), job, group, measures)
    assert totals() == expected
    kinds = {"total": feed.schema["amount"].dataType}
    assert consumers.metrics_drift(spark, job, group, kinds).isEmpty()
    # All folders of the sink are lost: the state gives them back.
    lost = sinks.Job(new_folder(spark, "lost"), job.checkpoints)
    consumers.repair_metrics(spark, lost, group, kinds)
    assert {tuple(r) for r in consumers.read_live_metrics(spark, lost.sink, group).collect()} == expected
    assert consumers.metrics_drift(spark, lost, group, kinds).isEmpty()
    again = job.recovered()
    # The recovered run has seen a part only: the earlier totals hold.
    part = new_folder(spark, "part")
    feed.where("_commit_version = 1").coalesce(1).write.parquet(part)
    consumers.stream_live_metrics(reading.stream_changes(spark, part, feed.schema, 0, 1), again, group, measures)
    assert totals() == expected
    consumers.stream_live_metrics(stream(0), again.recovered(), group, measures)
    assert totals() == expected


def test_partial_changes_fold_in_any_order(spark):
    feed = seed_feed(spark)
    deltas = changes.column_deltas(feed, KEYS)
    whole = changes.latest_by_key(feed, KEYS)
    live = whole.where("_change_type <> 'delete'").select("machine_id", "site", "remark")
    for cut in ("last_commit_version % 2", "hash(machine_id, last_commit_version) % 2"):
        first, rest = deltas.where(f"{cut} = 0"), deltas.where(f"{cut} <> 0")
        parts = [rest, first, first]
        folded = changes.fold_columns(changes.union_changes([changes.fold_columns(p, KEYS) for p in parts]), KEYS)
        found = folded.where("NOT is_deleted").select("machine_id", "site", "remark")
        assert changes.reconcile(found, live).isEmpty()
    assert deltas.where("site IS NULL AND column_versions.site IS NULL").count() > 0


def test_ranges_in_sql(spark):
    feed = seed_feed(spark)
    reading.register_changes_function(feed, "machine_changes")
    found = spark.sql("SELECT * FROM machine_changes(2, 3)")
    assert changes.reconcile(found, reading.changes_between(feed, 2, 3)).isEmpty()
    assert changes.reconcile(spark.sql("SELECT * FROM machine_changes(3)"), reading.changes_between(feed, 3)).isEmpty()
    with pytest.raises(ValueError):
        reading.register_changes_function(feed, "a; b")


def test_the_bounds_of_a_sql_range_reach_the_scan(spark):
    path = new_folder(spark, "feed")
    seed_feed(spark).write.parquet(path)
    reading.register_changes_function(spark.read.parquet(path), "stored_changes")
    plan = spark.sql("SELECT site FROM stored_changes(2, 3)")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]  # the text is cut after some hundred characters
    assert "OrEqual(_commit_version,2)" in pushed and "LessThanOrEqual(_commit_ver" in pushed


def test_sources_that_nobody_reads_are_reported(spark):
    commits = spark.createDataFrame(
        [(s, v, "WRITE", True, v > 1) for s in ("a", "b") for v in range(1, 5)],
        "source string, version bigint, operation string, feed_enabled boolean, retained boolean",
    ).withColumn("timestamp", F.current_timestamp())
    progress = spark.createDataFrame([("a", 4), ("c", 2)], "source string, last_version bigint")
    found = {r.source: (r.status, r.issues, r.lag) for r in recovery.feed_health(commits, progress).collect()}
    assert found == {
        "a": ("OK", "", 0), "b": ("VERSION_LOST", "VERSION_LOST,NEVER_READ", 4), "c": ("FEED_DISABLED", "FEED_DISABLED", None),
    }
    lag = {r.source: r.lag for r in recovery.processing_lag(commits, progress).collect()}
    assert lag == {"a": 0, "b": 4, "c": None}


def test_offsets_in_all_forms(spark):
    texts = ["2024-01-10", "2024-01-10 10:00", "2024-01-10T10:00:00Z", "10:00:00+10", "10:00:00.5+1000", "10:00 +10:00", "10:00:00 -0330", "10:00:00 Australia/Brisbane", "10:00:00[Etc/GMT+2]", None]
    found = scd.distinct_zone_offsets(spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()
    assert {r.utc_offset: r.rows for r in found} == {
        "": 2, "Z": 1, "+10:00": 3, "-03:30": 1, "Australia/Brisbane": 1, "Etc/GMT+2": 1, None: 1,
    }


def test_clock_shifts_are_found_to_the_version(spark):
    # Versions 1..1000, a minute each; the clock is 10 hours behind up to 333, right, then 90 minutes ahead from 701.
    at = F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000)
    off = F.when(F.col("id") <= 333, -600).when(F.col("id") < 700, 0).otherwise(90)
    late = F.when(F.col("id") % 7 == 0, 360).otherwise(F.col("id") % 13)
    time = F.timestamp_seconds((F.col("id") + off - late) * 60 + 1_700_000_000)
    events = spark.range(1, 1001).select(F.col("id").alias("version"), at.alias("committed"), time.alias("time"))
    found = scd.zone_shifts(events, "time", "version", "committed")
    assert sorted(map(tuple, found.collect())) == [(1, 333, 600), (334, 700, 0), (701, 1000, -90)]
    zones = scd.version_zones(found)
    assert [(z.first_version, z.last_version, z.zone) for z in zones] == [(1, 333, "-10:00"), (701, 1000, "+01:30")]
    assert scd.zone_shifts(events.limit(0), "time", "version", "committed").isEmpty()
