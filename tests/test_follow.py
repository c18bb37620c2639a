"""Progress of consumers, profiles of sketches, and histories laid out for lookups."""

import pytest
from pyspark.sql import functions as F

from changeflow.operators import history, profile
from changeflow.sources import feed as reading
from changeflow.sources.samples import seed_feed
from changeflow.sources.storage import new_folder
from changeflow.streaming import consumers, progress, sinks


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def new_job(spark):
    base = new_folder(spark, "job")
    return sinks.Job(f"{base}/sink", f"{base}/checkpoints")


def consume(spark, path, schema, job, name, source="machines"):
    stream = reading.stream_changes(spark, path, schema, 0, 1)
    consumers.append_available(progress.watched(stream, name, source), job, ["machine_id"])


def test_progress_goes_on_after_a_restart_and_takes_two_folders_a_run(spark):
    feed, path, folder, job = seed_feed(spark), new_folder(spark, "feed"), new_folder(spark, "seen"), new_job(spark)
    for version in (1, 2, 3):
        land(feed.where(F.col("_commit_version") == version), path)
    with progress.keep_progress(spark, folder):
        consume(spark, path, feed.schema, job, "a/b: c", "x:y")
    first = progress.read_progress(spark, folder).first()
    assert (first["consumer"], first["source"], first["last_version"]) == ("a/b: c", "x:y", 3)
    assert first["total_rows"] == feed.where("_commit_version <= 3").count()
    assert len(progress.children(spark, folder)) == 2
    land(feed.where("_commit_version > 3"), path)
    with progress.keep_progress(spark, folder):
        consume(spark, path, feed.schema, job, "a/b: c", "x:y")
    after = progress.read_progress(spark, folder)
    assert [tuple(r) for r in after.select("last_version", "total_rows").collect()] == [(5, feed.count())]
    assert progress.source_progress(after).first()["last_version"] == 5


def test_a_failed_consumer_keeps_its_mark_and_its_error(spark):
    feed, path, folder, job = seed_feed(spark), new_folder(spark, "feed"), new_folder(spark, "seen"), new_job(spark)
    land(feed.where("_commit_version <= 2"), path)
    land(feed.where("_commit_version > 2"), path)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(job.folder(batch_id))
        if batch_id == 1:
            raise RuntimeError("the sink is full")

    with progress.keep_progress(spark, folder), pytest.raises(Exception, match="the sink is full"):
        stream = reading.stream_changes(spark, path, feed.schema, 0, 1)
        sinks.run(progress.watched(stream, "late", "machines"), job, write)
    held = progress.read_progress(spark, folder)
    row = held.first()
    assert row["last_version"] == 2 and row["batch_id"] == 0 and "the sink is full" in row["error"]
    commits = spark.createDataFrame(
        [("machines", v, "UPDATE", True, True) for v in range(1, 6)],
        "source string, version bigint, operation string, feed_enabled boolean, retained boolean",
    )
    expected = spark.createDataFrame(
        [("late", "machines"), ("new", "machines"), ("lost", "nowhere")], "consumer string, source string"
    )
    told = {r["consumer"]: r for r in progress.consumer_health(commits, expected, held).collect()}
    assert told["late"]["issues"] == "FAILED" and told["late"]["lag"] == 3
    assert told["new"]["status"] == "NEVER_STARTED" and told["new"]["lag"] == 5
    assert told["lost"]["issues"] == "NEVER_STARTED,FEED_DISABLED" and told["lost"]["lag"] is None
    later = F.current_timestamp() + F.expr("interval 2 hours")
    told = progress.consumer_health(commits, expected, held, now=later).where("consumer = 'late'").first()
    assert told["issues"] == "FAILED,STALLED"


def test_no_progress_yet(spark):
    assert progress.read_progress(spark, new_folder(spark, "none")).isEmpty()


@pytest.fixture(scope="module")
def wide(spark):
    return spark.range(1, 40_001).select(
        F.col("id").alias("_commit_version"),
        (F.col("id") * 7919 % 9973).alias("number"),
        F.when(F.col("id") > 20_000, F.concat(F.lit("n"), F.col("id") % 3000)).alias("note"),
        F.lit(None).cast("string").alias("nothing"),
    )


def test_profiles_add_up_within_their_errors(spark, wide):
    columns = ["number", "note", "nothing"]
    parts = [profile.column_profile(wide.where(c), columns, 1000) for c in ("_commit_version <= 15000", "_commit_version > 15000")]
    merged = profile.merge_profiles(parts[0].unionByName(parts[1]))
    told = {r["column"]: r for r in profile.profile_estimates(merged).collect()}
    assert {c: (r["rows"], r["non_null_rows"], r["first_version"]) for c, r in told.items()} == {
        "number": (40_000, 40_000, 1), "note": (40_000, 20_000, 20_001), "nothing": (40_000, 0, None),
    }
    for column, exact in (("number", 9973), ("note", 3000), ("nothing", 0)):
        assert abs(told[column]["distinct_estimate"] - exact) <= 3 * profile.DISTINCT_ERROR * exact
    assert told["note"]["quantiles"] is None and told["nothing"]["quantiles"] is None
    for rank, value in zip((0.05, 0.5, 0.95), told["number"]["quantiles"]):
        assert abs(value / 9973 - rank) < 3 * profile.RANK_ERROR


def test_shift_names_what_is_new(wide):
    before = profile.column_profile(wide.where("_commit_version <= 20000"), ["number", "note"], 5000)
    after = profile.column_profile(wide.where("_commit_version > 20000").withColumn("number", F.col("number") + 50_000), ["number", "note"], 5000)
    told = {r["column"]: r for r in profile.profile_shift(before, after).collect()}
    assert told["note"]["null_percent_before"] == 100 and told["note"]["null_percent_after"] == 0
    assert abs(told["note"]["new_values"] - 3000) < 200
    assert told["number"]["median_after"] - told["number"]["median_before"] > 45_000


def test_a_new_range_reads_its_own_rows_and_overlaps_are_refused(spark, wide):
    path = new_folder(spark, "profile")
    profile.store_profile(wide, path, 0, 9_999, ["number"], 1000)
    profile.store_profile(wide.where("_commit_version >= 10000"), path, 10_000, 40_000, ["number"], 1000)  # older rows are gone
    profile.store_profile(wide, path, 10_000, 40_000, ["number"], 1000)  # a retry
    merged = profile.merge_profiles(profile.read_profile(spark, path))
    assert merged.first()["rows"] == 40_000
    assert profile.merge_profiles(profile.read_profile(spark, path, 0, 9_999)).first()["rows"] == 9_999
    with pytest.raises(ValueError, match="overlap"):
        profile.store_profile(wide, path, 9_000, 10_000, ["number"], 1000)
    with pytest.raises(ValueError, match="empty"):
        profile.store_profile(wide, path, 5, 4, ["number"], 1000)
    with pytest.raises(ValueError, match="no profile"):
        profile.read_profile(spark, path, 50_000)


def test_profile_of_an_empty_table_has_no_rows(wide):
    assert profile.column_profile(wide.limit(0), ["number"], 10).isEmpty()


def rows_scanned(df):
    """Rows that come out of the scan, before the filter: those of the row groups that were read."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan parquet"):
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


@pytest.fixture
def fixed_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_one_entity_reads_few_row_groups(spark, fixed_plans):
    events = spark.range(200_000).select(
        F.concat(F.lit("e"), F.col("id") * 48271 % 65521 * 2).alias("entity"),
        F.col("id").alias("_commit_version"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 4 as int))").alias("_commit_timestamp"),
    )
    path, plain = new_folder(spark, "lookups"), new_folder(spark, "plain")
    history.write_for_lookups(events, path, ["entity"], distinct_per_group=20_000, row_group_bytes=64 << 10)
    history.write_partitioned_history(events, plain)
    one = history.entity_history(spark.read.parquet(path), entity="e4242")
    expected = history.entity_history(spark.read.parquet(plain), entity="e4242")
    assert sorted(one.collect()) == sorted(expected.select(one.columns).collect()) and one.count() == 3
    assert rows_scanned(one) < 40_000 < rows_scanned(expected)
    # Within the range of values but in no file: the Bloom filters leave nothing to read.
    assert rows_scanned(history.entity_history(spark.read.parquet(path), entity="e4243")) == 0


def test_a_hot_entity_is_cut_by_version(spark):
    events = spark.range(50_000).select(
        F.lit("hot").alias("entity"),
        F.col("id").alias("_commit_version"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("_commit_timestamp"),
    )
    path = new_folder(spark, "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        history.write_for_lookups(events, path, ["entity"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] > 1 and sizes[1] < 25_000
