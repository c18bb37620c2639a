import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, scd, state
from changeflow.sources import feed as reading
from changeflow.sources.samples import seed_cdc, seed_feed
from changeflow.sources.storage import new_folder
from changeflow.streaming import consumers, dimension, sinks

KEYS = ["machine_id"]
SPEC = scd.Scd2(KEYS, ["updated_at", "_commit_version"], ["site"], "operation = 'DELETE'")


@pytest.fixture
def job(spark):
    base = new_folder(spark, "job")
    return sinks.Job(f"{base}/sink", f"{base}/checkpoints")


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def equal(a, b):
    return changes.reconcile(a.select(*b.columns), b).isEmpty()


def test_start_is_explicit_and_not_negative(spark):
    feed = seed_feed(spark)
    with pytest.raises(ValueError):
        reading.stream_changes(spark, "/tmp/none", feed.schema, -1)
    with pytest.raises(ValueError, match="lacks"):
        reading.stream_changes(spark, "/tmp/none", feed.select("site").schema, 1)


def test_second_run_adds_nothing_and_new_files_do(spark, job):
    feed, path = seed_feed(spark), new_folder(spark, "feed")
    land(feed.where("_commit_version <= 2"), path)

    def run():
        stream = reading.stream_changes(spark, path, feed.schema, 1)
        return tuple(consumers.run_feed_stream(stream, job, ["machine_id"]).first())

    assert run() == (3, 2)
    assert run() == (3, 2)
    land(feed.where("_commit_version > 2"), path)
    assert run() == (10, 5)


def test_lost_checkpoint_gives_no_duplicates(spark, job):
    feed, path = seed_feed(spark), new_folder(spark, "feed")
    land(feed.where("_commit_version <= 2"), path)
    stream = reading.stream_changes(spark, path, feed.schema, 1)
    consumers.append_available(stream, job, ["machine_id", "site"])
    land(feed.where("_commit_version > 2"), path)
    after = consumers.recover_stream(spark, path, feed.schema, job, ["machine_id", "site"])
    assert after.checkpoint.endswith("stream_v2_recovery")
    assert equal(sinks.read_feed_sink(spark, job.sink), changes.project_sink(feed, ["machine_id", "site"]))


def test_a_repeated_batch_is_written_once(spark, job):
    rows = seed_feed(spark)
    for _ in range(2):
        rows.write.mode("overwrite").parquet(job.folder(0))
    assert sinks.read_batches(spark, job.sink).count() == 10


def test_checkpoint_names():
    assert sinks.checkpoint_path("c", 1) == "c/stream_v1"
    assert sinks.Job("s", "c").recovered().checkpoint == "c/stream_v2_recovery"


def test_history_stream_widens(spark, job):
    feed, path = seed_feed(spark), new_folder(spark, "feed")
    land(feed.where("_commit_version <= 2"), path)
    at = F.lit(datetime(2026, 3, 1))
    rule = ("version", F.col("_commit_version").isNotNull())
    consumers.stream_history(reading.stream_changes(spark, path, feed.schema, 0), job, rule, at)
    wide = feed.withColumn("warranty", F.lit("gold"))
    land(wide.where("_commit_version > 2"), path)
    consumers.stream_history(reading.stream_changes(spark, path, wide.schema, 0), job, rule, at)
    kept = sinks.read_batches(spark, job.sink)
    assert kept.count() == 10 and kept.where("warranty IS NULL").count() == 3
    assert {"captured_at", "commit_date", "warranty"} <= set(kept.columns)


def test_history_stream_drops_what_breaks_the_rule(spark, job):
    feed, path = seed_feed(spark), new_folder(spark, "feed")
    land(feed, path)
    rule = ("no_notes", F.col("remark") == "new")
    consumers.stream_history(reading.stream_changes(spark, path, feed.schema, 0), job, rule)
    assert sinks.read_batches(spark, job.sink).count() == 7


@pytest.mark.parametrize("seed", range(2))
def test_scd1_stream_in_any_order_equals_the_batch(spark, job, seed):
    feed, path = seed_feed(spark), new_folder(spark, "feed")
    versions = [1, 2, 3, 4, 5]
    random.Random(seed).shuffle(versions)
    for v in versions:
        land(feed.where(F.col("_commit_version") == v), path)
        consumers.stream_apply_scd1(reading.stream_changes(spark, path, feed.schema, 0), job, KEYS)
    whole = state.fold_feed(feed, KEYS)
    assert equal(consumers.read_state(spark, job.sink, KEYS), whole)
    # A new checkpoint delivers everything again.
    again = job.recovered()
    consumers.stream_apply_scd1(reading.stream_changes(spark, path, feed.schema, 0), again, KEYS)
    assert equal(consumers.read_state(spark, job.sink, KEYS), whole)
    assert equal(consumers.read_live(spark, job.sink, KEYS), state.current_snapshot(whole))
    small = sinks.Job(new_folder(spark, "compact"), job.checkpoints)
    consumers.compact_state(spark, job.sink, KEYS, small)
    assert equal(consumers.read_state(spark, small.sink, KEYS), whole)


@pytest.mark.parametrize("seed", range(2))
def test_scd2_stream_in_any_order_equals_the_batch(spark, job, seed):
    raw, path = seed_cdc(spark), new_folder(spark, "raw")
    versions = list(range(1, 14))
    random.Random(seed).shuffle(versions)
    for part in (versions[:3], versions[3:7], versions[7:]):
        land(raw.where(F.col("_commit_version").isin(*part)), path)
        dimension.stream_apply_scd2(reading.stream_table(spark, path, raw.schema), job, SPEC)
    assert equal(dimension.read_dim2(spark, job.sink, raw.schema, SPEC), scd.apply_changes_scd2(raw, SPEC))
    again = job.recovered()
    dimension.stream_apply_scd2(reading.stream_table(spark, path, raw.schema), again, SPEC)
    assert equal(dimension.read_dim2(spark, job.sink, raw.schema, SPEC), scd.apply_changes_scd2(raw, SPEC))


def test_metrics_stream_equals_the_live_table(spark, job):
    feed = seed_feed(spark).withColumn("amount", F.col("machine_id").cast("decimal(18,0)"))
    path = new_folder(spark, "feed")
    for v in range(1, 6):
        land(feed.where(F.col("_commit_version") == v), path)
    consumers.stream_metrics(reading.stream_changes(spark, path, feed.schema, 0, 1), job, ["site"], {"total": "amount"})
    got = consumers.read_metrics(spark, job.sink, ["site"]).collect()
    assert [(r["site"], r["rows"], int(r["total"])) for r in sorted(got)] == [("Bonn", 1, 42), ("Oslo", 1, 41)]


def test_fan_out_fills_both_sinks(spark, job):
    feed, path = seed_feed(spark), new_folder(spark, "feed")
    land(feed, path)
    base = new_folder(spark, "deletes")
    deletes = sinks.Job(f"{base}/sink", f"{base}/checkpoints")
    consumers.fan_out(reading.stream_changes(spark, path, feed.schema, 0), job, deletes, KEYS)
    assert sinks.read_batches(spark, job.sink).count() == 10
    gone = sinks.read_batches(spark, deletes.sink).collect()
    assert [(r["machine_id"], r["_commit_version"], r["is_deleted"]) for r in sorted(gone)] == [(42, 3, True), (43, 5, True)]


def test_rows_by_file_time(spark):
    import time

    path = new_folder(spark, "files")
    land(spark.range(3), path)
    since = spark.read.parquet(path).agg(F.max("_metadata.file_modification_time")).first()[0]
    time.sleep(1.1)
    land(spark.range(3, 5), path)
    assert sorted(r["id"] for r in reading.rows_by_file_time(spark.read.parquet(path), since).collect()) == [3, 4]


def test_fifty_batches_of_a_dimension_leave_one_folder_each(spark, job):
    raw, path = seed_cdc(spark), new_folder(spark, "raw")
    many = raw.crossJoin(spark.range(4)).select(
        (F.col("machine_id") * 10 + F.col("id")).alias("machine_id"), *[c for c in raw.columns if c not in ("machine_id", "_commit_version")],
        (F.col("_commit_version") * 4 + F.col("id")).alias("_commit_version"),
    )
    versions = [r[0] for r in many.select("_commit_version").collect()]
    random.Random(7).shuffle(versions)
    for n in range(0, len(versions), 13):
        for v in versions[n : n + 13]:
            land(many.where(F.col("_commit_version") == v), path)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        try:
            dimension.stream_apply_scd2(reading.stream_table(spark, path, raw.schema, files_per_batch=1), job, SPEC)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert equal(dimension.read_dim2(spark, job.sink, raw.schema, SPEC), scd.apply_changes_scd2(many, SPEC))
    rows = sinks.read_batches(spark, job.sink, keep=["batch_id"])
    assert rows.select("batch_id").distinct().count() == len(versions) == 52
    # A batch writes its one event, and another row only for the event after it: never the events before.
    assert rows.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 2


def test_a_null_place_stops_the_dimension(spark, job):
    raw, path = seed_cdc(spark), new_folder(spark, "raw")
    schema = raw.withColumn("updated_at", F.col("updated_at").cast("timestamp")).schema
    bad = raw.withColumn("updated_at", F.when(F.col("_commit_version") != 3, F.col("updated_at")))
    land(bad, path)
    for field in schema:
        field.nullable = True
    with pytest.raises(Exception, match="NULL"):
        dimension.stream_apply_scd2(reading.stream_table(spark, path, schema), job, SPEC)
    odd = scd.Scd2(KEYS, ["score"], ["site"], "false")
    with pytest.raises(ValueError, match="whole number"):
        dimension.stream_apply_scd2(reading.stream_table(spark, path, schema).withColumn("score", F.lit(1.5)), job, odd)
