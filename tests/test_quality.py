import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from changeflow.contracts import check_feed
from changeflow.functions.compare import any_differs
from changeflow.operators import changes, quality
from changeflow.operators.scd import Scd2
from changeflow.sources import feed as reading
from changeflow.sources.samples import seed_cdc, seed_feed

EXPECTED = StructType(
    [StructField("added_later", IntegerType()), StructField("machine_id", LongType()), StructField("site", StringType())]
)


def test_safe_read_has_the_declared_shape(spark):
    got = quality.safe_cdf_read(seed_feed(spark), 2, EXPECTED)
    assert got.columns == ["added_later", "machine_id", "site", "_change_type", "_commit_version", "_commit_timestamp"]
    assert got.schema["added_later"].dataType == IntegerType()
    assert got.count() == 9


def test_expectations(spark):
    rows = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    report = Observation("drops")
    kept = quality.expect_or_drop(rows, "positive", F.col("x") > 0, report)
    assert [r["x"] for r in kept.collect()] == [1]
    assert report.get == {"positive_dropped": 2}
    seen = Observation("warnings")
    assert quality.expect(rows, "positive", F.col("x") > 0, seen).count() == 3
    assert seen.get == {"positive_violations": 2}
    with pytest.raises(Exception, match="expectation positive is violated"):
        quality.expect_or_fail(rows, "positive", F.col("x") > 0).collect()
    assert quality.expect_or_fail(rows.where("x = 1"), "positive", F.col("x") > 0).count() == 1


def test_not_null_split(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "k int, v string")
    good, bad = quality.enforce_not_null(rows, ["k", "v"])
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert sorted(tuple(r["null_columns"]) for r in bad.collect()) == [("k", "v"), ("v",)]


def test_schema_drift_covers_types_and_nested_fields(spark):
    reviewed = StructType.fromDDL("k bigint, site string, place struct<city: string, at: array<struct<x: int>>>")
    found = StructType.fromDDL("k int, place struct<city: string, at: array<struct<x: int, y: int>>>, extra map<string,int>")
    differences = quality.schema_drift(found, reviewed)
    assert [(d.path, d.expected, d.found) for d in differences] == [
        ("extra", None, "map<string,int>"), ("k", "bigint", "int"), ("place.at[].y", None, "int"), ("site", "string", None),
    ]
    with pytest.raises(ValueError, match=r"extra is map<string,int>, reviewed as nothing; k is int"):
        quality.refuse_drift(differences)
    quality.refuse_drift([d for d in differences if d.path == "site"])
    assert quality.schema_drift(seed_feed(spark).schema, seed_feed(spark).drop("_change_type").schema) == []


def test_not_null_sink_rejects_or_counts(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "k int, v string")
    with pytest.raises(Exception, match="expectation not_null is violated"):
        quality.reject_nulls(rows, ["k", "v"]).collect()
    report = Observation("nulls")
    assert quality.reject_nulls(rows, ["k", "v"], report).count() == 1
    assert report.get == {"not_null_dropped": 2}


def test_drift_impact_counts_spurious_versions(spark):
    raw = seed_cdc(spark).withColumn("txn", F.when(F.col("_commit_version") > 6, F.col("_commit_version")))
    spec = Scd2(["machine_id"], ["updated_at", "_commit_version"], ["site"], "operation = 'DELETE'")
    got = quality.drift_impact(raw, spec, ["txn"], "_commit_version").first().asDict()
    assert got == {"suspect": "txn", "non_null_rows": 7, "distinct_values": 7, "first_version": 7, "spurious_versions": 1}


def test_null_safe_difference(spark):
    rows = spark.createDataFrame([(None, None), (None, 1), (1, 1), (1, 2)], "a int, b int")
    got = rows.select(any_differs([(F.col("a"), F.col("b"))])).collect()
    assert [r[0] for r in got] == [False, True, False, True]


def test_version_and_time_ranges(spark):
    feed = seed_feed(spark)
    assert reading.read_changes(feed, start_version=2, end_version=3).count() == 4
    assert reading.read_changes(feed, start_version=9).isEmpty()
    commits = feed.select(F.col("_commit_version").alias("version"), F.col("_commit_timestamp").alias("timestamp")).distinct()
    noon = F.lit("2025-05-14 12:00:00").cast("timestamp")
    # Version 2 is from the 14th at six, so the next commit is version 3.
    assert {r[0] for r in reading.changes_since(feed, commits, noon).select("_commit_version").collect()} == {3, 4, 5}
    last = reading.changes_since(feed, commits, noon, F.lit("2025-05-16 05:00:00").cast("timestamp"))
    assert {r[0] for r in last.select("_commit_version").collect()} == {3}
    assert reading.changes_since(feed, commits, F.lit("2027-01-01").cast("timestamp")).isEmpty()
    from datetime import datetime

    with pytest.raises(ValueError, match="not both"):
        reading.read_changes(feed, commits, start_version=1, start_time=datetime(2026, 1, 1))
    with pytest.raises(ValueError, match="not neither"):
        reading.read_changes(feed)
    assert reading.read_changes(feed, commits, start_time=datetime(2025, 5, 16)).count() == 5


def test_changes_view(spark):
    reading.register_changes_view(seed_feed(spark), "customer_changes")
    assert spark.sql("SELECT * FROM customer_changes WHERE _commit_version >= 3").count() == 7
    with pytest.raises(ValueError, match="lacks"):
        check_feed(spark.range(1))


def test_projection_helpers(spark):
    feed = seed_feed(spark)
    assert changes.project_sink(feed, ["machine_id"]).columns == ["machine_id", "_change_type", "_commit_version", "_commit_timestamp"]
    assert "remark" not in changes.except_columns(feed, ["remark"]).columns
    assert "captured_at" in changes.with_capture_time(feed).columns
    assert changes.high_water_mark(feed).first()[0] == 5
    assert changes.high_water_mark(feed.where("1 = 0")).first()[0] == 0


def test_version_filter_reaches_the_scan(spark):
    from changeflow.sources.storage import new_folder

    path = new_folder(spark, "pushdown")
    seed_feed(spark).write.parquet(path)
    stored = reading.changes_between(spark.read.parquet(path), 2, 3).select("machine_id")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_commit_version), GreaterThanOrEqual(_commit_version,2), LessThan" in plan
    assert "ReadSchema: struct<machine_id:bigint,_commit_version:bigint>" in plan
