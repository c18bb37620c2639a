"""Every operator on the test tables, one query each.

Each query is (spark, sf_dir) -> DataFrame over whole tables.  Versions are taken
at percentages of the version range, so the work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from changeflow.contracts import DELETE, INSERT, POSTIMAGE, PREIMAGE
from changeflow.functions import session_rules
from changeflow.functions.compare import null_semantics_diff as differs
from changeflow.operators import changes, history, profile, quality, recovery, scd, security, state
from changeflow.plans.batch import run_batch
from changeflow.sources import commits as ledger
from changeflow.sources import derived, feed as reading
from changeflow.sources.storage import new_folder
from changeflow.streaming import consumers, dimension
from changeflow.streaming import progress as following
from changeflow.streaming.sinks import Job, read_batches, read_feed_sink, run

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["user_id"]
VALUES = ["segment", "score", "note"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def raw_spec(*track: str) -> scd.Scd2:
    return scd.Scd2(
        keys=KEYS,
        sequence=["updated_at", "_commit_version"],
        track=list(track) or ["segment", "tier"],
        deletes="operation = 'DELETE'",
    )


def at(spark: SparkSession, sf_dir: str, percent: int) -> int:
    return derived.version_at(spark, sf_dir, percent)


def feed_files(spark: SparkSession) -> int:
    """Files of a stored feed: as many as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def part_of_files(spark: SparkSession, batches: int) -> int:
    """Files per micro-batch, so that a stored feed comes in about so many batches."""
    return -(-feed_files(spark) // batches)


def stored_feed(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write a table as a folder of files in version order, as a feed lands."""
    path = new_folder(spark, name)
    df.repartitionByRange(feed_files(spark), "_commit_version").write.parquet(path)
    return path


def new_job(spark: SparkSession, name: str) -> Job:
    base = new_folder(spark, name)
    return Job(f"{base}/sink", f"{base}/checkpoints")


# --- sources and scans -------------------------------------------------------


@query
def changes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    return reading.changes_between(feed, at(spark, sf_dir, 20), at(spark, sf_dir, 60))


@query
def changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.changes_since(
        derived.user_feed(spark, sf_dir),
        derived.commits(spark, sf_dir),
        ntz("2024-01-10 00:00:00"),
        ntz("2024-01-20 12:00:00"),
    )


@query
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "stream-changes")
    stream = reading.stream_changes(spark, path, feed.schema, at(spark, sf_dir, 20))
    consumers.append_available(stream, job, ["user_id", *VALUES])
    return read_batches(spark, job.sink)


@query
def current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.current_snapshot(state.fold_feed(derived.user_feed(spark, sf_dir), KEYS))


@query
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.snapshot_as_of(derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50), KEYS)


@query
def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = derived.commits(spark, sf_dir)
    return ledger.commit_history(commits, at(spark, sf_dir, 40) - 1, at(spark, sf_dir, 45))


@query
def feed_enabled_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.feed_enabled_ranges(derived.commits(spark, sf_dir))


@query
def rows_by_file_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, half = derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50)
    path = new_folder(spark, "feed-files")
    reading.changes_between(feed, 0, half).write.parquet(path)
    since = spark.read.parquet(path).agg(F.max("_metadata.file_modification_time")).first()[0]
    reading.changes_between(feed, half + 1).write.mode("append").parquet(path)
    return reading.rows_by_file_time(spark.read.parquet(path), since)


@query
def stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_cdc(spark, sf_dir)
    path, job = stored_feed(spark, raw, "raw"), new_job(spark, "stream-table")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(job.folder(batch_id))

    run(reading.stream_table(spark, path, raw.schema), job, write)
    return read_batches(spark, job.sink)


@query
def policy_audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return security.policy_audit_trail(derived.audit_log(spark, sf_dir), "catalog", ["error", "signup"])


# --- sinks and writes --------------------------------------------------------


@query
def publish_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.publish_snapshot(current_snapshot(spark, sf_dir), new_folder(spark, "snapshot"))


@query
def run_feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    stream = reading.stream_changes(
        spark, stored_feed(spark, feed, "feed"), feed.schema, 1, part_of_files(spark, 2)
    )
    return consumers.run_feed_stream(stream, new_job(spark, "feed-stream"), ["user_id", "segment"])


@query
def capture_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_rows(derived.user_feed(spark, sf_dir), ntz("2024-02-01 00:00:00"))


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "history")
    history.write_partitioned_history(capture_history(spark, sf_dir), path, KEYS)
    return spark.read.parquet(path)


@query
def write_partitioned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_history(spark, sf_dir)


@query
def widen_and_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, half = derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50)
    old = reading.changes_between(feed, 0, half).drop("note")
    return history.widen_and_append(old, reading.changes_between(feed, half + 1))


def customer_dml(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = derived.table(spark, sf_dir, "customer")
    added = derived.table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("NEW").alias("c_mktsegment"),
    )
    return state.apply_dml(
        customer,
        state.Dml(
            version=2,
            timestamp=ntz("2024-02-01 00:00:00"),
            inserts=added,
            update_where=F.col("c_mktsegment") == "BUILDING",
            update_set={"c_acctbal": F.col("c_acctbal") + 100, "c_mktsegment": F.lit("HOUSING")},
            delete_where=F.col("c_acctbal") < 0,
        ),
    )


@query
def apply_dml_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_dml(spark, sf_dir)[0]


@query
def apply_dml_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_dml(spark, sf_dir)[1]


@query
def apply_scd1_split_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every commit comes in two batches, its delete last or first, and once more as a whole."""
    feed = read_stored_feed(spark, sf_dir)
    reborn = feed.where(F.col("_change_type") == DELETE).withColumn("_change_type", F.lit(INSERT))
    both = feed.unionByName(reborn.where(F.pmod("_commit_version", F.lit(2)) == 0))
    deletes, others = both.where(F.col("_change_type") == DELETE), both.where(F.col("_change_type") != DELETE)
    held = state.empty_state(spark, feed, KEYS)
    for part in (others, deletes, both):
        held = state.apply_changes_scd1(held, part, KEYS)
    return state.current_snapshot(held)


@query
def enforce_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = state.fold_feed(derived.user_feed(spark, sf_dir), KEYS)
    good, bad = quality.enforce_not_null(folded, ["segment", "score"])
    columns = ["user_id", "last_commit_version"]
    return good.select(*columns, F.lit("").alias("null_columns")).unionByName(
        bad.select(*columns, F.concat_ws(",", "null_columns").alias("null_columns"))
    )


@query
def append_only_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    tampered = feed.where(F.col("_change_type") != DELETE).withColumn(
        "note", F.when(F.col("segment") == "purchase", "changed").otherwise(F.col("note"))
    )
    return history.append_only_audit(feed, tampered, [[F.to_date("_commit_timestamp")], ["_commit_version"]])


@query
def retention_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.retention_profile(derived.user_feed(spark, sf_dir))


# --- projections, filters, predicates ----------------------------------------

EXPECTED = StructType(
    [
        StructField("user_id", LongType()),
        StructField("segment", StringType()),
        StructField("added_later", IntegerType()),
        StructField("score", DoubleType()),
    ]
)


@query
def safe_cdf_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.safe_cdf_read(derived.user_feed(spark, sf_dir), at(spark, sf_dir, 30), EXPECTED)


@query
def filter_change_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.filter_change_type(derived.user_feed(spark, sf_dir), [PREIMAGE, POSTIMAGE])


@query
def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_or_drop(derived.user_feed(spark, sf_dir), "large", F.col("score") >= 10)


@query
def changed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = changes.changed_columns(derived.user_feed(spark, sf_dir), KEYS)
    return changed.withColumn("changed", F.concat_ws(",", "changed"))


@query
def partial_replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that carry changed columns only, folded in three parts that cut across keys and versions, one twice."""
    path = new_folder(spark, "deltas")
    changes.column_deltas(derived.user_feed(spark, sf_dir), KEYS).write.parquet(path)
    # Stored, as every fold reads them: else one task sorts the feed of its keys once for each part and kind of change.
    deltas = spark.read.parquet(path)
    part = F.pmod(F.xxhash64("user_id", "last_commit_version"), F.lit(3))
    folds = [changes.fold_columns(deltas.where(part == k), KEYS) for k in (2, 0, 1, 0)]
    folded = changes.fold_columns(changes.union_changes(folds), KEYS)
    return folded.where("NOT is_deleted").select("user_id", *VALUES, "last_commit_version")


@query
def changes_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version range in SQL, through a table function."""
    reading.register_changes_function(derived.user_feed(spark, sf_dir), "user_changes")
    first, last = at(spark, sf_dir, 20), at(spark, sf_dir, 60)
    return spark.sql(f"SELECT * FROM user_changes({first}, {last})")


@query
def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.tombstones(derived.user_feed(spark, sf_dir), KEYS)


@query
def drift_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_cdc(spark, sf_dir, note_from=at(spark, sf_dir, 50))
    return quality.drift_impact(raw, raw_spec("segment"), ["tier", "note"], "_commit_version")


PROFILED = ["segment", "tier", "note"]


def stored_profile(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Raw events, and their profile in two ranges of versions, the second stored after the first."""
    half, top = at(spark, sf_dir, 50), at(spark, sf_dir, 100)
    raw = derived.raw_cdc(spark, sf_dir, note_from=half)
    path = new_folder(spark, "profile")
    for first, last in ((0, half - 1), (half, top)):
        profile.store_profile(raw, path, first, last, PROFILED, block=max(1, top // 16))
    return raw, path


@query
def drift_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged sketches of all ranges beside the exact figures: whether the estimates keep their errors."""
    raw, path = stored_profile(spark, sf_dir)
    merged = profile.merge_profiles(profile.read_profile(spark, path))
    told = profile.profile_estimates(merged, [0.5]).withColumn("median", F.get("quantiles", F.lit(0)))
    exact = raw.agg(*[F.countDistinct(c).alias(c) for c in PROFILED])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in PROFILED])))
    median = told.where("column = 'tier'").select("median").scalar()
    ranks = raw.agg(*[F.avg((x).cast("double")) for x in (F.col("tier") < median, F.col("tier") <= median)]).toDF("below", "upto")
    slack = 3 * profile.RANK_ERROR
    near = ranks.select((F.col("below") <= 0.5 + slack) & (F.col("upto") >= 0.5 - slack)).scalar()
    off = F.abs(F.col("distinct_estimate") - F.col("distinct"))
    return told.join(exact, "column").select(
        "column", "rows", "non_null_rows", "first_version",
        (off <= F.lit(3 * profile.DISTINCT_ERROR) * F.col("distinct") + 0.5).alias("distinct_near"),
        F.when(F.col("quantiles").isNotNull(), near).alias("median_near"),
    )


@query
def profile_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second half of the versions brought, from the two stored profiles alone."""
    _, path = stored_profile(spark, sf_dir)
    half = at(spark, sf_dir, 50)
    before, after = profile.read_profile(spark, path, 0, half - 1), profile.read_profile(spark, path, half)
    moved = profile.profile_shift(before, after)
    return moved.select(
        "column", "non_null_before", "non_null_after",
        (F.col("distinct_before") == 0).alias("was_empty"), (F.col("new_values") > 0).alias("has_new_values"),
    )


@query
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = spark.createDataFrame(
        [("users", at(spark, sf_dir, 70)), ("other", 1)], "source string, last_version bigint"
    )
    return reading.incremental_slice(derived.user_feed(spark, sf_dir), progress, "users")


@query
def history_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_history(spark, sf_dir)
    return history.history_audit(stored, date(2024, 1, 10), date(2024, 1, 20), user_id=7)


@query
def entity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of one user, from a history laid out for lookups."""
    path = new_folder(spark, "lookups")
    history.write_for_lookups(capture_history(spark, sf_dir), path, KEYS)
    return history.entity_history(spark.read.parquet(path), user_id=7)


@query
def null_semantics_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = snapshot_as_of(spark, sf_dir).alias("a")
    now = current_snapshot(spark, sf_dir).alias("b")
    joined = half.join(now, F.col("a.user_id") == F.col("b.user_id"), "full_outer")
    return joined.where(differs("a", "b", ["segment", "score"])).select(
        F.coalesce("a.user_id", "b.user_id").alias("user_id"),
        F.col("a.segment").alias("old_segment"),
        F.col("b.segment").alias("new_segment"),
    )


# --- joins -------------------------------------------------------------------


@query
def pair_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.pair_images(derived.user_feed(spark, sf_dir), KEYS)


@query
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.snapshot_diff(
        snapshot_as_of(spark, sf_dir), current_snapshot(spark, sf_dir), KEYS, VALUES
    )


def latest_raw(raw: DataFrame) -> DataFrame:
    """One raw event per user: the last by business time and version."""
    rest = [c for c in raw.columns if c not in KEYS]
    last = F.max_by(F.struct(*rest), F.struct("updated_at", "_commit_version"))
    return raw.groupBy(*KEYS).agg(last.alias("row")).select(*KEYS, "row.*")


def manual_dimension(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The dimension of the first half of the raw events, and the events of the second."""
    raw, half = derived.raw_cdc(spark, sf_dir), at(spark, sf_dir, 50)
    live = latest_raw(raw.where(F.col("_commit_version") <= half)).where("operation <> 'DELETE'")
    dim = live.select(
        "user_id",
        "segment",
        "tier",
        F.col("updated_at").alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    return dim, raw.where(F.col("_commit_version") > half)


def matched(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    dim, later = manual_dimension(spark, sf_dir)
    incoming = later.where("operation <> 'DELETE'")
    return scd.match_current(incoming, dim, KEYS, ["segment", "tier"], how)


@query
def match_current_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir, "inner")


@query
def match_current_new_or_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(spark, sf_dir, "left")


@query
def merge_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = reading.changes_between(derived.user_feed(spark, sf_dir), at(spark, sf_dir, 45))
    return state.merge_state(
        snapshot_as_of(spark, sf_dir), later, KEYS, state.guarded_merge(KEYS, VALUES)
    )


@query
def anti_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order of 1995: most of them have some of other years."""
    orders = derived.table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1995)
    seen = orders.select(F.col("o_custkey").alias("c_custkey"))
    return scd.anti_new_keys(derived.table(spark, sf_dir, "customer"), seen, ["c_custkey"])


@query
def anti_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = derived.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return scd.anti_new_keys(derived.table(spark, sf_dir, "customer"), seen, ["c_custkey"])


@query
def member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    readers = derived.principals(spark, sf_dir)
    return security.member_rows(
        derived.people(spark, sf_dir), "state", readers, "Supplier#000000001"
    )


@query
def as_of_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = derived.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    dim = apply_changes_scd2(spark, sf_dir)
    return scd.as_of_dimension(facts, dim, KEYS, "ts", ["segment", "tier"])


@query
def since_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.since_commit(
        derived.user_feed(spark, sf_dir),
        "_commit_timestamp",
        derived.commits(spark, sf_dir),
        at(spark, sf_dir, 60),
    )


@query
def affected_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_cdc(spark, sf_dir)
    batch = raw.where(F.col("_commit_version") > at(spark, sf_dir, 99))
    return scd.affected_keys(raw, batch, KEYS)


# --- aggregations ------------------------------------------------------------


@query
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.high_water_mark(derived.user_feed(spark, sf_dir), ["_change_type"])


@query
def duplicate_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, later = manual_dimension(spark, sf_dir)
    stepped = scd.scd2_step(dim, later.where(F.col("operation") != "DELETE"), raw_spec())
    return scd.duplicate_current(stepped, KEYS, F.col("is_current"))


@query
def duplicate_open_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = apply_changes_scd2(spark, sf_dir)
    return scd.duplicate_current(dim, KEYS, F.col("__END_AT").isNull())


@query
def change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.change_summary(derived.user_feed(spark, sf_dir), ["segment"])


@query
def distinct_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.distinct_versions(derived.user_feed(spark, sf_dir))


@query
def version_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.version_span(derived.user_feed(spark, sf_dir))


@query
def processing_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = derived.source_commits(spark, sf_dir)
    return recovery.processing_lag(commits, derived.source_progress(commits))


def decimal_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    return feed.withColumn("score", F.col("score").cast("decimal(18,2)"))


@query
def incremental_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = changes.incremental_aggregate(
        decimal_feed(spark, sf_dir), ["segment"], {"score_sum": "score"}
    )
    return metrics.withColumn("score_sum", F.col("score_sum").cast("double"))


@query
def distinct_zone_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, early = derived.raw_cdc(spark, sf_dir), at(spark, sf_dir, 30)
    version = F.col("_commit_version")
    short = F.when(version % 3 == 0, "+10").when(version % 3 == 1, "+1000").otherwise("+10:00")
    offset = F.when(version < early, short).otherwise("+00:00")
    text = raw.withColumn("ts_text", F.concat(F.col("updated_at").cast("string"), offset))
    return scd.distinct_zone_offsets(text, "ts_text")


@query
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.latest_by_key(derived.user_feed(spark, sf_dir), KEYS)


# --- windows, sorts, sets ----------------------------------------------------


@query
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.dedupe_latest(derived.user_feed(spark, sf_dir), KEYS)


@query
def close_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.close_intervals(
        derived.raw_cdc(spark, sf_dir), KEYS, ["updated_at", "_commit_version"]
    )


@query
def sequence_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.sequence_ties(derived.raw_cdc(spark, sf_dir), KEYS, ["updated_at"])


@query
def sequence_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_cdc(spark, sf_dir)
    return scd.sequence_regressions(raw, KEYS, "updated_at", "_commit_version")


@query
def composite_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.composite_order(derived.raw_cdc(spark, sf_dir), ["updated_at", "_commit_version"])


@query
def suppress_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scd.suppress_unchanged(derived.raw_cdc(spark, sf_dir), raw_spec())
    return kept.drop("gone")


@query
def ordered_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.ordered_feed(derived.user_feed(spark, sf_dir), "user_id")


@query
def latest_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest_commit(derived.commits(spark, sf_dir))


@query
def union_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    return changes.union_changes(
        [changes.filter_change_type(feed, [INSERT, DELETE]), changes.filter_change_type(feed, [POSTIMAGE])]
    )


@query
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.user_feed(spark, sf_dir).select("user_id", "segment", "_change_type").distinct()


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(1024))
    return changes.reconcile(snapshot_as_of(spark, sf_dir), current_snapshot(spark, sf_dir), [[bucket]])


# --- apply, history and recovery ---------------------------------------------


@query
def apply_changes_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    held = state.fold_feed(reading.changes_between(feed, 0, at(spark, sf_dir, 50)), KEYS)
    replayed = reading.changes_between(feed, at(spark, sf_dir, 40))
    return state.apply_changes_scd1(held, replayed, KEYS)


@query
def apply_changes_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.apply_changes_scd2(derived.raw_cdc(spark, sf_dir), raw_spec())


@query
def scd2_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, later = manual_dimension(spark, sf_dir)
    return scd.scd2_step(dim, latest_raw(later), raw_spec())


@query
def scd2_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scd2_effect(derived.user_feed(spark, sf_dir), KEYS, ["segment"])


@query
def history_vs_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = apply_changes_scd2(spark, sf_dir)
    return history.history_vs_scd2(derived.user_feed(spark, sf_dir), dim, KEYS)


@query
def rebaseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, commits = derived.user_feed(spark, sf_dir), derived.commits(spark, sf_dir)
    return recovery.rebaseline(feed, commits, KEYS).snapshot


@query
def recover_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, half = derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50)
    path, job = new_folder(spark, "feed"), new_job(spark, "recover")
    reading.changes_between(feed, 0, half).write.parquet(path)
    columns = ["user_id", *VALUES]
    first = reading.stream_changes(spark, path, feed.schema, 1)
    consumers.append_available(first, job, columns)
    reading.changes_between(feed, half + 1).write.mode("append").parquet(path)
    consumers.recover_stream(spark, path, feed.schema, job, columns)
    return read_feed_sink(spark, job.sink)


@query
def recover_split_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint is lost between the two files of one commit."""
    feed, half = derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50)
    last = feed.where((F.col("_commit_version") <= half) & (F.col("_change_type") == PREIMAGE))
    split = last.agg(F.max("_commit_version").alias("v")).scalar()
    first_half = (F.col("_commit_version") < split) | (
        (F.col("_commit_version") == split) & (F.col("_change_type") == PREIMAGE)
    )
    path, job = new_folder(spark, "feed"), new_job(spark, "recover-split")
    columns = ["user_id", *VALUES]
    feed.where(first_half).write.parquet(path)
    consumers.append_available(reading.stream_changes(spark, path, feed.schema, 1), job, columns)
    feed.where(~first_half).write.mode("append").parquet(path)
    consumers.recover_stream(spark, path, feed.schema, job, columns)
    return read_feed_sink(spark, job.sink)


@query
def gap_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.gap_window(derived.commits(spark, sf_dir))


def read_stored_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a table, for operators that read it several times."""
    return spark.read.parquet(stored_feed(spark, derived.user_feed(spark, sf_dir), "feed"))


@query
def gap_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, commits = read_stored_feed(spark, sf_dir), derived.commits(spark, sf_dir)
    gap = ledger.gap_window(commits)
    pre = state.snapshot_as_of(feed, at(spark, sf_dir, 40) - 1, KEYS)
    post = state.snapshot_as_of(feed, at(spark, sf_dir, 45), KEYS)
    return recovery.gap_repair(pre, post, KEYS, VALUES, gap, commits)


def quarters(spark: SparkSession, sf_dir: str) -> list[int]:
    return [at(spark, sf_dir, p) for p in (25, 50, 75)]


@query
def replay_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = read_stored_feed(spark, sf_dir)
    return recovery.replay_check(feed, KEYS, quarters(spark, sf_dir))


@query
def replayed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = read_stored_feed(spark, sf_dir)
    return recovery.replayed_state(feed, KEYS, quarters(spark, sf_dir))


def local_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events whose first 30 percent hold local times, ten hours ahead of UTC."""
    zones = [scd.VersionZone(0, at(spark, sf_dir, 30), "Australia/Brisbane")]
    raw = derived.raw_cdc(spark, sf_dir)
    return scd.normalize_sequence(raw, "updated_at", "_commit_version", zones)


@query
def zone_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the clock of the raw events moved, found from commit times alone."""
    committed = derived.table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("_commit_version"), "ts")
    events = local_early(spark, sf_dir).join(committed, "_commit_version")
    return scd.zone_shifts(events, "updated_at", "_commit_version", "ts")


@query
def zones_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw events again, from the shifted ones and the zones that the search found."""
    early = local_early(spark, sf_dir)
    return scd.normalize_sequence(early, "updated_at", "_commit_version", scd.version_zones(zone_shifts(spark, sf_dir)))


@query
def normalize_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_early(spark, sf_dir)


@query
def backfill_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = scd.apply_changes_scd2(local_early(spark, sf_dir), raw_spec())
    stored = apply_changes_scd2(spark, sf_dir)
    return scd.backfill_drift(rebuilt, stored, KEYS, "__START_VERSION", "__START_AT")


@query
def gap_repair_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gap in which every data commit was an insert gives inserts only."""
    feed, commits = read_stored_feed(spark, sf_dir), derived.commits(spark, sf_dir)
    first, last = at(spark, sf_dir, 40), at(spark, sf_dir, 45)
    inserts = feed.where(F.col("_change_type") == INSERT)
    inside = inserts.where(F.col("_commit_version").between(first, last)).dropDuplicates(KEYS)
    pre = state.snapshot_as_of(feed, first - 1, KEYS)
    post = pre.select("user_id", *VALUES).unionByName(
        inside.select("user_id", *VALUES).withColumn("user_id", F.col("user_id") + 1_000_000)
    )
    calm = commits.withColumn(
        "operation",
        F.when(~F.col("feed_enabled") & F.col("operation").isin("UPDATE", "DELETE", "MERGE", "WRITE"), "INSERT").otherwise(
            F.col("operation")
        ),
    )
    fixed = recovery.gap_repair(pre, post, KEYS, VALUES, ledger.gap_window(calm), calm)
    return fixed.select("user_id", "_change_type", "_commit_version", "synthetic")


@query
def feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = derived.source_commits(spark, sf_dir)
    return recovery.feed_health(commits, derived.source_progress(commits)).drop("action")


@query
def feed_health_unread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health where a source of the ledger was never read and one of progress has no commits."""
    commits = derived.source_commits(spark, sf_dir)
    progress = derived.source_progress(commits).where("source <> 'view'")
    ghost = progress.where("source = 'click'").withColumn("source", F.lit("ghost"))
    return recovery.feed_health(commits, progress.unionByName(ghost)).drop("action")


@query
def consumer_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three consumers ought to run: one has read all, one stands still at half of the feed, one never started."""
    feed, half = derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50)
    folder = new_folder(spark, "progress")
    with following.keep_progress(spark, folder):
        for consumer, rows in (("archive", feed), ("reports", reading.changes_between(feed, 0, half))):
            path, job = stored_feed(spark, rows, "feed"), new_job(spark, consumer)
            stream = reading.stream_changes(spark, path, feed.schema, 0, part_of_files(spark, 2))
            consumers.append_available(following.watched(stream, consumer, "users"), job, KEYS)
    expected = spark.createDataFrame(
        [(c, "users") for c in ("archive", "reports", "alerts")], "consumer string, source string"
    )
    stored = new_folder(spark, "ledger")
    derived.commits(spark, sf_dir).where("operation <> 'OPTIMIZE'").write.parquet(stored)
    commits = spark.read.parquet(stored)
    seen = following.read_progress(spark, folder)
    told = following.consumer_health(commits, expected, seen, now=F.lit("2100-01-01").cast("timestamp"))
    return told.drop("at", "error", "action").join(seen.select("consumer", "total_rows"), "consumer", "left")


@query
def evolve_dim2(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_cdc(spark, sf_dir, note_from=at(spark, sf_dir, 50))
    return scd.evolve_dim2(raw, raw_spec("segment"), "note", "string")


@query
def run_full_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed, commits = derived.user_feed(spark, sf_dir), derived.commits(spark, sf_dir)
    start = at(spark, sf_dir, 60)
    held = state.fold_feed(reading.changes_between(feed, 0, start), KEYS).drop("note")
    progress = spark.createDataFrame([("users", start)], "source string, last_version bigint")
    expected = StructType([f for f in EXPECTED if f.name != "added_later"])
    # As many versions as the consumer is behind: one less would close the gate.
    lag = at(spark, sf_dir, 100) - start
    return run_batch("users", feed, commits, held, progress, KEYS, expected, lag).state


@query
def run_first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermarks after the first batch of a source that had none."""
    feed, commits = derived.user_feed(spark, sf_dir), derived.commits(spark, sf_dir)
    # All is retained and the feed was never off: a first batch needs both.
    whole = commits.withColumn("retained", F.lit(True)).withColumn("feed_enabled", F.lit(True))
    held = state.empty_state(spark, feed, KEYS).drop("note")
    progress = spark.createDataFrame([("others", 7)], "source string, last_version bigint")
    expected = StructType([f for f in EXPECTED if f.name != "added_later"])
    return run_batch("users", feed, whole, held, progress, KEYS, expected, at(spark, sf_dir, 100)).progress


# --- streaming ---------------------------------------------------------------


@query
def available_now_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink report after two runs over the same files; the second adds nothing."""
    feed = derived.user_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "rerun")
    for _ in range(2):
        stream = reading.stream_changes(spark, path, feed.schema, 1)
        report = consumers.run_feed_stream(stream, job, ["user_id"])
    return report


@query
def stream_apply_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "scd1")
    stream = reading.stream_changes(spark, path, feed.schema, 1, part_of_files(spark, 4))
    consumers.stream_apply_scd1(stream, job, KEYS)
    return consumers.read_live(spark, job.sink, KEYS)


@query
def late_stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest versions arrive first; the version guard gives the same state."""
    feed, half = derived.user_feed(spark, sf_dir), at(spark, sf_dir, 50)
    path, job = new_folder(spark, "feed"), new_job(spark, "late")
    for part in (reading.changes_between(feed, half + 1), reading.changes_between(feed, 0, half)):
        part.write.mode("append").parquet(path)
        stream = reading.stream_changes(spark, path, feed.schema, 0)
        consumers.stream_apply_scd1(stream, job, KEYS)
    return consumers.read_state(spark, job.sink, KEYS)


@query
def stream_apply_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_cdc(spark, sf_dir)
    path, job = stored_feed(spark, raw, "raw"), new_job(spark, "scd2")
    stream = reading.stream_table(spark, path, raw.schema, part_of_files(spark, 2))
    dimension.stream_apply_scd2(stream, job, raw_spec())
    return dimension.read_dim2(spark, job.sink, raw.schema, raw_spec())


@query
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "history")
    stream = reading.stream_changes(spark, path, feed.schema, 0, part_of_files(spark, 2))
    known = ("known_user", F.col("user_id").isNotNull())
    consumers.stream_history(stream, job, known, ntz("2024-02-01 00:00:00"))
    return read_batches(spark, job.sink)


@query
def stream_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows an expectation dropped, counted while the stream wrote the others, by month."""
    feed = derived.user_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "drops")
    stream = reading.stream_changes(spark, path, feed.schema, 0, part_of_files(spark, 2))
    cheap = ("cheap", F.col("score") < 50)
    consumers.stream_history(stream, job, cheap, ntz("2024-02-01 00:00:00"), grain="month")
    kept = read_batches(spark, job.sink).groupBy("commit_date").agg(F.count("*").alias("rows"))
    dropped = consumers.read_drops(spark, job.sink)
    return kept.select(F.col("commit_date").cast("string").alias("what"), "rows").unionByName(
        dropped.select(F.col("expectation").alias("what"), F.col("dropped").alias("rows"))
    )


@query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = decimal_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "metrics")
    stream = reading.stream_changes(spark, path, feed.schema, 0, part_of_files(spark, 4))
    consumers.stream_metrics(stream, job, ["segment"], {"score_sum": "score"})
    metrics = consumers.read_metrics(spark, job.sink, ["segment"])
    return metrics.withColumn("score_sum", F.col("score_sum").cast("double"))


@query
def stream_live_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics kept as state of the stream, after a lost checkpoint and a second run over the whole feed."""
    feed = decimal_feed(spark, sf_dir)
    path, job = stored_feed(spark, feed, "feed"), new_job(spark, "live-metrics")
    for held in (job, job.recovered()):
        stream = reading.stream_changes(spark, path, feed.schema, 0, part_of_files(spark, 4))
        consumers.stream_live_metrics(stream, held, ["segment"], {"score_sum": "score"})
    metrics = consumers.read_live_metrics(spark, job.sink, ["segment"])
    return metrics.withColumn("score_sum", F.col("score_sum").cast("double"))


@query
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = derived.user_feed(spark, sf_dir)
    path = stored_feed(spark, feed, "feed")
    kept, removed = new_job(spark, "fan-history"), new_job(spark, "fan-deletes")
    stream = reading.stream_changes(spark, path, feed.schema, 0)
    consumers.fan_out(stream, kept, removed, KEYS, ntz("2024-02-01 00:00:00"))
    columns = ["user_id", "_commit_version"]
    return (
        read_batches(spark, kept.sink)
        .select(*columns, F.lit("history").alias("sink"))
        .unionByName(read_batches(spark, removed.sink).select(*columns, F.lit("deletes").alias("sink")))
    )


# --- row and column security -------------------------------------------------

MASKS = {"tfn": "HR", "salary": "Finance"}


@query
def row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return security.row_filter(derived.people(spark, sf_dir), "state", derived.READERS["asia"])


@query
def mask_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return security.mask_text(derived.people(spark, sf_dir), "tfn", derived.READERS["fin"])


@query
def mask_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return security.mask_number(derived.people(spark, sf_dir), "salary", derived.READERS["hr"])


@query
def view_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derived.people(spark, sf_dir)
    security.view_filtered(people, "people_filtered", "state", derived.READERS["europe"])
    return spark.table("people_filtered")


@query
def view_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derived.people(spark, sf_dir)
    security.view_masked(people, "people_masked", MASKS, derived.READERS["hr"])
    return spark.table("people_masked")


@query
def view_secured(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derived.people(spark, sf_dir)
    security.view_secured(people, "people_secured", "state", MASKS, derived.READERS["fin"])
    return spark.table("people_secured")


@query
def session_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as SQL functions over the session's reader."""
    session_rules.install(spark, derived.READERS["both"])
    derived.people(spark, sf_dir).createOrReplaceTempView("people_base")
    return spark.sql(
        "SELECT employee_id, name, department, state, cover_text(tfn, 'HR') AS tfn, "
        "cover_number(salary, 'Finance') AS salary FROM people_base WHERE row_visible(state)"
    )


@query
def apply_tag_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derived.people(spark, sf_dir)
    return security.apply_tag_policies(people, security.STANDARD_POLICIES, derived.READERS["hr"])


@query
def tag_policies_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set of policies for all tables below `hr`, on a tagged and an untagged table and one elsewhere."""
    people = derived.people(spark, sf_dir)
    untagged = people.select(*[F.col(c).alias(c, metadata={}) for c in people.columns])
    policies = [replace(p, scope="hr") for p in security.STANDARD_POLICIES]
    seen = [
        security.apply_tag_policies(df, policies, ["ASIA", "HR"], table).agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("tfn") != "XXX", 1)).alias("readable")
        ).select(F.lit(table).alias("table"), "rows", "readable")
        for table, df in (("hr.people", people), ("hr.untagged", untagged), ("sales.people", people))
    ]
    return changes.union_changes(seen)


@query
def verify_row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected rows leave out customers in debt, so that excess shows up."""
    people, readers = derived.people(spark, sf_dir), derived.principals(spark, sf_dir)
    expected = security.visible_rows(people.where("salary >= 0"), "state", readers)
    expected = expected.select("principal", F.col("visible_rows").alias("expected_rows"))
    return security.verify_row_filter(people, "state", readers, expected)


@query
def verify_column_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = derived.people(spark, sf_dir)
    leaky = security.mask_text(people.where("salary < 0"), "tfn", []).unionByName(
        people.where("salary >= 0")
    )
    return security.verify_column_mask(leaky, "tfn")


@query
def bypass_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = security.bypass_members(derived.principals(spark, sf_dir))
    return members.withColumn("bypass_groups", F.concat_ws(",", "bypass_groups"))


@query
def policy_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = security.tag_columns(
        derived.table(spark, sf_dir, "supplier"), {"s_acctbal": "financial", "s_name": "public"}
    )
    return security.policy_coverage(
        {"people": derived.people(spark, sf_dir), "suppliers": suppliers},
        security.STANDARD_POLICIES,
        {"people": security.TableRules("state", {"tfn": "HR"})},
    )
