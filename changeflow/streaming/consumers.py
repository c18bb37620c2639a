"""Feed consumers: append, history, current state, metrics, fan-out, recovery."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from changeflow.contracts import COMMIT_DATE, COMMIT_VERSION
from changeflow.operators.changes import (
    add_aggregates,
    high_water_mark,
    project_sink,
    reconcile,
    signed,
    signed_aggregate,
    tombstones,
)
from changeflow.operators.history import history_rows
from changeflow.operators.quality import expect_or_drop
from changeflow.operators.state import current_snapshot, fold_feed, fold_states
from changeflow.sources.feed import stream_changes
from changeflow.streaming.sinks import BATCH, RUN, Job, read_batches, read_feed_sink, run
from changeflow.streaming.tiers import FANOUT, fold_tiers, read_live_folders


def run_feed_stream(stream: DataFrame, job: Job, columns: Sequence[str]) -> DataFrame:
    """Append the projected feed to the sink; returns its row count and last version."""
    append_available(stream, job, columns)
    return sink_report(stream.sparkSession, job.sink)


def append_available(
    stream: DataFrame, job: Job, columns: Sequence[str], every: str | None = None
) -> StreamingQuery:
    """Append the projected feed; `every` keeps the stream running at that interval, as in all consumers."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(job.folder(batch_id))

    return run(project_sink(stream, columns), job, write, every)


def sink_report(spark: SparkSession, sink: str) -> DataFrame:
    """Rows and greatest version of a sink, in one pass over one column."""
    return read_feed_sink(spark, sink).agg(
        F.count("*").alias("sink_rows"), F.max(COMMIT_VERSION).alias("last_version")
    )


def recover_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    job: Job,
    columns: Sequence[str],
    files_per_batch: int | None = None,
) -> Job:
    """Resume after a lost checkpoint: read on from the sink's last version, under a new checkpoint.

    That version itself is read again, since the files of one commit may lie in two batches of
    which only the first was written; `read_feed_sink` counts it once.  Right when the feed
    lands in version order, as a feed does; for other arrival orders use a version-guarded
    state, which may read everything again.
    """
    mark = high_water_mark(read_feed_sink(spark, job.sink)).first()["high_water_mark"]
    next_job = job.recovered()
    stream = stream_changes(spark, source, schema, mark, files_per_batch)
    append_available(stream, next_job, columns)
    return next_job


def stream_history(
    stream: DataFrame,
    job: Job,
    expectation: tuple[str, Column] | None = None,
    at: Column | None = None,
    grain: str = "day",
    every: str | None = None,
) -> StreamingQuery:
    """Keep every change row with capture time and date partition, of a day or a month.

    A batch keeps the columns it came with; `read_batches` reads all of them
    under the union, so a new source column needs no rewrite.  What an expectation
    drops is counted per batch while the batch is written, see `read_drops`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counted = Observation(f"drops-{job.generation}-{batch_id}-{uuid4().hex}")
        rows = batch if expectation is None else expect_or_drop(batch, *expectation, counted)
        rows = history_rows(rows, at, grain).hint("rebalance", COMMIT_DATE)
        rows.write.mode("overwrite").partitionBy(COMMIT_DATE).parquet(job.folder(batch_id))
        if expectation is not None:
            name = expectation[0]
            report = batch.sparkSession.range(1).select(
                F.lit(name).alias("expectation"),
                F.lit(counted.get[f"{name}_dropped"]).cast("bigint").alias("dropped"),
            )
            report.write.mode("overwrite").parquet(Job(_drops(job.sink), "", job.generation).folder(batch_id))

    return run(stream, job, write, every)


def _drops(sink: str) -> str:
    return f"{sink.rstrip('/')}_drops"


def read_drops(spark: SparkSession, sink: str) -> DataFrame:
    """Rows that each expectation of a `stream_history` sink has dropped, over all batches."""
    return read_batches(spark, _drops(sink)).groupBy("expectation").agg(F.sum("dropped").alias("dropped"))


def stream_apply_scd1(
    stream: DataFrame, job: Job, keys: Sequence[str], every: str | None = None, fanout: int = FANOUT
) -> StreamingQuery:
    """Fold every batch to one row per key and store it as state rows of that batch.

    A batch writes as much as it changed, and every `fanout` batches are folded into one folder, tier by tier.
    `read_state` folds what is left by version, so order, repetition and recovery do not matter.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fold_tiers(batch.sparkSession, job, batch_id, lambda rows: fold_states(rows, keys), fanout)
        fold_feed(batch, keys).write.mode("overwrite").parquet(job.folder(batch_id))

    return run(stream, job, write, every)


def read_state(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """The state of a `stream_apply_scd1` sink, tombstones included."""
    return fold_states(read_live_folders(spark, sink), keys)


def compact_state(spark: SparkSession, sink: str, keys: Sequence[str], job: Job) -> None:
    """Write the folded state to another sink, where the stream may go on under any checkpoint.

    It lies in run 0, which no stream writes; later batches fold over it by version.
    """
    start = Job(job.sink, job.checkpoints, generation=0)
    read_state(spark, sink, keys).write.mode("overwrite").parquet(start.folder(0))


def stream_metrics(
    stream: DataFrame,
    job: Job,
    group: Sequence[str],
    measures: Mapping[str, str],
    every: str | None = None,
) -> StreamingQuery:
    """Store the signed change of the metrics per batch; no state is kept in the stream.

    The sum over all batches is the metric of the live table, see `read_metrics`.  After a
    lost checkpoint, the recovered job must read the feed from its start.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        signed_aggregate(batch, group, measures).write.mode("overwrite").parquet(job.folder(batch_id))

    return run(stream, job, write, every)


def read_metrics(spark: SparkSession, sink: str, group: Sequence[str]) -> DataFrame:
    """The metrics of a `stream_metrics` sink: those of its newest run, which has seen every change once."""
    parts = read_batches(spark, sink, keep=[RUN])
    newest = parts.agg(F.max(RUN)).scalar()
    return add_aggregates(parts.where(F.col(RUN) == newest).drop(RUN), group)


def stream_live_metrics(
    stream: DataFrame,
    job: Job,
    group: Sequence[str],
    measures: Mapping[str, str],
    every: str | None = None,
) -> StreamingQuery:
    """Metrics of the live table as keyed state of the stream; a batch stores the totals of the groups it changed.

    `read_live_metrics` takes the latest totals of a group, however many batches there were.
    """
    sums = [F.sum(F.col("sign") * F.col(c)).alias(name) for name, c in measures.items()]
    totals = signed(stream).groupBy(*group).agg(
        F.sum("sign").alias("rows"), *sums, F.max(COMMIT_VERSION).alias(UPTO)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(job.folder(batch_id))

    return run(totals, job, write, every, mode="update")


#: The greatest version that has gone into the totals of a group.
UPTO = "upto_version"


def read_live_metrics(
    spark: SparkSession, sink: str, group: Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """The metrics of a `stream_live_metrics` sink, from the run that has got furthest.

    A recovered stream must read the feed from its start; until it has reached the version
    that the earlier run had, that run's totals hold, so that totals never fall back meanwhile.
    """
    return _latest_totals(spark, sink, group, schema).where(F.col("rows") != 0).drop(UPTO, RUN)


def _latest_totals(
    spark: SparkSession, sink: str, group: Sequence[str], schema: StructType | None = None
) -> DataFrame:
    parts = read_batches(spark, sink, keep=[RUN, BATCH], schema=schema)
    # One row per checkpoint; of runs that got as far as each other the newest.
    furthest = parts.groupBy(RUN).agg(F.max(UPTO).alias(UPTO)).agg(F.max(F.struct(UPTO, RUN)).alias("at"))
    rest = [c for c in parts.columns if c not in (*group, BATCH)]
    mine = parts.where(F.col(RUN) == furthest.select(f"at.{RUN}").scalar())
    return mine.groupBy(*group).agg(F.max_by(F.struct(*rest), BATCH).alias("row")).select(*group, "row.*")


def state_totals(
    spark: SparkSession, job: Job, group: Sequence[str], measures: Mapping[str, DataType]
) -> DataFrame:
    """The totals that a `stream_live_metrics` job keeps in its checkpoint, read with Spark's state reader.

    `measures` names the types of the measured columns.
    """
    state = spark.read.format("statestore").load(job.checkpoint)
    # Sums and the maximum in order; a decimal sum has a second field that tells whether it is empty.
    names = ["rows"]
    for name, kind in measures.items():
        names += [name] + [f"{name}_empty"] * isinstance(kind, DecimalType)
    names.append(UPTO)

    def renamed(column: str, to: Sequence[str]) -> Column:
        fields = state.schema[column].dataType.fields
        return F.col(column).cast(StructType([StructField(n, f.dataType) for n, f in zip(to, fields, strict=True)]))

    flat = state.select(renamed("key", list(group)).alias("key"), renamed("value", names).alias("value"))
    return flat.select("key.*", *[f"value.{n}" for n in ("rows", *measures, UPTO)])


def metrics_drift(
    spark: SparkSession, job: Job, group: Sequence[str], measures: Mapping[str, DataType]
) -> DataFrame:
    """Totals that sink and state of a job don't agree on: `left` is the sink's. Empty unless folders were lost."""
    return reconcile(_sink_totals(spark, job, group), state_totals(spark, job, group, measures))


def _sink_totals(spark: SparkSession, job: Job, group: Sequence[str]) -> DataFrame:
    parts = read_batches(spark, job.sink, keep=[RUN, BATCH]).where(F.col(RUN) == job.generation)
    rest = [c for c in parts.columns if c not in (*group, RUN, BATCH)]
    return parts.groupBy(*group).agg(F.max_by(F.struct(*rest), BATCH).alias("row")).select(*group, "row.*")


def repair_metrics(
    spark: SparkSession, job: Job, group: Sequence[str], measures: Mapping[str, DataType]
) -> None:
    """Write the totals of the state to the sink as its newest batch so far, after folders were lost.

    The stream must not be running; its next batch comes after this one.
    """
    last = spark.read.format("state-metadata").load(job.checkpoint).agg(F.max("maxBatchId")).scalar()
    at = spark.range(1).select(last.alias("v")).first()["v"]
    totals = state_totals(spark, job, group, measures).checkpoint()
    totals.write.mode("overwrite").parquet(job.folder(at))


def fan_out(
    stream: DataFrame,
    history: Job,
    deletes: Job,
    keys: Sequence[str],
    at: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """One feed to two sinks, history by date and soft deletes, with one read per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            kept = history_rows(batch, at).hint("rebalance", COMMIT_DATE)
            kept.write.mode("overwrite").partitionBy(COMMIT_DATE).parquet(history.folder(batch_id))
            tombstones(batch, keys).write.mode("overwrite").parquet(deletes.folder(batch_id))
        finally:
            batch.unpersist()

    return run(stream, history, write, every)


def read_live(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """The live rows of a `stream_apply_scd1` sink."""
    return current_snapshot(read_state(spark, sink, keys))
