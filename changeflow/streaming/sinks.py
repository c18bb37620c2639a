"""Batch folders: a parquet sink that a retried micro-batch cannot write twice.

`foreachBatch` may repeat a batch after a failure.  Every batch therefore owns the
folder run=<generation>/batch_id=<n> and overwrites it.  The generation is the
number of the checkpoint, which also numbers batches anew: a recovery with a new
checkpoint writes beside the earlier run and not over it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from changeflow.contracts import COMMIT_VERSION

RUN, BATCH = "run", "batch_id"


@dataclass(frozen=True)
class Job:
    """Where a streaming job keeps its sink and its numbered checkpoints."""

    sink: str
    checkpoints: str
    generation: int = 1

    @property
    def checkpoint(self) -> str:
        return checkpoint_path(self.checkpoints, self.generation)

    def folder(self, batch_id: int, part: str = "") -> str:
        base = f"{self.sink}/{part}" if part else self.sink
        return f"{base}/{RUN}={self.generation}/{BATCH}={batch_id}"

    def recovered(self) -> Job:
        """The same job with the next checkpoint."""
        return Job(self.sink, self.checkpoints, self.generation + 1)


def checkpoint_path(base: str, generation: int) -> str:
    """stream_v1, and stream_v2_recovery and so on after a lost checkpoint."""
    return f"{base}/stream_v{generation}" + ("" if generation == 1 else "_recovery")


def start(
    stream: DataFrame,
    job: Job,
    each_batch: Callable[[DataFrame, int], None],
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a stream: all pending data and then stop, or at an interval for always-on jobs."""
    writer = (
        stream.writeStream.foreachBatch(each_batch)
        .outputMode(mode)
        .option("checkpointLocation", job.checkpoint)
    )
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run(
    stream: DataFrame,
    job: Job,
    each_batch: Callable[[DataFrame, int], None],
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Process what is there now and return when it is done; with an interval, return the running query."""
    query = start(stream, job, each_batch, every, mode)
    if every is None:
        query.awaitTermination()
    return query


def read_batches(
    spark: SparkSession,
    path: str,
    keep: Sequence[str] = (),
    schema: StructType | None = None,
) -> DataFrame:
    """All batch folders of a sink; `keep` names the batch columns to leave in.

    A declared schema opens no file.  Without one the folders are read under the union of
    their columns, which opens every footer, so that a column that came later is not lost.
    """
    reader = spark.read.option("mergeSchema", str(schema is None).lower())
    if schema is not None:
        stamp = [StructField(RUN, IntegerType()), StructField(BATCH, LongType())]
        reader = reader.schema(StructType([*schema.fields, *stamp]))
    return reader.parquet(path).drop(*[c for c in (RUN, BATCH) if c not in keep])


def read_feed_sink(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The change rows of a sink, also after recoveries.

    A recovery reads again from the last version that the sink held, since a lost run may have
    got half of it: from its first version on, a later run replaces what earlier runs wrote.
    """
    rows = read_batches(spark, path, keep=[RUN], schema=schema)
    # One row per checkpoint: few.
    starts = rows.groupBy(RUN).agg(F.min(COMMIT_VERSION).alias("from"))
    later = Window.orderBy(F.col(RUN).desc()).rowsBetween(Window.unboundedPreceding, -1)
    limits = starts.select(F.col(RUN).alias("of_run"), F.min("from").over(later).alias("until"))
    held = rows.join(limits, F.col(RUN) == F.col("of_run"))
    return held.where(F.col("until").isNull() | (F.col(COMMIT_VERSION) < F.col("until"))).drop(
        RUN, "of_run", "until"
    )


_BATCHES_PER_RUN = 1 << 40


def stamp_of(generation: int, batch_id: int) -> int:
    return generation * _BATCHES_PER_RUN + batch_id


def batch_stamp() -> Column:
    """A number that rises with run and batch."""
    return F.col(RUN).cast("bigint") * _BATCHES_PER_RUN + F.col(BATCH).cast("bigint")
