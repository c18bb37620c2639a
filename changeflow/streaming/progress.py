"""What every streaming consumer has read, kept by a listener, and the health that follows from it.

A consumer's stream is `watched`: each micro-batch observes its rows and its greatest version in
the pass that processes it.  A `ProgressListener` stores them, and how a run ended, in small folders
that `read_progress` turns into one row per consumer.  `consumer_health` starts from the
consumers that ought to run, so one that never started shows as well as one that stands still.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from changeflow.contracts import COMMIT_VERSION
from changeflow.operators.recovery import MAX_LAG, feed_health
from changeflow.sources.storage import children

log = logging.getLogger(__name__)

_OBSERVED = "changeflow-progress:"
STORED = (
    "consumer string, source string, run_id string, batch_id bigint, batch_rows bigint, total_rows bigint, "
    "last_version bigint, at timestamp, error string"
)

# Issues of a consumer that come before those of its source, with what to do.
CONSUMER_ACTIONS = {
    "NEVER_STARTED": "Start the consumer, or take it off the list.",
    "FAILED": "Read the error, mend its cause, start the consumer again on its checkpoint.",
    "STALLED": "Look whether the query is running and its trigger is due.",
}


def watched(stream: DataFrame, consumer: str, source: str) -> DataFrame:
    """The stream, with rows and greatest version of every micro-batch observed for a `ProgressListener`."""
    name = f"{_OBSERVED}{quote(consumer, safe='')}:{quote(source, safe='')}"
    return stream.observe(name, F.count("*").alias("rows"), F.max(COMMIT_VERSION).alias("last_version"))


class ProgressListener(StreamingQueryListener):
    """Stores the progress of all watched streams of a session.

    A run of a consumer owns two folders that its batches overwrite in turn: one of them is whole
    at any time, and their number does not grow with the batches.  A batch without rows keeps the
    version before it.  A listener that fails only logs: it must not stop the streams.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._held: dict[tuple[str, str], dict] = {}  # the last row per run and consumer: as many as streams run
        self._known: dict[str, tuple[int | None, int]] = {}  # version and rows per consumer
        self._open: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        try:
            self._progress(event.progress)
        except Exception:
            log.exception("progress of a stream could not be stored")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run_id = str(event.runId)
        try:
            for (run, consumer), row in list(self._held.items()):
                if run == run_id:
                    if event.exception:
                        self._store({**row, "at": datetime.now().astimezone(), "error": str(event.exception)})
                    del self._held[run, consumer]
        except Exception:
            log.exception("the end of a stream could not be stored")
        finally:
            with self._changed:
                self._open.discard(run_id)
                self._changed.notify_all()

    def drained(self, seconds: float = 60) -> bool:
        """Wait until no stream is open any more and all its progress is stored; False after the time given."""
        with self._changed:
            return self._changed.wait_for(lambda: not self._open, seconds)

    def _progress(self, progress) -> None:
        for name, seen in progress.observedMetrics.items():
            if not name.startswith(_OBSERVED):
                continue
            consumer, source = (unquote(x) for x in name[len(_OBSERVED) :].split(":"))
            if consumer not in self._known:
                self._known[consumer] = self._stored(consumer)
            version, total = self._known[consumer]
            held = self._held.get((str(progress.runId), consumer))
            if held is not None and held["batch_id"] == progress.batchId:
                continue  # told again
            rows = seen["rows"] or 0
            versions = [v for v in (version, seen["last_version"]) if v is not None]
            version, total = max(versions, default=None), total + rows
            self._known[consumer] = version, total
            row = {
                "consumer": consumer,
                "source": source,
                "run_id": str(progress.runId),
                "batch_id": progress.batchId,
                "batch_rows": rows,
                "total_rows": total,
                "last_version": version,
                "at": datetime.now().astimezone(),
                "error": None,
            }
            self._held[row["run_id"], consumer] = row
            self._store(row)

    def _store(self, row: dict) -> None:
        # A failure is stored beside the batch before it, whose folder stays whole.
        slot = (row["batch_id"] + (row["error"] is not None)) % 2
        path = f"{self.folder}/{quote(row['consumer'], safe='')}-{row['run_id']}-{slot}"
        order = [field.split()[0] for field in STORED.split(", ")]
        one = self.spark.createDataFrame([tuple(row[c] for c in order)], STORED)
        one.coalesce(1).write.mode("overwrite").parquet(path)

    def _stored(self, consumer: str) -> tuple[int | None, int]:
        rows = read_progress(self.spark, self.folder).where(F.col("consumer") == consumer)
        held = rows.select("last_version", "total_rows").first()
        return (held["last_version"], held["total_rows"]) if held else (None, 0)


@contextmanager
def keep_progress(spark: SparkSession, folder: str, seconds: float = 60) -> Iterator[ProgressListener]:
    """Listens while its block runs; at the end waits until what has stopped is stored, for so long at most."""
    listener = ProgressListener(spark, folder)
    spark.streams.addListener(listener)
    try:
        yield listener
        if not listener.drained(seconds):
            log.warning("streams still run, or their progress is not stored yet")
    finally:
        spark.streams.removeListener(listener)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per consumer: its last batch, all rows, the greatest version of all runs, and the error it ended with.

    Read the folder name by name, since a batch being written has no success mark yet.
    """
    folder = folder.rstrip("/")
    whole = [f"{folder}/{x}" for x in children(spark, folder) if "_SUCCESS" in children(spark, f"{folder}/{x}")]
    if not whole:
        return spark.createDataFrame([], STORED)
    rows = spark.read.schema(STORED).parquet(*whole)
    latest = F.max_by(F.struct("source", "run_id", "batch_id", "batch_rows", "at", "error"), F.col("at"))
    merged = rows.groupBy("consumer").agg(
        latest.alias("last"), F.max("total_rows").alias("total_rows"), F.max("last_version").alias("last_version")
    )
    return merged.select(
        "consumer", "last.source", "last.run_id", "last.batch_id", "last.batch_rows",
        "total_rows", "last_version", "last.at", "last.error",
    )


def source_progress(progress: DataFrame) -> DataFrame:
    """The progress contract of each source: the version that its slowest consumer has reached."""
    return progress.groupBy("source").agg(F.min("last_version").alias("last_version"))


def consumer_health(
    commits: DataFrame,
    expected: DataFrame,
    progress: DataFrame,
    max_lag: int = MAX_LAG,
    stalled_after: str = "1 hour",
    now: Column | None = None,
) -> DataFrame:
    """Status and issues of every consumer that ought to run (consumer, source), whether it ever did or not.

    NEVER_STARTED: it stored no progress.  FAILED: its last run ended with an error.  STALLED: its
    source has versions it hasn't read, and its last batch is older than the limit.  The issues of
    `feed_health` follow, by the consumer's own last version.
    """
    ledger = expected.join(commits, "source").select(
        F.col("consumer").alias("source"), "version", "operation", "feed_enabled", "retained"
    )
    marks = expected.select("consumer").join(progress.select("consumer", "last_version"), "consumer")
    by_versions = feed_health(ledger, marks.withColumnRenamed("consumer", "source"), max_lag).select(
        F.col("source").alias("consumer"), "current_version", "lag", F.split("issues", ",").alias("of_source")
    )
    seen = progress.select("consumer", F.lit(True).alias("started"), "last_version", "at", "error")
    rows = expected.join(seen, "consumer", "left").join(by_versions, "consumer", "left")
    started = F.col("started").isNotNull()
    since = (F.current_timestamp() if now is None else now) - F.expr(f"interval {stalled_after}")
    own = F.array(
        F.when(~started, "NEVER_STARTED"),
        F.when(F.col("error").isNotNull(), "FAILED"),
        F.when(started & (F.col("lag") > 0) & (F.col("at") < since), "STALLED"),
    )
    rest = F.array_remove(F.array_remove(F.coalesce("of_source", F.array(F.lit("FEED_DISABLED"))), ""), "NEVER_READ")
    issues = F.concat(F.array_compact(own), rest)
    action = F.create_map(*[F.lit(x) for pair in CONSUMER_ACTIONS.items() for x in pair])
    return (
        rows.withColumn("issues", issues)
        .withColumn("status", F.coalesce(F.get("issues", F.lit(0)), F.lit("OK")))
        .select(
            "consumer", "source", "last_version", "current_version", "lag", "status",
            F.concat_ws(",", "issues").alias("issues"), "at", "error",
            F.element_at(action, F.col("status")).alias("action"),
        )
    )
