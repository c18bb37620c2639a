"""Folding batch folders in tiers while a stream runs, so that a reader opens few of them.

Every `fanout` batches become one fold, as many folds of one size the next larger, and so on: a
reader of n batches opens about fanout * log(n) folders.  A fold is written beside the batches and counts once its
success mark is there; the folders that it replaces stay where they are, so readers see
either all of it or none.  Folds cover fixed ranges of batch numbers of committed batches, so a retry writes
the same fold again.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeflow.sources.storage import children
from changeflow.streaming.sinks import BATCH, RUN, Job

FANOUT = 8
_MARK = "_SUCCESS"


def _folds(sink: str) -> str:
    return f"{sink.rstrip('/')}_folds"


def fold_tiers(
    spark: SparkSession, job: Job, upto: int, fold: Callable[[DataFrame], DataFrame], fanout: int = FANOUT
) -> None:
    """Write the folds that end just before batch `upto`, the smallest first.

    Call it while batch `upto` is written: the batches before it are committed and don't change any more.
    """
    size = fanout
    while upto and upto % size == 0:
        start = upto - size
        target = f"{_folds(job.sink)}/{RUN}={job.generation}/size={size}/start={start}"
        parts = _cover(spark, job.sink, job.generation, start, upto, size)
        if _MARK not in children(spark, target) and parts:
            rows = spark.read.option("mergeSchema", "true").parquet(*parts)
            fold(rows).write.mode("overwrite").parquet(target)
        size *= fanout


def _numbers(names: list[str], label: str) -> list[int]:
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"{label}=(\d+)", n)))


def _cover(
    spark: SparkSession, sink: str, generation: int, start: int = 0, end: int | None = None, below: int | None = None
) -> list[str]:
    """Folders that hold the batches of a run in a range, large folds first; only folds smaller than `below`."""
    base, folds = f"{sink}/{RUN}={generation}", f"{_folds(sink)}/{RUN}={generation}"
    batches = [b for b in _numbers(children(spark, base), BATCH) if b >= start and (end is None or b < end)]
    out, covered = [], set()
    for size in reversed(_numbers(children(spark, folds), "size")):
        if below is not None and size >= below:
            continue
        for at in _numbers(children(spark, f"{folds}/size={size}"), "start"):
            inside = at >= start and (end is None or at + size <= end) and at not in covered
            if inside and _MARK in children(spark, f"{folds}/size={size}/start={at}"):
                out.append(f"{folds}/size={size}/start={at}")
                covered.update(range(at, at + size))
    return out + [f"{base}/{BATCH}={b}" for b in batches if b not in covered]


def live_folders(spark: SparkSession, sink: str) -> list[str]:
    """The folders of a sink that together hold every batch of every run once."""
    return [f for run in _numbers(children(spark, sink), RUN) for f in _cover(spark, sink, run)]


def read_live_folders(spark: SparkSession, sink: str) -> DataFrame:
    """All batches of a sink, each from the largest fold that holds it, under the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(*(live_folders(spark, sink) or [sink]))
