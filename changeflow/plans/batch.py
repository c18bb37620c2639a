"""The each-batch job: health check, slice, safe read, apply, move the watermark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.operators.quality import safe_cdf_read
from changeflow.operators.recovery import MAX_LAG, feed_health, guarded_batch
from changeflow.operators.state import apply_changes_scd1
from changeflow.sources.commits import latest_version


@dataclass(frozen=True)
class BatchResult:
    """The new state and the new watermark; store the state first."""

    state: DataFrame
    progress: DataFrame


def run_batch(
    source: str,
    feed: DataFrame,
    commits: DataFrame,
    state: DataFrame,
    progress: DataFrame,
    keys: Sequence[str],
    expected: StructType,
    max_lag: int = MAX_LAG,
) -> BatchResult:
    """One batch of one source.

    The end of the slice is fixed before anything is read, so state and watermark
    agree.  Write the state to a new folder, then the progress; after a crash in
    between the same slice comes again and the version guard makes it a no-op.
    """
    ledger = commits.where(F.col("source") == source)
    # A source that has no watermark yet starts at 0 and is checked like any other.
    held = progress.where(F.col("source") == source).agg(F.max("last_version").alias("v"))
    last = held.first()["v"] or 0
    mine = _watermark(progress, source, last)
    end = latest_version(ledger, source)

    def apply() -> DataFrame:
        changes = safe_cdf_read(feed, last + 1, expected, end)
        return apply_changes_scd1(state, changes, keys)

    new_state = guarded_batch(feed_health(ledger, mine, max_lag), apply)
    others = progress.where(~F.col("source").eqNullSafe(source))
    return BatchResult(new_state, others.unionByName(_watermark(progress, source, end)))


def _watermark(progress: DataFrame, source: str, version: int) -> DataFrame:
    return progress.sparkSession.range(1).select(
        F.lit(source).alias("source"), F.lit(version).cast("bigint").alias("last_version")
    )
