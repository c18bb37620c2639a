"""The append-only event history: partitions, widening, audits, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.contracts import COMMIT_DATE, COMMIT_TIMESTAMP, COMMIT_VERSION
from changeflow.operators.changes import with_capture_time
from changeflow.operators.digest import Level, only_differing

# Fixed value: above this many changes per day monthly partitions are advised.
BUSY_DAY_ROWS = 10_000_000
# Bytes of a row group, and distinct entities expected in it, of a history for lookups.
LOOKUP_ROW_GROUP = 16 << 20
LOOKUP_DISTINCT = 100_000


def with_commit_date(feed: DataFrame, grain: str = "day") -> DataFrame:
    """Add the partition date, from the commit time and not from the capture time."""
    day = F.to_date(COMMIT_TIMESTAMP)
    if grain not in ("day", "month"):
        raise ValueError("the grain of history partitions is day or month")
    return feed.withColumn(COMMIT_DATE, day if grain == "day" else F.trunc(day, "month"))


def history_rows(feed: DataFrame, at: Column | None = None, grain: str = "day") -> DataFrame:
    """Feed rows as history rows: every change type, both images, capture time and date."""
    return with_commit_date(with_capture_time(feed, at), grain)


def write_partitioned_history(
    history: DataFrame, path: str, cluster_by: Sequence[str] = (), mode: str = "append"
) -> None:
    """Append to a history partitioned by commit_date.

    The rebalance hint lets adaptive execution join small and split large dates, so
    that a busy day is not one task; the sort inside a file serves key lookups.
    """
    rows = history if COMMIT_DATE in history.columns else with_commit_date(history)
    rows = rows.hint("rebalance", COMMIT_DATE)
    if cluster_by:
        rows = rows.sortWithinPartitions(COMMIT_DATE, *cluster_by)
    rows.write.mode(mode).partitionBy(COMMIT_DATE).parquet(path)


def write_for_lookups(
    history: DataFrame,
    path: str,
    entity: Sequence[str],
    distinct_per_group: int = LOOKUP_DISTINCT,
    row_group_bytes: int = LOOKUP_ROW_GROUP,
    mode: str = "append",
) -> None:
    """Append to a history partitioned by commit_date, laid out so that one entity is found without reading the rest.

    Rows are ranged by date, entity and version and sorted so in every file: of a date an entity lies in
    neighbouring row groups, and one with very many events is cut by version, not held in one task.  Statistics
    exclude the other row groups, Bloom filters those whose range covers the value but which lack it.
    """
    rows = history if COMMIT_DATE in history.columns else with_commit_date(history)
    order = [COMMIT_DATE, *entity, COMMIT_VERSION]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = rows.write.mode(mode).partitionBy(COMMIT_DATE).option("parquet.block.size", row_group_bytes)
    for column in entity:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", distinct_per_group
        )
    writer.parquet(path)


def entity_history(history: DataFrame, **entity) -> DataFrame:
    """All events of one entity on all dates, by version: the filters reach the row groups of the files."""
    rows = history
    for column, value in entity.items():
        kind = history.schema[column].dataType
        rows = rows.where(F.col(column) == F.lit(value).cast(kind))
    return rows.orderBy(COMMIT_VERSION)


def publish_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a full snapshot with whatever schema it has and return it as stored.

    Give a new path and move readers to it afterwards; a plan must not read the
    folder it overwrites.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def widen_and_append(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Both parts under the union of their columns.

    Old rows have NULL in new columns and are never back-filled; a column whose type
    changed raises.
    """
    old = {f.name: f.dataType for f in existing.schema}
    for f in batch.schema:
        if f.name in old and old[f.name] != f.dataType:
            raise ValueError(
                f"column {f.name} is {old[f.name].simpleString()} in the history "
                f"and {f.dataType.simpleString()} in the batch"
            )
    return existing.unionByName(batch, allowMissingColumns=True)


def append_widening(batch: DataFrame, path: str) -> None:
    """Append a batch as it is; readers widen with `read_widened`."""
    batch.write.mode("append").parquet(path)


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """A folder of files with growing schemas under the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_only_audit(before: DataFrame, after: DataFrame, levels: Sequence[Level] = ()) -> DataFrame:
    """Rows of an earlier history that a later one lost or changed; must be empty.

    Copies count: a row stored twice has to be there twice.  With levels (say a date, then a
    version) digests are compared first, and only groups that differ are compared row by row: the
    later history should be cut at the end of the earlier one.
    """
    if levels:
        before, after = only_differing(before, after, levels)
    columns = before.columns
    tagged = before.withColumn("n", F.lit(1)).unionByName(after.select(*columns).withColumn("n", F.lit(-1)))
    lost = tagged.groupBy(*columns).agg(F.sum("n").alias("lost_copies"))
    return lost.where(F.col("lost_copies") > 0)


def history_audit(history: DataFrame, first_day, last_day, **entity) -> DataFrame:
    """Events of one entity between two dates, by version.

    The dates are literals on the partition column, so other dates are not read.
    """
    rows = history.where(F.col(COMMIT_DATE).between(first_day, last_day))
    for column, value in entity.items():
        rows = rows.where(F.col(column) == value)
    return rows.orderBy(COMMIT_VERSION)


def history_vs_scd2(history: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored events per key beside its rows in the dimension, in one aggregate."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = history.select(*keys, one.alias("h"), zero.alias("d")).unionByName(
        dim.select(*keys, zero.alias("h"), one.alias("d"))
    )
    return both.groupBy(*keys).agg(
        F.sum("h").alias("history_events"), F.sum("d").alias("dimension_rows")
    )


def retention_profile(
    history: DataFrame, by: Sequence[str] = (), busy_day: int = BUSY_DAY_ROWS
) -> DataFrame:
    """Rows per day and month, the running total, and which partition grain to use.

    The scan ends in one row per day; everything after works on calendar days.
    """
    days = history.groupBy(*by, F.to_date(COMMIT_TIMESTAMP).alias("period")).agg(
        F.count("*").alias("rows")
    )
    months = days.groupBy(*by, F.trunc("period", "month").alias("period")).agg(
        F.sum("rows").alias("rows"), F.max("rows").alias("busiest")
    )
    grains = days.select(*by, F.lit("day").alias("grain"), "period", "rows", F.col("rows").alias("busiest"))
    grains = grains.unionByName(months.select(*by, F.lit("month").alias("grain"), "period", "rows", "busiest"))
    so_far = Window.partitionBy(*by, "grain").orderBy("period")
    whole = Window.partitionBy(*by, "grain")
    return grains.select(
        *by,
        "grain",
        "period",
        "rows",
        F.sum("rows").over(so_far).alias("rows_so_far"),
        F.when(F.max("busiest").over(whole) > busy_day, "monthly").otherwise("daily").alias("advice"),
    )
