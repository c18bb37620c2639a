"""Reading row-level change feeds, as batches and as streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.contracts import COMMIT_VERSION, FEED_COLUMNS, check_feed
from changeflow.sources.commits import of_one_source


def changes_between(feed: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Change rows with start <= version <= end; without end, up to the latest.

    A plain comparison with a literal, so it reaches the parquet scan.  A range
    that holds maintenance commits only is empty.
    """
    rows = feed.where(F.col(COMMIT_VERSION) >= start)
    return rows if end is None else rows.where(F.col(COMMIT_VERSION) <= end)


def changes_since(
    feed: DataFrame,
    commits: DataFrame,
    ts_start: datetime | Column,
    ts_end: datetime | Column | None = None,
    source: str | None = None,
) -> DataFrame:
    """Change rows from the first commit at or after ts_start to the last at or before ts_end.

    The two versions are scalar subqueries over the ledger of one source.  A time
    without such a commit gives an empty frame.
    """
    inside = F.when(F.col("timestamp") >= _column(ts_start), F.col("version"))
    first = of_one_source(commits, F.min(inside), source)
    rows = feed.where(F.col(COMMIT_VERSION) >= first.scalar())
    if ts_end is None:
        return rows
    inside = F.when(F.col("timestamp") <= _column(ts_end), F.col("version"))
    last = of_one_source(commits, F.max(inside), source)
    return rows.where(F.col(COMMIT_VERSION) <= last.scalar())


def read_changes(
    feed: DataFrame,
    commits: DataFrame | None = None,
    *,
    start_version: int | None = None,
    end_version: int | None = None,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
) -> DataFrame:
    """One entry point for both kinds of range; versions and times cannot be mixed."""
    by_version = start_version is not None or end_version is not None
    by_time = start_time is not None or end_time is not None
    if by_version == by_time:
        raise ValueError("give a version range or a time range, not both and not neither")
    if by_version:
        if start_version is None:
            raise ValueError("a version range needs its start")
        return changes_between(feed, start_version, end_version)
    if start_time is None or commits is None:
        raise ValueError("a time range needs its start and the commit ledger")
    return changes_since(feed, commits, start_time, end_time)


def register_changes_view(feed: DataFrame, name: str) -> None:
    """Make the feed available to SQL; a range is WHERE _commit_version BETWEEN a AND b."""
    check_feed(feed)
    feed.createOrReplaceTempView(name)


def register_changes_function(feed: DataFrame, name: str) -> None:
    """A SQL table function `name(start_version, end_version)` over a feed, both ends inclusive.

    Without the second argument the range has no end.  SELECT * FROM name(20, 60) gives what `changes_between`
    gives, and the bounds reach the scan.  The feed is registered as the view `<name>_feed`.
    """
    if not name.isidentifier():
        raise ValueError(f"{name!r} is no name for a function")
    register_changes_view(feed, f"{name}_feed")
    feed.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
        "(start_version BIGINT, end_version BIGINT DEFAULT 9223372036854775807) RETURNS TABLE "
        f"RETURN SELECT * FROM {name}_feed f "
        f"WHERE f.{COMMIT_VERSION} >= {name}.start_version AND f.{COMMIT_VERSION} <= {name}.end_version"
    )


def stream_table(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """An append stream over a folder of parquet files with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_changes(
    spark: SparkSession,
    path: str,
    schema: StructType,
    start: int,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The feed as a stream from an explicit first version (1 is the first with a feed)."""
    if start < 0:
        raise ValueError("the first version of a feed stream cannot be negative")
    missing = [c for c in FEED_COLUMNS if c not in schema.names]
    if missing:
        raise ValueError(f"the declared schema lacks {missing}")
    return stream_table(spark, path, schema, files_per_batch).where(F.col(COMMIT_VERSION) >= start)


def incremental_slice(feed: DataFrame, progress: DataFrame, source: str) -> DataFrame:
    """Rows after the last version that `progress` holds for the source (0 without a row)."""
    last = progress.where(F.col("source") == source).agg(
        F.coalesce(F.max("last_version"), F.lit(0)).alias("v")
    )
    return feed.where(F.col(COMMIT_VERSION) > last.scalar())


def rows_by_file_time(df: DataFrame, since: datetime | Column) -> DataFrame:
    """Rows that came with files written after a time, for a frame read from files."""
    return df.where(F.col("_metadata.file_modification_time") > _column(since))


def ordered_feed(feed: DataFrame, *first: str) -> DataFrame:
    """The feed sorted by version, or by the given columns and then by version."""
    return feed.orderBy(*first, COMMIT_VERSION)


def _column(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
