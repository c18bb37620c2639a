"""The commit ledger: history, latest commit, ranges with and without a feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.contracts import DATA_OPERATIONS
from changeflow.functions.ordered import KeyOrder


def commit_history(commits: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Commits with lo < version <= hi in version order, as a recovery reads them."""
    rows = commits
    if lo is not None:
        rows = rows.where(F.col("version") > lo)
    if hi is not None:
        rows = rows.where(F.col("version") <= hi)
    return rows.orderBy("version")


def of_one_source(commits: DataFrame, value: Column, source: str | None = None) -> DataFrame:
    """An aggregate over the commits of one source, as one row with the column `v`.

    Versions of different tables don't compare: without `source`, a ledger that holds several
    fails the job in the same aggregate.
    """
    if source is not None:
        return commits.where(F.col("source") == source).agg(value.alias("v"))
    if "source" not in commits.columns:
        return commits.agg(value.alias("v"))
    several = ~F.min("source").eqNullSafe(F.max("source"))
    refusal = F.raise_error(F.lit("the commit ledger holds several sources; name one"))
    return commits.agg(value.alias("v"), F.when(several, refusal).cast("string").alias("refusal")).where(
        F.col("refusal").isNull()
    ).select("v")


def latest_commit(commits: DataFrame, source: str | None = None) -> DataFrame:
    """The newest commit of a source, as one row; none for an empty ledger."""
    newest = F.max_by(F.struct(*commits.columns), "version")
    return of_one_source(commits, newest, source).where("v IS NOT NULL").select("v.*")


def latest_version(commits: DataFrame, source: str | None = None) -> int:
    """The newest version of a source as a number; 0 for an empty ledger."""
    return of_one_source(commits, F.coalesce(F.max("version"), F.lit(0)), source).first()["v"]


def since_commit(
    df: DataFrame, time: str, commits: DataFrame, version: int, source: str | None = None
) -> DataFrame:
    """Rows whose time is after the timestamp of one commit of a source."""
    at = of_one_source(commits, F.max(F.when(F.col("version") == version, F.col("timestamp"))), source)
    return df.where(F.col(time) > at.scalar())


def with_feed_range(commits: DataFrame) -> DataFrame:
    """Add range_start: the first version of the run of equal feed_enabled flags."""
    order = KeyOrder(commits, ["source"], ["version"])
    flagged = order.with_previous(commits, ["feed_enabled"], "before")
    starts = F.col("before").isNull() | (F.col("before.feed_enabled") != F.col("feed_enabled"))
    ranged = order.with_last_known(flagged, F.when(starts, F.col("version")), "range_start")
    return order.finish(ranged).drop("before")


def feed_enabled_ranges(commits: DataFrame) -> DataFrame:
    """Maximal version ranges with the feed on or off, per source."""
    return (
        with_feed_range(commits)
        .groupBy("source", "feed_enabled", "range_start")
        .agg(F.max("version").alias("last_version"), F.count("*").alias("commits"))
        .withColumnRenamed("range_start", "first_version")
    )


def gap_window(commits: DataFrame) -> DataFrame:
    """Ranges with the feed off in which data changed, with what happened inside.

    Maintenance commits alone make no gap.
    """
    op = F.col("operation")
    data = op.isin(*DATA_OPERATIONS)

    def n(kind: str) -> Column:
        return F.count(F.when(op == kind, 1))

    return (
        with_feed_range(commits)
        .where(~F.col("feed_enabled"))
        .groupBy("source", "range_start")
        .agg(
            F.max("version").alias("last_version"),
            F.min(F.when(data, F.col("version"))).alias("first_data_version"),
            F.max(F.when(data, F.col("version"))).alias("last_data_version"),
            n("INSERT").alias("inserts"),
            n("UPDATE").alias("updates"),
            n("DELETE").alias("deletes"),
            F.count(F.when(data, 1)).alias("data_commits"),
            F.count("*").alias("commits"),
        )
        .where(F.col("data_commits") > 0)
        .withColumnRenamed("range_start", "first_version")
        .withColumn("insert_only", F.col("inserts") == F.col("data_commits"))
    )
