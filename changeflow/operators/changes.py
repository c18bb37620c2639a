"""Filters, projections, pairing and aggregates on a change feed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.contracts import (
    CAPTURED_AT,
    CHANGE_TYPE,
    COMMIT_TIMESTAMP,
    COMMIT_VERSION,
    DELETE,
    FEED_COLUMNS,
    INSERT,
    IS_DELETED,
    LAST_VERSION,
    POSTIMAGE,
    PREIMAGE,
    change_rank,
    data_columns,
    is_change,
    unknown_change,
)
from changeflow.functions.compare import any_differs, orderable, same
from changeflow.operators.digest import Level, only_differing


def filter_change_type(feed: DataFrame, types: Sequence[str]) -> DataFrame:
    """Rows of the given change types; the list reaches the scan as IN."""
    return feed.where(is_change(*types))


def without_preimages(feed: DataFrame) -> DataFrame:
    """All rows but pre-images; rows of unknown type stay, so that what folds them can refuse them."""
    return feed.where(~F.col(CHANGE_TYPE).eqNullSafe(PREIMAGE))


def project_sink(feed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the columns the sink knows, and the feed metadata."""
    return feed.select(*columns, *FEED_COLUMNS)


def except_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def with_capture_time(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add the time of ingest; a fixed value makes a run repeatable."""
    return df.withColumn(CAPTURED_AT, F.current_timestamp() if at is None else at)


def inject_column(df: DataFrame, name: str, value) -> DataFrame:
    """A column nobody reviewed, to try the drift checks with."""
    return df.withColumn(name, F.lit(value))


def union_changes(parts: Iterable[DataFrame]) -> DataFrame:
    """All rows of the parts, matched by column name."""
    return reduce(DataFrame.unionByName, parts)


def pair_images(feed: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Pre-image and post-image of every update as one row of <c>_before and <c>_after.

    One shuffle on (keys, version) with map-side aggregation, in place of a self join:
    copies of a redelivered commit fall together and do not multiply.  Any of several
    copies is taken as a whole, so columns need no order and may be maps.
    """
    columns = list(columns) if columns is not None else data_columns(feed, keys)
    row = F.struct(*columns)
    kind = F.col(CHANGE_TYPE)
    paired = (
        feed.where(is_change(PREIMAGE, POSTIMAGE))
        .groupBy(*keys, COMMIT_VERSION)
        .agg(
            F.any_value(F.when(kind == PREIMAGE, row), F.lit(True)).alias("pre"),
            F.any_value(F.when(kind == POSTIMAGE, row), F.lit(True)).alias("post"),
            F.max(COMMIT_TIMESTAMP).alias(COMMIT_TIMESTAMP),
        )
        .where(F.col("pre").isNotNull() & F.col("post").isNotNull())
    )
    images = [
        F.col(f"{side}.{c}").alias(f"{c}_{name}")
        for c in columns
        for side, name in (("pre", "before"), ("post", "after"))
    ]
    return paired.select(*keys, COMMIT_VERSION, COMMIT_TIMESTAMP, *images)


def changed_columns(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The names of the columns an update really changed, for partial replication."""
    columns = data_columns(feed, keys)

    def value(name: str, column: str) -> Column:
        return orderable(F.col(name), feed.schema[column].dataType)

    names = F.array_compact(
        F.array(*[F.when(~same(value(f"{c}_before", c), value(f"{c}_after", c)), F.lit(c)) for c in columns])
    )
    return pair_images(feed, keys).select(*keys, COMMIT_VERSION, names.alias("changed"))


COLUMN_VERSIONS = "column_versions"


def column_deltas(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changes that carry only what changed, as partial states that `fold_columns` adds up.

    keys, the data columns (NULL unless changed), column_versions (the version of every column that changed, NULL
    for the others), last_commit_version, is_deleted.  An insert sets all columns, a delete none.
    """
    columns = data_columns(feed, keys)
    kind = F.col(CHANGE_TYPE)
    whole = feed.where(is_change(INSERT, DELETE)).select(
        *keys,
        *[F.when(kind == INSERT, F.col(c)).alias(c) for c in columns],
        F.struct(*[F.when(kind == INSERT, F.col(COMMIT_VERSION)).alias(c) for c in columns]).alias(COLUMN_VERSIONS),
        F.col(COMMIT_VERSION).alias(LAST_VERSION),
        (kind == DELETE).alias(IS_DELETED),
    )

    def moved(c: str) -> Column:
        values = [orderable(F.col(f"{c}_{side}"), feed.schema[c].dataType) for side in ("before", "after")]
        return ~same(*values)

    updates = pair_images(feed, keys).select(
        *keys,
        *[F.when(moved(c), F.col(f"{c}_after")).alias(c) for c in columns],
        F.struct(*[F.when(moved(c), F.col(COMMIT_VERSION)).alias(c) for c in columns]).alias(COLUMN_VERSIONS),
        F.col(COMMIT_VERSION).alias(LAST_VERSION),
        F.lit(False).alias(IS_DELETED),
    )
    return whole.unionByName(updates)


def fold_columns(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One partial state per key from many: every column has the value of its own greatest version.

    Parts may come in any order and more than once, and be folds themselves.  A key is deleted if
    its last change is a delete; a live row stands above a delete of its version.
    """
    columns = [c for c in parts.columns if c not in (*keys, COLUMN_VERSIONS, LAST_VERSION, IS_DELETED)]
    of = {c: F.col(f"{COLUMN_VERSIONS}.{c}") for c in columns}
    last = F.struct(LAST_VERSION, ~F.col(IS_DELETED))
    folded = parts.groupBy(*keys).agg(
        *[F.max_by(F.struct(c), of[c]).alias(c) for c in columns],
        F.struct(*[F.max(of[c]).alias(c) for c in columns]).alias(COLUMN_VERSIONS),
        F.max(LAST_VERSION).alias(LAST_VERSION),
        F.max_by(IS_DELETED, last).alias(IS_DELETED),
    )
    return folded.select(*keys, *[F.col(f"{c}.{c}").alias(c) for c in columns], COLUMN_VERSIONS, LAST_VERSION, IS_DELETED)


def tracked_updates(feed: DataFrame, keys: Sequence[str], track: Sequence[str]) -> DataFrame:
    """Post-images whose tracked columns differ from their pre-image, as feed rows.

    Pre- and post-image meet in one aggregate on (keys, version).
    """
    kind = F.col(CHANGE_TYPE)
    columns = [c for c in feed.columns if c not in keys and c != COMMIT_VERSION]
    pairs = (
        feed.where(is_change(PREIMAGE, POSTIMAGE))
        .groupBy(*keys, COMMIT_VERSION)
        .agg(
            F.any_value(F.when(kind == PREIMAGE, F.struct(*track)), F.lit(True)).alias("pre"),
            F.any_value(F.when(kind == POSTIMAGE, F.struct(*columns)), F.lit(True)).alias("post"),
        )
        .where(F.col("pre").isNotNull() & F.col("post").isNotNull())
    )
    kinds = {c: feed.schema[c].dataType for c in track}
    changed = any_differs(
        [tuple(orderable(F.col(f"{side}.{c}"), kinds[c]) for side in ("pre", "post")) for c in track]
    )
    return pairs.where(changed).select(*keys, COMMIT_VERSION, "post.*").select(*feed.columns)


def scd2_effect(feed: DataFrame, keys: Sequence[str], track: Sequence[str]) -> DataFrame:
    """The feed rows a Type 2 target keeps: inserts, deletes and tracked updates."""
    return union_changes([filter_change_type(feed, [INSERT, DELETE]), tracked_updates(feed, keys, track)])


def tombstones(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deletes as key, version and marker, for sinks that cannot delete."""
    return feed.where(is_change(DELETE)).select(*keys, COMMIT_VERSION, F.lit(True).alias("is_deleted"))


def change_summary(feed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per change type, optionally per day or per version; an update counts twice."""
    return feed.groupBy(*by, CHANGE_TYPE).agg(F.count("*").alias("rows"))


def distinct_versions(feed: DataFrame) -> DataFrame:
    """The versions that occur in the feed."""
    return feed.select(COMMIT_VERSION).distinct()


def version_span(feed: DataFrame) -> DataFrame:
    """First, last and number of distinct versions, as one row."""
    return distinct_versions(feed).agg(
        F.min(COMMIT_VERSION).alias("first_version"),
        F.max(COMMIT_VERSION).alias("last_version"),
        F.count("*").alias("versions"),
    )


def high_water_mark(sink: DataFrame, by: Sequence[str] = (), column: str = COMMIT_VERSION) -> DataFrame:
    """The greatest version in the sink, 0 when it is empty."""
    return sink.groupBy(*by).agg(F.coalesce(F.max(column), F.lit(0)).alias("high_water_mark"))


def latest_by_key(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last image of every key, deletes included.

    max_by combines on the map side, so a key with very many rows leaves each
    map task as one row.
    """
    rest = [c for c in feed.columns if c not in keys]
    place = F.struct(COMMIT_VERSION, change_rank())
    return (
        without_preimages(feed)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), place).alias("row"))
        .select(*keys, "row.*")
        .select(*feed.columns)
    )


def dedupe_latest(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last image of every key by ROW_NUMBER, whole rows.

    Spark limits each key to one row before the shuffle (WindowGroupLimit).
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(COMMIT_VERSION).desc(), change_rank().desc())
    return (
        without_preimages(feed)
        .withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") == 1)
        .drop("rn")
    )


def signed(feed: DataFrame) -> DataFrame:
    """Add the sign of a change: +1 for a row that appears, -1 for one that goes."""
    arrives, goes = is_change(INSERT, POSTIMAGE), is_change(PREIMAGE, DELETE)
    return feed.withColumn("sign", F.when(arrives, 1).when(goes, -1).otherwise(unknown_change().cast("int")))


def signed_aggregate(
    feed: DataFrame, group: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """How the changes alter count and sums per group; a zero count can still move a sum."""
    sums = [F.sum(F.col("sign") * F.col(c)).alias(name) for name, c in measures.items()]
    return signed(feed).groupBy(*group).agg(F.sum("sign").alias("rows"), *sums)


def incremental_aggregate(
    feed: DataFrame, group: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """Count and sums of the live table per group, from all its signed changes alone.

    `measures` maps an output name to a column; decimals keep the sums exact.
    A row that changes its group leaves one and enters the other.
    """
    return signed_aggregate(feed, group, measures).where(F.col("rows") != 0)


def add_aggregates(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Metrics from the signed aggregates of many slices; groups that ran empty go."""
    sums = [F.sum(c).alias(c) for c in parts.columns if c not in group]
    return parts.groupBy(*group).agg(*sums).where(F.col("rows") != 0)


def reconcile(left: DataFrame, right: DataFrame, levels: Sequence[Level] = ()) -> DataFrame:
    """Rows that one side has more often than the other: side and number of extra copies.

    One aggregate over the union of both sides instead of two set differences.  With levels digests of
    groups are compared first, coarse ones before fine ones, and only rows of groups that differ are shuffled.
    """
    if levels:
        left, right = only_differing(left, right, levels)
    columns = left.columns
    tagged = left.withColumn("n", F.lit(1)).unionByName(right.withColumn("n", F.lit(-1)))
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") != 0)
        .select(
            *columns,
            F.when(F.col("n") > 0, "left").otherwise("right").alias("only_in"),
            F.abs("n").alias("copies"),
        )
    )
