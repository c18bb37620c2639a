"""Current-state tables: snapshots, diffs, DML, MERGE and version-guarded apply."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, MapType, StructField, StructType

from changeflow.contracts import (
    CHANGE_TYPE,
    COMMIT_TIMESTAMP,
    COMMIT_VERSION,
    DELETE,
    INSERT,
    IS_DELETED,
    LAST_VERSION,
    POSTIMAGE,
    PREIMAGE,
    data_columns,
    is_change,
    unknown_change,
)
from changeflow.functions.compare import any_differs, keys_match
from changeflow.operators.changes import latest_by_key, without_preimages


def empty_state(spark: SparkSession, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A state without rows that fits a feed."""
    fields = [feed.schema[c] for c in [*keys, *data_columns(feed, keys)]]
    fields += [StructField(LAST_VERSION, LongType()), StructField(IS_DELETED, BooleanType())]
    return spark.createDataFrame([], StructType(fields))


def current_snapshot(state: DataFrame) -> DataFrame:
    """The live rows of a state."""
    return state.where(~F.col(IS_DELETED)).drop(IS_DELETED)


def _fold(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the row of the greatest version; a delete keeps key and version only.

    Within a version a live row is the net result and stands above a delete.  A feed has one
    live image per key and version; if there are more, a hash of the values decides.  All of
    it can be seen in a stored row, so the result doesn't depend on the order of arrival.
    """
    hashed = [c for c in columns if not isinstance(rows.schema[c].dataType, MapType)]
    place = F.struct(LAST_VERSION, ~F.col(IS_DELETED), F.xxhash64(F.lit(0), *hashed))
    winner = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*columns, LAST_VERSION, IS_DELETED), place).alias("row")
    )
    values = [F.when(~F.col(f"row.{IS_DELETED}"), F.col(f"row.{c}")).alias(c) for c in columns]
    return winner.select(*keys, *values, f"row.{LAST_VERSION}", f"row.{IS_DELETED}")


def _events(feed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return without_preimages(feed).select(
        *keys,
        *columns,
        F.col(COMMIT_VERSION).alias(LAST_VERSION),
        F.when(is_change(DELETE), True)
        .when(is_change(INSERT, POSTIMAGE), False)
        .otherwise(unknown_change().cast("boolean"))
        .alias(IS_DELETED),
    )


def fold_feed(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state that a feed alone leads to, tombstones included."""
    columns = data_columns(feed, keys)
    return _fold(_events(feed, keys, columns), keys, columns)


def apply_changes_scd1(
    state: DataFrame, feed: DataFrame, keys: Sequence[str], floor: int | None = None
) -> DataFrame:
    """Apply change rows to a state, in any order and any number of times.

    The higher version wins and a live row stands above a delete of its version, so
    the result depends only on the set of rows ever seen.  A deleted key stays as a tombstone with its
    version; otherwise a late older insert would bring it back.  `floor` is a
    version below which no row can arrive any more: older rows are left out and
    older tombstones are forgotten.

    State and feed meet in one aggregate: one shuffle, combined on the map side.
    """
    columns = [c for c in state.columns if c not in (*keys, LAST_VERSION, IS_DELETED)]
    events = _events(feed, keys, columns)
    if floor is not None:
        events = events.where(F.col(LAST_VERSION) > floor)
    folded = _fold(state.unionByName(events), keys, columns)
    if floor is not None:
        folded = folded.where(~F.col(IS_DELETED) | (F.col(LAST_VERSION) > floor))
    return folded


def fold_states(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state from state rows of many batches: per key the highest version."""
    columns = [c for c in parts.columns if c not in (*keys, LAST_VERSION, IS_DELETED)]
    return _fold(parts, keys, columns)


def snapshot_as_of(feed: DataFrame, version: int, keys: Sequence[str]) -> DataFrame:
    """The live rows of the table at a version, by folding the feed up to it."""
    return current_snapshot(fold_feed(feed.where(F.col(COMMIT_VERSION) <= version), keys))


def snapshot_diff(
    pre: DataFrame, post: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """INSERT, UPDATE and DELETE between two snapshots, with both values of every column.

    Presence is a marker of its own and not a nullable column; NULL to value is a change.
    """
    before = pre.select(*keys, F.struct(*columns).alias("before"))
    after = post.select(*keys, F.struct(*columns).alias("after"))
    joined = before.join(after, list(keys), "full_outer")
    gone, new = F.col("after").isNull(), F.col("before").isNull()
    change = (
        F.when(new, "INSERT")
        .when(gone, "DELETE")
        .when(any_differs([(F.col(f"before.{c}"), F.col(f"after.{c}")) for c in columns]), "UPDATE")
    )
    values = [
        F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in columns for side in ("before", "after")
    ]
    return joined.select(*keys, change.alias("change"), *values).where(F.col("change").isNotNull())


@dataclass(frozen=True)
class Dml:
    """One INSERT, UPDATE or DELETE statement on a live table.

    Set the part you need.  An update writes both images for every row its
    predicate selects, even if no value changes; an insert never looks at
    existing keys; a delete writes the last values.
    """

    version: int
    timestamp: datetime | Column
    inserts: DataFrame | None = None
    update_where: Column | None = None
    update_set: Mapping[str, Column] = field(default_factory=dict)
    delete_where: Column | None = None


def _images(table: DataFrame, dml: Dml) -> DataFrame:
    """Every row of the table with the images this statement makes of it."""
    columns = table.columns
    delete = F.lit(False) if dml.delete_where is None else F.coalesce(dml.delete_where, F.lit(False))
    update = F.lit(False) if dml.update_where is None else F.coalesce(dml.update_where, F.lit(False))
    old = [F.col(c) for c in columns]
    new = [
        dml.update_set.get(c, F.col(c)).cast(table.schema[c].dataType).alias(c) for c in columns
    ]

    def image(kind: str, values: list[Column], keeps: bool) -> Column:
        return F.struct(F.lit(kind).alias(CHANGE_TYPE), F.lit(keeps).alias("keeps"), *values)

    images = (
        F.when(delete, F.array(image(DELETE, old, False)))
        .when(update, F.array(image(PREIMAGE, old, False), image(POSTIMAGE, new, True)))
        .otherwise(F.array(image("unchanged", old, True)))
    )
    rows = table.select(F.inline(images))
    if dml.inserts is not None:
        added = dml.inserts.select(F.lit(INSERT).alias(CHANGE_TYPE), F.lit(True).alias("keeps"), *columns)
        rows = rows.unionByName(added)
    return rows


def apply_dml(table: DataFrame, dml: Dml) -> tuple[DataFrame, DataFrame]:
    """(table after the statement, change rows of the statement), both without a shuffle."""
    images = _images(table, dml)
    after = images.where("keeps").select(*table.columns)
    feed = images.where(F.col(CHANGE_TYPE) != "unchanged").select(
        *table.columns,
        CHANGE_TYPE,
        F.lit(dml.version).cast("bigint").alias(COMMIT_VERSION),
        (dml.timestamp if isinstance(dml.timestamp, Column) else F.lit(dml.timestamp)).alias(COMMIT_TIMESTAMP),
    )
    return after, feed


@dataclass(frozen=True)
class Merge:
    """The clauses of a MERGE; conditions and values see the aliases t (target) and s (source).

    A clause that is None does not apply.  Conditions default to true.
    """

    delete_when: Column | None = None
    update_when: Column | None = None
    update_set: Mapping[str, Column] = field(default_factory=dict)
    insert_when: Column | None = None
    insert_values: Mapping[str, Column] = field(default_factory=dict)


def merge_state(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], clauses: Merge
) -> DataFrame:
    """The target after MERGE: matched delete, matched update, not matched insert.

    The batch is a feed; it is reduced to one row per key before the join, so that
    two versions of a new key cannot both be inserted.
    """
    source = latest_by_key(batch, keys)
    t = target.withColumn("in_target", F.lit(True)).alias("t")
    s = source.withColumn("in_source", F.lit(True)).alias("s")
    joined = t.join(s, keys_match("t", "s", keys), "full_outer")

    def holds(condition: Column | None) -> Column:
        return F.lit(False) if condition is None else F.coalesce(condition, F.lit(False))

    in_t, in_s = F.col("t.in_target").isNotNull(), F.col("s.in_source").isNotNull()
    action = (
        F.when(in_t & in_s & holds(clauses.delete_when), "delete")
        .when(in_t & in_s & holds(clauses.update_when), "update")
        .when(in_t, "keep")
        .when(holds(clauses.insert_when), "insert")
        .otherwise("skip")
    )

    def value(c: str) -> Column:
        kept = F.col(f"t.{c}")
        if c in keys:
            return F.coalesce(kept, F.col(f"s.{c}")).alias(c)
        updated = clauses.update_set.get(c, kept)
        inserted = clauses.insert_values.get(c, F.lit(None))
        return (
            F.when(F.col("action") == "update", updated)
            .when(F.col("action") == "insert", inserted)
            .otherwise(kept)
            .cast(target.schema[c].dataType)
            .alias(c)
        )

    return (
        joined.withColumn("action", action)
        .where(~F.col("action").isin("delete", "skip"))
        .select(*[value(c) for c in target.columns])
    )


def guarded_merge(keys: Sequence[str], columns: Sequence[str]) -> Merge:
    """The version-guarded MERGE without tombstones: newer deletes, newer values, new keys."""
    newer = F.col(f"s.{COMMIT_VERSION}") > F.col(f"t.{LAST_VERSION}")
    gone = F.col(f"s.{CHANGE_TYPE}") == DELETE
    values = {c: F.col(f"s.{c}") for c in columns}
    values[LAST_VERSION] = F.col(f"s.{COMMIT_VERSION}")
    return Merge(
        delete_when=gone & newer,
        update_when=~gone & newer,
        update_set=values,
        insert_when=~gone,
        insert_values=values,
    )

