"""Comparing two large tables by digests of groups, level by level, before any row is compared.

The digest of a group is its row count, the sum of one hash and the exclusive-or of another over its rows.
Groups are coarse first (a date) and finer below (a version): only rows of groups that differ
go on to the next level, and only those of the last level are shuffled as whole rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.sources.storage import shared_folder

Level = Sequence[str | Column]


def _hash(df: DataFrame, seed: int) -> Column:
    """A hash of a whole row that tells NULL apart in every column."""
    return F.xxhash64(F.lit(seed), *[x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def _named(by: Level) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(f"__group_{i}") for i, c in enumerate(by)]


def _slim(df: DataFrame, by: Level, sign: int) -> DataFrame:
    return df.select(
        *_named(by), F.lit(sign).alias("n"), _hash(df, 1).cast("decimal(20,0)").alias("one"), _hash(df, 2).alias("two")
    )


def group_digests(df: DataFrame, by: Level) -> DataFrame:
    """(groups, rows, hash_sum, hash_xor) of every group; combined on the map side, whatever a group's size."""
    slim = _slim(df, by, 1)
    return slim.groupBy(*slim.columns[: len(by)]).agg(
        F.sum("n").alias("rows"), F.sum("one").alias("hash_sum"), F.bit_xor("two").alias("hash_xor")
    )


def differing_groups(left: DataFrame, right: DataFrame, by: Level) -> DataFrame:
    """The groups whose digests differ between two tables of the same columns, or that one of them lacks."""
    both = _slim(left, by, 1).union(_slim(right.select(*left.columns), by, -1))
    groups = both.columns[: len(by)]
    found = both.groupBy(*groups).agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("one")).alias("sums"), F.bit_xor("two").alias("xors")
    )
    return found.where("rows <> 0 OR sums <> 0 OR xors <> 0").select(*groups)


def only_differing(left: DataFrame, right: DataFrame, levels: Sequence[Level]) -> tuple[DataFrame, DataFrame]:
    """Both tables without the groups that agree; both are empty, without any scan, if all agree.

    Each level is one aggregate over the rows that are left; what it finds is a small table of groups,
    which adaptive execution broadcasts by its size.
    """
    shared_folder(left.sparkSession)  # the groups are kept there
    right = right.select(*left.columns)
    for by in levels:
        found = differing_groups(left, right, by).checkpoint()
        if found.isEmpty():
            none = left.sparkSession.createDataFrame([], left.schema)
            return none, none
        left, right = _within(left, found, by), _within(right, found, by)
    return left, right


def _within(df: DataFrame, found: DataFrame, by: Level) -> DataFrame:
    keyed = df.select("*", *_named(by))
    same = [F.col(f"d.__group_{i}").eqNullSafe(F.col(f"f.__group_{i}")) for i in range(len(by))]
    kept = keyed.alias("d").join(found.alias("f"), same, "left_semi")
    return kept.select(*[F.col(f"d.`{c}`") for c in df.columns])
