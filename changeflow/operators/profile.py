"""Profiles of columns per block of versions, of sketches that add up.

A profile holds one row per column and block: counts, a HyperLogLog sketch of the values and a
quantile sketch of the numbers.  Profiles of two ranges merge without another look at their rows, so a new
range costs a scan of itself only, whatever has been profiled before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from changeflow.contracts import COMMIT_VERSION, require_columns
from changeflow.sources.feed import changes_between
from changeflow.sources.storage import children

# Sketch sizes. 2^12 registers estimate distinct values with a relative standard error of about 1.6
# percent; a k of 200 gives ranks within about 1.7 percent.
REGISTERS_LOG2 = 12
QUANTILE_K = 200

#: Standard errors of the two sketches, for whoever compares with exact figures.
DISTINCT_ERROR = 0.0165
RANK_ERROR = 0.0175


def column_profile(
    rows: DataFrame, columns: Sequence[str], block: int, version: str = COMMIT_VERSION
) -> DataFrame:
    """One row per column and block of `block` versions: counts, first version with a value, sketches.

    One scan and one shuffle of sketches, combined on the map side: a row is never repeated per
    column.  Values are compared as text.  A column without numbers has no quantile sketch, an
    empty table no rows.
    """
    require_columns(rows, [*columns, version], "profiled table")
    kinds = {f.name: f.dataType for f in rows.schema}
    cells = {c: _aggregates(c, kinds[c], version) for c in columns}
    by_block = rows.groupBy(F.expr(f"`{version}` div {int(block)}").alias("block")).agg(
        F.count("*").alias("rows"),
        F.min(version).alias("from_version"),
        F.max(version).alias("to_version"),
        *[F.struct(*parts).alias(f"cell_{i}") for i, parts in enumerate(cells.values())],
    )
    named = [F.struct(F.lit(c).alias("column"), F.col(f"cell_{i}").alias("cell")) for i, c in enumerate(columns)]
    return by_block.select("block", "rows", "from_version", "to_version", F.inline(F.array(*named))).select(
        "column", "block", "rows", "from_version", "to_version", "cell.*"
    )


def _aggregates(column: str, kind: DataType, version: str) -> list[Column]:
    value = F.col(column)
    numbers = value.cast("double") if isinstance(kind, NumericType) else F.lit(None).cast("double")
    return [
        F.count(value).alias("non_null_rows"),
        F.min(F.when(value.isNotNull(), F.col(version))).alias("first_version"),
        F.count(numbers).alias("numbers"),
        F.hll_sketch_agg(value.cast("string"), REGISTERS_LOG2).alias("distinct_sketch"),
        F.kll_sketch_agg_double(numbers, QUANTILE_K).alias("quantile_sketch"),
    ]


def merge_profiles(profile: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """Rows of a profile, or of several under one another, added up to one per column (or other columns of it)."""
    return profile.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.min("from_version").alias("from_version"),
        F.max("to_version").alias("to_version"),
        F.sum("non_null_rows").alias("non_null_rows"),
        F.min("first_version").alias("first_version"),
        F.sum("numbers").alias("numbers"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch", QUANTILE_K).alias("quantile_sketch"),
    )


def profile_estimates(merged: DataFrame, quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """What the sketches say: about how many distinct values, and the quantiles (NULL without numbers)."""
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.select(
        *[c for c in merged.columns if c not in ("distinct_sketch", "quantile_sketch", "numbers")],
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", ranks)).alias("quantiles"),
    )


def profile_shift(before: DataFrame, after: DataFrame) -> DataFrame:
    """How each column moved from one range of versions to another, from their profiles alone.

    Null percents, estimates of distinct values, of values the earlier range did not have, and the
    medians.  A column of one side only has NULL on the other.
    """
    sides = {name: _side(profile, name) for name, profile in (("before", before), ("after", after))}
    both = sides["before"].join(sides["after"], "column", "full_outer")
    known = F.hll_sketch_estimate("before.distinct_sketch")
    either = F.hll_sketch_estimate(F.hll_union("before.distinct_sketch", "after.distinct_sketch"))
    return both.select(
        "column",
        *[F.col(f"{name}.non_null_rows").alias(f"non_null_{name}") for name in sides],
        *[
            ((F.col(f"{name}.rows") - F.col(f"{name}.non_null_rows")) * 100 / F.col(f"{name}.rows")).alias(
                f"null_percent_{name}"
            )
            for name in sides
        ],
        *[F.hll_sketch_estimate(f"{name}.distinct_sketch").alias(f"distinct_{name}") for name in sides],
        F.greatest(either - known, F.lit(0)).alias("new_values"),
        *[_median(name).alias(f"median_{name}") for name in sides],
    )


def _side(profile: DataFrame, name: str) -> DataFrame:
    merged = merge_profiles(profile)
    return merged.select("column", F.struct(*[c for c in merged.columns if c != "column"]).alias(name))


def _median(side: str) -> Column:
    middle = F.kll_sketch_get_quantile_double(f"{side}.quantile_sketch", F.lit(0.5))
    return F.when(F.col(f"{side}.numbers") > 0, middle)


def store_profile(
    feed: DataFrame, path: str, first: int, last: int, columns: Sequence[str], block: int
) -> None:
    """Profile a version range, both ends included, beside the ranges stored before; only its rows are read.

    A retry of the same range replaces it; a range that overlaps another is refused, since its
    versions would count twice.
    """
    if first > last or first < 0:
        raise ValueError(f"the range {first} to {last} is empty or starts below 0")
    for held_first, held_last in stored_ranges(feed.sparkSession, path):
        if (held_first, held_last) != (first, last) and first <= held_last and held_first <= last:
            raise ValueError(f"versions {first} to {last} overlap the stored profile of {held_first} to {held_last}")
    rows = column_profile(changes_between(feed, first, last), columns, block)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_RANGE}{first}-{last}")


_RANGE = "versions="


def stored_ranges(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The ranges that `store_profile` has written whole, in order."""
    path = path.rstrip("/")
    names = [x for x in children(spark, path) if x.startswith(_RANGE)]
    whole = [x[len(_RANGE) :].split("-") for x in names if "_SUCCESS" in children(spark, f"{path}/{x}")]
    return sorted((int(first), int(last)) for first, last in whole)


def read_profile(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """The stored ranges that lie within the given versions; folders of others are not opened."""
    held = [r for r in stored_ranges(spark, path) if r[0] >= first and (last is None or r[1] <= last)]
    if not held:
        raise ValueError(f"no profile is stored for versions {first} to {last}")
    parts = [f"{path.rstrip('/')}/{_RANGE}{a}-{b}" for a, b in held]
    return spark.read.parquet(*parts)
