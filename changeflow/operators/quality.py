"""Expectations, NOT NULL checks, schema allow-lists and the impact of drift."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from changeflow.contracts import FEED_COLUMNS
from changeflow.functions.compare import all_same, same
from changeflow.functions.ordered import KeyOrder
from changeflow.operators.scd import Scd2
from changeflow.sources.feed import changes_between

log = logging.getLogger(__name__)


def expect_or_drop(
    df: DataFrame, name: str, predicate: Column, report: Observation | None = None
) -> DataFrame:
    """Rows that meet the predicate; NULL counts as a violation.

    The observation, filled while the frame is written, holds `<name>_dropped`.
    """
    return _observed(df, name, predicate, "dropped", report).where(F.coalesce(predicate, F.lit(False)))


def expect(df: DataFrame, name: str, predicate: Column, report: Observation | None = None) -> DataFrame:
    """All rows; the observation holds `<name>_violations`."""
    return _observed(df, name, predicate, "violations", report)


def expect_or_fail(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """All rows, or a failing job at the first violation."""
    met = F.coalesce(predicate, F.lit(False))
    text = F.lit(f"expectation {name} is violated")
    return df.where(F.when(met, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def _observed(
    df: DataFrame, name: str, predicate: Column, what: str, report: Observation | None
) -> DataFrame:
    if report is None:
        return df
    broken = F.count(F.when(~F.coalesce(predicate, F.lit(False)), 1))
    return df.observe(report, broken.alias(f"{name}_{what}"))


def enforce_not_null(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep NOT NULL, rows that break it with the columns they break)."""
    broken = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    split = df.withColumn("null_columns", broken)
    good = split.where(F.size("null_columns") == 0).drop("null_columns")
    return good, split.where(F.size("null_columns") > 0)


def reject_nulls(df: DataFrame, columns: Sequence[str], report: Observation | None = None) -> DataFrame:
    """All rows, or a failing job at the first NULL in one of the columns, as a NOT NULL sink does.

    With a report nothing fails: rows with a NULL are dropped and counted as `not_null_dropped`
    in the pass that writes the others.
    """
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns], F.lit(True))
    if report is not None:
        return expect_or_drop(df, "not_null", whole, report)
    return expect_or_fail(df, "not_null", whole)


@dataclass(frozen=True)
class Difference:
    """One field, by its dotted path, that differs between two schemas; None where it is absent."""

    path: str
    expected: str | None
    found: str | None


def _fields(schema: StructType, prefix: str = "") -> dict[str, str]:
    """Type of every field by path; fields of structs and of arrays of structs are listed, too."""
    out = {}
    for field in schema:
        path, kind = prefix + field.name, field.dataType
        while isinstance(kind, ArrayType):
            path, kind = path + "[]", kind.elementType
        if isinstance(kind, StructType):
            out[path] = "struct"
            out |= _fields(kind, path + ".")
        else:
            out[path] = kind.simpleString()
    return out


def schema_drift(found: StructType, expected: StructType, metadata: Iterable[str] = FEED_COLUMNS) -> list[Difference]:
    """Where a schema differs from the reviewed one, in path order: new, absent and retyped fields.

    A pure comparison: `refuse_drift` decides what it means.  Metadata columns are not looked at.
    """
    ignored = set(metadata)
    have = _fields(StructType([f for f in found if f.name not in ignored]))
    want = _fields(StructType([f for f in expected if f.name not in ignored]))
    return [
        Difference(path, want.get(path), have.get(path))
        for path in sorted(have.keys() | want.keys())
        if want.get(path) != have.get(path)
    ]


def refuse_drift(differences: Iterable[Difference]) -> None:
    """Raise if a field is new or has another type; an absent field reads as NULL and passes."""
    bad = [d for d in differences if d.found is not None]
    if bad:
        told = "; ".join(f"{d.path} is {d.found}, reviewed as {d.expected or 'nothing'}" for d in bad)
        raise ValueError(f"the schema was not reviewed: {told}")


def safe_cdf_read(
    feed: DataFrame, start: int, expected: StructType, end: int | None = None
) -> DataFrame:
    """A version range in the shape a consumer declared, whatever its source has become.

    Expected columns come in the declared order and type, absent ones as NULL; other data
    columns stay out.  Differences are logged.
    """
    for d in schema_drift(feed.schema, expected):
        log.warning("feed column %s: expected %s, found %s", d.path, d.expected, d.found)
    present = set(feed.columns)
    shaped = {f.name: (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType) for f in expected}
    rows = changes_between(feed, start, end)
    return rows.select(*[value.alias(name) for name, value in shaped.items()], *FEED_COLUMNS)


def drift_impact(events: DataFrame, spec: Scd2, suspects: Sequence[str], version: str) -> DataFrame:
    """What each unreviewed column would do to a Type 2 dimension.

    Per column: non-null rows, distinct values, first version seen, and the number of
    versions that only this column would make: live events that repeat the event
    before them on all tracked columns and differ on the suspect.
    """
    slim = events.select(
        *dict.fromkeys([*spec.keys, *spec.sequence, *spec.track, version, *suspects]),
        spec.gone().alias("gone"),
    )
    order = KeyOrder(slim, spec.keys, spec.sequence)
    compared = list(dict.fromkeys([*spec.track, *suspects, "gone"]))
    seen = order.with_previous(slim, compared, "before")
    quiet = (
        F.col("before").isNotNull()
        & ~F.col("before.gone")
        & ~F.col("gone")
        & all_same([(F.col(c), F.col(f"before.{c}")) for c in spec.track])
    )
    # One row per (event, suspect); values compared as text, NULL kept apart.
    long = seen.select(
        F.col(version).alias("version"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("suspect"),
                        F.col(c).cast("string").alias("value"),
                        (quiet & ~same(F.col(c), F.col(f"before.{c}"))).alias("spurious"),
                    )
                    for c in suspects
                ]
            )
        ).alias("s"),
    ).select("version", "s.*")
    # Distinct values first: the second aggregate then sees each value once.
    by_value = long.groupBy("suspect", "value").agg(
        F.count("*").alias("rows"),
        F.min("version").alias("first_version"),
        F.count(F.when(F.col("spurious"), 1)).alias("spurious"),
    )
    present = F.col("value").isNotNull()
    return by_value.groupBy("suspect").agg(
        F.coalesce(F.sum(F.when(present, F.col("rows"))), F.lit(0)).alias("non_null_rows"),
        F.count("value").alias("distinct_values"),
        F.min(F.when(present, F.col("first_version"))).alias("first_version"),
        F.sum("spurious").alias("spurious_versions"),
    )
