"""Null-safe comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType


def same(left: Column, right: Column) -> Column:
    """Equal, where two NULLs are equal too."""
    return left.eqNullSafe(right)


def orderable(value: Column, kind: DataType) -> Column:
    """A value that can be compared: of a map its entries in key order, of anything else itself."""
    return F.array_sort(F.map_entries(value)) if isinstance(kind, MapType) else value


def all_same(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, (same(x, y) for x, y in pairs), F.lit(True))


def any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when at least one pair differs; NULL to value counts as a difference."""
    return reduce(lambda a, b: a | b, (~same(x, y) for x, y in pairs), F.lit(False))


def null_semantics_diff(left: str, right: str, columns: Sequence[str]) -> Column:
    """`any_differs` over equally named columns of two aliased frames."""
    return any_differs([(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in columns])


def keys_match(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition on equally named keys of two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        (F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys),
    )
