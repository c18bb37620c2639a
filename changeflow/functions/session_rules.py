"""The access rules as SQL functions over a session variable, for views written in SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

GROUPS_VARIABLE = "reader_groups"

# Spark inlines these; a view over them follows SET VARIABLE.
_FUNCTIONS = (
    "is_group_member(name STRING) RETURNS BOOLEAN RETURN array_contains(reader_groups, name)",
    "row_visible(value STRING) RETURNS BOOLEAN "
    "RETURN is_group_member(value) OR is_group_member('platform-admins')",
    "cover_text(value STRING, may_read STRING) RETURNS STRING "
    "RETURN CASE WHEN is_group_member(may_read) THEN value ELSE 'XXX' END",
    "cover_number(value DECIMAL(10,2), may_read STRING) RETURNS DECIMAL(10,2) "
    "RETURN CASE WHEN is_group_member(may_read) THEN value ELSE NULL END",
)


def install(spark: SparkSession, groups: Iterable[str] = ()) -> None:
    """Declare the variable and the functions, and sign a reader in."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {GROUPS_VARIABLE} ARRAY<STRING>")
    for f in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {f}")
    sign_in(spark, groups)


def sign_in(spark: SparkSession, groups: Iterable[str]) -> None:
    """Set the groups of the session's reader.

    A name goes into the statement as the hexadecimal digits of its UTF-8 bytes, so nothing
    in it can end the literal.
    """
    names = ", ".join(f"decode(X'{g.encode().hex()}', 'UTF-8')" for g in groups)
    spark.sql(f"SET VARIABLE {GROUPS_VARIABLE} = CAST(array({names}) AS ARRAY<STRING>)")
