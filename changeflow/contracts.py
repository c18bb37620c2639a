"""Column contracts of the tables that travel between the operators.

feed       data columns + _change_type, _commit_version, _commit_timestamp
commits    source, version, timestamp, operation, feed_enabled, retained
state      keys, attributes, last_commit_version, is_deleted
history    feed + captured_at + commit_date
dim2       keys, attributes, one __START_x / __END_x pair per sequence column
progress   source, last_version
principals principal, group_name
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The change types of a row-level change feed and its metadata columns.
INSERT = "insert"
PREIMAGE = "update_preimage"
POSTIMAGE = "update_postimage"
DELETE = "delete"
CHANGE_TYPES = (INSERT, PREIMAGE, POSTIMAGE, DELETE)

CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
FEED_COLUMNS = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)

LAST_VERSION = "last_commit_version"
IS_DELETED = "is_deleted"
CAPTURED_AT = "captured_at"
COMMIT_DATE = "commit_date"

# Operations of a commit that change rows; every other operation is maintenance.
DATA_OPERATIONS = ("INSERT", "UPDATE", "DELETE", "MERGE", "WRITE")


def data_columns(feed: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    """Columns of a feed that are neither metadata nor key, in order."""
    return [c for c in feed.columns if c not in FEED_COLUMNS and c not in keys]


def is_change(*types: str) -> Column:
    return F.col(CHANGE_TYPE).isin(*types)


def change_rank() -> Column:
    """Order of change types inside one commit of one key: the net result ranks last."""
    kind = F.col(CHANGE_TYPE)
    return (
        F.when(kind == PREIMAGE, 0)
        .when(kind == DELETE, 1)
        .when(kind == INSERT, 2)
        .when(kind == POSTIMAGE, 3)
        .otherwise(unknown_change().cast("int"))
    )


def unknown_change() -> Column:
    """Fails the job: a change type that is none of the four, or none at all."""
    return F.raise_error(F.concat(F.lit("unknown change type: "), F.coalesce(F.col(CHANGE_TYPE), F.lit("NULL"))))


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}; it has {df.columns}")


def check_feed(feed: DataFrame, keys: Sequence[str] = ()) -> None:
    require_columns(feed, [*keys, *FEED_COLUMNS], "change feed")
