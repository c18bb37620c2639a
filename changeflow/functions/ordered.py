"""Neighbours and running values in the order of a key's events.

The methods of `KeyOrder` are the window functions lag, lead, max and
last_value(ignore nulls) over a key.  A plain window puts all rows of one key
into one task.  Here one aggregate counts the rows per key first; when no key is
larger than the limit, the result is exactly that plain window.  A larger key is
cut into consecutive parts of its own sequence, the window runs per (key, part),
and one small row per part carries the value over the cut.  No row is dropped
and the result is the same.

The limit is `changeflow.hotKeyRows` of the session.  The number of cuts is
bounded whatever the data size, because the limit rises to total / MAX_PARTS.
A task sorts all rows of its parts, a few hundred bytes each, so parts are dealt to
twice as many tasks as there are parts: sized by bytes, a task gets as many parts
as narrow rows compress to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_KEY_ROWS_CONF = "changeflow.hotKeyRows"
HOT_KEY_ROWS = 250_000
MAX_PARTS = 10_000
# Fewer rows are not worth a task of their own, whatever the limit.
TASK_ROWS = 1_000
POINTS_PER_PART = 50

_SEED = 11
_HASH, _HOT, _PART, _DEAL, _EDGE = "__key_hash", "__hot", "__part", "__deal", "__edge"


class KeyOrder:
    """The event order of the keys of a frame, with its hot keys counted once.

    The methods take that frame or any later frame whose rows are some of its
    rows, so that several steps share one count.  If keys are cut, the part stays
    in the frame as a column, so that later steps find the rows where they are;
    `finish` takes it away.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]):
        self.keys = list(keys)
        self.order = list(order)
        self.cuts, self.steps, self.tasks = _hot_key_cuts(df, self.keys, self.order)

    def with_previous(self, df: DataFrame, columns: Sequence[str], into: str) -> DataFrame:
        """Add `into`: the struct of `columns` on the row just before, NULL on the first row."""
        return self._carry(df, F.struct(*columns), into, "previous")

    def with_next(self, df: DataFrame, columns: Sequence[str], into: str) -> DataFrame:
        """Add `into`: the struct of `columns` on the row just after, NULL on the last row."""
        return self._carry(df, F.struct(*columns), into, "next")

    def with_running_max(self, df: DataFrame, value: Column, into: str) -> DataFrame:
        """Add `into`: the largest `value` over all rows before this one."""
        return self._carry(df, value, into, "max")

    def with_last_known(self, df: DataFrame, value: Column, into: str) -> DataFrame:
        """Add `into`: the latest non-null `value` up to and including this row."""
        return self._carry(df, value, into, "last")

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(_HOT, _PART, _DEAL)

    def _carry(self, df: DataFrame, value: Column, into: str, kind: str) -> DataFrame:
        keys, order = self.keys, self.order
        if self.cuts is None:
            return df.withColumn(into, _over(value, kind, _window(keys, order)))

        # The mark belongs to the window keys so that the filter on it passes the window, the hash
        # so that rows stay where they were dealt to, also if the optimizer drops a constant key.
        by_part = [*keys, _HOT, _PART, _DEAL]
        parted = dealt = df
        if _PART not in df.columns:
            parted = _with_part(df, keys, order, self.cuts, self.steps)
            parted = parted.withColumn(_DEAL, F.xxhash64(*keys, _HOT, _PART))
            dealt = parted.repartition(self.tasks, _DEAL)
        local = dealt.withColumn(into, _over(value, kind, _window(by_part, order)))
        # One row per part of a cut key: at most 2 * MAX_PARTS rows, hence the broadcast.
        edges = (
            parted.where(F.col(_HOT))
            .groupBy(*keys, _PART)
            .agg(_edge(value, order, kind).alias(_EDGE))
            .withColumn(_EDGE, _over_parts(kind, _window(keys, [_PART])))
        )
        left, right = local.alias("l"), F.broadcast(edges).alias("r")
        on = F.col(f"l.{_PART}") == F.col(f"r.{_PART}")
        for key in keys:
            on = on & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
        here, carried = F.col(f"l.{into}"), F.col(f"r.{_EDGE}")
        merged = F.greatest(here, carried) if kind == "max" else F.coalesce(here, carried)
        kept = [F.col(f"l.{c}") for c in parted.columns if c != into]
        return left.join(right, on, "left").select(*kept, merged.alias(into))


def spread_ties(*columns: str) -> Column:
    """A number that tells tied rows apart, for a last order column where their order is of no account."""
    return F.xxhash64(*columns) if columns else F.monotonically_increasing_id()


def _window(keys: Sequence[str], order: Sequence[str]):
    # A key-less window is only reached below the row limit.
    by = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return by.orderBy(*order)


def _over(value: Column, kind: str, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "previous":
        return F.lag(value).over(window)
    if kind == "next":
        return F.lead(value).over(window)
    if kind == "max":
        return F.max(value).over(before)
    return F.last(value, ignorenulls=True).over(upto)


def _edge(value: Column, order: Sequence[str], kind: str) -> Column:
    place = F.struct(*order)
    if kind == "previous":
        return F.max_by(value, place)
    if kind == "next":
        return F.min_by(value, place)
    if kind == "max":
        return F.max(value)
    return F.max_by(value, F.when(value.isNotNull(), place))


def _over_parts(kind: str, window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    edge = F.col(_EDGE)
    if kind == "previous":
        return F.lag(edge).over(window)
    if kind == "next":
        return F.lead(edge).over(window)
    if kind == "max":
        return F.max(edge).over(before)
    return F.last(edge, ignorenulls=True).over(before)


def hot_key_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_KEY_ROWS_CONF, str(HOT_KEY_ROWS)))


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")


def _hot_key_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame | None, int, int]:
    """(key hash, sorted cut points) of the keys above the limit, or None without such keys.

    With it come the number of binary search steps that the longest list takes and the
    number of tasks for the parts.
    """
    counts = df.groupBy(_key_hash(keys).alias(_HASH)).agg(F.count("*").alias("n"))
    top = counts.agg(F.max("n").alias("largest"), F.sum("n").alias("total")).first()
    if top["largest"] is None:
        return None, 0, 0
    limit = max(hot_key_rows(df), -(-top["total"] // MAX_PARTS))
    if top["largest"] <= limit:
        return None, 0, 0

    # A cut point is a place in the sequence, found among rows picked at random, so that a
    # place is picked as often as it has rows: every `gap`-th pick ends a part of about
    # `limit` rows.  Picks place the cuts only; all rows go on.  There are at most about
    # POINTS_PER_PART * MAX_PARTS picks over all keys, and a place that ends several parts
    # is one cut.  A place alone is never cut: an order that ties so many rows has no
    # sequence to carry along, see `spread_ties`.
    gap = min(POINTS_PER_PART, limit)
    hot = counts.where(F.col("n") > limit).select(_HASH)  # fewer than MAX_PARTS keys
    place = F.struct(*order)
    picked = (
        df.select(_key_hash(keys).alias(_HASH), place.alias("at"))
        .where(F.rand(_SEED) * (limit // gap) < 1)
        .join(F.broadcast(hot), _HASH)
        .withColumn("nth", F.row_number().over(Window.partitionBy(_HASH).orderBy("at")))
    )
    points = (
        picked.where(F.col("nth") % gap == 0)
        .groupBy(_HASH)
        .agg(F.array_sort(F.collect_set("at")).alias("cuts"))
    )
    # As a small local table the cuts agree in every later use, also after a lost task.
    rows = points.collect()
    most = max((len(r["cuts"]) for r in rows), default=0)
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffles, 2 * -(-top["total"] // max(limit, TASK_ROWS)))
    return df.sparkSession.createDataFrame(rows, points.schema), most.bit_length(), tasks


def _with_part(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame, steps: int
) -> DataFrame:
    """Add whether the key is cut, and the part: 0 for ordinary keys, 1.. along a cut key.

    The part is one more than the number of cuts <= the row's place, found by binary
    search with one projection per step, which stays in generated code.  A place of one
    column is compared as such, for which far less code is generated; NULL comes before all cuts.
    """
    place = F.struct(*order)
    if len(order) == 1:
        place = F.col(order[0])
        cuts = cuts.withColumn("cuts", F.array_compact(F.col("cuts").getField(order[0])))
    found = (
        df.withColumn(_HASH, _key_hash(keys))
        .join(F.broadcast(cuts), _HASH, "left")
        .withColumn(_HOT, F.col("cuts").isNotNull())
        .withColumn(_PART, F.when(F.col(_HOT), 1).otherwise(0))
    )
    for step in range(steps - 1, -1, -1):
        further = F.col(_PART) + (1 << step)
        # Cut number n (from 1) ends part n, so its index is the part to reach minus 2.
        beyond = F.get("cuts", further - 2) <= place
        found = found.withColumn(_PART, F.when(beyond, further).otherwise(F.col(_PART)))
    return found.drop(_HASH, "cuts")
