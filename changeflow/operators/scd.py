"""Type 2 dimensions: declarative from any arrival order, step by step, and their checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from changeflow.contracts import CHANGE_TYPE, require_columns
from changeflow.functions.compare import all_same, any_differs, keys_match
from changeflow.functions.ordered import KeyOrder, spread_ties
from changeflow.operators.changes import without_preimages


@dataclass(frozen=True)
class Scd2:
    """What a Type 2 dimension is made of.

    keys      columns that identify an entity
    sequence  columns that order its events, compared one after the other
    track     attributes whose change makes a version
    deletes   condition of a delete event, as a column or as SQL text
    carry     further columns a version takes from the event that opened it
    """

    keys: Sequence[str]
    sequence: Sequence[str]
    track: Sequence[str]
    deletes: Column | str
    carry: Sequence[str] = ()

    def gone(self) -> Column:
        """True for a delete event; a NULL condition is none."""
        condition = F.expr(self.deletes) if isinstance(self.deletes, str) else self.deletes
        return F.coalesce(condition, F.lit(False))

    def track_all_except(self, columns: Sequence[str], excluded: Sequence[str]) -> Scd2:
        """The same with every column tracked but the keys and the excluded ones."""
        track = [c for c in columns if c not in (*self.keys, *excluded)]
        return Scd2(self.keys, self.sequence, track, self.deletes, self.carry)


def range_columns(sequence: Sequence[str]) -> list[tuple[str, str, str]]:
    """(sequence column, start column, end column): __START_AT for the first, then by name."""
    named = []
    for i, column in enumerate(sequence):
        suffix = "AT" if i == 0 else _suffix(column)
        named.append((column, f"__START_{suffix}", f"__END_{suffix}"))
    return named


def _suffix(column: str) -> str:
    return "VERSION" if column == "_commit_version" else column.strip("_").upper()


def mark_unchanged(
    events: DataFrame, spec: Scd2, order: KeyOrder | None = None, on_ties: str = "raise"
) -> DataFrame:
    """Add `gone` for a delete, and `unchanged` for an event that makes no version.

    An event makes none if it repeats the event just before on all tracked columns.
    A delete after a delete, or with nothing before it, repeats too.  A NULL or tied
    sequence has no defined order: the job fails, unless ties are allowed.
    """
    order = order or KeyOrder(events, spec.keys, spec.sequence)
    marked = events.withColumn("gone", spec.gone())
    compared = list(dict.fromkeys([*spec.track, *spec.sequence, "gone"]))
    seen = order.with_previous(marked, compared, "before")
    none_before = F.col("before").isNull() | F.col("before.gone")
    repeats_values = all_same([(F.col(c), F.col(f"before.{c}")) for c in spec.track])
    unchanged = F.when(F.col("gone"), none_before).otherwise(~none_before & repeats_values)

    bad = any_null(spec.sequence)
    if on_ties == "raise":
        tied = all_same([(F.col(c), F.col(f"before.{c}")) for c in spec.sequence])
        bad = bad | (F.col("before").isNotNull() & tied)
    text = f"the sequence {list(spec.sequence)} is NULL or tied; add a column that breaks the tie"
    checked = F.when(bad, F.raise_error(F.lit(text)).cast("boolean")).otherwise(unchanged)
    return seen.withColumn("unchanged", checked).drop("before")


def suppress_unchanged(
    events: DataFrame, spec: Scd2, order: KeyOrder | None = None, on_ties: str = "raise"
) -> DataFrame:
    """The events that make or end a version, with their `gone` mark."""
    order = order or KeyOrder(events, spec.keys, spec.sequence)
    return order.finish(_kept(events, spec, order, on_ties))


def _kept(events: DataFrame, spec: Scd2, order: KeyOrder, on_ties: str) -> DataFrame:
    return mark_unchanged(events, spec, order, on_ties).where(~F.col("unchanged")).drop("unchanged")


def any_null(columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return missing


def close_intervals(
    events: DataFrame, keys: Sequence[str], sequence: Sequence[str], order: KeyOrder | None = None
) -> DataFrame:
    """Add the range of every event: its own sequence, and that of the next event."""
    order = order or KeyOrder(events, keys, sequence)
    following = order.with_next(events, sequence, "after")
    for column, start, end in range_columns(sequence):
        following = following.withColumn(start, F.col(column)).withColumn(end, F.col(f"after.{column}"))
    return order.finish(following).drop("after")


def apply_changes_scd2(events: DataFrame, spec: Scd2, on_ties: str = "raise") -> DataFrame:
    """The Type 2 dimension of all events of its keys, whatever order they arrived in.

    Both steps use one partitioning and one sort of the events.
    """
    if CHANGE_TYPE in events.columns:
        events = without_preimages(events)
    needed = [*spec.keys, *spec.sequence, *spec.track, *spec.carry]
    require_columns(events, needed, "event table")
    # Prune before the shuffle; the delete condition may use any column, so it comes along as one flag.
    slim = events.select(*dict.fromkeys(needed), spec.gone().alias("__deleted"))
    slim_spec = Scd2(spec.keys, spec.sequence, spec.track, "__deleted", spec.carry)
    order = KeyOrder(slim, spec.keys, spec.sequence)
    kept = _kept(slim, slim_spec, order, on_ties)
    ranged = close_intervals(kept, spec.keys, spec.sequence, order)
    bounds = [c for _, start, end in range_columns(spec.sequence) for c in (start, end)]
    attributes = dict.fromkeys([*spec.track, *spec.carry])
    return ranged.where(~F.col("gone")).select(
        *spec.keys, *[c for c in attributes if c not in spec.keys], *bounds
    )


def scd2_step(dim: DataFrame, batch: DataFrame, spec: Scd2) -> DataFrame:
    """One incremental batch by hand on start_date, end_date and is_current.

    Closes changed rows, adds a row per new or changed incoming row, closes deleted
    rows, in that order.  It compares with the stored current row only: several
    changes of one key in a batch make several current rows, which
    `duplicate_current` shows.  `apply_changes_scd2` has no such condition.  A row of
    the batch without a time fails the job.

    The batch meets the current rows once, which tells per key when it closes and when it
    is deleted; current and incoming rows together then take these moments in a second
    join.  Rows that are not current cannot change: they go around both.
    """
    keys, at = list(spec.keys), spec.sequence[0]
    columns = [*keys, *spec.track, "start_date", "end_date", "is_current"]
    live = F.coalesce(F.col("is_current"), F.lit(False))
    current = dim.where(live).select(*columns)
    text = F.lit(f"the sequence ['{at}'] is NULL in a row of the batch")
    incoming = batch.select(
        *keys,
        *[c for c in dict.fromkeys(spec.track) if c != at],
        F.coalesce(F.col(at), F.raise_error(text).cast(batch.schema[at].dataType)).alias(at),
        spec.gone().alias("gone"),
    )
    moments = _moments(incoming, current, spec)
    opened = incoming.where(~F.col("gone")).select(
        *keys,
        *spec.track,
        F.col(at).alias("start_date"),
        F.lit(None).cast(dim.schema["end_date"].dataType).alias("end_date"),
        F.lit(True).alias("is_current"),
        F.lit(True).alias("incoming"),
    )
    rows = current.withColumn("incoming", F.lit(False)).unionByName(opened).join(moments, keys, "left")
    # Once a key's row is closed, or if it had none, all its incoming rows are versions.
    fresh = ~F.coalesce(F.col("known"), F.lit(False)) | F.col("closed_at").isNotNull()
    ended = F.when(F.col("incoming"), F.col("deleted_at")).otherwise(F.coalesce("closed_at", "deleted_at"))
    return (
        rows.where(~F.col("incoming") | fresh)
        .withColumn("is_current", ended.isNull())
        .withColumn("end_date", F.coalesce(ended, F.col("end_date")))
        .select(*columns)
        .unionByName(dim.where(~live).select(*columns))
    )


def _moments(incoming: DataFrame, current: DataFrame, spec: Scd2) -> DataFrame:
    """Per key of the batch: whether a current row is known, its earliest change, the latest delete."""
    keys, at = list(spec.keys), F.col(f"i.{spec.sequence[0]}")
    stored = current.select(*keys, F.struct(*spec.track).alias("now"))
    met = incoming.alias("i").join(stored.alias("d"), keys_match("i", "d", keys), "left")
    known, gone = F.col("d.now").isNotNull(), F.col("i.gone")
    changed = any_differs([(F.col(f"i.{c}"), F.col(f"d.now.{c}")) for c in spec.track])
    return met.groupBy(*[F.col(f"i.{k}").alias(k) for k in keys]).agg(
        F.bool_or(known).alias("known"),
        F.min(F.when(known & ~gone & changed, at)).alias("closed_at"),
        F.max(F.when(gone, at)).alias("deleted_at"),
    )


def match_current(
    incoming: DataFrame, dim: DataFrame, keys: Sequence[str], track: Sequence[str], how: str
) -> DataFrame:
    """Incoming rows against the current dimension row.

    inner: keys that exist and changed; left: those and keys that are new.
    """
    current = dim.where("is_current").select(*keys, F.struct(*track).alias("now"))
    joined = incoming.alias("i").join(current.alias("d"), keys_match("i", "d", keys), how)
    changed = any_differs([(F.col(f"i.{c}"), F.col(f"d.now.{c}")) for c in track])
    keep = changed if how == "inner" else F.col("d.now").isNull() | changed
    return joined.where(keep).select("i.*", *[F.col(f"d.now.{c}").alias(f"current_{c}") for c in track])


def anti_new_keys(incoming: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the dimension has never seen.

    The known keys are made distinct before the join, so a key with very many
    versions is one row there.
    """
    return incoming.join(dim.select(*keys).distinct(), list(keys), "left_anti")


def duplicate_current(dim: DataFrame, keys: Sequence[str], is_open: Column) -> DataFrame:
    """Keys with more than one open row; a right dimension has none."""
    return (
        dim.where(is_open)
        .groupBy(*keys)
        .agg(F.count("*").alias("open_rows"))
        .where(F.col("open_rows") > 1)
    )


def sequence_ties(events: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Groups of events of a key with equal sequence, which no sort can order."""
    return (
        events.groupBy(*keys, *sequence)
        .agg(F.count("*").alias("events"))
        .where(F.col("events") > 1)
    )


def sequence_regressions(
    events: DataFrame, keys: Sequence[str], time: str, version: str
) -> DataFrame:
    """Events whose business time lies below the running maximum in commit order."""
    order = KeyOrder(events, keys, [version])
    seen = order.finish(order.with_running_max(events, F.col(time), "latest_before"))
    return seen.where(F.col(time) < F.col("latest_before"))


def composite_order(events: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """Events sorted by a composite sequence, compared field by field."""
    return events.orderBy(F.struct(*sequence))


def as_of_dimension(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str],
    start: str = "__START_AT",
    end: str = "__END_AT",
    tie: str | None = "__START_VERSION",
) -> DataFrame:
    """Facts with the dimension row valid at their time: start <= time < end.

    Facts and versions are merged into one stream per key, ordered by time, and the
    latest version is carried forward; a fact never meets all versions of its key.
    """
    tie_value = F.col(tie) if tie else F.lit(0)
    row = F.struct(F.lit(True).alias("found"), F.col(end).alias("until"), *columns)
    versions = (
        # An empty range never matches, and must not hide the row before it.
        dim.where(F.col(end).isNull() | (F.col(start) < F.col(end)))
        .select(
            *keys,
            F.col(start).alias("at"),
            F.lit(0).alias("side"),
            tie_value.cast("bigint").alias("tie"),
            row.alias("version"),
        )
    )
    hashed = [f.name for f in facts.schema if not isinstance(f.dataType, MapType)]
    asking = facts.select(
        *keys,
        F.col(time).alias("at"),
        F.lit(1).alias("side"),
        # All facts of one time get the same version, so any order of them will do: a time
        # that very many facts share can be cut.
        spread_ties(*hashed).alias("tie"),
        F.struct(*[c for c in facts.columns if c not in keys]).alias("fact"),
    )
    both = versions.unionByName(asking, allowMissingColumns=True)
    order = KeyOrder(both, keys, ["at", "side", "tie"])
    known = order.with_last_known(both, F.col("version"), "valid").where(F.col("fact").isNotNull())
    holds = F.col("valid.until").isNull() | (F.col("at") < F.col("valid.until"))
    return known.select(
        *keys,
        "fact.*",
        *[F.when(holds, F.col(f"valid.{c}")).alias(f"dim_{c}") for c in columns],
    )


def affected_keys(history: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All stored events of the keys that a batch touches."""
    touched = batch.select(*keys).distinct()
    return history.join(touched, list(keys), "left_semi")


@dataclass(frozen=True)
class VersionZone:
    """A version range whose naive times are local times of a zone."""

    first_version: int
    last_version: int
    zone: str


def normalize_sequence(
    events: DataFrame, time: str, version: str, zones: Sequence[VersionZone]
) -> DataFrame:
    """Turn naive local times of the named version ranges into UTC, row by row."""
    value = F.col(time)
    for z in zones:
        inside = F.col(version).between(z.first_version, z.last_version)
        utc = F.convert_timezone(F.lit(z.zone), F.lit("UTC"), F.col(time).cast("timestamp_ntz"))
        value = F.when(inside, utc.cast(events.schema[time].dataType)).otherwise(value)
    return events.withColumn(time, value)


def zone_shifts(
    events: DataFrame, time: str, version: str, committed: str, step_minutes: int = 30, blocks: int = 1000
) -> DataFrame:
    """(first_version, last_version, lag_minutes): version ranges between whose ends the clock of `time` didn't move.

    Events are committed soon after they happen, apart from late ones, so the least lag of a block of versions
    is near zero, or near what the clock of the block is off by.  Blocks of equal least lag, in whole steps, are one
    range; the version at which it changes is then looked up in the block where it lies.  A positive
    lag means that times are behind, as local times west of UTC are.  Late events just at a change fit both
    ranges and count to that of the lesser lag.

    One aggregate gives at most `blocks` rows, in blocks of 100 versions at least; another reads the blocks that
    hold a change.
    """
    lag = F.timestamp_diff("MINUTE", F.col(time), F.col(committed))
    slim = events.where(F.col(time).isNotNull() & F.col(committed).isNotNull())
    slim = slim.select(F.col(version).alias("v"), lag.alias("lag"))
    ends = slim.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if ends["lo"] is None:
        return slim.select(F.col("v").alias("first_version"), F.col("v").alias("last_version"), F.col("lag").alias("lag_minutes"))
    size = max(100, -(-(ends["hi"] - ends["lo"] + 1) // blocks))
    placed = slim.withColumn("block", F.floor((F.col("v") - ends["lo"]) / size))
    least = placed.groupBy("block").agg(F.min("lag").alias("least"))
    order = Window.orderBy("block")  # a row per block
    steps = least.select("block", (F.floor(F.col("least") / step_minutes) * step_minutes).alias("shift")).select(
        "block", "shift", F.lag("shift").over(order).alias("before"), F.lag("block").over(order).alias("block_before")
    )
    moved = steps.where(F.col("before").isNull() | (F.col("before") != F.col("shift")))
    # A block that holds both clocks has the smaller lag: it comes first where the lag rises.
    rises = F.col("shift") > F.col("before")
    moved = moved.select("shift", "before", rises.alias("rises"), F.when(rises, F.col("block_before")).otherwise(F.col("block")).alias("block"))
    inside = placed.join(F.broadcast(moved), "block")  # at most `blocks` rows
    start = F.when(
        F.first("rises"), F.max(F.when(F.col("lag") < F.col("shift"), F.col("v"))) + 1
    ).otherwise(F.min(F.when(F.col("before").isNull() | (F.col("lag") < F.col("before")), F.col("v"))))
    starts = inside.groupBy("block", "shift", "before").agg(start.alias("first_version"))
    following = F.lead("first_version").over(Window.orderBy("first_version"))
    return starts.select(
        "first_version",
        F.coalesce(following - 1, F.lit(ends["hi"])).alias("last_version"),
        F.col("shift").cast("bigint").alias("lag_minutes"),
    )


def version_zones(shifts: DataFrame, usual_minutes: int = 0) -> list[VersionZone]:
    """The ranges of `zone_shifts` that are off the usual lag, as offsets for `normalize_sequence`; a few rows."""
    out = []
    for r in shifts.where(F.col("lag_minutes") != usual_minutes).orderBy("first_version").collect():
        off = usual_minutes - r["lag_minutes"]
        sign, minutes = ("+" if off > 0 else "-"), abs(off)
        out.append(VersionZone(r["first_version"], r["last_version"], f"{sign}{minutes // 60:02d}:{minutes % 60:02d}"))
    return out


def distinct_zone_offsets(events: DataFrame, text: str) -> DataFrame:
    """UTC offsets that time strings are written with; more than one asks for a check.

    `+10`, `+1000` and `+10:00` are one offset; a zone may be named, as in `12:30 Australia/Brisbane`;
    a time without any has the empty one.
    """
    zone = r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*"
    number = F.regexp_extract(F.col(text), zone + r"([+-]\d{2}(?::?\d{2})?)$", 1)
    digits = F.rpad(F.regexp_replace(number, ":", ""), 5, "0")
    name = F.regexp_extract(F.col(text), zone + r"\[?([A-Za-z]+(?:/[A-Za-z0-9_+-]+)*)\]?$", 1)
    offset = F.when(number == "", name).otherwise(F.concat(F.substring(digits, 1, 3), F.lit(":"), F.substring(digits, 4, 2)))
    return events.select(offset.alias("utc_offset")).groupBy("utc_offset").agg(F.count("*").alias("rows"))


def backfill_drift(
    rebuilt: DataFrame, incremental: DataFrame, keys: Sequence[str], version: str, start: str
) -> DataFrame:
    """Versions of a full rebuild that start at another time than in the stored dimension."""
    a = rebuilt.select(*keys, version, F.struct(start).alias("r"))
    b = incremental.select(*keys, version, F.struct(start).alias("i"))
    joined = a.join(b, [*keys, version], "full_outer")
    kind = (
        F.when(F.col("i").isNull(), "only_rebuilt")
        .when(F.col("r").isNull(), "only_incremental")
        .when(~F.col(f"r.{start}").eqNullSafe(F.col(f"i.{start}")), "moved")
    )
    return joined.select(
        *keys,
        version,
        F.col(f"r.{start}").alias("rebuilt_start"),
        F.col(f"i.{start}").alias("incremental_start"),
        kind.alias("drift"),
    ).where(F.col("drift").isNotNull())


def evolve_dim2(events: DataFrame, spec: Scd2, attribute: str, data_type: str) -> DataFrame:
    """Rebuild a dimension with one more reviewed attribute.

    Events stored before the attribute existed have it NULL; nothing is back-filled.
    """
    if attribute not in events.columns:
        events = events.withColumn(attribute, F.lit(None).cast(data_type))
    longer = Scd2(spec.keys, spec.sequence, [*spec.track, attribute], spec.deletes, spec.carry)
    return apply_changes_scd2(events, longer)
