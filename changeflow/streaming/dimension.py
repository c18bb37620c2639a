"""A Type 2 dimension kept by a stream on keyed state, right for late rows too.

Whether an event makes a version depends on the event just before it alone.  The state of a key
holds its last event and the list of all of them, each as its place in the sequence, a hash of its tracked values and
whether it is a delete.  Events after the last one need only that; a late event is judged in the
list, and so is the event that now comes after it.  No file of an earlier batch is read.

The sink holds judgements in batch folders: every event once with its values, and once more
without them whenever a late event changed what it is.  The latest judgement of an event holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from changeflow.functions.ordered import KeyOrder
from changeflow.operators.scd import Scd2, close_intervals, range_columns
from changeflow.streaming.sinks import BATCH, RUN, Job, batch_stamp, read_batches, run

ROW, GONE, KEPT = "row", "gone", "kept"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_apply_scd2(stream: DataFrame, job: Job, spec: Scd2, every: str | None = None) -> StreamingQuery:
    """Keep the dimension up to date with everything the stream has now; see `read_dim2`.

    Sequence columns are whole numbers, times, dates or strings.  A NULL in one fails the job;
    an event with the key and sequence of one seen before is that one again and is ignored.  A task holds the
    events that one key has in a micro-batch, and of a key with late events the list of its
    places; `files_per_batch` of the stream bounds the first.
    """
    shaped, places = _shaped(stream, spec)
    key_fields = [stream.schema[c] for c in spec.keys]
    kinds = [shaped.schema[p] for p in places]
    values = StructField(ROW, shaped.schema[ROW].dataType)  # NULL where only a judgement changed
    out = StructType([*key_fields, *kinds, StructField(KEPT, BooleanType()), values])
    judged = shaped.groupBy(*spec.keys).transformWithState(
        statefulProcessor=_Judge(list(spec.keys), StructType(kinds)),
        outputStructType=out,
        outputMode="Append",
        timeMode="None",
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(job.folder(batch_id))

    conf, before = stream.sparkSession.conf, stream.sparkSession.conf.get(_PROVIDER)
    conf.set(_PROVIDER, _ROCKSDB)  # keyed state needs it; a query keeps the setting it started with
    try:
        return run(judged, job, write, every)
    finally:
        conf.set(_PROVIDER, before)


def read_dim2(spark: SparkSession, sink: str, stream_schema: StructType, spec: Scd2) -> DataFrame:
    """The dimension: the events that their latest judgement keeps, closed by the next one."""
    fields = StructType([stream_schema[c] for c in _columns(spec)] + [StructField(GONE, BooleanType())])
    places = [StructField(f"place_{i}", _place_type(stream_schema[c].dataType)) for i, c in enumerate(spec.sequence)]
    keys = [stream_schema[c] for c in spec.keys]
    schema = StructType([*keys, *places, StructField(KEPT, BooleanType()), StructField(ROW, fields)])
    rows = read_batches(spark, sink, keep=[RUN, BATCH], schema=schema)
    identity = [*spec.keys, *[p.name for p in places]]
    judged = (
        rows.groupBy(*identity)
        .agg(
            F.max_by(KEPT, batch_stamp()).alias(KEPT),
            F.max_by(ROW, F.when(F.col(ROW).isNotNull(), batch_stamp())).alias(ROW),
        )
        .where(KEPT)
        .select(*spec.keys, *[F.col(f"{ROW}.{f.name}") for f in fields])
    )
    # Counted on the stored rows, so that the fold above runs once.
    whole = rows.where(F.col(ROW).isNotNull()).select(*spec.keys, f"{ROW}.*")
    order = KeyOrder(whole, spec.keys, spec.sequence)
    ranged = close_intervals(judged, spec.keys, spec.sequence, order).where(~F.col(GONE))
    bounds = [c for _, start, end in range_columns(spec.sequence) for c in (start, end)]
    attributes = [c for c in dict.fromkeys([*spec.track, *spec.carry]) if c not in spec.keys]
    return ranged.select(*spec.keys, *attributes, *bounds)


def _columns(spec: Scd2) -> list[str]:
    """What a version takes from its event, without the keys."""
    return [c for c in dict.fromkeys([*spec.sequence, *spec.track, *spec.carry]) if c not in spec.keys]


def _place_type(kind: DataType) -> DataType:
    if isinstance(kind, (IntegralType, DateType, TimestampType, TimestampNTZType)):
        return LongType()
    if isinstance(kind, StringType):
        return StringType()
    raise ValueError(f"a sequence column is a whole number, time, date or string, not {kind.simpleString()}")


def _place(column: Column, kind: DataType) -> Column:
    """A sequence value as a number or string that orders like it."""
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    return column.cast(_place_type(kind))


def _shaped(stream: DataFrame, spec: Scd2) -> tuple[DataFrame, list[str]]:
    """Keys, places, the hash of what is tracked, the delete mark, and the values as one struct."""
    kinds = {c: stream.schema[c].dataType for c in spec.sequence}
    places = [_place(F.col(c), kinds[c]).alias(f"place_{i}") for i, c in enumerate(spec.sequence)]
    values = [x for c in spec.track for x in (F.col(c), F.col(c).isNull())]  # a hash alone skips NULLs
    shaped = stream.select(
        *spec.keys,
        *places,
        F.xxhash64(F.lit(0), *values).alias("tracked"),
        spec.gone().alias(GONE),
        F.struct(*[F.col(c) for c in _columns(spec)], spec.gone().alias(GONE)).alias(ROW),
    )
    return shaped, [f"place_{i}" for i in range(len(places))]


def _keeps(tracked: int, gone: bool, before: tuple | None) -> bool:
    """Whether an event makes or ends a version after the one before, (places..., tracked, gone)."""
    if before is None or before[-1]:
        return not gone
    return gone or tracked != before[-2]


class _Judge(StatefulProcessor):
    """Judges the events of one key; state rows are (places..., tracked, gone)."""

    def __init__(self, keys: list[str], places: StructType):
        self.keys, self.places = keys, places

    def init(self, handle: StatefulProcessorHandle) -> None:
        row = StructType([*self.places, StructField("tracked", LongType()), StructField(GONE, BooleanType())])
        self.last = handle.getValueState("last", row)
        self.events = handle.getListState("events", row)

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        names = self.places.names
        new: dict[tuple, Row] = {}
        for r in rows:
            place = tuple(r[n] for n in names)
            if None in place:
                raise ValueError(f"the sequence of an event of the key {tuple(key)} is NULL")
            new.setdefault(place, r)
        states = [(*place, r["tracked"], r[GONE]) for place, r in sorted(new.items(), key=lambda x: x[0])]
        last = self.last.get() if self.last.exists() else None
        last = tuple(last) if last is not None else None
        width = len(names)
        if last is None or states[0][:width] > last[:width]:
            before = last
            for state in states:
                yield self._row(key, state, before, new[state[:width]])
                before = state
            self.events.appendList(states)
            self.last.update(states[-1])
            return
        held = {tuple(e)[:width]: tuple(e) for e in self.events.get()}
        states = [s for s in states if s[:width] not in held]
        if not states:
            return
        fresh = {s[:width] for s in states}
        before = before_held = None
        for state in sorted([*held.values(), *states], key=lambda s: s[:width]):
            if state[:width] in fresh:
                yield self._row(key, state, before, new[state[:width]])
            else:
                if before is not before_held and self._kept(state, before) != self._kept(state, before_held):
                    yield self._row(key, state, before, None)
                before_held = state
            before = state
        self.events.appendList(states)
        if before[:width] != last[:width]:
            self.last.update(before)

    def _kept(self, state: tuple, before: tuple | None) -> bool:
        return _keeps(state[-2], state[-1], before)

    def _row(self, key: tuple, state: tuple, before: tuple | None, source: Row | None) -> Row:
        names = [*self.keys, *self.places.names, KEPT, ROW]
        values = [*key, *state[:-2], self._kept(state, before), source[ROW] if source is not None else None]
        return Row(**dict(zip(names, values)))
