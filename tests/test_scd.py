import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from changeflow.operators import scd
from changeflow.sources.samples import seed_cdc

SPEC = scd.Scd2(
    keys=["machine_id"],
    sequence=["updated_at", "_commit_version"],
    track=["model", "site"],
    deletes="operation = 'DELETE'",
)
BEGIN = datetime(2025, 5, 12, 6)


def hour(h):
    return BEGIN + timedelta(hours=h)


def ranges(dim):
    return [
        (r["machine_id"], r["site"], r["__START_AT"], r["__START_VERSION"], r["__END_AT"], r["__END_VERSION"])
        for r in dim.collect()
    ]


GOLDEN = sorted(
    [
        (71, "Lima", hour(0.5), 2, hour(2), 6),
        (71, "Bonn", hour(8), 10, None, None),
        (72, "Oslo", hour(2.25), 12, None, None),
        (73, "Oslo", hour(0.25), 1, hour(4.5), 5),
        (73, "Bonn", hour(4.5), 5, hour(6), 3),
        (73, "Cork", hour(6), 3, None, None),
        (74, "Lima", hour(3), 7, hour(7), 8),
        (74, "Oslo", hour(7), 8, hour(7), 9),
        (74, "Cork", hour(7), 9, None, None),
        (75, None, hour(1), 4, hour(9), 11),
        (75, "Lima", hour(9), 11, None, None),
    ],
    key=repr,
)


def test_golden_dimension(spark):
    dim = scd.apply_changes_scd2(seed_cdc(spark), SPEC)
    assert sorted(ranges(dim), key=repr) == GOLDEN
    assert scd.duplicate_current(dim, ["machine_id"], F.col("__END_AT").isNull()).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_arrival_order_does_not_matter(spark, seed):
    shuffled = seed_cdc(spark).orderBy(F.rand(seed)).repartition(3)
    assert sorted(ranges(scd.apply_changes_scd2(shuffled, SPEC)), key=repr) == GOLDEN


def test_tied_sequence_raises(spark):
    plain = scd.Scd2(["machine_id"], ["updated_at"], ["model", "site"], SPEC.deletes)
    with pytest.raises(Exception, match="NULL or tied"):
        scd.apply_changes_scd2(seed_cdc(spark), plain).collect()
    assert scd.apply_changes_scd2(seed_cdc(spark), plain, on_ties="allow").count() == 11


def test_null_sequence_raises(spark):
    raw = seed_cdc(spark).withColumn("updated_at", F.when(F.col("machine_id") != 72, F.col("updated_at")))
    with pytest.raises(Exception, match="NULL or tied"):
        scd.apply_changes_scd2(raw, SPEC).collect()


def test_tracking_the_version_makes_every_event_a_version(spark):
    raw = seed_cdc(spark)
    everything = SPEC.track_all_except(raw.columns, ["operation", "updated_at"])
    assert "_commit_version" in everything.track
    dim = scd.apply_changes_scd2(raw, everything)
    assert dim.where("machine_id = 73").count() == 3
    reviewed = SPEC.track_all_except(raw.columns, ["operation", "updated_at", "_commit_version"])
    assert scd.apply_changes_scd2(raw, reviewed).count() == 11


def test_null_to_value_is_a_version(spark):
    raw = spark.createDataFrame(
        [(1, None, "INSERT", BEGIN, 1), (1, "A", "UPDATE", hour(1), 2), (1, None, "UPDATE", hour(2), 3)],
        "machine_id bigint, site string, operation string, updated_at timestamp, _commit_version bigint",
    )
    spec = scd.Scd2(["machine_id"], SPEC.sequence, ["site"], SPEC.deletes)
    assert [r["site"] for r in scd.apply_changes_scd2(raw, spec).orderBy("__START_AT").collect()] == [None, "A", None]


def test_carried_columns_come_from_the_opening_event(spark):
    spec = scd.Scd2(["machine_id"], SPEC.sequence, ["site"], SPEC.deletes, carry=["operation"])
    dim = scd.apply_changes_scd2(seed_cdc(spark), spec)
    assert {r["operation"] for r in dim.where("machine_id = 73").collect()} == {"INSERT", "UPDATE"}


def empty_dim(spark):
    return spark.createDataFrame(
        [],
        "machine_id bigint, model string, site string, start_date timestamp, end_date timestamp, is_current boolean",
    )


def test_manual_step_on_an_empty_dimension_duplicates(spark):
    dim = scd.scd2_step(empty_dim(spark), seed_cdc(spark).where("_commit_version NOT IN (10, 13)"), SPEC)
    current = dict(dim.where("is_current").groupBy("machine_id").count().collect())
    assert current == {72: 1, 73: 3, 74: 3, 75: 2}
    closed = dim.where("NOT is_current").collect()
    assert [(r["machine_id"], r["end_date"]) for r in closed] == [(71, hour(2))]
    twice = scd.duplicate_current(dim, ["machine_id"], F.col("is_current"))
    assert {r["machine_id"] for r in twice.collect()} == {73, 74, 75}


def test_manual_step_with_one_change_per_key(spark):
    raw = seed_cdc(spark)
    first = scd.scd2_step(empty_dim(spark), raw.where("_commit_version IN (1, 2, 4, 7, 12)"), SPEC)
    second = scd.scd2_step(first, raw.where("_commit_version IN (3, 6, 9, 11)"), SPEC)
    rows = {(r["machine_id"], r["site"], r["is_current"]) for r in second.collect()}
    assert rows == {
        (71, "Lima", False),
        (72, "Oslo", True),
        (73, "Oslo", False),
        (73, "Cork", True),
        (74, "Lima", False),
        (74, "Cork", True),
        (75, None, False),
        (75, "Lima", True),
    }


def test_ties_and_regressions(spark):
    raw = seed_cdc(spark)
    ties = scd.sequence_ties(raw, ["machine_id"], ["updated_at"]).collect()
    assert [(r["machine_id"], r["events"]) for r in ties] == [(74, 2)]
    assert scd.sequence_ties(raw, ["machine_id"], SPEC.sequence).isEmpty()
    late = scd.sequence_regressions(raw, ["machine_id"], "updated_at", "_commit_version").collect()
    assert [(r["machine_id"], r["updated_at"]) for r in late] == [(73, hour(4.5))]


def test_late_event_needs_the_suppressed_one(spark):
    """A@1, A@3 (suppressed), late B@2: a full rebuild finds A, B, A."""
    columns = "machine_id bigint, site string, operation string, updated_at timestamp, _commit_version bigint"
    rows = [(1, "A", "INSERT", hour(1), 1), (1, "A", "UPDATE", hour(3), 2), (1, "B", "UPDATE", hour(2), 3)]
    spec = scd.Scd2(["machine_id"], SPEC.sequence, ["site"], SPEC.deletes)
    dim = scd.apply_changes_scd2(spark.createDataFrame(rows, columns), spec)
    assert [r["site"] for r in dim.orderBy("__START_AT").collect()] == ["A", "B", "A"]


def test_intervals_of_a_key_do_not_overlap(spark, sf_dir):
    from changeflow.plans.queries import QUERIES
    from pyspark.sql import Window

    dim = QUERIES["apply_changes_scd2"](spark, sf_dir)
    following = F.lead("__START_AT").over(Window.partitionBy("user_id").orderBy("__START_AT", "__START_VERSION"))
    checked = dim.withColumn("following", following)
    assert checked.where("following < __END_AT OR (following IS NOT NULL AND __END_AT IS NULL)").isEmpty()


def test_as_of_ignores_empty_ranges_and_gaps(spark):
    dim = scd.apply_changes_scd2(seed_cdc(spark), SPEC)
    facts = spark.createDataFrame(
        [(1, 74, hour(4)), (2, 74, hour(7)), (3, 71, hour(2)), (4, 71, hour(0.5)), (5, 73, hour(-1)), (6, 9, BEGIN)],
        "fact bigint, machine_id bigint, at_time timestamp",
    )
    got = scd.as_of_dimension(facts, dim, ["machine_id"], "at_time", ["site"])
    assert {r["fact"]: r["dim_site"] for r in got.collect()} == {
        1: "Lima", 2: "Cork", 3: None, 4: "Lima", 5: None, 6: None,
    }


def test_as_of_equals_brute_force(spark, sf_dir):
    from changeflow.plans.queries import QUERIES

    dim = [tuple(r) for r in QUERIES["apply_changes_scd2"](spark, sf_dir).collect()]
    by_user = {}
    for user, segment, tier, start, version, end, _ in [
        (r[0], r[1], r[2], r[3], r[5], r[4], r[6]) for r in dim
    ]:
        by_user.setdefault(user, []).append((start, end, segment, tier))
    for r in QUERIES["as_of_dimension"](spark, sf_dir).collect():
        hits = [
            (s, t) for a, b, s, t in by_user.get(r["user_id"], []) if a <= r["ts"] and (b is None or r["ts"] < b)
        ]
        assert hits == ([] if r["dim_segment"] is None else [(r["dim_segment"], r["dim_tier"])])


def test_normalize_by_version_range(spark):
    raw = spark.createDataFrame([(41, 100), (41, 101)], "k bigint, _commit_version bigint").withColumn(
        "at", F.lit("2021-06-01 09:00:00").cast("timestamp_ntz")
    )
    fixed = scd.normalize_sequence(raw, "at", "_commit_version", [scd.VersionZone(0, 100, "Australia/Brisbane")])
    assert {r["_commit_version"]: r["at"].hour for r in fixed.collect()} == {100: 23, 101: 9}


def test_zone_offsets_are_read_from_text(spark):
    text = spark.createDataFrame([("2021-06-01 09:00:00+10:00",), ("2021-06-01T09:00:00Z",), ("2021-06-01",)], "t string")
    offsets = {r["utc_offset"] for r in scd.distinct_zone_offsets(text, "t").collect()}
    assert offsets == {"+10:00", "Z", ""}


def test_backfill_drift_is_empty_for_equal_dimensions(spark):
    dim = scd.apply_changes_scd2(seed_cdc(spark), SPEC)
    assert scd.backfill_drift(dim, dim, ["machine_id"], "__START_VERSION", "__START_AT").isEmpty()


def stepped_plainly(dim, batch):
    """The step on lists of (key, value, start, end, current) and (key, value, kind, time), change by change."""
    alive, dead = [b for b in batch if b[2] != "D"], [b for b in batch if b[2] == "D"]
    closing = {}
    for k, value, _, time in alive:
        if any(d[0] == k and d[4] and d[1] != value for d in dim):
            closing[k] = min(time, closing.get(k, time))
    dim = [(*d[:3], closing[d[0]], False) if d[4] and d[0] in closing else d for d in dim]
    open_keys = {d[0] for d in dim if d[4]}
    dim = dim + [(k, value, time, None, True) for k, value, _, time in alive if k not in open_keys]
    last = {k: max(b[3] for b in dead if b[0] == k) for k in {b[0] for b in dead}}
    return [(*d[:3], last[d[0]], False) if d[4] and d[0] in last else d for d in dim]


@pytest.mark.parametrize("seed", range(4))
def test_manual_step_equals_a_plain_one(spark, seed):
    chance = random.Random(seed)
    value = lambda: chance.choice(["a", "b", "c", None])
    dim = [(k, value(), 1, None, True) for k in range(60)] + [(k, value(), 0, 1, False) for k in range(0, 80, 3)]
    batch = [(chance.randrange(90), value(), chance.choice("IUUD"), 10 + i) for i in range(120)]
    batch += [(7, "x", "U", 500 + i) for i in range(200)]  # one key holds most of the batch
    found = scd.scd2_step(
        spark.createDataFrame(dim, "k bigint, v string, start_date int, end_date int, is_current boolean"),
        spark.createDataFrame(batch, "k bigint, v string, op string, at int"),
        scd.Scd2(["k"], ["at"], ["v"], "op = 'D'"),
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(stepped_plainly(dim, batch), key=repr)


def test_manual_step_needs_times(spark):
    dim = spark.createDataFrame([], "k bigint, v string, start_date int, end_date int, is_current boolean")
    batch = spark.createDataFrame([(1, "a", "I", None)], "k bigint, v string, op string, at int")
    with pytest.raises(Exception, match="is NULL in a row of the batch"):
        scd.scd2_step(dim, batch, scd.Scd2(["k"], ["at"], ["v"], "op = 'D'")).collect()
