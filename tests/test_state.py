import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes, state
from changeflow.sources.samples import generated_rows, seed_feed

FEED = "id bigint, value string, _change_type string, _commit_version bigint, _commit_timestamp timestamp"
KEYS = ["id"]


def feed(spark, *rows):
    return spark.createDataFrame([(*r, datetime(2026, 1, 1)) for r in rows], FEED)


def live(rows):
    return sorted((r["id"], r["value"], r["last_commit_version"]) for r in state.current_snapshot(rows).collect())


def test_dml_makes_the_feed_of_the_demo(spark):
    """Insert four rows, update two of them, delete one: 4, 2, 2 and 1 change rows."""
    table = spark.createDataFrame([], "id bigint, city string, email string")
    at = datetime(2026, 1, 1)
    people = spark.createDataFrame([(i, "a", f"{i}@x") for i in range(1, 5)], table.schema)
    steps = [
        state.Dml(1, at, inserts=people),
        state.Dml(2, at, update_where=F.col("id") == 1, update_set={"city": F.lit("b")}),
        state.Dml(3, at, update_where=F.col("id") == 2, update_set={"email": F.lit("new")}),
        state.Dml(4, at, delete_where=F.col("id") == 3),
    ]
    feeds = []
    for step in steps:
        table, made = state.apply_dml(table, step)
        feeds.append(made)
    whole = changes.union_changes(feeds)
    kinds = [(r["_commit_version"], r["_change_type"]) for r in whole.collect()]
    assert sorted(kinds) == [
        (1, "insert"), (1, "insert"), (1, "insert"), (1, "insert"),
        (2, "update_postimage"), (2, "update_preimage"),
        (3, "update_postimage"), (3, "update_preimage"), (4, "delete"),
    ]
    assert {(r["id"], r["city"], r["email"]) for r in table.collect()} == {
        (1, "b", "1@x"), (2, "a", "new"), (4, "a", "4@x"),
    }
    folded = state.current_snapshot(state.fold_feed(whole, KEYS)).drop("last_commit_version")
    assert changes.reconcile(folded, table.select(*folded.columns)).isEmpty()
    assert whole.where("_commit_version BETWEEN 2 AND 3").count() == 4


def test_update_writes_images_even_without_a_change(spark):
    table = generated_rows(spark, 3)
    _, made = state.apply_dml(table, state.Dml(2, datetime(2026, 1, 1), update_where=F.lit(True)))
    assert made.count() == 6


def test_insert_ignores_existing_keys(spark):
    table = generated_rows(spark, 3)
    after, _ = state.apply_dml(table, state.Dml(2, datetime(2026, 1, 1), inserts=table))
    assert after.count() == 6


def test_two_versions_of_a_new_key_make_one_row(spark):
    batch = feed(spark, (8, "original", "insert", 1), (8, "late", "insert", 3))
    target = spark.createDataFrame([], "id bigint, value string, last_commit_version bigint")
    clauses = state.guarded_merge(KEYS, ["value"])
    once = state.merge_state(target, batch, KEYS, clauses)
    twice = state.merge_state(once, batch, KEYS, clauses)
    assert [tuple(r) for r in twice.collect()] == [(8, "late", 3)]


def test_stale_rows_lose_in_a_merge(spark):
    target = spark.createDataFrame([(1, "new", 9), (2, "new", 9)], "id bigint, value string, last_commit_version bigint")
    batch = feed(spark, (1, "old", "update_postimage", 5), (2, "old", "delete", 5), (3, None, "delete", 5))
    merged = state.merge_state(target, batch, KEYS, state.guarded_merge(KEYS, ["value"]))
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "new", 9), (2, "new", 9)]


def test_late_old_insert_does_not_revive_a_deleted_key(spark):
    start = state.empty_state(spark, feed(spark, (1, "a", "insert", 1)), KEYS)
    deleted = state.apply_changes_scd1(start, feed(spark, (1, "a", "delete", 5)), KEYS)
    again = state.apply_changes_scd1(deleted, feed(spark, (1, "a", "insert", 1)), KEYS)
    assert live(again) == []
    assert [tuple(r) for r in again.collect()] == [(1, None, 5, True)]


def test_delete_and_insert_again(spark):
    rows = feed(spark, (1, "a", "insert", 1), (1, "a", "delete", 2), (1, "b", "insert", 3))
    assert live(state.fold_feed(rows, KEYS)) == [(1, "b", 3)]
    same_commit = feed(spark, (1, "a", "delete", 2), (1, "b", "insert", 2))
    assert live(state.fold_feed(same_commit, KEYS)) == [(1, "b", 2)]


def test_floor_forgets_old_tombstones_and_late_rows(spark):
    start = state.empty_state(spark, feed(spark, (1, "a", "insert", 1)), KEYS)
    held = state.apply_changes_scd1(start, feed(spark, (1, "a", "delete", 5), (2, "b", "insert", 8)), KEYS)
    later = state.apply_changes_scd1(held, feed(spark, (1, "a", "insert", 3)), KEYS, floor=6)
    assert [tuple(r) for r in later.collect()] == [(2, "b", 8, False)]


@pytest.mark.parametrize("seed", range(4))
def test_apply_is_free_of_order_split_and_repetition(spark, seed):
    rng = random.Random(seed)
    events = []
    for version in range(1, 60):
        key, kind = rng.randint(1, 5), rng.choice(["insert", "update_postimage", "delete"])
        events.append((key, None if kind == "delete" else f"v{version}", kind, version))
    expected = {}
    for key, value, kind, version in events:
        expected[key] = None if kind == "delete" else (key, value, version)
    expected = sorted(x for x in expected.values() if x)

    shuffled = events + rng.sample(events, 20)
    rng.shuffle(shuffled)
    third = len(shuffled) // 3
    held = state.empty_state(spark, feed(spark, events[0]), KEYS)
    for part in (shuffled[:third], shuffled[third : 2 * third], shuffled[2 * third :]):
        held = state.apply_changes_scd1(held, feed(spark, *part), KEYS)
    assert live(held) == expected


def test_snapshot_diff_sees_deletes_and_nulls(spark):
    schema = "id bigint, value string"
    pre = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], schema)
    post = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, None)], schema)
    got = {r["id"]: (r["change"], r["value_before"], r["value_after"]) for r in state.snapshot_diff(pre, post, KEYS, ["value"]).collect()}
    assert got == {2: ("UPDATE", None, "b"), 3: ("DELETE", "c", None), 5: ("INSERT", None, None)}


def test_snapshot_plus_later_changes_is_now(spark):
    rows = seed_feed(spark)
    early = state.fold_feed(rows.where("_commit_version <= 2"), ["machine_id"])
    now = state.apply_changes_scd1(early, rows.where("_commit_version > 2"), ["machine_id"])
    assert changes.reconcile(now, state.fold_feed(rows, ["machine_id"])).isEmpty()


def test_latest_by_key_equals_dedupe(spark):
    rows = seed_feed(spark)
    a, b = changes.latest_by_key(rows, ["machine_id"]), changes.dedupe_latest(rows, ["machine_id"])
    assert changes.reconcile(a, b).isEmpty()


def test_reconcile_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    got = {(r["x"], r["only_in"], r["copies"]) for r in changes.reconcile(a, b).collect()}
    assert got == {(1, "left", 1), (2, "left", 1), (3, "right", 1)}


def test_aggregate_delta_keeps_a_sum_that_moves_at_count_zero(spark):
    rows = feed(
        spark,
        (1, "10", "insert", 1), (2, "20", "insert", 1),
        (1, "10", "delete", 2), (3, "70", "insert", 2),
    ).withColumn("amount", F.col("value").cast("decimal(10,0)")).withColumn("g", F.lit("x"))
    parts = [changes.signed_aggregate(rows.where(F.col("_commit_version") == v), ["g"], {"total": "amount"}) for v in (1, 2)]
    assert parts[1].first()["rows"] == 0
    whole = changes.add_aggregates(changes.union_changes(parts), ["g"]).first()
    assert (whole["rows"], int(whole["total"])) == (2, 90)


def test_redelivered_images_pair_once(spark):
    rows = seed_feed(spark)
    once = changes.pair_images(rows, ["machine_id"])
    many = changes.pair_images(changes.union_changes([rows] * 3), ["machine_id"])
    assert once.count() == 2 and changes.reconcile(once, many).isEmpty()


def test_a_state_read_back_from_files_goes_on(spark):
    """The state is written to a new folder each time and read from the last one."""
    from changeflow.operators.history import publish_snapshot
    from changeflow.sources.storage import new_folder

    rows, held = seed_feed(spark), None
    for v in (1, 2, 3, 4, 5):
        base = held if held is not None else state.empty_state(spark, rows, ["machine_id"])
        step = state.apply_changes_scd1(base, rows.where(F.col("_commit_version") == v), ["machine_id"])
        held = publish_snapshot(step, new_folder(spark, "state"))
    assert changes.reconcile(held, state.fold_feed(rows, ["machine_id"])).isEmpty()
