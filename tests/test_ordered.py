"""Keys that are cut into parts give what the plain window gives."""

import random

import pytest
from compare import connect, difference
from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.functions import ordered
from changeflow.functions.ordered import HOT_KEY_ROWS_CONF, KeyOrder
from changeflow.plans.oracle import ORACLE_SQL
from changeflow.plans.queries import QUERIES


@pytest.fixture
def small_limit(spark):
    spark.conf.set(HOT_KEY_ROWS_CONF, "7")
    yield
    spark.conf.unset(HOT_KEY_ROWS_CONF)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one has a NULL name, many rows tie on the first column."""
    rng = random.Random(3)
    keys = ["hot"] * 300 + ["warm"] * 40 + [None] * 20 + [f"k{i}" for i in range(60)]
    rows = [
        (k, rng.choice([1, 1, 1, 1, 2, 3, None]), i, rng.choice([None, 1, 2, 5, 9]))
        for i, k in enumerate(keys)
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v int, x int").repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("kind", ["previous", "next", "max", "last"])
def test_parts_give_the_plain_window(spark, skewed, small_limit, kind):
    by = Window.partitionBy("k").orderBy("t", "v")
    order = KeyOrder(skewed, ["k"], ["t", "v"])
    assert order.cuts is not None
    if kind == "previous":
        cut = order.with_previous(skewed, ["x"], "out").withColumn("out", F.col("out.x"))
        plain = skewed.withColumn("out", F.lag("x").over(by))
    elif kind == "next":
        cut = order.with_next(skewed, ["x"], "out").withColumn("out", F.col("out.x"))
        plain = skewed.withColumn("out", F.lead("x").over(by))
    elif kind == "max":
        cut = order.with_running_max(skewed, F.col("x"), "out")
        plain = skewed.withColumn("out", F.max("x").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    else:
        cut = order.with_last_known(skewed, F.col("x"), "out")
        upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        plain = skewed.withColumn("out", F.last("x", ignorenulls=True).over(upto))
    assert rows(order.finish(cut).select(*plain.columns)) == rows(plain)


def test_parts_split_ties_on_the_first_column(spark, skewed, small_limit):
    order = KeyOrder(skewed, ["k"], ["t", "v"])
    parts = ordered._with_part(skewed, ["k"], ["t", "v"], order.cuts, order.steps)
    sizes = [r["count"] for r in parts.where("k = 'hot'").groupBy("__part").count().collect()]
    assert sum(sizes) == 300 and max(sizes) <= 14


def test_no_hot_key_means_one_plain_window(spark, skewed):
    order = KeyOrder(skewed, ["k"], ["t", "v"])
    assert order.cuts is None
    plan = order.with_previous(skewed, ["x"], "out")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_without_keys(spark, skewed, small_limit):
    order = KeyOrder(skewed, [], ["v"])
    cut = order.with_previous(skewed, ["v"], "out").select("v", "out.v").collect()
    assert sorted((a, b) for a, b in cut if b is not None) == [(i, i - 1) for i in range(1, 420)]


@pytest.mark.parametrize(
    "name",
    [
        "changes_between",
        "feed_enabled_ranges",
        "gap_window",
        "apply_changes_scd2",
        "close_intervals",
        "suppress_unchanged",
        "sequence_regressions",
        "as_of_dimension",
        "drift_impact",
        "evolve_dim2",
    ],
)
def test_queries_with_cut_keys(spark, sf_dir, small_limit, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) is None


def test_parts_of_a_hot_key_are_dealt_to_many_tasks(spark):
    rows = spark.range(40_000, numPartitions=1).select(F.lit("users").alias("k"), "id", (F.col("id") % 7).alias("x"))
    spark.conf.set(HOT_KEY_ROWS_CONF, "1000")
    try:
        order = KeyOrder(rows, ["k"], ["id"])
        cut = order.with_last_known(order.with_previous(rows, ["id"], "before"), F.when(F.col("x") == 0, F.col("id")), "last")
        held = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 40_000 and max(held) <= 4 * 1000
        wrong = (F.col("last") != F.col("id") - F.col("x")) | (F.coalesce("before.id", F.lit(-1)) != F.col("id") - 1)
        assert order.finish(cut).columns == [*rows.columns, "before", "last"] and cut.where(wrong).isEmpty()
    finally:
        spark.conf.unset(HOT_KEY_ROWS_CONF)


def test_a_key_of_some_hundred_thousand_rows_is_cut(spark):
    assert KeyOrder(spark.range(600_000).withColumn("k", F.lit(1)), ["k"], ["id"]).cuts is not None
