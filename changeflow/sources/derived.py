"""Change feeds, ledgers and people derived from the star-schema test tables.

One event is one commit of a user table: version = event_id + 1.  An `error`
event deletes the user's row if there is one; any other event inserts or updates
it.  Everything here is a Spark plan over the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.contracts import DELETE, INSERT, POSTIMAGE, PREIMAGE
from changeflow.functions.ordered import KeyOrder
from changeflow.operators.security import tag_columns

REMOVE_EVENT = "error"

_LATEST: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _latest_event(spark: SparkSession, sf_dir: str) -> int:
    """The greatest event id; the tables never change, so it is read once per session."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _LATEST:
        _LATEST[known] = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return _LATEST[known]


def version_at(spark: SparkSession, sf_dir: str, percent: int) -> int:
    """The version that lies at a percentage of the whole version range."""
    return (_latest_event(spark, sf_dir) + 1) * percent // 100


def _with_last_event(events: DataFrame, columns: list[str]) -> DataFrame:
    order = KeyOrder(events, ["user_id"], ["event_id"])
    return order.with_previous(events, columns, "last")


def _alive() -> Column:
    return F.coalesce(F.col("last.event_type") != REMOVE_EVENT, F.lit(False))


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of the user table: one scan, one shuffle, images by inline."""
    events = table(spark, sf_dir, "events")

    def image(kind: str, old: bool) -> Column:
        row = "last." if old else ""
        return F.struct(
            F.col(f"{row}event_type").alias("segment"),
            F.col(f"{row}value").alias("score"),
            F.col(f"{row}props").alias("note"),
            F.lit(kind).alias("_change_type"),
        )

    removed = F.col("event_type") == REMOVE_EVENT
    images = (
        F.when(removed & _alive(), F.array(image(DELETE, True)))
        .when(~removed & _alive(), F.array(image(PREIMAGE, True), image(POSTIMAGE, False)))
        .when(~removed, F.array(image(INSERT, False)))
    )
    return (
        _with_last_event(events, ["event_type", "value", "props"])
        .select(
            "user_id",
            F.inline(images),
            (F.col("event_id") + 1).alias("_commit_version"),
            F.col("ts").alias("_commit_timestamp"),
        )
    )


def raw_cdc(spark: SparkSession, sf_dir: str, note_from: int | None = None) -> DataFrame:
    """A raw CDC table with ties on the business time and late rows.

    With `note_from`, a column `note` nobody reviewed appears at that version.
    """
    version = F.col("event_id") + 1
    extra = [] if note_from is None else [F.when(version >= note_from, F.col("props")).alias("note")]
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "user_id",
        kind.alias("segment"),
        F.floor(F.col("value") / 25).alias("tier"),
        F.when(kind == REMOVE_EVENT, "DELETE").when(kind == "signup", "INSERT").otherwise("UPDATE").alias("operation"),
        F.expr("date_trunc('hour', CASE WHEN event_id % 7 = 0 THEN ts - INTERVAL 6 HOURS ELSE ts END)")
        .cast("timestamp_ntz")
        .alias("updated_at"),
        version.alias("_commit_version"),
        *extra,
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit ledger of the user table, with a feed gap and a lost start."""
    top = version_at(spark, sf_dir, 100)
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    removed = F.col("event_type") == REMOVE_EVENT
    version = F.col("event_id") + 1
    return _with_last_event(events, ["event_type"]).select(
        F.lit("users").alias("source"),
        version.alias("version"),
        F.col("ts").alias("timestamp"),
        F.when(removed & _alive(), "DELETE")
        .when(removed, "OPTIMIZE")
        .when(_alive(), "UPDATE")
        .otherwise("INSERT")
        .alias("operation"),
        (~version.between(top * 40 // 100, top * 45 // 100)).alias("feed_enabled"),
        (version > top * 10 // 100).alias("retained"),
    )


def source_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers of five tables, one per event type; every commit writes data."""
    top = version_at(spark, sf_dir, 100)
    version = F.col("event_id") + 1
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"),
        version.alias("version"),
        F.col("ts").alias("timestamp"),
        F.lit("WRITE").alias("operation"),
        (~version.between(top * 40 // 100, top * 45 // 100)).alias("feed_enabled"),
        (version > top * 10 // 100).alias("retained"),
    )


def source_progress(ledger: DataFrame) -> DataFrame:
    """How far a consumer got on each of the five tables, relative to its newest version."""
    top, source = F.col("top"), F.col("source")
    last = (
        F.when(source == "click", top)
        .when(source == "view", F.expr("top * 5 div 100"))
        .when(source == "purchase", F.expr("top * 43 div 100"))
        .when(source == "signup", top - 100)
        .otherwise(top - 101)
    )
    return ledger.groupBy("source").agg(F.max("version").alias("top")).select(
        "source", last.cast("bigint").alias("last_version")
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as employees, with the region as their state and tagged columns."""
    customer = table(spark, sf_dir, "customer")
    # 25 nations and 5 regions whatever the scale; Spark broadcasts them by their size.
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("employee_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("department"),
            F.col("r_name").alias("state"),
            F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("tfn"),
            F.col("c_acctbal").cast("decimal(10,2)").alias("salary"),
        )
    )
    return tag_columns(rows, {"tfn": "pii", "salary": "financial", "state": "state"})


# The groups of the named readers.
READERS = {
    "asia": ["ASIA"],
    "europe": ["EUROPE"],
    "hr": ["HR", "ASIA"],
    "fin": ["Finance", "EUROPE"],
    "both": ["HR", "Finance", "AFRICA"],
    "padmin": ["platform-admins"],
    "admin": ["admins"],
    "nobody": [],
}


def principals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as readers: the group of their region, and more by account balance."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    balance = F.col("s_acctbal")
    groups = F.array(
        F.col("r_name"),
        F.when(balance > 8000, "HR"),
        F.when((balance > 6000) & (balance <= 9000), "Finance"),
        F.when(balance < 0, "platform-admins"),
        F.when(balance < -500, "admins"),
    )
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(F.col("s_name").alias("principal"), F.explode(F.array_compact(groups)).alias("group_name"))
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an audit log with nested fields."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("event_time"),
        F.when(F.col("event_id") % 2 == 0, "catalog").otherwise("jobs").alias("service_name"),
        F.col("event_type").alias("action_name"),
        F.struct(F.col("user_id").cast("string").alias("email")).alias("user_identity"),
        F.create_map(F.lit("name"), F.col("props")).alias("request_params"),
        F.struct(F.when(F.col("event_type") == REMOVE_EVENT, 500).otherwise(200).alias("status_code")).alias("response"),
    )
