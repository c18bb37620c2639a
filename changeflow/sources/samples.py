"""Small tables with declared schemas and awkward cases, to try operators by hand."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from changeflow.operators.security import tag_columns

CDC_SCHEMA = StructType(
    [
        StructField("machine_id", LongType(), False),
        StructField("model", StringType()),
        StructField("site", StringType()),
        StructField("operation", StringType(), False),
        StructField("updated_at", TimestampType(), False),
        StructField("_commit_version", LongType(), False),
    ]
)

FEED_SCHEMA = StructType(
    [
        StructField("machine_id", LongType(), False),
        StructField("site", StringType()),
        StructField("remark", StringType()),
        StructField("_change_type", StringType(), False),
        StructField("_commit_version", LongType(), False),
        StructField("_commit_timestamp", TimestampType(), False),
    ]
)

EMPLOYEE_SCHEMA = StructType(
    [
        StructField("employee_id", LongType()),
        StructField("state", StringType()),
        StructField("tfn", StringType()),
        StructField("salary", DecimalType(10, 2)),
    ]
)

EMPLOYEES_PER_STATE = {"NSW": 4, "VIC": 2, "QLD": 5, "SA": 1, "WA": 3, "TAS": 2, "ACT": 1, "NT": 2}

_START = datetime(2025, 5, 12, 6)


def seed_cdc(spark: SparkSession) -> DataFrame:
    """A raw CDC feed of machines that move between sites, one event per version.

    Machine 71 is deleted and comes back; 72 has an update that moves nothing; 73 is corrected
    late; 74 has two updates at one time; 75 goes from no site to one.
    """
    moves = """
        73 INSERT 0.25 Oslo, 71 INSERT 0.5 Lima, 73 UPDATE 6 Cork, 75 INSERT 1 -, 73 UPDATE 4.5 Bonn, 71 DELETE 2 Lima,
        74 INSERT 3 Lima, 74 UPDATE 7 Oslo, 74 UPDATE 7 Cork, 71 INSERT 8 Bonn, 75 UPDATE 9 Lima, 72 INSERT 2.25 Oslo,
        72 UPDATE 5 Oslo
    """
    rows = []
    for version, move in enumerate(moves.split(","), start=1):
        machine, operation, hours, site = move.split()
        at = _START + timedelta(hours=float(hours))
        rows.append((int(machine), f"M{machine}", None if site == "-" else site, operation, at, version))
    return spark.createDataFrame(rows, CDC_SCHEMA)


def seed_feed(spark: SparkSession) -> DataFrame:
    """A change feed of machines, one commit a day, with what consumers get wrong.

    Machine 42 goes and comes back in one commit; 41 gets a remark where it had none, while an
    update of 43 alters nothing; 43 goes for good.
    """
    story = """
        1 41 insert Oslo -, 2 42 insert Lima new, 2 43 insert Cork new, 3 42 delete Lima new, 3 42 insert Bonn new,
        4 41 update_preimage Oslo -, 4 41 update_postimage Oslo oiled, 4 43 update_preimage Cork new,
        4 43 update_postimage Cork new, 5 43 delete Cork new
    """
    rows = []
    for event in story.split(","):
        version, machine, kind, site, remark = event.split()
        at = _START + timedelta(days=int(version))
        rows.append((int(machine), site, None if remark == "-" else remark, kind, int(version), at))
    return spark.createDataFrame(rows, FEED_SCHEMA)


def seed_employees(spark: SparkSession) -> DataFrame:
    """Employees of eight states with tagged columns."""
    states = [s for s, n in EMPLOYEES_PER_STATE.items() for _ in range(n)]
    rows = [
        (i, state, f"{i:09d}", Decimal(90_000 + 1_000 * i)) for i, state in enumerate(states, start=1)
    ]
    employees = spark.createDataFrame(rows, EMPLOYEE_SCHEMA)
    return tag_columns(employees, {"tfn": "pii", "salary": "financial", "state": "state"})


def generated_rows(spark: SparkSession, n: int, text: str = "value") -> DataFrame:
    """n rows of id and text, made on the executors."""
    return spark.range(n).select(
        F.col("id"), F.concat(F.lit(f"{text}_"), F.col("id").cast("string")).alias("value")
    )
