"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.sources.storage import new_folder

#: Rows of a fold are those whose crc32(id as text) has this remainder modulo 3.
HELD_OUT = 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: Column | str, name: str) -> DataFrame:
    """df with _number, from 0 in the given order, without one task that sees all rows.

    Rows are sorted by range; a row's number is its place in its partition and the rows of the
    partitions before it.  Rows that tie get any order among themselves.
    """
    ranged = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        name,
    ).withColumn("_part", F.shiftright("_at", 33))
    counts = ranged.groupBy("_part").count()  # one row per partition
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(before, "_part").withColumn("_number", place + F.col("_before")).drop("_at", "_part", "_before")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(ids: Column) -> Column:
    """Whether a row may not be learned from; a null id may not either and counts as not held out."""
    return F.coalesce(F.pmod(F.crc32(ids.cast("string")), F.lit(3)) == HELD_OUT, F.lit(False))


def learnable(ids: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(ids.cast("string")), F.lit(3)) != HELD_OUT, F.lit(False))


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def least_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the components of linked positions; every position ends with its component's least position."""
    while len(a):
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(labels, x, low)
        np.minimum.at(labels, y, low)
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped
    return labels


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of one partition that is sorted by key, one at a time."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if kept and keys[lo] != last:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if kept:
        yield pa.Table.from_batches(kept)


def parts(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most `size` bytes of a text column, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, to - at)
        at = to
