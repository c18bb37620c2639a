"""Near-duplicate embeddings by counting collisions of sorted projections.

Every unit vector is projected on many random lines.  On a line, two vectors collide if their
values lie in one window centred on either of them.  Vectors as close as the threshold asks
collide on a known share of the lines, and the count that a pair must reach is calibrated so
that such a pair passes with a given probability.  Pairs that pass are verified by their exact
cosine, so no link below the threshold is ever made; links found on the way stay, whatever their count.

The order of the first line also deals the work out: it is cut into blocks of equal size, and
two blocks meet unless their value ranges lie further apart than close vectors can.  A task
takes two blocks and counts in them on all lines, value by value (only the first line is kept in sorted order:
a window holds near half of the vectors of a block, so that sorting the others saves nothing), and it gives one number of links per vector and a
spanning forest of the links, never the pairs themselves.  Equal vectors are one class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import least_labels, numbered, sorted_groups, stored
from changeflow.llm.graph import components

COSINE = 0.9
LINES, SEED = 32, 10
#: A window reaches as far as this many standard deviations of a pair at the threshold.
REACH = 1.7
#: Part of the pairs at the threshold that must pass the count, and that two blocks that don't meet may lose.
RECALL, ROUTED = 0.995, 0.9995
#: Vectors of one block: as many as make this number of blocks, between the bounds.
BLOCKS, LEAST, MOST = 12, 256, 8192
#: Tasks that the meetings of blocks are dealt to, at most; each takes one meeting after another.
MOST_TASKS = 20_000
#: Comparisons of one step.
STEP = 1 << 20


class Windows:
    """Half width of a window, collisions that a pair needs, and the range beyond which blocks don't meet."""

    def __init__(self, cosine: float, lines: int = LINES):
        spread = math.sqrt(max(2 - 2 * cosine, 1e-12))
        normal = NormalDist()
        self.half = REACH * spread
        share = 2 * normal.cdf(REACH) - 1
        self.count = max(c for c in range(lines + 1) if _at_least(c, lines, share) >= RECALL)
        self.route = normal.inv_cdf((1 + ROUTED) / 2) * spread


def _at_least(count: int, n: int, p: float) -> float:
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(count, n + 1))


def _lines(width: int, lines: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, lines))


def _packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, raw): components as bytes in their own precision; null if one is null or not finite or all are zero."""
    kind = vectors.schema[vector_col].dataType.elementType
    single = isinstance(kind, T.FloatType)
    numbers = np.float32 if single else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                if not value.is_valid:
                    out.append(None)
                    continue
                x = value.values.to_numpy(zero_copy_only=False).astype(numbers)
                usable = len(x) and np.isfinite(x).all() and x.any()
                out.append((x + numbers(0)).tobytes() if usable else None)  # -0 is 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "raw"])

    narrow = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast(f"array<{'float' if single else 'double'}>").alias("v"),
    )
    return narrow.mapInArrow(pack, "vec_id long, raw binary")


def _matrix(column: pa.ChunkedArray, single: bool) -> np.ndarray:
    """Unit vectors in double precision."""
    raw = column.combine_chunks().to_pylist()
    x = np.frombuffer(b"".join(raw), np.float32 if single else np.float64).reshape(len(raw), -1).astype(np.float64)
    return _unit(x)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    lines: int = LINES,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors.

    Two rows are linked if the cosine of their vectors is `cosine` or more.  Rows whose vector is
    null, empty, zero or holds a null or non-finite component, and rows whose vectors differ in
    length, are not linked.  Rows of one id are different vectors, each with the id's row count of
    links.  Equal vectors are linked to each other.  An empty table gives no rows.
    """
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    rows = stored(_packed(vectors, id_col, vector_col), "vectors")
    classes = (
        rows.where("raw is not null and vec_id is not null")
        .groupBy("raw")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    classes = stored(classes.withColumn("width", F.length("raw")), "classes")
    compared = stored(_compared(classes, cosine, lines, single), "compared")
    forest = compared.where("b is not null and a <> b").select("a", "b")
    found = components(forest)
    counts = compared.where("n is not null").groupBy("a").agg(F.sum("n").alias("n"))
    named = (
        classes.join(counts, classes["rep"] == counts["a"], "left")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("raw").alias("_raw"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = rows.join(named, F.col("raw") == F.col("_raw"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _compared(classes: DataFrame, cosine: float, lines: int, single: bool) -> DataFrame:
    """(a, b, n): links of class a in one task as a number n, and forest links (a, b)."""
    windows = Windows(cosine, lines)
    size = 4 if single else 8

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.zeros(batch.num_rows)
            width = batch.column("width").to_numpy()
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                x = _matrix(pa.chunked_array([batch.column("raw").take(pa.array(at))]), single)
                value[at] = x @ _lines(w // size, lines)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=[*batch.schema.names, "value"])

    block = min(MOST, max(LEAST, -(-classes.count() // BLOCKS)))
    valued = classes.mapInArrow(first_line, "raw binary, rep long, copies long, width int, value double")
    placed = stored(
        numbered(valued, "width", "value", "rep", name="sorted").withColumn(
            "block", F.floor(F.col("_number") / block).cast("int")
        ),
        "placed",
    )
    spans = placed.groupBy("block", "width").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    spans = stored(spans, "spans")
    one, two = spans.alias("one"), spans.alias("two")
    meets = one.join(two, "width").where(
        (F.col("one.block") <= F.col("two.block")) & (F.col("two.lo") - F.col("one.hi") <= windows.route)
    )
    meets = stored(meets.select("width", F.col("one.block").alias("i"), F.col("two.block").alias("j")), "meets")
    sides = meets.select("width", F.col("i").alias("block"), "i", "j", F.lit(True).alias("left"))
    sides = sides.union(meets.where("i <> j").select("width", F.col("j"), "i", "j", F.lit(False)))
    dealt = placed.join(sides, ["width", "block"]).select(
        (F.col("i").cast("long") * F.lit(1 << 31) + F.col("j")).alias("pair"),
        "width",
        "rep",
        "copies",
        "raw",
        "left",
        (F.col("i") == F.col("j")).alias("same"),
    )
    tasks = max(1, min(MOST_TASKS, meets.count()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "pair"):
            for width in np.unique(group["width"].to_numpy()):
                part = group.filter(pc.equal(group["width"], int(width)))
                left = part["left"].to_numpy(zero_copy_only=False)
                order = np.argsort(~left, kind="stable")
                x = _matrix(part["raw"], single)[order]
                rep, copies = part["rep"].to_numpy()[order], part["copies"].to_numpy()[order]
                same = bool(part["same"][0].as_py())
                n, labels = _count(x, copies, int(left.sum()), same, cosine, windows, lines)
                some, moved = np.flatnonzero(n), np.flatnonzero(labels != np.arange(len(rep)))
                nothing = pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([rep[some], rep[moved]])),
                        pa.concat_arrays([nothing(len(some), pa.int64()), pa.array(rep[labels[moved]])]),
                        pa.concat_arrays([pa.array(n[some]), nothing(len(moved), pa.int64())]),
                    ],
                    names=["a", "b", "n"],
                )

    return dealt.repartition(tasks, "pair").sortWithinPartitions("pair").mapInArrow(compare, "a long, b long, n long")


def _count(
    x: np.ndarray, copies: np.ndarray, left: int, same: bool, cosine: float, windows: Windows, lines: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector, equal vectors not counted, and its least linked position.

    The first `left` vectors meet the others, or each other if there is one block only.
    Values are compared as whole steps of an eighth of a window, so that values in a window
    differ by at most 9 steps; those beyond the range of the steps may collide more than they do.
    """
    steps = np.floor(x @ _lines(x.shape[1], lines) / (windows.half / 8))
    values = np.clip(steps, -63, 63).astype(np.int8).T.copy()
    n, labels = np.zeros(len(x), np.int64), np.arange(len(x))
    others = slice(0, left) if same else slice(left, len(x))
    first, partner = values[:, :left], values[:, others]
    width = partner.shape[1]
    if not left or not width:
        return n, labels
    step = max(1, STEP // width)
    # Which vectors have a pair that passes; the same for both sides of a pair, whatever the step it lies in.
    some, partners = np.zeros(left, bool), np.zeros(width, bool)
    for at in range(0, left, step):
        hits = np.zeros((min(step, left - at), width), np.uint8)
        for line in range(lines):
            gap = first[line, at : at + step, None] - partner[line][None, :]
            hits += np.abs(gap, out=gap) <= 9
        passed = hits >= windows.count
        if same:  # every vector passes with itself
            passed[np.arange(len(hits)), at + np.arange(len(hits))] = False
        some[at : at + step] |= passed.any(axis=1)
        partners |= passed.any(axis=0)
    rows, columns = np.flatnonzero(some), np.flatnonzero(partners)
    step = max(1, STEP // max(1, len(columns)))
    for at in range(0, len(rows), step):
        # All pairs of such vectors get their cosine, and a link that it finds stays, whatever its own count.
        i, j = np.nonzero(x[rows[at : at + step]] @ x[others][columns].T >= cosine)
        i, j = rows[at + i], (0 if same else left) + columns[j]
        i, j = i[i != j], j[i != j]
        n += np.bincount(i, copies[j], len(x)).astype(np.int64)
        if not same:
            n += np.bincount(j, copies[i], len(x)).astype(np.int64)
        labels = least_labels(labels, i, j)
    return n, labels
