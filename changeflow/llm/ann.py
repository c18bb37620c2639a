"""Nearest neighbours by inner product through low-dimensional stable projections.

Vectors get one more component that makes all of a block equally long, so that the largest
inner product is the smallest distance.  Gaussian (2-stable) projections take them to a few
dimensions, where squared distances are chi-square multiples of the true ones.  Each block
holds a kd-tree over its projections.  A query takes the leaves in order of their projected
distance and verifies their vectors by the exact measure.  It stops when the next leaf is so
far that a vector nearer than the k-th best would hardly be projected there: when the ratio of
projected to k-th distance passes the chi-square quantile.

Index rows and queries are dealt into blocks; each block of queries meets each block of the index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import sorted_groups, stored
from changeflow.llm.embed_dedup import _packed

NEAREST = 20
#: Projected dimensions (even) and the chance that a true neighbour passes the stopping test.
DIMENSIONS, PASS, SEED = 8, 0.97, 2
#: Vectors of one leaf, of one index block, of one block of queries.
LEAF, INDEXED, ASKED = 256, 8192, 8192


def chi_square_quantile(dimensions: int, share: float) -> float:
    """The value that a chi-square variable of even degrees of freedom stays below with this chance."""

    def below(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, dimensions // 2):
            term *= x / 2 / i
            total += term
        return 1 - total

    lo, hi = 0.0, 1.0
    while below(hi) < share:
        hi *= 2
    for _ in range(80):
        middle = (lo + hi) / 2
        lo, hi = (middle, hi) if below(middle) < share else (lo, middle)
    return hi


class Block:
    """Vectors in the order of the leaves of a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, dimensions: int, leaf: int):
        squares = (x * x).sum(axis=1)
        self.longest = float(squares.max())
        lines = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, dimensions))
        self.lines = lines[:-1]
        extra = np.sqrt(np.maximum(self.longest - squares, 0))
        projected = x @ self.lines + extra[:, None] * lines[-1]
        leaves: list[np.ndarray] = []
        open_ = [np.arange(len(x))]
        while open_:
            at = open_.pop()
            spread = np.ptp(projected[at], axis=0)
            if len(at) <= leaf or not spread.max():
                leaves += np.array_split(at, -(-len(at) // leaf))
                continue
            axis, half = int(spread.argmax()), len(at) // 2
            at = at[np.argpartition(projected[at, axis], half)]
            open_ += [at[:half], at[half:]]
        order = np.concatenate(leaves)
        self.ids, self.x = ids[order], np.ascontiguousarray(x[order])
        self.ends = np.cumsum([0, *map(len, leaves)])
        self.low = np.array([projected[at].min(axis=0) for at in leaves])
        self.high = np.array([projected[at].max(axis=0) for at in leaves])

    def nearest(self, own: int, q: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, best first, ties by id."""
        p = q @ self.lines
        gap = np.maximum(self.low - p, 0) + np.maximum(p - self.high, 0)
        away = (gap * gap).sum(axis=1)
        length = float(q @ q)
        slack = 1e-9 * math.sqrt(length * self.longest)
        ids, scores, worst = np.zeros(0, np.int64), np.zeros(0), -np.inf
        for leaf in np.argsort(away, kind="stable"):
            if len(ids) == k and away[leaf] > limit * max(0.0, length + self.longest - 2 * worst):
                break
            lo, hi = self.ends[leaf], self.ends[leaf + 1]
            at = lo + np.flatnonzero(self.x[lo:hi] @ q >= worst - slack)
            at = at[self.ids[at] != own]
            if not len(at):
                continue
            ids = np.concatenate([ids, self.ids[at]])
            scores = np.concatenate([scores, (self.x[at] * q).sum(axis=1)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                worst = scores[-1]
        return ids, scores


def nearest(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
    dimensions: int = DIMENSIONS,
    chance: float = PASS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each row where `queries` holds.

    A query isn't its own neighbour; fewer other rows give fewer neighbours.  Nearest first, ties
    to the smaller id.  Rows whose vector is null, empty, zero or holds a null or non-finite
    component take no part, nor do rows without an id.  Vectors meet vectors of equal length only.
    Equal rows count once; a query id with several vectors asks with the first of them by bytes.
    """
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    numbers = np.float32 if single else np.float64
    packed = _packed(vectors, id_col, vector_col).where("raw is not null and vec_id is not null")
    rows = stored(packed.distinct().withColumn("width", F.length("raw")), "index")
    asked = vectors.where(queries).select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    asking = rows.join(asked, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("raw").alias("raw"))
    asking = stored(asking.withColumn("width", F.length("raw")), "queries")
    blocks = max(1, -(-rows.count() // INDEXED))
    askers = max(1, -(-asking.count() // ASKED))
    dealt = F.hash("vec_id")

    def spread(df: DataFrame, own: int, others: int, asks: bool) -> DataFrame:
        mine, other = F.pmod(dealt, F.lit(own)), F.col("_other")
        block, asker = (other, mine) if asks else (mine, other)
        group = block.cast("long") * F.lit(1 << 31) + asker
        return df.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).select(
            group.alias("group"), "width", "vec_id", "raw", F.lit(asks).alias("asks")
        )

    meetings = spread(rows, blocks, askers, False).union(spread(asking, askers, blocks, True))
    limit = chi_square_quantile(dimensions, chance)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "group"):
            widths, asks = group["width"].to_numpy(), group["asks"].to_numpy(zero_copy_only=False)
            ids, raw = group["vec_id"].to_numpy(), group["raw"].combine_chunks()
            for width in np.unique(widths[asks]):
                there, here = np.flatnonzero((widths == width) & ~asks), np.flatnonzero((widths == width) & asks)
                if not len(there):
                    continue
                block = Block(ids[there], _numbers(raw, there, numbers), dimensions, LEAF)
                found = [
                    (own, *block.nearest(own, q, k, limit)) for own, q in zip(ids[here], _numbers(raw, here, numbers))
                ]
                counts = [len(x[1]) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array([x[0] for x in found], np.int64), counts)),
                        pa.array(np.concatenate([x[1] for x in found])),
                        pa.array(np.concatenate([x[2] for x in found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    found = (
        meetings.repartition(blocks * askers, "group")
        .sortWithinPartitions("group")
        .mapInArrow(search, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _numbers(raw: pa.Array, at: np.ndarray, numbers: type) -> np.ndarray:
    taken = raw.take(pa.array(at)).to_pylist()
    return np.frombuffer(b"".join(taken), numbers).reshape(len(taken), -1).astype(np.float64)
