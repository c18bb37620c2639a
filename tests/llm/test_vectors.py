"""Nearest neighbours and near-duplicate embeddings against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import ann, embed_dedup
from changeflow.llm.common import least_labels

SCHEMA = "vec_id long, embedding array<float>, rep string, raw string, n_links int, width int"


def vectors(seed=0, n=700, width=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    x[100:220] = x[100] + 0.05 * rng.standard_normal((120, width))  # near copies
    x[220:300] = x[220]  # copies
    x[300:340] = x[300] + 0.25 * rng.standard_normal((40, width))
    x[400:500] *= rng.uniform(0.1, 5, (100, 1))
    return x.astype(np.float32)


def frame(spark, x, schema=SCHEMA):
    rows = [(i, [float(v) for v in row], "r", "w", 1, 2) for i, row in enumerate(x)]
    n = len(rows)
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [1.0] * 23]
    return spark.createDataFrame(rows + [(n + i, v, "r", "w", 1, 2) for i, v in enumerate(odd)], schema), n


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_duplicates(spark, kind):
    x = vectors()
    df, n = frame(spark, x, SCHEMA.replace("array<float>", f"array<{kind}>"))
    found = {r.vec_id: r for r in embed_dedup.near_duplicates(df).collect()}
    assert len(found) == n + 6
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    links = near.sum(axis=1) - 1
    labels = least_labels(np.arange(n), *np.nonzero(near))
    got = np.array([found[i].n_links for i in range(n)])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()
    assert (got[220:300] == 79).all() and got[100] >= 100
    assert np.mean([found[i].component_id == labels[i] for i in range(n)]) > 0.99
    for i in range(n, n + 6):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_count_is_calibrated():
    windows = embed_dedup.Windows(0.9)
    rng = np.random.default_rng(3)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * b  # cosine 0.9 to a
    lines = embed_dedup._lines(64, embed_dedup.LINES)
    hits = (np.abs(a @ lines - b @ lines) <= windows.half).sum(axis=1)
    assert (hits >= windows.count).mean() > 0.98


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "LEAST", 32)
    monkeypatch.setattr(embed_dedup, "STEP", 1000)
    df, _ = frame(spark, vectors(1))
    small = {tuple(r) for r in embed_dedup.near_duplicates(df).collect()}
    monkeypatch.undo()
    assert {tuple(r) for r in embed_dedup.near_duplicates(df).collect()} == small


def test_nearest(spark, monkeypatch):
    x = vectors(2)
    df, n = frame(spark, x)
    df = df.union(df.where("vec_id in (3, 20)"))  # repeated rows
    asked = F.col("vec_id") % 20 == 0
    full = {}
    scores = x.astype(float) @ x.astype(float).T
    for q in range(0, n, 20):
        s = [(-(x[i].astype(float) * x[q].astype(float)).sum(), i) for i in range(n) if i != q]
        full[q] = sorted(s)[:20]
    for block in (8192, 100):
        monkeypatch.setattr(ann, "INDEXED", block)
        monkeypatch.setattr(ann, "LEAF", 16)
        found = {}
        for r in ann.nearest(df, asked).orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append(r)
            assert r.score == pytest.approx(scores[r.query_id, r.vec_id], rel=1e-9, abs=1e-9)
        assert set(found) == set(full)
        hits = 0
        for q, rows in found.items():
            assert [r.rank for r in rows] == list(range(1, 21)) and q not in [r.vec_id for r in rows]
            assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
            hits += len({r.vec_id for r in rows} & {i for _, i in full[q]})
        assert hits >= 0.9 * 20 * len(full)
        copies = [r.vec_id for r in found[220] if 220 <= r.vec_id < 300]
        assert copies == list(range(221, 221 + len(copies))) and copies  # ties go to the smaller id


def test_few_candidates_and_empty_tables(spark):
    df, _ = frame(spark, vectors()[:3])
    found = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in found) == [1, 2] and {r.query_id for r in found} == {0}
    empty = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(empty, F.col("vec_id") % 20 == 0).collect() == []
    assert embed_dedup.near_duplicates(empty).collect() == []


def test_chi_square():
    rng = np.random.default_rng(0)
    draws = (rng.standard_normal((200000, 8)) ** 2).sum(axis=1)
    assert (draws <= ann.chi_square_quantile(8, 0.97)).mean() == pytest.approx(0.97, abs=0.003)


def test_planted_links_just_above_the_threshold_are_found_from_both_sides():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cosines = rng.uniform(0.9005, 0.95, 1500)
    side = rng.standard_normal((1500, 64))
    side -= (side * x[:1500]).sum(axis=1, keepdims=True) * x[:1500]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[1500:] = cosines[:, None] * x[:1500] + np.sqrt(1 - cosines**2)[:, None] * side
    windows = embed_dedup.Windows(0.9)
    ones = np.ones(len(x), np.int64)
    n, labels = embed_dedup._count(x, ones, len(x), True, 0.9, windows, embed_dedup.LINES)
    truth = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert n.sum() % 2 == 0 and n.sum() >= 0.99 * truth.sum() and (n <= truth).all()
    assert (labels == np.arange(len(x)))[:1500].all() and (labels != np.arange(len(x))).sum() * 2 == n.sum()
    split = embed_dedup._count(x, ones, 1500, False, 0.9, windows, embed_dedup.LINES)[0]
    assert split[:1500].sum() == split[1500:].sum() >= 0.99 * 1500
