"""Mixing: targets against plain water filling, copies against their rules."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from changeflow.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies string, target int"


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        share = (total - sum(target.values())) / sum(weight[s] for s in open_)
        above = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        if not above:
            return target | {s: share * weight[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in above}
        open_ -= above
    return target


def corpus(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    sources = ["hot"] * 12 + ["b", "é", "tiny", "z", None, "Z"]
    rows = []
    for i in range(n):
        source = sources[int(rng.integers(len(sources)))]
        words = int(rng.integers(0, 4)) if source == "tiny" else int(min(900, rng.lognormal(3, 1)))
        rows.append((i, " ".join(["w"] * words) if i % 97 else None, source, "s", "c", 1))
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    rows = corpus()
    rows += rows[5:9]
    return rows, mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()


def test_targets_and_taken(mixed):
    rows, found = mixed
    sizes, largest = Counter(), Counter()
    for _, text, source, *_ in rows:
        size = len((text or "").split())
        sizes[source] += size
        largest[source] = max(largest[source], size)
    expected = plain_targets(dict(sizes))
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], abs=1e-6)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
    assert len(found) == len(rows)
    assert sum(expected.values()) == pytest.approx(sum(sizes.values()))
    for source, words in taken.items():
        assert abs(words - expected[source]) <= largest[source] / 2 + 1e-6
    assert any(expected[s] == 3 * sizes[s] for s in sizes)  # one source stops at its limit


def test_reruns_agree(spark, mixed):
    rows, found = mixed
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_expectation(spark):
    rows = [(i, "w " * 5, "ab"[i % 4 == 0], "s", "c", 1) for i in range(4000)]
    copies = Counter()
    for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect():
        copies[r.source, r.copies] += 1
    assert copies["b", 2] + copies["b", 3] == 1000  # target 2/3 of 20000 words from 5000
    assert abs(copies["b", 3] - 667) <= 1 and abs(copies["a", 1] - 1333) <= 1


def test_rows_are_repeated(spark):
    rows = corpus(400, 1)
    rows += rows[3:5]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    decided = Counter()
    for r in mixing.mix(docs).collect():
        decided[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +decided


@pytest.mark.parametrize("rows", [[], [(1, None, None, "s", "c", 1)], [(1, "", "a", "s", "c", 1), (None, " ", None, "s", "c", 1)]])
def test_nothing_to_take(spark, rows):
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows) and all(r.copies == 0 and r.target == 0 for r in found)
    assert mixing.mixed_rows(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_only_dataframe_functions(spark, capsys):
    mixing.mix(spark.createDataFrame(corpus(50), SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
