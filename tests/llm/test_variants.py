"""Spelling variants against a plain search of all pairs."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from changeflow.llm import variants
from changeflow.llm.queries import QUERIES

DOCS = "doc_id long, text string, word string, n long, form string, key int, shard int, root string"


def plain_words(rows):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(words):
    """All pairs of words that can meet, by deleted characters, then checked one by one."""
    at = {}
    for w in words:
        for x in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            at.setdefault(x, set()).add(w)
    near = {w: set() for w in words}
    for some in at.values():
        for a in some:
            near[a] |= {b for b in some if b not in near[a] and one_apart(a, b)}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def awkward(seed):
    rng = np.random.default_rng(seed)
    letters = list("abÀéÿZ")
    base = ["".join(rng.choice(letters, n)) for n in (7, 8, 8, 9, 12, 15) for _ in range(3)] + ["a" * 7, "a" * 8, "a" * 9, "ab" * 5]
    words = []
    for k, w in enumerate(base):
        words += [w] * (300 if k % 3 == 0 else 25 if k % 3 == 1 else 2)
        for _ in range(12):
            at, c = int(rng.integers(len(w) + 1)), str(rng.choice(letters))
            words += [rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])] * int(rng.integers(1, 25))
    return [str(w) for w in words]


@pytest.mark.parametrize("shard", [20_000, 40, 3])
def test_all_pairs_by_brute_force(spark, shard):
    words = awkward(shard)
    rows = [(k % 50, " ".join(words[k::50])) for k in range(50)] + [(None, "Wordlike wordlike Wordlike-" + words[0]), (3, None), (4, ""), (4, "12 ! x"), (7, "b" * 9000 + " " + "b" * 9000 + " " + "b" * 8999 + " " + "b" * 8999)]
    rows += [rows[1], rows[1]]
    docs = spark.createDataFrame([(i, t, "w", 1, "f", 2, 3, "r") for i, t in rows], DOCS)
    expected = plain(plain_words(rows))
    assert found(variants.spelling_variants(docs, shard=shard)) == expected
    assert sum(x[0] is not None for x in expected.values()) > 20 and max(x[3] for x in expected.values()) > 5


def test_query_by_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = found(QUERIES["op13_spelling_variants"](spark, folder))
    assert got == plain(plain_words(docs)) and len(got) > 1000


def test_index_ranks():
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abc"), int(rng.integers(7, 10)))).encode() for _ in range(60)})
    index = variants.Index(words)
    text = b"\0" + b"\0".join(words) + b"\0"
    circle = text + text
    assert index.at.tolist() == sorted(range(len(text)), key=lambda i: circle[i : i + len(text)])


def test_empty(spark):
    assert variants.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []
    assert variants.spelling_variants(spark.createDataFrame([(1, None, "w", 1, "f", 2, 3, "r")], DOCS)).collect() == []
