"""The filter audit against a run of every order, and its SQL."""

from collections import Counter
from itertools import permutations

import pytest
from compare import connect, difference

from changeflow.llm import filter_audit
from changeflow.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, source string, _mask int, _digest string, part string, quality string, _good int"
NAME = "op11_filter_interactions"


def plain(rows):
    """(part, order, step) to counts: every document goes through every order."""
    least = {}
    for i, text, _, _, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, part, good, toxic in rows:
        text = text or ""
        words = text.encode().split()
        fails = "".join(
            name
            for name, bad in (
                ("A", len(words) < 50),
                ("B", 100 * len(set(words)) < 65 * len(words)),
                ("C", 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)),
                ("D", any(c in "#$%&*|" for c in text)),
                ("E", i is not None and i > least[text]),
            )
            if bad
        )
        docs.append((part or "", fails, good, toxic))
    out, shares = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            for step in range(1, 6):
                out[part, order, step] = Counter()
        for part, fails, good, toxic in docs:
            gone = False
            for step, name in enumerate(order, start=1):
                c, failing = out[part, order, step], name in fails
                c["unique_fails"] += fails == name
                c["redundant"] += failing and gone
                here = failing and not gone
                c["removed"] += here
                c["good_lost"] += here and good
                c["toxic_lost"] += here and toxic
                shares[part, name] += here
                gone = gone or failing
                c["kept"] += not gone
    for (part, order, step), c in out.items():
        c["shapley"] = shares[part, order[step - 1]]
    return out


def found(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): {k: r[k] for k in names} for r in df.collect()}


def test_every_order_by_brute_force(spark):
    long = " ".join(f"word{i}" for i in range(60))
    texts = [None, "", " \t", long, long, long + " #", "A" * 9 + long, "x " * 80, "X Y " * 60, long.upper() + "&", "É\x1cé " + long, "long " * 30000]
    rows = [(k % 9, t, [None, "", "a", "b"][k % 4], k % 3 == 0, k % 4 == 1) for k, t in enumerate(texts)]
    rows += [(None, long, "a", False, False), (2, long, "a", False, False), rows[3], (-5, "", "hot", False, False)]
    rows += [(100 + k, long, "hot", False, False) for k in range(40)]
    marks = {i: (any(r[3] for r in rows if r[0] == i), any(r[4] for r in rows if r[0] == i)) for i, *_ in rows if i is not None}
    rows = [(i, t, s, *marks.get(i, (False, False))) for i, t, s, _, _ in rows]
    docs = spark.createDataFrame([(i, t, s, 7, "d", "p", "q", 1) for i, t, s, _, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, int(g), int(x)) for i, (g, x) in marks.items()] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    got = found(filter_audit.filter_interactions(docs, labels))
    expected = plain(rows)
    assert got.keys() == expected.keys() and len(got) == 600 * 4
    assert all(got[k][name] == expected[k][name] for k in got for name in got[k])


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sql(spark, folder):
    assert difference(QUERIES[NAME](spark, folder), connect(folder), ORACLE_SQL[NAME]) is None


def test_empty(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_interactions(docs, labels).collect() == []


def test_other_numbers_of_filters(spark):
    masks = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (0, 3)], "p int, _mask int")
    rows = filter_audit.audit(masks, ["p"], "XY").collect()
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in rows} == {
        ("XY", 1): (2, 2, 0, 1, 3), ("XY", 2): (1, 1, 1, 1, 3), ("YX", 1): (2, 2, 0, 1, 3), ("YX", 2): (1, 1, 1, 1, 3),
    }
