"""Quality rules: counts and the language model against plain Python, and bands that refuse noise."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeflow.llm import perplexity
from changeflow.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, kept string, half string, n_words int, word string, row string, _row int"
EXTRA = ("k", "h", 3, "w", "r", 1)


def plain_counts(text):
    text = text or ""
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            again += line in lines
            lines.add(line)
    n = len(words)
    stats = (n, sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), again, len(inside))
    return (*stats, n < 50 or 100 * len(inside) > 50 * n)


class Plain:
    """Interpolated modified Kneser-Ney by the textbook, with dictionaries."""

    def __init__(self, words):
        n = 5
        counts = Counter()
        for w in words:
            for i in range(0, len(w), 256):
                padded = "\x02" * (n - 1) + w[i : i + 256] + "\x03"
                counts.update(padded[k : k + n] for k in range(len(padded) - n + 1))
        self.counts = {n: counts}
        for k in range(n - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.cut, self.context = {}, {}
        for k, c in self.counts.items():
            of = Counter(c.values())
            n1, n2, n3, n4 = (of[i] for i in (1, 2, 3, 4))
            if min(n1, n2, n3, n4):
                y = n1 / (n1 + 2 * n2)
                raw = [i - (i + 1) * y * b / a for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
                cuts = [min(i, d) if d > 0 else i / 2 for i, d in enumerate(raw, 1)]
            else:
                cuts = [0.5, 1.0, 1.5]
            self.cut[k] = cuts
            by = defaultdict(list)
            for g, v in c.items():
                by[g[:-1]].append(v)
            self.context[k] = {h: (sum(v), sum(cuts[min(x, 3) - 1] for x in v) / sum(v)) for h, v in by.items()}

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(self.counts[1]) + 1)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.context[k]:
            return lower
        total, weight = self.context[k][gram[:-1]]
        c = self.counts[k].get(gram, 0)
        return (c - self.cut[k][min(c, 3) - 1] if c else 0) / total + weight * lower

    def score(self, words):
        total, size = 0.0, 0
        for w in words:
            for i in range(0, len(w), 256):
                padded = "\x02" * 4 + w[i : i + 256] + "\x03"
                for k in range(len(padded) - 4):
                    total += math.log(self.p(padded[k : k + 5]))
                    size += 1
        return total, size


def half(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 2


def rows_of(seed=0):
    rng = np.random.default_rng(seed)
    syllables = ["an", "the", "ing", "or", "ti", "on", "è"]
    rows = []
    for i in range(60):
        words = ["".join(rng.choice(syllables, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(40, 200)))]
        rows.append((i, " ".join(words), "en" if i % 3 else "fr"))
    rows += [(70, " ".join("zq%dxkj" % k for k in range(90)), "en"), (71, None, "en"), (72, "", None), (73, " \n\t ", "de"), (None, "one two", None)]
    rows += [(74, "a b c a b c\n\n x\n x\r\n x\n#*|", "en"), rows[3], (75, "w" * 3000 + " the", "en"), (76, "on a line\n" * 60, "en")]
    return rows


@pytest.mark.parametrize("sent", [perplexity.SENT, 0])
def test_counts_and_model_by_brute_force(spark, sent):
    rows = rows_of()
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS)
    found = perplexity.quality_rules(docs, sent=sent).collect()
    assert len(found) == len(rows)
    training = defaultdict(list)
    for i, text, lang in rows:
        training[lang or "", half(i)] += [w.decode() for w in (text or "").encode().split()]
    models = {of: Plain(words) for of, words in training.items() if words}
    by = {(r.doc_id, r.lang, r.n_words): r for r in found}
    for i, text, lang in rows:
        expected = plain_counts(text)
        r = by[i, lang or "", expected[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected
        model, words = models.get((lang or "", 1 - half(i))), [w.decode() for w in (text or "").encode().split()]
        if model is None or not words:
            assert r.log_ppl is None and r.kept == (not r.base_failed)
        else:
            total, size = model.score(words)
            assert r.log_ppl == pytest.approx(-total / size, abs=1e-5)
            assert r.kept == (not r.base_failed and (r.lower is None or r.lower <= r.log_ppl <= r.upper))
    assert not by[70, "en", 90].kept and not by[70, "en", 90].base_failed
    assert sum(r.kept for r in found) > 40


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows_of(1)], DOCS)
    models = perplexity.gathered(perplexity.estimate(perplexity.grams(docs)))
    plain = Plain([w.decode() for i, t, l in rows_of(1) if l == "en" and half(i) == 0 for w in (t or "").encode().split()])
    signs = [*plain.counts[1], "\x00"]
    for before in ("\x02\x02\x02\x02", "\x02the", "ting", "zzzz"):
        assert sum(plain.p(before + c) for c in signs) == pytest.approx(1)
    assert len(models) >= 4


def test_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op12_quality_rules"](spark, folder).toPandas().set_index("doc_id")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(found) == len(docs)
    for i, r in found.iterrows():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(docs[i])
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")
    both = found.join(labels, how="inner")
    good = both[(both["quality"] == 1) & ~both["base_failed"]]
    # Six of 327 are mixtures of two languages, far above the band of the one they are marked with.
    assert good["kept"].mean() > 0.975 and not found[found["base_failed"]]["kept"].any()


def test_empty(spark):
    assert perplexity.quality_rules(spark.createDataFrame([], DOCS)).collect() == []
