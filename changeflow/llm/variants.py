"""Spelling variants: words of a vocabulary that differ in one character, by FM-index search.

If two words differ by one inserted, deleted or replaced character, one half of the searched
word stands unchanged in the other.  The search scheme has two parts: the right half is matched exactly and
the match goes on to the left with one error, or the left half is matched and it goes on to
the right.  The second part runs on the index of the reversed words, so that both extend to the left
of what is matched: a bidirectional index is such a pair.  A match ends at a delimiter, and a rank interval then names
one word.

The index is cut by what a search needs to match exactly: a word lies, once per part, in the
shard of its length and of as many of its end characters as any searched half has.  A search visits
three shards per part, one for each length, each with one kind of error.  A shard's words are read first and
searches stream past them.  Keys with very many words are cut into several shards, which each get the searches.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import stored

#: Characters of a run, least length and count of a word, divisor of what loses a character, ratio of a form.
RUN = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, LOSES, RATIO = 7, 2, 31, 10
#: Words of one shard, and words that a counting task holds.
SHARD, HELD = 20_000, 500_000
#: Characters that one interval may hold to be expanded by its own characters and not by the alphabet.
NARROW = 64


def words_of(doc_id, text: str | None, longest: re.Pattern) -> Counter:
    """The words of one text with their counts; a null id is written as nothing."""
    out: Counter = Counter()
    if not text:
        return out
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: only A-Z
    for run, n in Counter(longest.findall(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of all texts of at least 7 characters and 2 occurrences; counted in each task first."""
    pattern = f"[{RUN}]{{{LEAST_LENGTH},}}"  # a shorter run has no word, whatever it loses

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, held = re.compile(pattern), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                held.update(words_of(doc_id.as_py(), text.as_py(), longest))
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    texts = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return (
        texts.mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


class Index:
    """FM-index of delimited byte strings: ranks of suffixes by backward search."""

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        self.size = n = len(text)
        self.at = _suffixes(text)
        self.last = text[self.at - 1]
        # Characters with their ranks in order: how many are below (c, i) is where c's suffixes begin and its rank at i.
        self.keys = np.sort(self.last.astype(np.int64) * (n + 1) + np.arange(n))
        self.letters = np.unique(text[text > 0]).astype(np.int64)
        self.starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]  # places of the delimiters before them

    def extend(self, char: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals with one more character to the left."""
        base = char.astype(np.int64) * (self.size + 1)
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, character): what stands to the left of each interval, delimiters left out."""
        size = hi - lo
        wide, narrow = np.flatnonzero(size > NARROW), np.flatnonzero(size <= NARROW)
        amount = size[narrow]
        of = np.repeat(narrow, amount)
        place = np.arange(len(of)) - np.repeat(np.cumsum(amount) - amount, amount) + lo[of]
        found = np.unique(of * 256 + self.last[place])
        found = found[found % 256 > 0]
        all_ = (wide[:, None] * 256 + self.letters).ravel()
        both = np.concatenate([found, all_])
        return both // 256, both % 256


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text read as a circle, by doubling."""
    n, step = len(text), 1
    rank = text.astype(np.int64)
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if new.max() == n - 1 or step >= n:
            return order
        rank, step = new, step * 2


def search(index: Index, words: list[bytes], half: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(search, word of the index) of every match of a search, each once.

    The last `half` characters match exactly; one error follows, and the delimiter.  kind says how
    much longer the match is: 1 has a character more, 0 another one, -1 one less.
    """
    buffer = np.frombuffer(b"".join(words), np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(length) - length
    rest = length - half
    lo, hi = np.zeros(len(words), np.int64), np.full(len(words), int(index.keys.searchsorted(index.size + 1)))
    alive = np.arange(len(words))
    for j in range(1, int(half.max(initial=0)) + 1):
        some = alive[half[alive] >= j]
        lo[some], hi[some] = index.extend(buffer[begin[some] + length[some] - j], lo[some], hi[some])
        alive = alive[hi[alive] > lo[alive]]
    joins = alive[np.argsort(-rest[alive], kind="stable")]
    waiting, nothing = 0, np.zeros(0, np.int64)
    exact, wrong = (nothing, nothing, nothing), (nothing, nothing, nothing)  # search, lo, hi

    def both(a: tuple, *more: tuple) -> tuple:
        return tuple(np.concatenate(x) for x in zip(a, *more))

    def left(state: tuple, r: int) -> tuple:
        q, a, b = state
        a, b = index.extend(buffer[begin[q] + r - 1], a, b)
        keep = b > a
        return q[keep], a[keep], b[keep]

    for r in range(int(rest[joins[0]]) if len(joins) else -1, -1, -1):
        upto = waiting
        while upto < len(joins) and rest[joins[upto]] == r:
            upto += 1
        new = joins[waiting:upto]
        waiting = upto
        exact = both(exact, (new, lo[new], hi[new]))
        q, a, b = exact
        later = (nothing, nothing, nothing)
        for k in (1, 0):
            some = kind[q] == k if k or r else np.zeros(len(q), bool)
            of, char = index.branches(a[some], b[some])
            qs = q[some][of]
            if k == 0:
                other = char != buffer[begin[qs] + r - 1]
                of, char, qs = of[other], char[other], qs[other]
            x, y = index.extend(char, a[some][of], b[some][of])
            ok = y > x
            grown = (qs[ok], x[ok], y[ok])
            if k:
                wrong = both(wrong, grown)
            else:
                later = grown
        if r:
            less = kind[q] == -1
            later = both(later, (q[less], a[less], b[less]))
            exact, wrong = left(exact, r), both(left(wrong, r), later)
    q, a, b = wrong
    a, b = index.extend(np.zeros(len(q), np.int64), a, b)
    keep = b > a  # a delimited word is there once
    found = np.unique(q[keep] * len(index.starts) + np.searchsorted(index.starts, index.at[a[keep]]))
    return found // len(index.starts), found % len(index.starts)


def _half(length, right):
    """Characters of the half of a word that a part of the scheme matches exactly; numbers, arrays or columns."""
    return length // 2 + right * (length % 2)


def nearest_forms(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """(word, n_near, form_n, form) of the words(word, n) with a near word; form is the near word of largest n.

    Words are distinct, of characters up to U+00FF and of at least 7 of them.  Each word counts its near words
    shard by shard; a pair is found in one shard only: where the left half stands unchanged, in the part that matches it,
    otherwise in the other part.
    """
    amount = words.count()
    shards = -(-2 * amount // shard)
    length = F.length("word")

    def key(right: bool, of: Column) -> Column:
        """Side, length of the match, and what it shares with any search that can find it."""
        size = F.floor((of - 1) / 2) + (F.pmod(of - 1, F.lit(2)) if right else 0)
        part = F.substring("word", 1, size) if not right else F.substring("word", length - size + 1, size)
        return F.struct(F.lit(right).alias("right"), of.cast("int").alias("length"), part.alias("part"))

    def rows(kinds: list[int], is_search: bool) -> DataFrame:
        visits = [
            F.struct(key(right, length + k).alias("key"), F.lit(k).alias("kind")) for right in (False, True) for k in kinds
        ]
        return words.select("word", "n", F.lit(is_search).alias("search"), F.inline(F.array(*visits)))

    placed, asked = rows([0], False), rows([-1, 0, 1], True)
    hot = stored(placed.groupBy("key").count().where(F.col("count") > shard), "hot-keys")
    home = F.pmod(F.xxhash64("key"), F.lit(max(1, shards)))
    if hot.isEmpty():
        placed, asked = placed.withColumn("shard", home), asked.withColumn("shard", home)
    else:
        cuts = hot.select("key", F.ceil(F.col("count") / shard).cast("int").alias("cuts"))
        # Beyond the home shards a cut key has its own, named by its hash and the number of the cut.
        own = F.when(F.col("cut").isNull(), home).otherwise(
            F.xxhash64("key", "cut").bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
        )
        cut = F.when(F.col("cuts").isNotNull(), F.pmod(F.xxhash64("word"), F.col("cuts")))
        placed = placed.join(cuts, "key", "left").withColumn("cut", cut.cast("int")).withColumn("shard", own)
        spread = F.when(F.col("cuts").isNull(), F.array(F.lit(None).cast("int"))).otherwise(
            F.sequence(F.lit(0), F.col("cuts") - 1)
        )
        asked = asked.join(cuts, "key", "left").withColumn("cut", F.explode(spread)).withColumn("shard", own)
    columns = ["shard", "search", F.col("key.right").alias("right"), "kind", "word", "n"]
    sent = placed.select(*columns).union(asked.select(*columns))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, indexes = None, [], {}
        for batch in batches:
            shard_of = batch.column("shard").to_numpy(zero_copy_only=False)
            search_of = batch.column("search").to_numpy(zero_copy_only=False)
            mark = np.flatnonzero((shard_of[1:] != shard_of[:-1]) | (search_of[1:] != search_of[:-1])) + 1
            cuts = [0, *mark.tolist(), len(shard_of)] if len(shard_of) else []
            for lo, hi in zip(cuts, cuts[1:]):
                piece = batch.slice(lo, hi - lo)
                if shard_of[lo] != at:
                    at, held, indexes = shard_of[lo], [], {}
                if not search_of[lo]:
                    held.append(piece)
                    continue
                if held:
                    indexes, held = _indexes(pa.Table.from_batches(held)), []
                yield from _matches(piece, indexes)

    return (
        sent.repartition("shard")
        .sortWithinPartitions("shard", "search")
        .mapInArrow(find, "word string, n_near long, form_n long, form string")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")
    )


def _turned(word: str, right: bool) -> bytes:
    return word.encode("latin-1") if right else word[::-1].encode("latin-1")


def _indexes(rows: pa.Table) -> dict[bool, tuple[Index, list[str], np.ndarray]]:
    """By part: the index of the words of a shard in code-point order, the words, and their counts."""
    out = {}
    of = rows["right"].to_numpy(zero_copy_only=False)
    for right in (False, True):
        mine = sorted(zip(*(rows.filter(pa.array(of == right))[c].to_pylist() for c in ("word", "n"))))
        if mine:
            words = [w for w, _ in mine]
            counts = np.array([n for _, n in mine], np.int64)
            out[right] = Index([_turned(w, right) for w in words]), words, counts
    return out


def _matches(rows: pa.RecordBatch, indexes: dict) -> Iterator[pa.RecordBatch]:
    """Searches with the number of their near words in a shard and the best of them."""
    of = rows.column("right").to_numpy(zero_copy_only=False)
    for right, (index, words, counts) in indexes.items():
        mine = rows.filter(pa.array(of == right))
        asked = mine.column("word").to_pylist()
        if not asked:
            continue
        length = np.fromiter(map(len, asked), np.int64, len(asked))
        kind = mine.column("kind").to_numpy(zero_copy_only=False)
        q, found = search(index, [_turned(w, right) for w in asked], _half(length, right), kind)
        if right:  # those with the same left half are found by the other part
            ends = length // 2
            keep = np.array([not words[w].startswith(asked[i][: ends[i]]) for i, w in zip(q.tolist(), found.tolist())], bool)
            q, found = q[keep], found[keep]
        order = np.lexsort((found, -counts[found], q))
        q, found = q[order], found[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        near = np.diff(np.append(first, len(q)))
        best = found[first]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([asked[i] for i in q[first].tolist()], pa.string()),
                pa.array(near, pa.int64()),
                pa.array(counts[best], pa.int64()),
                pa.array([words[w] for w in best.tolist()], pa.string()),
            ],
            names=["word", "n_near", "form_n", "form"],
        )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms(word, form): the last word that following forms leads to, by doubling the steps.

    Forms have ten times the count, so chains are short; many words may have one form.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = reached.join(on, "root", "left")
        if further.where("next is not null").isEmpty():
            return reached
        reached = stored(further.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts, see `vocabulary`.

    A form is the near word of largest count (the first by code points of several), if it has ten times
    the word's count; the root is where forms lead.  Null, empty and wordless texts have no words, rows count as often
    as they are there, a null id is written as nothing before the colon, other columns are ignored, and no documents give no rows.
    """
    words = stored(vocabulary(docs, id_col, text_col), "vocabulary")
    near = nearest_forms(words, shard)
    large = F.col("form_n") >= F.col("n") * RATIO
    named = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(large, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(named.where("form is not null"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
