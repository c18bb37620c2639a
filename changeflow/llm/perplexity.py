"""Quality rules: counts of words, symbols and repeats, and bands of n-gram perplexity per language.

The language model is a modified Kneser-Ney model of the characters of words: n-grams of five
characters, a word being a sentence of its own.  Characters, because word n-grams of a corpus are nearly all
unique, while a character model stays small beside its corpus and still knows the language from noise.
Spark counts it over all documents: words first, their n-grams once per distinct word, lower orders as continuation counts.

A document would find its own n-grams in a model of all documents and look likelier than it is.  So there are
two models per language, of either half of the documents by a hash of the id, and a document is
scored by the model of the other half.

Tasks look n-grams up in sorted arrays of hashes.  The arrays are sent to the tasks while they have at most
`SENT` entries; a larger model is joined instead, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import parts, stored, type_of

#: Characters of an n-gram, and of a piece of a word; longer words are scored in pieces.
ORDER, PIECE = 5, 256
#: Entries of a model that are sent to the tasks, 16 bytes each.
SENT = 6_000_000
#: Bytes of text that are held at once.
HELD = 16 << 20
#: Marks of the beginning and the end of a word.
BEGIN, END = "\x02", "\x03"
#: Fixed values of the base rules: least words, and percent of words in repeated windows.
LEAST_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS, SPACE = b"#*$%&|<>", " \t\n\x0b\x0c\r"
#: Width of a band in deviations below and above, the least deviation (in nats per character), the deviation
#: of one character's logarithm, and documents without which a language has no bands.
BELOW, ABOVE, LEAST_SPREAD, NOISE, LEAST_DOCS = 2.75, 6.0, 0.02, 2.0, 20
#: Steps in which logarithms of perplexity are counted for medians.
STEP = 0.002
#: Multiplier of the polynomial hash of an n-gram's code points, modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
WORD = rf"([^\x20\x09-\x0D]{{1,{PIECE}}})"


def half_of(ids: Column) -> Column:
    """The half of the documents that a row is in; a null id is in the first."""
    return F.coalesce(F.pmod(F.crc32(ids.cast("string")), F.lit(2)), F.lit(0)).cast("int")


def grams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, half, gram, n): five-character n-grams of the words of all documents; a null language is the empty one."""
    spaced = F.translate(F.col(text_col).cast("string"), SPACE, " " * len(SPACE))
    words = (
        docs.select(
            F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
            half_of(F.col(id_col)).alias("half"),
            F.explode(F.split(spaced, " ")).alias("word"),
        )
        .where("word <> ''")
        .groupBy("lang", "half", "word")
        .agg(F.count("*").alias("n"))
    )
    pieces = F.regexp_extract_all("word", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    each = F.when(F.length("word") <= PIECE, _grams_of(F.col("word"))).otherwise(F.flatten(F.transform(pieces, _grams_of)))
    return words.select("lang", "half", "n", F.explode(each).alias("gram")).groupBy("lang", "half", "gram").agg(
        F.sum("n").alias("n")
    )


def _grams_of(word: Column) -> Column:
    """The n-grams that end in each character of a word and in its end mark."""
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), word, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))


def estimate(top: DataFrame) -> DataFrame:
    """(lang, half, size, gram, seen, value): the model of n-gram counts `top`, as logarithms.

    seen: the probability of the last character of an n-gram of `size` characters after the others.
    Else: the weight with which an n-gram of `size` characters that was not seen after the context `gram`
    backs off to the next shorter one; at size 1 it is the probability of an unknown character.
    Discounts are those of modified Kneser-Ney per order, from the counts of counts; where one of these is
    zero, or a discount would not be above it, a half, one and one and a half stand in.
    """
    of = ["lang", "half"]
    tables = {ORDER: stored(top, "grams")}
    for size in range(ORDER - 1, 0, -1):
        shorter = F.substring("gram", 2, size).alias("gram")
        tables[size] = stored(tables[size + 1].select(*of, shorter).groupBy(*of, "gram").agg(F.count("*").alias("n")), "grams")
    below, out = None, []
    for size in range(1, ORDER + 1):
        table = tables[size].withColumn("context", F.substring("gram", 1, size - 1))
        counts = [F.count(F.when(F.col("n") == k, 1)).alias(f"c{k}") for k in range(1, 5)]
        c = [F.col(f"c{k}") for k in range(1, 5)]
        y = F.try_divide(c[0], c[0] + 2 * c[1])
        some = F.least(*c) > 0
        raw = [k - (k + 1) * y * F.try_divide(c[k], c[k - 1]) for k in (1, 2, 3)]
        cuts = [F.when(some & (d > 0), F.least(F.lit(float(k)), d)).otherwise(k / 2) for k, d in enumerate(raw, 1)]
        discounts = tables[size].groupBy(*of).agg(*counts).select(*of, *[d.alias(f"d{k}") for k, d in enumerate(cuts, 1)])
        kinds = [F.count(F.when(test, 1)) for test in (F.col("n") == 1, F.col("n") == 2, F.col("n") > 2)]
        contexts = (
            table.groupBy(*of, "context")
            .agg(F.sum("n").alias("total"), F.count("*").alias("types"), *[k.alias(f"n{i}") for i, k in enumerate(kinds, 1)])
            .join(discounts, of)
            .withColumn("rest", sum((F.col(f"d{k}") * F.col(f"n{k}") for k in (1, 2, 3)), F.lit(0.0)) / F.col("total"))
        )
        if size == 1:
            contexts = contexts.withColumn("rest", F.col("rest") / (F.col("types") + 1))
        contexts = stored(contexts.select(*of, "context", "total", "rest", "d1", "d2", "d3"), "contexts")
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = table.join(contexts, [*of, "context"])
        lower = F.col("rest") if size == 1 else F.col("rest") * F.col("p_below")
        if below is not None:
            rows = rows.withColumn("suffix", F.substring("gram", 2, size - 1)).join(below, [*of, "suffix"])
        found = stored(rows.select(*of, "gram", ((F.col("n") - cut) / F.col("total") + lower).alias("p")), "chances")
        below = found.select(*of, F.col("gram").alias("suffix"), F.col("p").alias("p_below"))
        at = F.lit(size).alias("size")
        out.append(found.select(*of, at, "gram", F.lit(True).alias("seen"), F.log("p").alias("value")))
        weight = F.log("rest").alias("value")
        out.append(contexts.select(*of, at, F.col("context").alias("gram"), F.lit(False).alias("seen"), weight))
    model = out[0]
    for more in out[1:]:
        model = model.union(more)
    return model


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _powers() -> list[np.uint64]:
    return [np.uint64(pow(BASE, k, 1 << 64)) for k in range(ORDER)]


def gram_hashes(grams: list[str]) -> np.ndarray:
    """Polynomial hashes of n-grams, as signed longs."""
    out, sizes = np.zeros(len(grams), np.uint64), np.fromiter(map(len, grams), np.int64, len(grams))
    for size in range(1, ORDER + 1):
        some = np.flatnonzero(sizes == size)
        codes = _codes("".join([grams[k] for k in some.tolist()])).reshape(-1, size)
        for k, power in enumerate(_powers()[:size]):
            out[some] += codes[:, size - 1 - k] * power
    return out.view(np.int64)


@dataclass
class Arrays:
    """The model of one language and half: sorted arrays of hashes and their values, by (size, seen)."""

    sorted: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]

    def _find(self, size: int, seen: bool, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = self.sorted.get((size, seen), (np.zeros(0, np.uint64), np.zeros(0)))
        if not len(keys):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return keys[at] == hashes, values[at]

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logarithm of the probability of each word, and its number of characters with the end mark of each piece."""
        pieces, owner = [], []
        for k, word in enumerate(words):
            for at in range(0, len(word), PIECE):
                pieces.append(word[at : at + PIECE])
                owner.append(k)
        if not pieces:
            return np.zeros(len(words)), np.zeros(len(words), np.int64)
        pad = BEGIN * (ORDER - 1)
        codes = _codes("".join(f"{pad}{p}{END}" for p in pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1
        ends = np.cumsum(sizes + ORDER - 1)
        of = np.repeat(np.arange(len(pieces)), sizes)
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + (ends - sizes)[of]
        hashes, shifted = [np.zeros(len(codes), np.uint64)], codes
        for power in _powers():
            hashes.append(hashes[-1] + shifted * power)
            shifted = np.concatenate([np.zeros(1, np.uint64), shifted[:-1]])
        # The last characters decide: each distinct n-gram is looked up once.
        _, first, which = np.unique(hashes[ORDER][place], return_index=True, return_inverse=True)
        place = place[first]
        chance, open_ = np.zeros(len(place)), np.arange(len(place))
        for size in range(ORDER, 0, -1):
            hit, value = self._find(size, True, hashes[size][place[open_]])
            chance[open_[hit]] += value[hit]
            open_ = open_[~hit]
            hit, value = self._find(size, False, hashes[size - 1][place[open_] - 1])
            chance[open_[hit]] += value[hit]
        by = np.array(owner)[of]
        return np.bincount(by, chance[which], len(words)), np.bincount(by, minlength=len(words))


def model_key(lang: Column, half: Column) -> Column:
    """What names the model of a language and half."""
    return F.xxhash64(lang, half)


def gathered(model: DataFrame) -> dict[int, Arrays]:
    """The arrays by `model_key` of a model of a size that was checked; n-grams are hashed in the tasks."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = pa.array(gram_hashes(batch.column("gram").to_pylist()))
            columns = [batch.column("of"), batch.column("slot"), h, batch.column("value")]
            yield pa.RecordBatch.from_arrays(columns, names=["of", "slot", "h", "value"])

    slot = (F.col("size") * 2 + F.col("seen").cast("int")).alias("slot")
    slim = model.select(model_key(F.col("lang"), F.col("half")).alias("of"), slot, "gram", F.col("value").cast("float").alias("value"))
    rows = slim.mapInArrow(hashed, "of long, slot int, h long, value float").toArrow()
    of, slots, h, value = (rows[c].to_numpy() for c in ("of", "slot", "h", "value"))
    h = h.view(np.uint64)
    order = np.lexsort((h, slots, of))
    of, slots, h, value = of[order], slots[order], h[order], value[order]
    cuts = [0, *(np.flatnonzero(np.diff(of) | np.diff(slots)) + 1).tolist(), len(of)] if len(of) else []
    out: dict[int, Arrays] = {}
    for lo, hi in zip(cuts, cuts[1:]):
        kind = int(slots[lo])
        out.setdefault(int(of[lo]), Arrays({})).sorted[kind // 2, bool(kind % 2)] = (h[lo:hi], value[lo:hi])
    return out


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeats(ids: np.ndarray) -> int:
    """Words in windows of three words that are there twice or more."""
    if len(ids) < 4:
        return 0
    if ids.max() >= 1 << 21:
        ids = np.unique(ids, return_inverse=True)[1]
    windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def _counts(text: str, data: bytes, ids: np.ndarray) -> tuple[int, ...]:
    lines, again = set(), 0
    for line in data.split(b"\n"):
        if line.strip():
            again += line in lines
            lines.add(line)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(ids), len(text) - sum(map(text.count, SPACE)), symbols, again, _repeats(ids)


def measured(docs: DataFrame, models: dict[int, Arrays] | None, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(id, lang, half, counts of the base rules, logp, chars) per document; without models logp is null."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(models) if models is not None else None

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = sent.value if sent is not None else {}
        for batch in batches:
            for part in parts(batch, 4, HELD):
                keys = part.column(3).to_pylist()
                words: dict[int, dict[bytes, int]] = {}
                counts, used = [], []
                for key, text in zip(keys, part.column(4)):
                    text = text.as_py() or ""
                    data = text.encode("utf-8", "surrogatepass")
                    known = words.setdefault(key, {})
                    ids = np.array([known.setdefault(w, len(known)) for w in data.split()], np.int64)
                    counts.append(_counts(text, data, ids))
                    used.append(ids)
                chances = {}
                for key, known in words.items():
                    model = arrays.get(key)
                    if model is not None:
                        chances[key] = model.score([w.decode("utf-8", "surrogatepass") for w in known])
                logp, chars = [], []
                for key, ids in zip(keys, used):
                    found = chances.get(key)
                    logp.append(float(found[0][ids].sum()) if found is not None and len(ids) else None)
                    chars.append(int(found[1][ids].sum()) if found is not None else 0)
                columns = [pa.array(x, pa.int64()) for x in zip(*counts)] if counts else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *columns, pa.array(logp, pa.float64()), pa.array(chars, pa.int64())],
                    names=["id", "lang", "half", *STATS, "logp", "chars"],
                )

    slim = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        half_of(F.col(id_col)).alias("half"),
        F.col(text_col).cast("string").alias("text"),
    )
    slim = slim.select("id", "lang", "half", model_key(F.col("lang"), 1 - F.col("half")).alias("of"), "text")
    longs = ", ".join(f"{c} long" for c in STATS)
    return slim.mapInArrow(
        compute, f"id {type_of(docs, id_col)}, lang string, half int, {longs}, logp double, chars long"
    )


def joined(docs: DataFrame, model: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """`measured` for a model of any size: words meet its n-grams by joins, and nothing is gathered.

    Each distinct word of a language and half is scored once; documents take the scores of their words.
    """
    of = ["lang", "half"]
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
            half_of(F.col(id_col)).alias("half"),
            F.col(text_col).cast("string").alias("text"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    counts = measured(rows, None, "row", "text", "lang").select(F.col("id").alias("row"), *STATS)
    each = rows.select(
        "row", *of, F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(1))).alias("word")
    ).groupBy("row", *of, "word").agg(F.count("*").alias("times"))
    each = stored(each, "row-words")
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), "word", F.lit(END))
    places = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))
    asked = each.select("lang", (1 - F.col("half")).alias("half"), "word").distinct()
    asked = asked.select(*of, "word", F.explode(places).alias("whole"))
    seen, weights = model.where("seen"), model.where("not seen")
    distinct = asked.select(*of, "whole").distinct()
    value, weight, found = F.lit(None).cast("double"), F.lit(0.0), distinct
    for size in range(ORDER, 0, -1):
        p = seen.where(F.col("size") == size).select(*of, F.col("gram").alias("tail"), F.col("value").alias(f"p{size}"))
        w = weights.where(F.col("size") == size).select(*of, F.col("gram").alias("before"), F.col("value").alias(f"w{size}"))
        found = found.withColumn("tail", F.substring("whole", ORDER - size + 1, size)).join(p, [*of, "tail"], "left").drop("tail")
        before = F.substring("whole", ORDER - size + 1, size - 1)
        found = found.withColumn("before", before).join(w, [*of, "before"], "left").drop("before")
        value = F.coalesce(value, weight + F.col(f"p{size}"))
        weight = weight + F.coalesce(F.col(f"w{size}"), F.lit(0.0))
    known = model.select(*of).distinct().withColumn("known", F.lit(True))
    chances = found.select(*of, "whole", F.coalesce(value, weight).alias("value")).join(known, of)
    scored = asked.join(chances, [*of, "whole"]).groupBy(*of, "word").agg(F.sum("value").alias("value"), F.count("*").alias("size"))
    scored = scored.withColumn("half", 1 - F.col("half"))
    sums = each.join(scored, [*of, "word"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("value")).alias("logp"), F.sum(F.col("times") * F.col("size")).alias("chars")
    )
    return (
        rows.select("row", "id", *of)
        .join(counts, "row")
        .join(sums, "row", "left")
        .select("id", *of, *STATS, "logp", F.coalesce("chars", F.lit(0)).alias("chars"))
    )


def _median(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(lang, name): the least value with half of its language's rows at or below it; values are few whole numbers."""
    by = rows.groupBy("lang", value).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("lang").orderBy(value)
    marked = by.select("lang", value, F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy("lang")).alias("all"))
    return marked.where("2 * upto >= all").groupBy("lang").agg(F.min(value).alias(name))


def bands(scored: DataFrame) -> DataFrame:
    """(lang, centre, spread): median and deviation (from the median distance) of the logarithm of perplexity per language.

    From documents that pass the base rules; copies, which agree in language, counts and perplexity, count once.
    A language with fewer than `LEAST_DOCS` of them has none.
    """
    step = F.floor(F.col("log_ppl") / STEP).alias("step")
    once = stored(
        scored.where(~F.col("base_failed") & F.col("log_ppl").isNotNull()).select("lang", *STATS, step).distinct(), "steps"
    )
    centre = _median(once, "step", "middle").join(once.groupBy("lang").agg(F.count("*").alias("n")), "lang")
    away = once.join(centre.where(F.col("n") >= LEAST_DOCS), "lang").withColumn("away", F.abs(F.col("step") - F.col("middle")))
    spread = _median(away, "away", "distance")
    return centre.join(spread, "lang").select(
        "lang",
        ((F.col("middle") + 0.5) * STEP).alias("centre"),
        F.greatest(F.col("distance") * (1.4826 * STEP), F.lit(LEAST_SPREAD)).alias("spread"),
    )


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sent: int = SENT
) -> DataFrame:
    """One row per document: id, lang, the base counts, base_failed, log_ppl, lower, upper, kept.

    The base rules refuse fewer than 50 words and more than half of them in repeated windows of three words.  A document that
    passes is kept if its perplexity lies in the band of its language: from `BELOW` deviations below the median to `ABOVE`
    above it, where the deviation of a document adds what chance makes of its length.  Without a
    model of the other half or a band (languages of a few documents), the base rules decide.

    Null and empty texts have no words; rows without a language are a language of their own; repeated rows each have
    a row; an id that is null stays null; other columns are ignored; no documents give no rows.
    """
    model = stored(estimate(grams(docs, id_col, text_col, lang_col)), "model")
    if model.count() <= sent:
        found = measured(docs, gathered(model), id_col, text_col, lang_col)
    else:
        found = joined(docs, model, id_col, text_col, lang_col)
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    log_ppl = F.try_divide(-F.col("logp"), F.col("chars"))
    scored = stored(found.withColumn("base_failed", failed).withColumn("log_ppl", log_ppl), "scored")
    deviation = F.sqrt(F.col("spread") * F.col("spread") + F.try_divide(F.lit(NOISE * NOISE), F.col("chars")))
    lower, upper = F.col("centre") - deviation * BELOW, F.col("centre") + deviation * ABOVE
    inside = F.coalesce(F.col("log_ppl").between(lower, upper), F.lit(True))
    return scored.join(bands(scored), "lang", "left").select(
        F.col("id").alias(id_col),
        F.col("lang").alias(lang_col),
        *STATS,
        "base_failed",
        "log_ppl",
        lower.alias("lower"),
        upper.alias("upper"),
        (~F.col("base_failed") & inside).alias("kept"),
    )
