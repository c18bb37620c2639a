"""Toxicity scores of whole texts from averaged subword embeddings under a linear softmax.

A text is the bag of the character n-grams of its words, each n-gram hashed to a bucket.  The
bucket embeddings and the softmax over their average are trained jointly, in numpy, on a
bounded sample of labelled documents.  A misspelt word shares most n-grams with the word that
it hides, and so most of its vector.  As the softmax is linear in the average, scoring needs
one number per bucket: the log odds that it adds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import learnable, parts

BUCKETS, SIZES, WIDTH = 1 << 17, (3, 4, 5), 8
#: Labelled documents of each class to learn from, on average; all if there are fewer.
SAMPLE = {0: 3000, 1: 1500}
#: Steps (whole passes over the sample, at least so many), documents per step, step size, factor on the average.
STEPS, STEP, RATE, SCALE, SEED = 600, 64, 0.02, 256.0, 5
#: Power of an n-gram's own mean square slope in the divisor of its step, of 1/2 together with the mean over all.
OWN = 0.1
#: Weight of the clean documents against the toxic ones.
CLEAN = 0.7
#: Part of every vector that is lost in each step: n-grams of few documents, which are seldom stepped, stay small.
DECAY = 0.003
#: Documents that an n-gram must occur in to be learned.
SHOWN = 5
#: N-grams without a vector that every text has besides its own: what few words say counts for less.
NEUTRAL = 100
#: Texts that are handled in one call, in bytes.
BATCH_BYTES = 4_000_000
THRESHOLD = 0.7


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts and n-grams of the distinct words.

    Gives where each text's words begin and end, the distinct word of each word, where each
    distinct word's n-grams begin and end, and the bucket of each n-gram.
    """
    words = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\s+")
    ends = words.offsets.to_numpy() - words.offsets[0].as_py()
    distinct = words.flatten().dictionary_encode()
    known = distinct.dictionary
    if not len(known):
        return ends, np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(known)], known), "><")[0].as_py()
    codes = np.frombuffer(f"<{joined}>".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = pc.utf8_length(known).to_numpy().astype(np.int64) + 2
    stop = np.cumsum(length)
    room = np.repeat(stop, length) - np.arange(len(codes))  # letters from here to the end of the word
    word = np.repeat(np.arange(len(known)), length)
    grams, owner = [], []
    mixed = codes.copy()
    for n in range(2, max(SIZES) + 1):
        mixed = mixed[:-1] * np.uint64(0x9E3779B1) + codes[n - 1 :]
        if n in SIZES:
            at = np.flatnonzero(room[: len(mixed)] >= n)
            hashed = (mixed[at] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            grams.append((hashed >> np.uint64(40)).astype(np.int64) % BUCKETS)
            owner.append(word[at])
    order = np.argsort(np.concatenate(owner), kind="stable")
    per_word = np.bincount(np.concatenate(owner), minlength=len(known))
    return ends, distinct.indices.to_numpy().astype(np.int64), np.concatenate([[0], np.cumsum(per_word)]), np.concatenate(
        grams
    )[order]


def _tally(ends: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, distinct word and weight of each word of a text: the root of its count, so that junk that repeats one word
    doesn't consist of that word alone."""
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    base = int(used.max()) + 1 if len(used) else 1
    pair, times = np.unique(text * base + used, return_counts=True)
    return pair // base, pair % base, np.sqrt(times)


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and their share of its n-grams."""
    ends, used, begin, grams = subwords(texts)
    text, word, weight = _tally(ends, used)
    out = []
    for lo, hi in zip(*(np.searchsorted(text, np.arange(len(texts)), side=side) for side in ("left", "right"))):
        here = word[lo:hi]
        size = begin[here + 1] - begin[here]
        at = np.repeat(begin[here] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        bucket, place = np.unique(grams[at], return_inverse=True)
        share = np.bincount(place, np.repeat(weight[lo:hi], size), len(bucket))
        out.append((bucket.astype(np.int32), (share / (share.sum() + NEUTRAL)).astype(np.float32)))
    return out


def train(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Log odds per bucket and, last, the bias; joint Adam steps on embeddings and softmax."""
    rng = np.random.default_rng(SEED)
    bag = [pair for at in range(0, len(texts), STEP) for pair in bags(pa.array(texts[at : at + STEP], pa.string()))]
    vectors = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
    # Whatever their numbers, clean documents weigh as much together as CLEAN times the toxic ones.
    mass = np.array([CLEAN, 1.0]) / (CLEAN + 1)
    worth = mass * len(labels) / np.maximum(1, np.bincount(labels, minlength=2))
    bias = np.log(mass).astype(np.float32)
    shown = np.zeros(BUCKETS, np.int32)
    for bucket, _ in bag:
        shown[bucket] += 1
    vectors[shown < SHOWN] = 0  # n-grams of few documents say nothing about others
    count = len(bag)
    groups = [part for part in np.array_split(rng.permutation(count), max(1, count // STEP)) if len(part)]
    batches = []
    for part in groups:
        bucket = np.concatenate([bag[i][0] for i in part])
        share = np.concatenate([bag[i][1] for i in part]) * np.float32(SCALE)
        row = np.repeat(np.arange(len(part), dtype=np.int32), [len(bag[i][0]) for i in part])
        for i in part:
            bag[i] = None  # each bag is held once
        often = shown[bucket] >= SHOWN
        bucket, share, row = bucket[often], share[often], row[often]
        order = np.argsort(bucket, kind="stable")
        batches.append((part, bucket[order], share[order], row[order]))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (vectors, softmax, bias)]
    t = 0
    odds, kept = np.zeros(BUCKETS + 1), 0
    passes = -(-STEPS // max(1, len(batches)))
    for turn in range(passes):
        for part, bucket, share, row in batches:
            t += 1
            y = labels[part]
            mean = np.stack(
                [np.bincount(row, share * vectors[bucket, d], len(part)) for d in range(WIDTH)], axis=1
            ).astype(np.float32)
            score = (mean[:, :, None] * softmax).sum(axis=1) + bias
            score = np.exp(score - score.max(axis=1, keepdims=True))
            error = score / score.sum(axis=1, keepdims=True)
            error[np.arange(len(y)), y] -= 1
            error *= (worth[y] / len(y))[:, None]
            back = (error[:, None, :] * softmax).sum(axis=2)  # of the averages
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            if len(cuts):
                touched = bucket[cuts]
                slope = np.add.reduceat(share[:, None] * back[row], cuts, axis=0)
                vectors *= 1 - DECAY
                _adam(vectors, slope, moments[0], t, touched)
            _adam(softmax, (mean[:, :, None] * error[:, None, :]).sum(axis=0), moments[1], t)
            _adam(bias, error.sum(axis=0), moments[2], t)
            if 2 * turn >= passes:  # the mean over the later steps is calmer than the last
                kept += 1
                odds[:-1] += vectors @ (softmax[:, 1] - softmax[:, 0]) * SCALE
                odds[-1] += bias[1] - bias[0]
    return (odds / max(1, kept)).astype(np.float32)


def _adam(x: np.ndarray, slope: np.ndarray, moments: list, t: int, rows: np.ndarray | slice = slice(None)) -> None:
    """A step along the mean slope.

    Slopes are divided by their root mean square, but hardly n-gram by n-gram: those that many
    toxic documents share have steep slopes and go far, and those of a few documents don't.
    """
    first, second = moments
    first[rows] = 0.9 * first[rows] + 0.1 * slope
    second[rows] = 0.99 * second[rows] + 0.01 * slope * slope
    square = second[rows] / (1 - 0.99**t) + 1e-20
    x[rows] -= RATE * (first[rows] / (1 - 0.9**t)) / (square**OWN * square.mean() ** (0.5 - OWN))


def odds_of(texts: pa.Array, model: np.ndarray) -> np.ndarray:
    """Log odds of each text."""
    ends, used, begin, grams = subwords(texts)
    text, word, weight = _tally(ends, used)
    sums = np.concatenate([[0], np.cumsum(model[grams].astype(np.float64))])
    odds = np.bincount(text, weight * (sums[begin[word + 1]] - sums[begin[word]]), len(texts))
    size = np.bincount(text, weight * (begin[word + 1] - begin[word]), len(texts))
    return odds / (size + NEUTRAL) + float(model[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: dict[int, int] | None = None,
) -> np.ndarray:
    """The model from labelled documents outside the held-out third.

    `sample` bounds the documents of each class: rows are taken by a hash of their id, with the
    chance that gives so many on average.  A document with several labels counts as toxic if one
    says so.  Without a label of either class every text gets the same score.
    """
    marks = labels.where(learnable(F.col(id_col))).where(F.col(label_col).isin(0, 1))
    marks = marks.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    counts = {row["y"]: row["count"] for row in marks.groupBy("y").count().collect()}
    bounds = sample or SAMPLE
    chance = F.lit(0.0)
    for y, n in counts.items():
        chance = F.when(F.col("y") == y, min(1.0, bounds[y] / n)).otherwise(chance)
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = marks.where(place < chance).groupBy("doc_id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # The sample has a bound, so it may be broadcast and one task may train on it.
    learned = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "y", "text")))
        )
        y = np.array([row[1] for row in rows], np.int64)
        model = train([row[2] or "" for row in rows], y) if len(rows) else np.zeros(BUCKETS + 1, np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], names=["model"])

    row = learned.where("text is not null").repartition(1).mapInArrow(run, "model binary").first()
    return np.frombuffer(row[0], np.float32) if row else np.zeros(BUCKETS + 1, np.float32)


def score(docs: DataFrame, model: np.ndarray, text_col: str = "text", into: str = "score") -> DataFrame:
    """docs with the chance, by the model, that the whole text is toxic.

    Null and empty texts have the score of an average of nothing, the bias alone.  All columns
    and rows are kept; a column named `into` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], names=["text"])
            found = [odds_of(part.column(0), shared.value) for part in parts(batch, 0, BATCH_BYTES)]
            odds = np.concatenate(found) if found else np.zeros(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -50, 50))))

    # Nondeterministic: else a later filter on the score would compute it a second time.
    return docs.withColumn(into, chance.asNondeterministic()(F.col(text_col).cast("string")))


def is_toxic(chance: Column, threshold: float = THRESHOLD) -> Column:
    return F.when(chance >= threshold, 1).otherwise(0)
