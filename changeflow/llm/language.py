"""Language of whole texts by a string kernel with Nystroem landmarks.

The blended-spectrum presence kernel counts the character n-grams (of one to four characters,
hashed) that two texts share, whatever their number in either, over the root of the product of
both sets' sizes.  Kernel ridge regression, one language against the rest, is solved in the span
of a few landmark texts.  A prediction is the kernel of a text with the landmarks times their
coefficients.  As that kernel is a product of presence matrices, landmarks and coefficients are
multiplied once, and a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import learnable, parts, unused

GRAMS, BUCKETS = 4, 1 << 15
#: Documents to learn from, on average and over all languages, and landmarks among them.
SAMPLE, LANDMARKS = 2000, 200
RIDGE, SHARPNESS, SEED = 1e-3, 6.0, 3
UNKNOWN = "und"
#: Texts that are handled in one call, in bytes, and rows of one matrix product.
BATCH_BYTES, ROWS = 4_000_000, 64


def presence(texts: list[str]) -> Iterator[np.ndarray]:
    """Matrices of at most ROWS texts: which buckets their n-grams fall into."""
    for at in range(0, len(texts), ROWS):
        some = [text.lower() for text in texts[at : at + ROWS]]
        codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint32)
        ends = np.cumsum([len(text) for text in some])
        out = np.zeros((len(some), BUCKETS), bool)
        mixed = np.zeros(len(codes), np.uint32)
        for n in range(1, GRAMS + 1):
            mixed = mixed[: len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1 :] + np.uint32(n)
            bucket = (mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)
            begin = 0
            for row, end in enumerate(ends.tolist()):
                out[row, bucket[begin : max(begin, end - n + 1)]] = True
                begin = end
        yield out


def train(texts: list[str], languages: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages, and the coefficient of each bucket for each of them."""
    names = sorted(set(languages))
    if not names:
        return [], np.zeros((BUCKETS, 0), np.float32)
    seen = np.concatenate(list(presence(texts)))
    norm = np.sqrt(np.maximum(1, seen.sum(axis=1, dtype=np.int64))).astype(np.float32)
    # Landmarks: the first texts of each language in turn, so that each has its share.
    place = {name: 0 for name in names}
    turn = []
    for language in languages:
        turn.append(place[language])
        place[language] += 1
    marks = np.argsort(turn, kind="stable")[:LANDMARKS]
    landmark = seen[marks].astype(np.float32) / norm[marks, None]
    kernel = np.concatenate(
        [seen[i : i + ROWS].astype(np.float32) @ landmark.T for i in range(0, len(texts), ROWS)]
    ).astype(np.float64) / norm[:, None]
    goal = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # A language with few texts counts as much as one with many.
    weight = np.array([1 / place[language] for language in languages])[:, None] * len(texts) / len(names)
    inner = kernel.T @ (kernel * weight) + RIDGE * len(texts) * (kernel[marks] + 1e-6 * np.eye(len(marks)))
    dual = np.linalg.lstsq(inner, kernel.T @ (goal * weight), rcond=None)[0]
    return names, landmark.T @ dual.astype(np.float32)


def classify(texts: pa.Array, names: list[str], coefficients: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its share of the softmax over all; `und` and 0 for a text without a letter."""
    texts = pc.fill_null(texts, "")
    letters = pc.match_substring_regex(texts, r"\pL").to_numpy(zero_copy_only=False)
    language, chance = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    some = np.flatnonzero(letters)
    if len(names) and len(some):
        scores = []
        for seen in presence(texts.take(pa.array(some)).to_pylist()):
            root = np.sqrt(np.maximum(1, np.count_nonzero(seen, axis=1)))
            scores.append(seen.astype(np.float32) @ coefficients / root[:, None])
        score = np.concatenate(scores)
        language[some] = np.array(names, object)[score.argmax(axis=1)]
        share = np.exp(SHARPNESS * (score - score.max(axis=1, keepdims=True)))
        chance[some] = share.max(axis=1) / share.sum(axis=1)
    return language.tolist(), np.clip(chance, 0, 1)


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> tuple[list[str], np.ndarray]:
    """The model from documents with a language and a text, outside the held-out third.

    `sample` bounds the documents: each language gets an equal share, and its rows are taken by
    a hash of their id with the chance that gives so many on average.
    """
    known = docs.where(learnable(F.col(id_col))).where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    known = known.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    counts = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chance = F.lit(0.0)
    for name, n in counts.items():
        chance = F.when(F.col("lang") == name, min(1.0, sample / len(counts) / n)).otherwise(chance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text")))),
            key=lambda row: (_draw(row[0]), row),
        )
        model = train([row[2] for row in rows], [row[1] for row in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # The sample has a bound, so one task may train on it.
    row = known.where(place < chance).repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else train([], [])


def _draw(ident: object) -> int:
    """A number that mixes the order of ids of any type."""
    number = ident if isinstance(ident, int) else xxhash.xxh64_intdigest(str(ident), SEED)
    return number * 0x9E3779B97F4A7C15 % (1 << 64)


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray],
    text_col: str = "text",
    into: tuple[str, str] = ("lang_pred", "lang_score"),
) -> DataFrame:
    """docs with the language and its score, from the whole text and nothing else, in the columns `into`.

    Null texts and texts without a letter are `und` with score 0, and so is every text if there
    was no language to learn.  All columns and rows are kept; columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], names=["text"])
            found = [classify(part.column(0), *shared.value) for part in parts(batch, 0, BATCH_BYTES)]
            yield pd.DataFrame(
                {
                    "lang_pred": [name for names, _ in found for name in names],
                    "lang_score": np.concatenate([x for _, x in found]) if found else np.zeros(0),
                }
            )

    predicted = unused(docs, "_predicted")
    named = docs.withColumn(predicted, predict.asNondeterministic()(F.col(text_col).cast("string")))
    found = F.col(predicted)
    return named.withColumns({into[0]: found["lang_pred"], into[1]: found["lang_score"]}).drop(predicted)
