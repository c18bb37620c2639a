"""Documents to training sequences: toxic and unreadable ones go, near copies go, sources are mixed, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import language, mixing, packing, simhash, toxicity
from changeflow.llm.common import unused
from changeflow.sources.storage import new_folder

#: Lowest share of the best language that a document of one language has; mixtures of two have more than it, too.
LEAST_LANGUAGE = 0.4


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on `labels`, doesn't predict toxic.

    Null and empty texts have the score of the bias alone; without labels nothing is learned.  Repeated rows
    are scored alike; all columns stay, whatever their names; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = unused(docs, "_toxicity")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), into=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(docs.columns)


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose text is clearly of one of the languages of the corpus.

    Null and empty texts and texts without a letter go; so does every text if no row has both a text and a
    language to learn from.  Repeated rows are treated alike; all columns stay as they are, whatever their names.
    """
    name, score = unused(docs, "_lang"), unused(docs, "_score")
    named = language.identify(docs, language.fit(docs), into=(name, score))
    known = (F.col(name) != language.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE)
    return named.where(known).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more): that of the smallest id.

    Null and wordless texts are copies of each other, repeated rows too; rows without an id all stay.
    """
    return simhash.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    A null source is a source of its own; null and wordless texts are never taken; repeated rows are decided
    one by one; an empty table stays empty.
    """
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens.

    Null texts are empty; each of several equal rows is packed for itself; no documents give no pieces.
    """
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("language_id", in_known_language),
    ("simhash_near_dedup", without_copies),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The models and the hashes of the stages can't be expressed in SQL; tests hold them against plain Python.
ORACLE_SQL = None
