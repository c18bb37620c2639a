"""The corpus pipeline stage by stage."""

from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], LARGER).cache())
    return out


def test_columns_and_order(steps):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "mixing", "best_fit_packing"]
    assert all(step.columns == steps[0].columns for step in steps[1:-1])


def test_each_stage_decides(spark, steps):
    docs, clean, known, single, mixed, packed = [Counter(r.doc_id for r in step.select("doc_id").collect()) for step in steps]
    toxic = {r.doc_id for r in spark.read.parquet(f"{LARGER}/labels.parquet").where("toxic = 1").collect()}
    fine = {r.doc_id for r in spark.read.parquet(f"{LARGER}/labels.parquet").where("toxic = 0").collect()}
    assert set(clean) < set(docs) and len(toxic & set(clean)) < len(toxic) and len(fine & set(clean)) > 0.95 * len(fine)
    assert len(known) > 0.99 * len(clean) and set(known) <= set(clean)
    assert set(single) <= set(known) and max(single.values()) == 1 and len(single) < len(known)
    assert set(mixed) <= set(single) and max(mixed.values()) > 1
    assert set(packed) == set(mixed)
    pieces = steps[-1].groupBy("doc_id").agg({"piece": "max"}).collect()
    assert all(packed[d] == mixed[d] * (last + 1) for d, last in pieces)


def test_run_gives_the_last_stage(spark, steps):
    assert pipeline.run(spark, LARGER).columns == steps[-1].columns


def test_stages_keep_clashing_columns_and_stand_odd_rows(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["lang_pred", "lang_score", "_toxicity", "_lang", "_score", "_place", "_copies", "_copy", "_id", "_row", "_text", "_set", "_size", "_one"]
    odd = docs.limit(1).withColumn("doc_id", F.lit(-1)).withColumn("text", F.lit(None).cast("string"))
    odd = odd.union(odd.withColumn("text", F.lit(""))).union(docs.where("doc_id < 3")).union(docs.limit(1).withColumn("source", F.lit(None).cast("string")))
    wide = docs.union(odd)
    for i, name in enumerate(names):
        wide = wide.withColumn(name, F.lit(i))
    step = wide
    for _, stage in pipeline.STAGES[:-1]:
        step = stage(spark, step, folder).cache()
        assert step.columns == wide.columns and step.count() > 0
        assert step.select(*names).distinct().collect() == [tuple(range(len(names)))]
        assert stage(spark, wide.limit(0), folder).collect() == []
    assert pipeline.STAGES[-1][1](spark, step, folder).count() >= step.count()
