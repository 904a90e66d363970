"""The stages of the pipeline on the smallest tables and on odd rows."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

from lakeshore.llm import line_crf, simhash, substring
from lakeshore.llm.common import saved

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start, good, single, cut, red, packed = stages(spark, docs)
    assert all(x.columns == docs.columns for x in (good, single, cut, red))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    predicted = {r["doc_id"]: r["predicted"] for r in line_crf.classify(start, labels).collect()}
    assert {r[0] for r in good.select("doc_id").collect()} == {d for d, p in predicted.items() if p}
    groups = simhash.simhash_groups(good).collect()
    assert {r[0] for r in single.select("doc_id").collect()} == {r["component_id"] for r in groups}
    removed = {r[0]: r[1] for r in substring.remove_repeats(single).select("row.doc_id", "kept_text").collect()}
    after = {r[0]: r[1] for r in cut.select("doc_id", "text").collect()}
    assert {d: " ".join(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in after.items()} == removed
    assert red.where(F.col("text").rlike(r'(?i)token = "[0-9a-f]{40}"')).count() == 0
    assert red.count() == cut.count() == single.count()
    assert red.where(F.col("n_chars") != F.length("text")).count() == 0
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == set(after)
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == packed.columns
    assert run.agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()


def test_stages_survive_odd_rows(spark, documents, no_documents):
    for docs in (documents, no_documents):
        last = docs
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            last = saved(stage(spark, last, SF), "test-stage")
            assert last.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, last, SF).where("length < 1").count() == 0
        assert line_crf.keep_good(docs, spark.read.parquet(f"{SF}/labels.parquet")).columns == docs.columns


def test_registered_with_their_queries():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
