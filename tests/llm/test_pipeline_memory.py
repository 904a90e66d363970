"""What bounds the memory of the pipeline's stages."""

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeshore.llm import common, encoders, packing, secrets

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def batch_bytes(spark):
    before = spark.conf.get(BATCH)
    yield
    spark.conf.set(BATCH, before)


def test_batches_to_python_are_bounded(spark, batch_bytes):
    spark.conf.set(BATCH, "64m")

    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
    for name, stage in corpus_pipeline.STAGES:
        if name != "secret_values":
            spark.conf.set(BATCH, "64m")
            stage(spark, docs, "/root/testdata/sf0.001")
            assert int(spark.conf.get(BATCH)) == common.BATCH_BYTES, name
    n = [r[0] for r in texts.mapInArrow(rows, "n long").collect()]
    assert sum(n) == 6000 and max(n) < 1500
    spark.conf.set(BATCH, "1m")
    common.small_batches(spark)
    assert spark.conf.get(BATCH) == "1m"


def test_texts_are_not_shuffled_to_few_secrets(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a KEY-1 b KEY-12", 16), (1, "a KEY-1 b KEY-12", 16), (1, "KEY-1", 5),
                                  (None, "KEY-1", 5), (2, None, 0), (3, "KEY-1", 5)],
                                 "doc_id long, text string, n_chars int")
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    found = docs.where("doc_id IS NULL OR doc_id < 3").select(
        "doc_id", text_hash.alias("text_hash"), F.explode(F.array(F.lit("KEY-1"), F.lit("KEY-12"))).alias("value"))
    few = secrets.redact(docs, found)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    got = sorted(few.collect(), key=str)
    monkeypatch.setattr(secrets, "REDACT_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = secrets.redact(docs, found)
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(many.collect(), key=str) == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    said = secrets.REDACTED
    assert sorted((r["text"] or "", r["doc_id"] or 0) for r in got) == sorted(
        [(f"a {said} b {said}", 1), (f"a {said} b {said}", 1), (said, 1), (said, 0), ("", 2), ("KEY-1", 3)])


def test_a_bounded_memo_packs_the_same(spark):
    import public_tokenizers
    tokenizer = common.tokenizer_bytes(public_tokenizers.path("byte_bpe_50k.json"))
    texts = pa.array([f"word{i} and another{i * 7919} of them" for i in range(3000)])
    small, large = encoders.json_tokenizer_memo(tokenizer, 50_000), encoders.json_tokenizer_memo(tokenizer)
    assert small is not large
    for part in (texts[:200], texts[200:], texts):
        for (ids, at), (other, places) in zip(small.encode(part), large.encode(part), strict=True):
            assert ids.tolist() == other.tolist() and at.tolist() == places.tolist()
    assert len(small.slot_of) < len(large.slot_of)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "doc_id long, text string").coalesce(1)
    bounded, whole = (sorted(packing.pack(docs, tokenizer, 1, memo_bytes=b).collect()) for b in (50_000, None))
    assert bounded == whole
