"""A corpus pipeline over the operators of lakeshore.llm.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm import line_crf, packing, secrets, simhash, substring
from lakeshore.llm.common import saved, small_batches, table, tokenizer_bytes, with_text

# Of a worker's encoded pieces: the executors' heaps are full by then.
MEMO_BYTES = 64 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    small_batches(spark)
    return line_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that start earlier elsewhere; a
    document of which nothing is left stays, with an empty text."""
    small_batches(spark)
    cut = substring.remove_repeats(docs, width=20, keep_layout=True)
    rows = cut.select("row.*", F.col("kept_text").alias("text"))
    return with_text(rows, F.col("text")).select(*docs.columns)


def secret_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret's value replaced."""
    terms = secrets.dictionary(docs)
    model = secrets.train(secrets.derived_findings(docs, terms), terms)
    found = secrets.scan(docs, model, terms).where("is_secret")
    return secrets.redact(docs, found.select("doc_id", "text_hash", "value"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full sequences of at most 2048 tokens."""
    small_batches(spark)
    tokenizer = tokenizer_bytes(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(docs, tokenizer, end_id=1, memo_bytes=MEMO_BYTES)


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeated_passages", repeated_passages),
          ("secret_values", secret_values), ("packed", packed)]

# No stage before the last can be told in SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
