"""Registered queries of this subpackage: each applies one operator with
production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm import (
    bpe, chat_tree, divergence, language, line_crf, nearest, nn_descent, packing, secrets, simhash, substring,
    token_files, vector_codes)
from lakeshore.llm.common import table, tokenizer_bytes
from lakeshore.llm.oracle import ORACLE_SQL
from lakeshore.session import scratch_dir


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    control = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], conversations.schema)
    nodes, paths = chat_tree.chat_tree(conversations.unionByName(control))
    return chat_tree.conversation_digests(nodes, paths)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    terms = secrets.dictionary(docs)
    model = secrets.train(secrets.derived_findings(docs, terms), terms)
    return secrets.scan(docs, model, terms).select(
        "doc_id", F.col("at").alias("word_no"), F.col("nth").alias("value_no"), "value", "score", "is_secret")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", "fingerprint", "component_id")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, F.col("vec_id") % 20 == 0, k=20).select(
        "query_id", "rank", "vec_id", "score")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = line_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), width=20)
    return kept.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_bytes(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, end_id=1)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_bytes(public_tokenizers.path("word_bpe_49k.json"))
    folder = scratch_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer, end_id=2)
    return token_files.read_token_files(spark, folder)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokenizer_bytes(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.byte_bpe_digests(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.classify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {f.__name__: f for f in (
    op1_chat_tree, op2_secrets, op3_simhash, op4_nearest, op5_quality, op6_substring, op7_nn_descent, op8_packing,
    op9_token_files, op10_byte_bpe, op11_vector_codes, op12_source_divergence, op13_language)}

__all__ = ["QUERIES", "ORACLE_SQL"]
