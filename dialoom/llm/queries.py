"""The opN_ queries: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dialoom.llm import ans, decontam, fingerprint, hilbert, langid, ngram_join, packing, sql, toolcalls, toxicity, urlfilter
from dialoom.llm.shared import held_out


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class ids of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ngram_join.join(spark, docs, ngram_join.Rule(size=3, num=90, den=100))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of documents and of their edited texts, compared with each other."""
    return fingerprint.fingerprints(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents through rANS files and back."""
    plan = ans.Plan(public_tokenizers.path("word_bpe_49k.json"))
    return ans.round_trip(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), plan)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of documents by PPM code lengths, learned from two thirds of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.predict(docs, langid.train(docs))
    return found.withColumn("held_out", held_out())


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens."""
    plan = packing.Plan(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.packing(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), plan)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of documents by nnPU learning from two thirds of the labels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.train(docs, labels)).withColumn("held_out", held_out())


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of pages by rules, else by boosted trees."""
    return urlfilter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards of equal rows along a Hilbert curve of their metadata."""
    return hilbert.shards(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold which benchmark items, up to eight edits in a hundred characters."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decontam.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of conversations as calls and their results, linked, ordered, validated and serialised."""
    calls, results, context = toolcalls.from_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return toolcalls.link(spark, calls, results, toolcalls.REPLY, context)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_fingerprints": op2_fingerprints,
    "op3_token_files": op3_token_files,
    "op4_language": op4_language,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_hilbert_shards": op8_hilbert_shards,
    "op9_decontamination": op9_decontamination,
    "op10_tool_calls": op10_tool_calls,
}

ORACLE_SQL = {
    "op1_ngram_join": sql.NGRAM_JOIN,
    "op10_tool_calls": sql.TOOL_CALLS,
}
