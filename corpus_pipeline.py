"""The training-corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

    toxicity         documents scored toxic go
    language         documents without a language, or whose language is unsure, go
    near_duplicates  of each group linked by 5-word shingles at a Jaccard similarity of 0.8, the least doc_id stays
    decontamination  documents that hold a benchmark item go
    packing          the rest is packed into sequences of 1024 tokens

SQL can't express the stages, so ORACLE_SQL is None; tests hold the near-duplicate and decontamination stages against
plain Python on small documents, and all stages against their operators.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dialoom import ship
from dialoom.llm import decontam, langid, ngram_join, packing, toxicity
from dialoom.llm.shared import Scratch

#: Documents whose language score is lower go.
LEAST_LANGUAGE_SCORE = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the operator's threshold, by a model learned from ``labels``. Null and empty texts get the
    score of a text without features; repeated rows and null ids are judged as any others."""
    ship(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of LEAST_LANGUAGE_SCORE or more. Texts that are null, empty or
    without a letter go; repeated rows and null ids are judged as any others; if no row has a lang, all go."""
    ship(spark)
    return langid.keep(docs, langid.train(docs), least=LEAST_LANGUAGE_SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the least doc_id. Texts without a word and rows with a null id stay; of rows
    that are equal in id and text one stays."""
    return ngram_join.representatives(ship(spark), docs, ngram_join.Rule(size=5, num=80, den=100))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, be it with or without an id. Null and empty texts hold none and
    stay; an empty benchmark removes nothing."""
    return decontam.clean(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document and its place in a sequence. Null text is empty: its piece is the end id
    alone. Repeated rows and null ids are packed as any others."""
    return packing.packing(ship(spark), docs, packing.Plan(public_tokenizers.path("byte_bpe_50k.json")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
