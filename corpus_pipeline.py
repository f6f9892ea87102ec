"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read
again as the next one's input.

toxicity            rows predicted toxic go
line_dedup          lines that at least five sites share stay in one place; rows of which
                    nothing is left go
near_duplicates     one row of each class of near duplicates stays
decontamination     rows with a passage of the benchmark go
byte_bpe            token ids of every text that is left (``ids``, ``n_tokens``)

All but the last return the columns of ``documents``. The models learn from labelled rows of
the stage's input; ``labels`` and ``benchmark`` are read from ``sf_dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import bpe, decontamination, jaccard, line_dedup, toxicity
from tillwatch.llm.common import table
from tillwatch.session import written

TOKENIZER = "byte_bpe_50k.tiktoken"


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def cut_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.cut_lines(docs)
    left = cut.filter((F.col("lines_cut") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("lines_cut") == 0, F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    return bpe.tokenized(docs, vocabulary)


STAGES = [
    ("toxicity", keep_civil),
    ("line_dedup", cut_shared_lines),
    ("near_duplicates", keep_one),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenize),
]
# Trained scores and token ids are beyond SQL; tests/llm/test_pipeline.py holds the stages
# against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
