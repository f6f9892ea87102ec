"""Registered queries of the training-data operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tillwatch.llm import (
    bpe, collocations, decontamination, html_text, jaccard, language_id, line_dedup, neighbours,
    periodic_runs, sharding, simhash, toxicity, url_filter,
)
from tillwatch.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.digest(jaccard.similar(table(spark, sf_dir, "documents")))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return vocabulary.round_trip(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(html_text.main_text(table(spark, sf_dir, "pages")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.cut_lines(table(spark, sf_dir, "documents")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(toxicity.score(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.digest(language_id.identify(table(spark, sf_dir, "documents")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(
        table(spark, sf_dir, "documents"), prepare=periodic_runs.planted))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_decontamination": op1_decontamination,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_html_text": op4_html_text,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_toxicity": op7_toxicity,
    "op8_neighbours": op8_neighbours,
    "op9_sharding": op9_sharding,
    "op10_language_id": op10_language_id,
    "op11_collocations": op11_collocations,
    "op12_simhash": op12_simhash,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op5_line_dedup": line_dedup.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
