"""Extra columns whose names an operator might use itself."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import rows
from tillwatch.llm import (
    collocations, decontamination, jaccard, language_id, line_dedup, periodic_runs, sharding,
    simhash, toxicity,
)
from tillwatch.llm.common import table, unused

NAMES = [
    "_id", "_ID_", "_hash", "_cut", "_x", "_n", "_spans", "_h", "stays", "at", "doc", "line", "line_hash", "site",
    "first", "sites", "exact", "set_key", "signature", "component", "class_key", "text_hash", "words", "items",
    "start", "copy", "n_hit", "score", "predicted", "held_out", "lines_cut", "lines_before", "ids", "n_tokens",
    "shard", "slot", "bits", "runs", "rank", "phrase", "number", "size", "block", "law", "has_words",
]


@pytest.fixture(scope="module")
def given(spark, sf):
    documents = table(spark, sf, "documents").filter("doc_id < 90")
    extra = documents.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])
    return documents, extra


def test_unused(spark):
    d = spark.createDataFrame([(1, 2)], "_id int, _ID_ int")
    assert unused(d, "_id", "_hash", "_hash") == ["_id__", "_hash", "_hash_"]


OPERATORS = {
    "decontamination": lambda d, t: decontamination.digest(decontamination.contamination(d, t("benchmark"))),
    "jaccard": lambda d, t: jaccard.digest(jaccard.similar(d)),
    "line_dedup": lambda d, t: line_dedup.digest(line_dedup.cut_lines(d)),
    "toxicity": lambda d, t: toxicity.digest(toxicity.score(d, t("labels"))),
    "sharding": lambda d, t: sharding.sharded(d),
    "language_id": lambda d, t: language_id.digest(language_id.identify(d)),
    "collocations": lambda d, t: collocations.collocations(d),
    "simhash": lambda d, t: simhash.near_duplicates(d),
    "periodic_runs": lambda d, t: periodic_runs.digest(periodic_runs.periodic_runs(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, sf, given, name):
    plain, extra = given
    run = OPERATORS[name]
    assert rows(run(extra, lambda t: table(spark, sf, t))) == rows(run(plain, lambda t: table(spark, sf, t)))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, sf, given, name, stage):
    plain, extra = given
    columns = [c for c in plain.columns]
    got = stage(spark, extra, sf)
    assert set(got.columns) >= set(extra.columns) - {"ids", "n_tokens"}
    assert rows(got, *columns) == rows(stage(spark, plain, sf), *columns)
    if name != "byte_bpe":
        assert got.columns == extra.columns
        assert got.agg(*[F.max(F.col(n) == i).alias(f"c{i}") for i, n in enumerate(NAMES)]).first()[0] is not False
