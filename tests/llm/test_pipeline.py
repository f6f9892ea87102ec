"""Every stage held against a plain version, each on its own input."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline as C
from test_bpe import ENCODING
from test_decontamination import brute as hits
from test_jaccard import brute_in_order as classes, shingles
from tillwatch.llm import line_dedup, toxicity
from tillwatch.llm.common import table
from tillwatch.session import written


@pytest.fixture(scope="module")
def inputs(spark, sf):
    """The input of every stage, and the result."""
    docs = [table(spark, sf, "documents")]
    for name, stage in C.STAGES:
        docs.append(written(stage(spark, docs[-1], sf), f"test-{name}"))
    return docs


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns(inputs):
    assert all(d.columns == inputs[0].columns for d in inputs[1:-1])
    assert set(inputs[0].columns) < set(inputs[-1].columns)


def test_toxicity(spark, sf, inputs):
    scored = toxicity.score(inputs[0], table(spark, sf, "labels")).collect()
    assert sorted(d for d, _ in pairs(inputs[1])) == sorted(r["doc_id"] for r in scored if r["score"] < 0.5)


def test_line_dedup(inputs):
    con = duckdb.connect()
    con.register("given", inputs[1].select("doc_id", "text", "source").toArrow())
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    expected = {d: (n, s) for d, n, s in con.execute(
        f"SELECT doc_id, n_cut, text_sha256 FROM ({line_dedup.ORACLE})").fetchall()}
    got = {r["doc_id"]: r for r in inputs[2].selectExpr(
        "doc_id", "sha2(cast(text as binary), 256) as sha", "length(text) as n", "n_chars").collect()}
    blank = {d for d, t in pairs(inputs[1]) if d not in got}
    assert all(expected[d][0] for d in blank)
    assert {d: s for d, (_, s) in expected.items() if d not in blank} == {d: r["sha"] for d, r in got.items()}
    assert all(r["n"] == r["n_chars"] for d, r in got.items() if expected[d][0])


def test_near_duplicates(inputs):
    given = pairs(inputs[2])
    kept = [c for (_, c, _), (_, text) in zip(classes(given), given) if shingles(text)]
    wordless = [d for d, text in given if not shingles(text)]
    assert sorted(d for d, _ in pairs(inputs[3])) == sorted([*set(kept), *wordless])


def test_decontamination(spark, sf, inputs):
    found = hits(pairs(inputs[3]), pairs(table(spark, sf, "benchmark").withColumnRenamed("item_id", "doc_id")))
    assert sorted(d for d, _ in pairs(inputs[4])) == sorted(r[0] for r in found if not r[5])


def test_byte_bpe(inputs):
    for r in inputs[5].collect():
        assert r["ids"] == ENCODING.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"])


def test_odd_input(spark, sf):
    odd = spark.createDataFrame(
        [(1, None, "en", "s", 0, "x"), (1, None, "en", "s", 0, "x"), (None, "", None, None, None, None),
         (2, "just a few clean words here", "en", "s1", 27, "y"), (2, "just a few clean words here", "en", "s1", 27, "y")],
        "doc_id long, text string, lang string, source string, n_chars long, ids string")
    docs = odd
    for _, stage in C.STAGES:
        docs = written(stage(spark, docs, sf), "odd")
    assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == [1, 1, 2, None]


def test_empty(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = written(stage(spark, docs, sf), "empty")
    assert docs.count() == 0
