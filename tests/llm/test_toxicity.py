from __future__ import annotations

import random
import zlib

import pytest

from conftest import rows
from tillwatch.llm import toxicity as X
from tillwatch.llm.queries import op7_toxicity


@pytest.fixture(scope="module")
def made(spark):
    draw = random.Random(3)
    plain = ["".join(draw.choices("abcdefghilmnoprstu", k=draw.randint(3, 9))) for _ in range(400)]
    bad = ["vilebrute", "rottenfool", "grimlout", "scoundrel", "blackguard"]

    def text(toxic):
        words = draw.choices(plain, k=draw.randint(20, 60))
        for _ in range(4 * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(bad))
        return " ".join(words).capitalize() + "."

    data = [(i, text(i % 4 == 0), "k") for i in range(600)]
    labels = [(i, int(i % 4 == 0)) for i in range(600)]
    return (spark.createDataFrame(data, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_rows(made):
    documents, labels = made
    scored = X.digest(X.score(documents, labels)).collect()
    assert len(scored) == 600
    held = [r for r in scored if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)


def test_query(spark, sf):
    assert op7_toxicity(spark, sf).count() == 200


def test_edges(spark, made):
    documents, labels = made
    odd = spark.createDataFrame(
        [(1001, None, ""), (1002, "", ""), (None, "vilebrute rottenfool", ""), (1003, "..!", ""),
         (1004, "grimlout scoundrel " * 20_000, ""), (1, "again", ""), (1, "again", "")], documents.schema)
    got = rows(X.digest(X.score(documents.union(odd), labels.union(labels))))
    by_id = {r[0]: r for r in got}
    assert by_id[1001][2] == by_id[1002][2] == by_id[1003][2] < 0.5
    assert by_id[None][3] == 1 and by_id[1004][3] == 1 and len(got) == 607
    kept = X.keep_civil(documents.union(odd), labels)
    assert kept.columns == documents.columns and kept.filter("doc_id = 1").count() == 3


def test_missing_class_and_empty_tables(made):
    documents, labels = made
    assert {r["score"] for r in X.score(documents, labels.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in X.score(documents, labels.filter("toxic = 1")).collect()} == {1.0}
    assert X.score(documents.limit(0), labels).count() == 0
