from __future__ import annotations

import hashlib
import re

import pytest

from conftest import rows
from tillwatch.llm import decontamination as D
from tillwatch.llm.common import table
from tillwatch.llm.queries import op1_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(documents, benchmark, window=10):
    found = {}
    for item, text in benchmark:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w and item is not None else 0):
            found.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    out = []
    for doc_id, text in documents:
        w, hit, items = words(text), set(), set()
        for size in {len(f) for f in found}:
            for i in range(len(w) - size + 1):
                if (has := found.get(tuple(w[i:i + size]))) is not None:
                    hit.update(range(i, i + size))
                    items |= has
        listed = ",".join(sorted(items))
        out.append((doc_id, len(w), len(hit), len(items),
                    hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text").collect()
    benchmark = table(spark, sf, "benchmark").select("item_id", "text").collect()
    got = rows(op1_decontamination(spark, sf), "doc_id", "n_words", "n_hit", "n_items",
               "items_sha256", "contaminated")
    assert got == brute(documents, benchmark)
    assert any(r[5] for r in got)


@pytest.fixture(scope="module")
def edge(spark):
    a = " ".join(f"w{i}" for i in range(14))
    long = " ".join(f"x{i}" for i in range(4091)) + " " + a + " y" * 5000 + " " + a
    benchmark = [(1, a), (2, a.upper()), (3, "One two three"), (4, ""), (5, None), (6, "É alpha"),
                 (None, "no id here"), (7, "solo"), (8, "p q r s t u v w x")]
    documents = [
        (1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"), (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (3, None), (4, ""),
        (5, "ONE, two; three one two three"), (6, "é alpha É ALPHA"), (7, long), (8, "SOLO solo"),
        (9, "no id here"), (1, "other text of the same id"), (2, a), (2, a), (None, a + " z " + a),
        (10, "...!"), (11, "p q r s t u v w x"), (11, "0 p q r s t u v w x 1"), (12, "ΣΑΣ solo"),
    ]
    doc_rows = [(d, t, "en", 7) for d, t in documents]
    return (
        documents, benchmark,
        spark.createDataFrame(doc_rows, "doc_id long, text string, start string, items int"),
        spark.createDataFrame(benchmark, "item_id long, text string"),
    )


def test_edges_equal_brute_force(edge):
    documents, benchmark, d, b = edge
    assert rows(D.digest(D.contamination(d, b))) == brute(documents, benchmark)


def test_without_broadcast(edge, monkeypatch):
    documents, benchmark, d, b = edge
    monkeypatch.setattr(D, "small", lambda df: df)
    assert rows(D.digest(D.contamination(d, b))) == brute(documents, benchmark)


def test_removal(edge):
    documents, benchmark, d, b = edge
    clean = {(r[0], r[1]) for r in brute(documents, benchmark) if not r[5]}
    kept = D.decontaminate(d, b)
    assert kept.columns == d.columns
    assert {(r["doc_id"], len(words(r["text"]))) for r in kept.collect()} == clean
    spans = {(r["doc_id"], r["text"]) for r in D.decontaminate(d, b, remove="spans").collect()}
    assert (None, "z ") in spans and (5, "") in spans and (12, "ΣΑΣ ") in spans
    assert (3, None) in spans and (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8") in spans


def test_empty_tables(edge):
    _, _, d, b = edge
    assert D.contamination(d.limit(0), b).count() == 0
    assert rows(D.digest(D.contamination(d, b.limit(0))), "contaminated") == [(False,)] * d.count()
