from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
import pytest

from conftest import rows
from tillwatch.llm import jaccard as J
from tillwatch.llm.common import table
from tillwatch.llm.components import components
from tillwatch.llm.queries import op2_jaccard_join
from tillwatch.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_in_order(documents):
    """(doc_id, class_id, n_links) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in documents]
    holders, root, links = {}, list(range(len(sets))), [0] * len(sets)
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    seen = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    for a, b in seen:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            root[top(a)] = top(b)
    ids = {}
    for i, (d, _) in enumerate(documents):
        if d is not None:
            ids[top(i)] = min(d, ids.get(top(i), d))
    return [(d, ids.get(top(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(documents)]


def brute(documents):
    return sorted(brute_in_order(documents), key=repr)


def test_query_equals_brute_force(spark, sf):
    documents = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert rows(op2_jaccard_join(spark, sf)) == brute(documents)


@pytest.fixture(scope="module")
def edge(spark):
    base = " ".join(f"v{i}" for i in range(200))
    near = [(100 + i, base.replace(f"v{7 * i} ", f"z{i} ")) for i in range(28)]
    far = [(200 + i, base.replace("v1", f"q{i}x")) for i in range(3)]
    documents = [(1, None), (2, ""), (3, "one two"), (4, "One, two!"), (5, "one two"), (6, "..."), (6, "..."),
                 (7, base), (7, base), (None, base), (8, base + " v" * 30_000), (9, base + " v" * 30_001),
                 *near, *far]
    return documents, spark.createDataFrame([(d, t, "k") for d, t in documents],
                                            "doc_id long, text string, set_key string")


def test_edges_equal_brute_force(edge):
    documents, d = edge
    assert rows(J.digest(J.similar(d))) == brute(documents)


def test_small_cells_find_the_same(edge, monkeypatch):
    documents, d = edge
    monkeypatch.setattr(J, "BAND_BLOCK", 4)
    monkeypatch.setattr(J, "NODE_BLOCK", 5)
    assert rows(J.digest(J.similar(d))) == brute(documents)


def test_keep_one(edge):
    documents, d = edge
    kept = J.keep_one(d)
    assert kept.columns == d.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    classes = {c for (_, c, _), (_, text) in zip(brute_in_order(documents), documents) if shingles(text)}
    assert ids == sorted([1, 2, 6, 6, *classes], key=repr)


def test_empty(edge):
    _, d = edge
    assert J.similar(d.limit(0)).count() == 0


def test_pruning_limits_grow():
    limits = J.least_matches()
    assert [n for n, _ in limits] == [16, 32, 48, 64]
    assert all(a[1] < b[1] for a, b in zip(limits, limits[1:])) and limits[-1][1] < 51


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 102), (101, 102), (7, 7), (200, 200)]
    d = spark.createDataFrame([(f"{a:04}", f"{b:04}") for a, b in edges], "a string, b string")
    assert rows(components(d)) == sorted(
        [(f"{i:04}", "0000") for i in range(41)] + [(f"{i:04}", "0100") for i in range(100, 104)], key=repr)


CHAIN = [[f"c{i}" for i in range(18 * n, 18 * n + 200)] for n in range(12)]


@pytest.mark.parametrize("order", [(0, 3, 1, 2), (1, 0, 2, 3), (3, 2, 1, 0)])
def test_links_of_a_cell_hold_its_classes_together(order):
    """Only neighbours of the chain are similar; whatever the order in the cell, it stays one class."""
    texts = pa.array([" ".join(CHAIN[n]) for n in order])
    cell = pd.DataFrame({
        "component": "c", "low": 0, "high": 0, "block": 0, "set_key": [f"k{n}" for n in order], "copies": 1,
        "shingles": [s.tobytes() for s in shingle_sets(texts)]})
    found = J._links(cell)
    assert dict(zip(found["a"], found["links"])) == {"k0": 1, "k1": 2, "k2": 2, "k3": 1}
    edges = {frozenset(e) for e in zip(found["a"], found["b"]) if e[0] != e[1]}
    assert edges == {frozenset({"k0", "k1"}), frozenset({"k1", "k2"}), frozenset({"k2", "k3"})}


def test_chains_are_one_class_each(spark):
    documents = [(1000 * r + n, " ".join(f"r{r}{w}" for w in words))
                 for r in range(8) for n, words in enumerate(CHAIN)]
    d = spark.createDataFrame(documents, "doc_id long, text string")
    found = rows(J.digest(J.similar(d)))
    assert found == brute(documents) and {c for _, c, _ in found} == {1000 * r for r in range(8)}
