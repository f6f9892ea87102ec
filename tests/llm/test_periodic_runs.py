from __future__ import annotations

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import pytest

from conftest import rows
from tillwatch.llm import periodic_runs as P
from tillwatch.llm.common import table
from tillwatch.llm.queries import op13_periodic_runs


def brute_runs(words, length=6, periods=4):
    """Every maximal stretch of each period, kept where no smaller period fits."""
    n, out = len(words), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, periods * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, l, q) for (s, l), q in out.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), crc32(str(doc_id).encode() if doc_id is not None else b"")
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for s, l, q in runs for i in range(s + q, s + l)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, sf):
    documents = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = rows(op13_periodic_runs(spark, sf))
    assert found == sorted((brute(d, t) for d, t in documents), key=repr)
    assert sum(r[1] > 0 for r in found) > 5


@pytest.mark.parametrize("length, periods", [(6, 4), (2, 2), (7, 3), (1, 2)])
def test_runs_equal_brute_force(length, periods):
    rng = random.Random(length)
    documents = [[rng.choice("ab").encode() for _ in range(rng.randrange(60))] for _ in range(300)]
    documents += [[rng.choice("abc").encode() for _ in range(rng.randrange(9))] * rng.randrange(9) for _ in range(300)]
    a, b = [b"a"], [b"b"]
    for _ in range(8):
        a, b = a + b, a
    documents += [a, a * 3, [b"x"] * 200, [], [b"x"]]
    found = P.runs_of(documents, P.Wanted(length, periods))
    assert found == [brute_runs(d, length, periods) for d in documents]


def test_chunks_find_the_same(spark, monkeypatch):
    texts = [(i, "u v w " * i + "z " * (i % 11)) for i in range(60)]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    whole = rows(P.digest(P.periodic_runs(d)))
    monkeypatch.setattr(P, "CHUNK_WORDS", 1)
    documents = [t.encode().split() for _, t in texts]
    assert [P.runs_of([w])[0] for w in documents] == P.runs_of(documents)
    assert whole == rows(P.digest(P.periodic_runs(d)))


def test_edges(spark):
    long = "k " * 50_000 + "end"
    documents = [(None, None), (None, "a a a a a a a"), (1, ""), (2, " \t\n "), (3, None), (4, "x x x x x x"),
                 (4, "x x x x x x"), (5, "x\x0bx\x0cx\rx\nx x"), (6, "a a a a a a a a a"), (7, long),
                 (8, "A a A a A a a a A a")]
    d = spark.createDataFrame([(i, t, "r") for i, t in documents], "doc_id long, text string, runs string")
    found = rows(P.digest(P.periodic_runs(d, prepare=P.planted)))
    assert found == sorted((brute(i, t) if i != 7 else brute_long(i, t) for i, t in documents), key=repr)
    assert P.periodic_runs(d.limit(0)).count() == 0
    plain = {r["doc_id"]: r for r in P.periodic_runs(d).collect()}
    assert plain[7]["collapsed"] == "k end" and tuple(plain[7]["runs"][0]) == (0, 50_000, 1)


def brute_long(doc_id, text):
    words = P.planted(doc_id, text.encode().split())
    runs = [(0, 50_000, 1)] if words[-1] == b"end" else [(0, 50_001, 1)]
    kept = b"k end" if words[-1] == b"end" else b"k"
    s, l, q = runs[0]
    return (doc_id, 1, s, l, q, 1000 * l, hashlib.sha256(f"{s},{l},{q}\n".encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_long_alternation_is_fast():
    words = [b"a", b"b", b"a", b"c"] * 50_000
    assert P.runs_of([words])[0] == [(0, 200_000, 4)]


def test_wanted():
    assert P.Wanted().least_lcp == 5
    assert P.Wanted(2, 2).least_lcp == 1
    with pytest.raises(ValueError):
        P.Wanted(6, 1)
