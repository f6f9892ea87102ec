from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
import xxhash

from conftest import rows
from tillwatch.llm import simhash as S
from tillwatch.llm.common import table
from tillwatch.llm.queries import op12_simhash

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(documents, radius=2):
    prints = [brute_fingerprint(t) for _, t in documents]
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[top(a)] = top(b)
    least = {}
    for (d, _), f in zip(documents, prints):
        if d is not None:
            least[top(f)] = min(d, least.get(top(f), d))
    return sorted(((d, f"{f:016x}", least.get(top(f))) for (d, _), f in zip(documents, prints)), key=repr)


def test_query_equals_brute_force(spark, sf):
    documents = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert rows(op12_simhash(spark, sf)) == brute(documents)


@pytest.mark.parametrize("radius", [2, 4])
def test_links_equal_brute_force(spark, radius):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(8)] + [0, (1 << 64) - 1]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for c in centres for _ in range(30)}
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    found = S.linked(spark.createDataFrame([(f,) for f in signed], "bits long"), radius).collect()
    pairs = {frozenset((a % (1 << 64), b % (1 << 64))) for a, b in found}
    near = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius}
    assert len(pairs) == len(found) and pairs <= near
    assert classes(prints, pairs) == classes(prints, near)


def test_odd_radius(spark):
    with pytest.raises(ValueError):
        S.linked(spark.createDataFrame([(1,)], "bits long"), 3)


def classes(nodes, pairs):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in map(tuple, pairs):
        root[top(a)] = top(b)
    out = {}
    for n in nodes:
        out.setdefault(top(n), set()).add(n)
    return sorted(map(sorted, out.values()))


def test_edges(spark):
    base = " ".join(f"w{i}" for i in range(900))
    documents = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "oNE\x0btwo"), (6, "one two three"),
                 (7, base), (8, base), (8, base), (None, base), (9, base.replace("w450 ", "")),
                 (10, base.replace("w1 ", "W1 ")), (11, "é É é"), (None, "alone here"), (12, base * 30)]
    d = spark.createDataFrame([(i, t, "b", 1) for i, t in documents],
                              "doc_id long, text string, bits string, component long")
    assert rows(S.near_duplicates(d)) == brute(documents)
    assert S.near_duplicates(d.limit(0)).count() == 0


def test_bits_are_counted_in_chunks(monkeypatch):
    texts = pa.array(["a b c d e f g", None, "x", "q w e r t y " * 40])
    whole = S.fingerprints(texts).tolist()
    monkeypatch.setattr(S, "CHUNK", 3)
    assert S.fingerprints(texts).tolist() == whole
    assert [f % (1 << 64) for f in whole] == [brute_fingerprint(t) for t in texts.to_pylist()]


def test_ball_sizes():
    assert [len(S.ball(r)) for r in range(3)] == [1, 65, 65 + 64 * 63 // 2]
