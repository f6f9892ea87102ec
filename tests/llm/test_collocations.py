from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from conftest import rows
from tillwatch.llm import collocations as C
from tillwatch.llm.fm_index import FMIndex
from tillwatch.llm.queries import op11_collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute(documents, least=30, top=2000):
    counts = {}
    for lang, text in documents:
        held = counts.setdefault("und" if lang is None else lang, Counter())
        for words in pieces(text):
            held.update(tuple(words[i:i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for w, v in f.items() if len(w) == 1)
        candidates = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        found, around = [], {}
        for v, b in candidates.items():
            for k in range(2, len(v)):
                for i in range(len(v) - k + 1):
                    around[v[i:i + k]] = max(b, around.get(v[i:i + k], 0))
        for w, a in candidates.items():
            if 100 * around.get(w, -1) >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k) for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out, key=repr)


def made(seed, n=250):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "dé", "e", "f'g", "H", " x", "中文"]
    fixed = ["new york city hall", "New York", "b b b b", "de facto"]
    out = []
    for _ in range(n):
        words = [rng.choice(fixed if rng.random() < 0.3 else vocabulary) for _ in range(rng.randrange(40))]
        out.append((rng.choice(["en", "en", "en", "fr", None, "und"]),
                    "".join(w + rng.choice([" ", " ", "\t", "  ", ". ", "\n", "!", "\x0b"]) for w in words)))
    return [*out, ("en", None), ("fr", ""), (None, " \t . "), *[("zz", "rare words here")] * 3]


@pytest.mark.parametrize("shard, pieces_", [(1 << 20, 4096), (50, 3)])
def test_equals_brute_force(spark, monkeypatch, shard, pieces_):
    monkeypatch.setattr(C, "SHARD_WORDS", shard)
    monkeypatch.setattr(C, "PIECES", pieces_)
    monkeypatch.setattr(C, "SPLIT", shard)
    documents = made(shard)
    d = spark.createDataFrame([(l, t, "w", 1) for l, t in documents], "lang string, text string, word string, shard long")
    found = rows(C.collocations(d.repartition(3)))
    assert found == brute(documents) and len(found) > 10
    assert rows(C.collocations(d, least=2, top=7)) == brute(documents, 2, 7)


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = op11_collocations(spark, sf)
    cursor = db.execute(C.ORACLE)
    assert [c[0] for c in cursor.description] == found.columns
    assert rows(found) == sorted(cursor.fetchall(), key=repr)


def test_sql_equals_brute_force():
    documents = made(5)
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (lang VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", documents)
    assert sorted(db.execute(C.ORACLE).fetchall(), key=repr) == brute(documents)


def test_no_frequent_phrase_and_empty(spark):
    d = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert C.collocations(d).count() == 0
    assert C.collocations(d.limit(0)).count() == 0


def test_long_text(spark):
    text = "x y " * 60_000 + "z"
    d = spark.createDataFrame([("en", text)], "lang string, text string")
    assert rows(C.collocations(d)) == brute([("en", text)])


def test_index_finds_every_phrase():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(0, 5, 500), 0).astype(np.int32)
    index = FMIndex.of(text)
    want = [Counter() for _ in range(5)]
    for k in range(1, 5):
        for i in range(len(text) - k + 1):
            if text[i:i + k].all():
                want[k][tuple(text[i:i + k].tolist())] += 1
    by = {1: [index.single()]}
    for k in range(2, 5):
        by[k] = [f(p) for p in by[k - 1] for f in (index.extend_right, index.extend_left)]
        for found in by[k]:
            assert dict(zip(map(tuple, found.words.tolist()), found.count.tolist())) == want[k]


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000):
        columns = rng.integers(-(1 << 62), 1 << 62, (3, n))
        assert C._columns(C._planes(columns), 3).tolist() == columns.tolist()


def test_a_shard_sends_few_bytes_a_pair_and_gets_back_a_bit():
    """Pairs were sent as one row per first word, and the frequent ones were sent back as numbers."""
    rng = np.random.default_rng(7)
    numbers = (np.arange(5000) // 500 << 33) + np.arange(5000) % 500 + 1
    shards = []
    for shard in range(2):
        text = np.append((5000 * rng.random(100_000) ** 2).astype(np.int32) + 1, np.int32(0))
        index = FMIndex.of(text)
        shards.append(pa.RecordBatch.from_arrays(
            [pa.array([shard]), C._lists([0, 5000], numbers), pa.array([C._packed(index.left)]),
             pa.array([C._packed(index.right)])], names=["shard", "numbers", "left", "right"]))
    pairs = sum(len(x.extend_right(x.single()).count) for x, _ in (C._loaded(b, 0) for b in shards))
    sent = list(C._pairs(iter(shards), 8))
    assert sum(b.num_rows for b in sent) == 2 * 8
    assert sum(len(data) for b in sent for data in b.column("data").to_pylist()) < 5 * pairs
    rows = pa.Table.from_batches(sent).sort_by("bucket").to_batches(max_chunksize=3)
    back = [r for b in C._frequent_pairs(iter(rows), 2) for r in b.to_pylist()]
    bits = [r["alive"] for r in back if r["shard"] != C.ALL]
    assert sum(map(len, bits)) <= pairs / 8 + 2 * 8
    want = Counter()
    for b in shards:
        index, known = C._loaded(b, 0)
        found = index.extend_right(index.single())
        want.update(dict(zip(map(tuple, known[found.words].tolist()), found.count.tolist())))
    got = {(w1, w2): n for r in back if r["shard"] == C.ALL for w1, w2, n in zip(r["w1"], r["w2"], r["n"])}
    assert got == {pair: n for pair, n in want.items() if n >= 2}
