from __future__ import annotations

import zlib

import numpy as np
import pytest

from tillwatch.llm import sharding as S
from tillwatch.llm.common import table
from tillwatch.llm.queries import op9_sharding


def check(placed, texts, shards=8, slack=0.01):
    assert sorted((r["size"], r["text_crc32"]) for r in placed) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    load = np.zeros(shards)
    slots = [[] for _ in range(shards)]
    for r in placed:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert load.max() - load.min() <= slack * load.mean() + max(len((t or "").encode()) + 1 for t in texts)
    return load


def test_query(spark, sf):
    texts = [r[0] for r in table(spark, sf, "documents").select("text").collect()]
    placed = op9_sharding(spark, sf).collect()
    check(placed, texts)
    assert {r["law"] for r in placed} == {"bytes"} and {r["grown_shard"] for r in placed} == {None}


@pytest.fixture(scope="module")
def edge(spark):
    data = [(i, "copy of a hot text " * 5) for i in range(700)] + [(i, f"text {i} é" * (i % 9 + 1)) for i in range(1300)]
    data += [(None, None), (None, ""), (5, None), (5, None), (6, "long " * 3000)]
    return data, spark.createDataFrame([(*d, 0, 1) for d in data], "doc_id long, text string, shard int, row int")


def test_hot_group_spreads_and_others_stay_whole(edge):
    data, d = edge
    placed = S.sharded(d).collect()
    check(placed, [t for _, t in data], slack=0.03)
    rows = np.bincount([r["shard"] for r in placed])
    assert rows.max() - rows.min() < 0.1 * rows.mean()
    where = {}
    for r in S.place(d).collect():
        where.setdefault(r["group"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) == 1


def test_blocks_and_chunks(edge, monkeypatch):
    data, d = edge
    monkeypatch.setattr(S, "BLOCK_PIECES", 40)
    monkeypatch.setattr(S, "CHUNK_ROWS", 10)
    monkeypatch.setattr(S, "LARGE", 16)
    check(S.sharded(d, 3).collect(), [t for _, t in data], 3, 0.05)


def test_empty(edge):
    assert S.sharded(edge[1].limit(0)).count() == 0
