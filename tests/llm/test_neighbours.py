from __future__ import annotations

import math

import numpy as np
import pytest

from tillwatch.llm import neighbours as N
from tillwatch.llm.common import table
from tillwatch.llm.queries import op8_neighbours


def brute(ids, vectors, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(int(ids[j]), scores[j]) for j in order]
    return out


def recall(got, truth):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r)
    assert found.keys() == truth.keys()
    hits = 0
    for q, best in truth.items():
        mine = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        keys = [(-r["score"], r["vec_id"]) for r in mine]
        assert keys == sorted(keys)
        hits += len({r["vec_id"] for r in mine} & {i for i, _ in best})
    return hits / sum(map(len, truth.values()))


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    given = table(spark, sf, "embeddings").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in given]), np.array([r[1] for r in given], np.float64)
    assert recall(op8_neighbours(spark, sf).collect(), brute(ids, vectors)) >= 0.9


def test_recall_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 300)
    monkeypatch.setattr(N, "CHUNK", 20)
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((12, 24))
    vectors = centres[draw.integers(0, 12, 1500)] + 0.4 * draw.standard_normal((1500, 24))
    vectors[100:500] = vectors[100]
    ids = np.arange(1500)
    d = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = N.search(d).collect()
    truth = brute(ids, vectors)
    assert recall(got, truth) >= 0.9
    # Ties of equal vectors go to the smaller ids.
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 120] == [
        i for i, _ in truth[120]]


def test_edges(spark):
    good = [(20, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.5, 9.0]), (2, [0.5, 9.0]), (40, [0.0, 2.0])]
    bad = [(60, None), (3, []), (4, [0.0, 0.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [None, 1.0]),
           (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0])]
    d = spark.createDataFrame([(*r, 1) for r in good + bad], "vec_id long, embedding array<double>, rank int")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.search(d).collect())
    assert got == [(20, 1, 1, 1.0), (20, 2, 2, 0.5), (20, 3, 40, 0.0),
                   (40, 1, 2, 18.0), (40, 2, 1, 2.0), (40, 3, 20, 0.0)]
    assert N.search(d.limit(0)).count() == 0


def test_components_of_any_size(spark):
    """Huge, tiny and ordinary components together; overflowing products rank as infinities."""
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((61, 6))
    vectors[7] *= 1e200
    vectors[8] *= 1e-200
    vectors[20] *= 1e-200
    vectors[40] *= 1e200
    vectors[41:44] = [[1e200, -1e200, 0, 0, 0, 0], [1e200, 1e200, 1, 0, 0, 0], [5e-324, 0, 0, 0, 0, 0]]
    ids = np.arange(61)
    d = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = N.search(d).collect()
    with np.errstate(over="ignore", invalid="ignore"):
        products = vectors[:, None, :] * vectors[None]
        truth = products.sum(axis=2)
    truth[np.isnan(truth)] = -np.inf
    for q in (0, 20, 40, 60):
        mine = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert len(mine) == 20
        best = [(int(i), truth[q, i]) for i in np.lexsort((ids, -truth[q])) if i != q][:20]
        assert mine == best


def test_one_id_with_different_vectors(spark):
    d = spark.createDataFrame([(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [3.0, 2.0])], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.search(d).collect())
    assert got == [(20, 1, 1, 3.0), (20, 2, 1, 2.0)]


def test_clusters_are_pruned():
    draw = np.random.default_rng(1)
    centres = 10 * draw.standard_normal((64, 32))
    data = (centres[:, None] + draw.standard_normal((64, 128, 32))).reshape(-1, 32)
    block = N.Block(np.arange(len(data)), data)
    found = block.search(np.arange(0, len(data), 20), data[::20])
    truth = np.argsort(-(data[::20] @ data.T) + 1e9 * (np.arange(0, len(data), 20)[:, None] == np.arange(len(data))), axis=1)[:, :20]
    hits = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found.ids, truth)])
    assert hits > 0.9 and block.verified < 0.5 * len(data) * len(data[::20])


def test_chi_square():
    draw = np.random.default_rng(0).chisquare(N.PROJECTED, 200_000)
    for x in (2.0, 7.0, 15.0):
        assert abs(N.chi_square(np.array([x]))[0] - (draw < x).mean()) < 0.005


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_leaves_hold_every_point_once(n):
    points = np.random.default_rng(n).standard_normal((n, N.PROJECTED))
    leaves = N.kd_leaves(points)
    assert sorted(np.concatenate(leaves)) == list(range(n)) and max(map(len, leaves)) <= N.LEAF
