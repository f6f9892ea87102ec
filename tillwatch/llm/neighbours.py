"""Approximate nearest neighbours by largest inner product, over stable projections.

Vectors get one more component that gives them all the largest length, so that the largest
inner product is the smallest distance. A 2-stable (Gaussian) projection to ``PROJECTED``
dimensions is indexed by a kd-tree. A query takes its projected neighbours in order, leaf by leaf:
first the leaf whose box is nearest, whose verification already rules out leaves by their boxes,
then those that are left by their nearest point. Every vector handed out is verified on the
original components. A query stops when the chi-square test says that a vector nearer than its k-th
best would have been projected nearer than the next point with probability ``CONFIDENCE``: the
squared ratio of projected to true distance is chi-square distributed.

Every vector is dealt to one block by hash; a block is one tree, built once, past which the
queries stream in chunks. A query's best of all blocks are merged by rank. Each block stops by its
own k-th best, which is no nearer than the query's, so dividing the data can only add to the recall.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows with a null id; equal rows count once; only vectors of equal length are
compared; the query's own id is no candidate; ties go to the smaller id; other columns are
ignored. Projections work on scaled vectors, so finite components of any size take part; a score is
the inner product of the original doubles, which may overflow: to plus or minus infinity, which
rank as such, or to no number (infinities of both signs), which ranks as minus infinity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import release, small
from tillwatch.session import written

NEIGHBOURS = 20
PROJECTED = 12
CONFIDENCE = 0.5
LEAF = 128
# Leaves handed out between two stopping tests.
STEP = 8
# Vectors and bytes of vectors in a block; queries that search one together.
BLOCK_ROWS = 16_384
BLOCK_BYTES = 64 << 20
CHUNK = 2048
SEED = 11


def chi_square(x: np.ndarray, even: int = PROJECTED) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(x / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, even // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of each leaf: halved at the median of the widest dimension."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        wide = np.ptp(points[rows], axis=0).argmax()
        half = len(rows) // 2
        order = np.argpartition(points[rows, wide], half)
        open_ += [rows[order[:half]], rows[order[half:]]]
    return done


def scale(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by their largest component, and that component."""
    largest = np.abs(vectors).max(axis=1)
    return vectors / largest[:, None], largest


@dataclass
class Found:
    """The best of each query so far, nearest first; open places have a score of -inf."""

    ids: np.ndarray
    scores: np.ndarray

    @classmethod
    def none(cls, queries: int, k: int) -> Found:
        return cls(np.full((queries, k), np.iinfo(np.int64).max), np.full((queries, k), -np.inf))

    def offer(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates ``ids``, with one row of scores for each of the queries ``who``."""
        k = self.ids.shape[1]
        some = (scores >= self.scores[who, -1:]).any(axis=1)
        who = who[some]
        if not len(who):
            return
        score = np.concatenate([self.scores[who], scores[some]], axis=1)
        name = np.concatenate([self.ids[who], np.broadcast_to(ids, (len(who), len(ids)))], axis=1)
        # An open place comes after every candidate, whatever its score.
        top = np.lexsort((name, -score), axis=1)[:, :k]
        self.scores[who] = np.take_along_axis(score, top, axis=1)
        self.ids[who] = np.take_along_axis(name, top, axis=1)


class Block:
    """The kd-tree of a block's projections, with the vectors in the order of its leaves."""

    def __init__(self, ids: np.ndarray, data: np.ndarray) -> None:
        self.size = float(np.abs(data).max())
        scaled = data / self.size
        norms = (scaled * scaled).sum(axis=1)
        self.largest = float(norms.max())
        self.project = np.random.default_rng(SEED).standard_normal((data.shape[1] + 1, PROJECTED))
        points = scaled @ self.project[:-1] + np.sqrt(self.largest - norms)[:, None] * self.project[-1]
        leaves = kd_leaves(points)
        order = np.concatenate(leaves)
        self.bounds = np.cumsum([0, *map(len, leaves)])
        self.ids, self.data, self.points = ids[order], np.ascontiguousarray(data[order]), points[order]
        self.low = np.minimum.reduceat(self.points, self.bounds[:-1])
        self.high = np.maximum.reduceat(self.points, self.bounds[:-1])
        self.verified = 0

    def _boxes(self, asked: np.ndarray) -> np.ndarray:
        """Squared projected distance of each query to each leaf's box."""
        gap = np.zeros((len(asked), len(self.low)))
        for d in range(PROJECTED):
            away = np.maximum(self.low[:, d] - asked[:, d, None], asked[:, d, None] - self.high[:, d])
            gap += np.maximum(away, 0) ** 2
        return gap

    def _nearest(self, asked: np.ndarray, leaf: int) -> np.ndarray:
        """Squared projected distance of queries to the nearest point of a leaf."""
        points = self.points[self.bounds[leaf]:self.bounds[leaf + 1]]
        inner = asked @ points.T
        return np.maximum(((asked * asked).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * inner).min(axis=1), 0)

    def _verify(self, found: Found, query_ids: np.ndarray, queries: np.ndarray, who: np.ndarray, leaf: np.ndarray) -> None:
        order = np.argsort(leaf, kind="stable")
        who, leaf = who[order], leaf[order]
        starts = np.flatnonzero(np.diff(leaf, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(leaf)]):
            rows = slice(self.bounds[leaf[a]], self.bounds[leaf[a] + 1])
            ids, asking = self.ids[rows], who[a:b]
            scores = self._scores(queries[asking], self.data[rows], found.scores[asking, -1:])
            own = ids == query_ids[asking][:, None]
            self.verified += scores.size
            if own.any():
                for i in range(len(asking)):
                    found.offer(asking[i:i + 1], ids[~own[i]], scores[i:i + 1, ~own[i]])
            else:
                found.offer(asking, ids, scores)

    def _scores(self, queries: np.ndarray, data: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Inner products, where they may reach ``least``; else -inf. A matrix product rounds by
        the place of a pair, so what comes near is summed again in one order for every pair, and
        equal vectors have equal scores."""
        with np.errstate(over="ignore", invalid="ignore"):
            scores = queries @ data.T
            error = 1e-12 * data.shape[1] * self.size * np.abs(queries).max(axis=1, keepdims=True)
            far = scores < least - error
            q, x = np.nonzero(~far)
            scores[far] = -np.inf
            scores[q, x] = (queries[q] * data[x]).sum(axis=1)
        scores[np.isnan(scores)] = -np.inf
        return scores

    def _far(self, found: Found, who: np.ndarray, sizes: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Whether the stopping test holds for queries whose next point is ``near`` away."""
        with np.errstate(over="ignore"):
            best = found.scores[who, -1] / self.size / sizes[who]
        true = 2 * self.largest - 2 * best
        ratio = near / np.clip(true, 1e-12 * self.largest, None)[(...,) + (None,) * (near.ndim - 1)]
        return (chi_square(ratio) >= CONFIDENCE) & np.isfinite(true)[(...,) + (None,) * (near.ndim - 1)] | np.isposinf(
            best)[(...,) + (None,) * (near.ndim - 1)]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int = NEIGHBOURS) -> Found:
        found = Found.none(len(queries), k)
        # Queries get the length of the data, which changes no order.
        scaled, sizes = scale(queries)
        length = np.sqrt((scaled * scaled).sum(axis=1) / self.largest)
        sizes = sizes * length
        asked = (scaled / length[:, None]) @ self.project[:-1]
        everyone = np.arange(len(queries))
        gap = self._boxes(asked)
        first = gap.argmin(axis=1)
        self._verify(found, query_ids, queries, everyone, first)
        near = np.full(gap.shape, np.inf)
        reachable = ~self._far(found, everyone, sizes, gap)
        reachable[everyone, first] = False
        for leaf in range(len(self.low)):
            who = np.flatnonzero(reachable[:, leaf])
            near[who, leaf] = self._nearest(asked[who], leaf)
        order = np.argsort(near, axis=1, kind="stable")
        near = np.take_along_axis(near, order, axis=1)
        active = everyone
        for turn in range(0, near.shape[1], STEP):
            active = active[np.isfinite(near[active, turn])]
            active = active[~self._far(found, active, sizes, near[active, turn])]
            if not len(active):
                break
            leaves, open_ = order[active, turn:turn + STEP], np.isfinite(near[active, turn:turn + STEP])
            self._verify(found, query_ids, queries, np.repeat(active, open_.sum(axis=1)), leaves[open_])
        return found


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and the vector as doubles, of the rows that take part."""
    vector = F.col(column).cast("array<double>")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v")).filter(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
    ).filter(finite & F.exists("v", lambda x: x != 0)).distinct()


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by width and block, the block's vectors before the queries."""
    release()
    key, block, held = None, None, []
    for batch in batches:
        names = ["width", "block", "asks"]
        columns = np.column_stack([batch.column(c).cast(pa.int64()).to_numpy() for c in names])
        cuts = np.flatnonzero((np.diff(columns, axis=0) != 0).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(columns)]):
            width, number, asks = columns[a].tolist() if b > a else (None,) * 3
            if b > a and (width, number) != key:
                key, block, held = (width, number), None, []
            if b > a and not asks:
                held.append(batch.slice(a, b - a))
            elif b > a and held:
                block = block or Block(
                    np.concatenate([h.column("vec_id").to_numpy() for h in held]),
                    np.concatenate([_matrix(h) for h in held]))
                for at in range(a, b, CHUNK):
                    part = batch.slice(at, min(CHUNK, b - at))
                    ids = part.column("vec_id").to_numpy()
                    found = block.search(ids, _matrix(part), k)
                    real = found.ids != np.iinfo(np.int64).max
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids, k)[real.ravel()]), pa.array(found.ids[real]),
                         pa.array(found.scores[real])], names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, is_query: Column | None = None, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` nearest."""
    is_query = F.pmod("vec_id", F.lit(20)) == 0 if is_query is None else is_query
    rows = written(usable(vectors).withColumn("asks", is_query).withColumn("width", F.size("v")), "vectors")
    widths = written(rows.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / F.greatest(
        F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("width")))), F.lit(1))
    ).cast("int").alias("blocks")), "widths")
    rows = rows.join(small(widths), "width")
    data = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), "blocks").cast("int")).withColumn(
        "asks", F.lit(False))
    queries = rows.filter("asks").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    keys = ["width", "block"]
    dealt = data.unionByName(queries).select(*keys, "asks", "vec_id", "v").repartition(*keys).sortWithinPartitions(
        *keys, "asks", "vec_id")
    found = dealt.mapInArrow(lambda batches: _searched(batches, k), "query_id long, vec_id long, score double")
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
