"""Runs of words that repeat with a period, found by uniting suffix classes.

The suffixes of a document's word sequence are sorted by prefix doubling; neighbours in that
order and their common prefixes (LCP) are the edges of a path. Kruskal's order, by decreasing LCP,
unites the suffix classes in a union-find whose classes are sorted position sets. Two positions
that become neighbours in a class at LCP ``l`` and lie ``d <= l`` apart begin a stretch of period
``d`` and length ``l + d``, since ``l`` is exactly their common prefix; where the words before them
differ, the stretch is a run. Every run of at least two periods is found so, once, and with its
smallest period: a position between its first two repetitions in the same class, or a shorter
period under a seed, would give (Fine and Wilf) a shorter period to the whole run or would have
been united before.

Classes with a shorter common prefix than any run asked for are never united. Documents are
worked on inside the task that reads them, many short ones together, one long one alone; nothing
is shuffled and memory grows with the longest text.

Defined results: words are separated by ASCII white space only and compared byte by byte; null,
empty and blank texts have no runs and collapse to an empty text; a text shorter than a run has
none; repeated rows are treated alike; a null id passes through; other columns are ignored; an
empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import release

MIN_LENGTH = 6
MIN_PERIODS = 4
# Words of several documents that are sorted together; a longer document is sorted alone.
CHUNK_WORDS = 400_000

Run = tuple[int, int, int]
Prepare = Callable[[object, list[bytes]], list[bytes]]


@dataclass(frozen=True)
class Wanted:
    """Runs of at least ``length`` words and ``periods`` (two or more) periods."""

    length: int = MIN_LENGTH
    periods: int = MIN_PERIODS

    def __post_init__(self) -> None:
        if self.periods < 2 or self.length < 1:
            raise ValueError("a run has at least two periods and one word")

    @property
    def least_lcp(self) -> int:
        """The shortest common prefix that can seed a run."""
        return min(max(self.length - d, (self.periods - 1) * d) for d in range(1, self.length + 1))


class Suffixes:
    """Sorted suffixes of several word sequences, those alone in their class left out.

    ``words`` holds a separator of its own after each sequence, so no class spans two."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.levels: list[tuple[int, np.ndarray]] = []
        order = np.argsort(words, kind="stable")
        slots, live, rank = self._ranked(np.arange(n), order, words[order], np.zeros(n, np.int64))
        self.order, width = order, 1
        while len(live):
            self.levels.append((width, rank))
            key = rank[live] * n + rank[live + width]
            by_key = np.argsort(key, kind="stable")
            live = live[by_key]
            order[slots] = live
            slots, live, rank = self._ranked(slots, live, key[by_key], rank)
            width *= 2

    @staticmethod
    def _ranked(
        slots: np.ndarray, rows: np.ndarray, keys: np.ndarray, rank: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranks by the first slot of each class of equal keys; slots and rows not alone."""
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(starts, append=len(keys))
        out = rank.copy()
        out[rows] = np.repeat(slots[starts], sizes)
        many = np.repeat(sizes > 1, sizes)
        return slots[many], rows[many], out

    def edges(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbouring suffixes and their LCP, where it is ``least`` or more."""
        usable = [rank for width, rank in self.levels if width <= least]
        if not usable:
            return (np.zeros(0, np.int64),) * 3
        classes = usable[-1][self.order]
        at = np.flatnonzero(classes[1:] == classes[:-1])
        a, b = self.order[at], self.order[at + 1]
        lcp = np.zeros(len(at), np.int64)
        for width, rank in reversed(self.levels):
            lcp[rank[a + lcp] == rank[b + lcp]] += width
        enough = lcp >= least
        return a[enough], b[enough], lcp[enough]


def seeds(words: np.ndarray, wanted: Wanted) -> list[Run]:
    """(start, length, period) of every run, by Kruskal over the suffix classes."""
    a, b, lcp = Suffixes(words).edges(wanted.least_lcp)
    places, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    by_lcp = np.argsort(-lcp, kind="stable")
    left, right = where[:len(a)][by_lcp].tolist(), where[len(a):][by_lcp].tolist()
    position = places.tolist()
    before = words[places - 1].tolist()
    root = list(range(len(position)))
    members: list[list[int] | None] = [[i] for i in root]
    more, shortest = wanted.periods - 1, wanted.length
    found = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def met(i: int, j: int, common: int) -> None:
        apart = position[j] - position[i]
        if apart * more <= common and apart + common >= shortest and before[i] != before[j]:
            found.append((position[i], apart + common, apart))

    for x, y, common in zip(left, right, lcp[by_lcp].tolist()):
        x, y = top(x), top(y)
        if len(members[x]) < len(members[y]):
            x, y = y, x
        large, few = members[x], members[y]
        root[y], members[y] = x, None
        own = -1
        for k, i in enumerate(few):
            at = bisect(large, i)
            if at and large[at - 1] != own:
                met(large[at - 1], i, common)
            if at < len(large) and (k + 1 == len(few) or few[k + 1] > large[at]):
                met(i, large[at], common)
            large.insert(at, i)
            own = i
    return found


def runs_of(documents: list[list[bytes]], wanted: Wanted = Wanted()) -> list[list[Run]]:
    """The runs of each word sequence, by start, then period."""
    out: list[list[Run]] = [[] for _ in documents]
    long_enough = [i for i, d in enumerate(documents) if len(d) >= max(wanted.length, wanted.periods)]
    if not long_enough:
        return out
    ids: dict[bytes, int] = {}
    sizes = np.array([len(documents[i]) for i in long_enough])
    flat = np.fromiter(
        (ids.setdefault(w, len(ids)) for i in long_enough for w in documents[i]), np.int64, sizes.sum())
    # A word is told apart by document, and every document ends (and the first begins) with a
    # separator of its own.
    ends = np.cumsum(sizes + 1)
    words = np.empty(ends[-1] + 1, np.int64)
    inside = np.ones(len(words), bool)
    inside[0] = inside[ends] = False
    words[inside] = flat + np.repeat(np.arange(len(sizes)), sizes) * len(ids)
    words[~inside] = len(sizes) * len(ids) + np.arange(len(sizes) + 1)
    first = np.concatenate([[0], ends[:-1]]) + 1
    for start, length, period in seeds(words, wanted):
        k = int(np.searchsorted(first, start, "right")) - 1
        out[long_enough[k]].append((start - int(first[k]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains after its first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    cuts = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cuts[start + period] += 1
        cuts[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cuts[:-1]) == 0).tolist()])


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """A tenth of all documents, told by the CRC-32 of the decimal id, with their words from
    some place on repeating periodically. A null id counts as empty text."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _chunks(documents: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for words in documents:
        if held and size + len(words) > CHUNK_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def periodic_runs(documents: DataFrame, wanted: Wanted = Wanted(), prepare: Prepare | None = None) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period in words, by start, then period) and
    ``collapsed`` (the text with one period left of each run) of every row. ``prepare`` changes the
    words of a document beforehand."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            ids = batch.column("doc_id")
            texts = batch.column("text").cast(pa.large_binary())

            def split() -> Iterator[list[bytes]]:
                for row in range(batch.num_rows):
                    words = (texts[row].as_py() or b"").split()
                    yield words if prepare is None else prepare(ids[row].as_py(), words)

            first = 0
            for part in _chunks(split()):
                runs = runs_of(part, wanted)
                flat = [r for each in runs for r in each]
                values = pa.StructArray.from_arrays(
                    [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)],
                    names=["start", "length", "period"])
                offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                text = pa.array([collapsed(w, r) for w, r in zip(part, runs)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(part)), pa.ListArray.from_arrays(offsets, values),
                     text.cast(pa.string())], names=["doc_id", "runs", "collapsed"])
                first += len(part)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        found, f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run with most periods, and digests of runs and collapsed text."""
    best = F.expr(
        "reduce(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>), (best, r) -> CASE"
        " WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)")
    listed = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
