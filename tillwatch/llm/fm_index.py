"""A bidirectional FM-index over word ids for phrases of at most ``DEPTH`` words.

Rows are the rotations of a text of ids, sorted by their first ``DEPTH`` ids; ``left`` is the id
before each row. The rows of the reversed text give ``right``, the id after each context. A phrase
is an interval of equal length in both orders. Extending it by an id on one side is a backward
search step in that side's order, and shifts the interval in the other order by the number of
smaller ids met; sorting to ``DEPTH`` ids is enough for that, as longer phrases are not asked for.
Id 0 separates pieces, is the last of the text and is part of no phrase.

All intervals of a length are extended at once, by all ids that occur next to them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 4


def _before(text: np.ndarray) -> np.ndarray:
    """The id before each rotation, rotations sorted by their first ``DEPTH`` ids."""
    rank, width = text.astype(np.int64), 1
    while width < DEPTH:
        most = int(rank.max()) + 1
        rank = np.unique(rank * most + np.roll(rank, -width), return_inverse=True)[1].astype(np.int64)
        width *= 2
    return np.roll(text, 1)[np.argsort(rank, kind="stable")]


@dataclass(frozen=True)
class Phrases:
    """Phrases of one length as rows of ids, with their intervals in both orders."""

    words: np.ndarray
    forward: np.ndarray
    backward: np.ndarray
    count: np.ndarray

    def only(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.words[keep], self.forward[keep], self.backward[keep], self.count[keep])


class FMIndex:
    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        self.left, self.right = left, right
        self.rows = len(left)
        self.ids = int(left.max()) + 1 if len(left) else 1
        self.totals = np.bincount(left, minlength=self.ids)
        self._to_left, self._to_right = self._searchable(left), self._searchable(right)

    @classmethod
    def of(cls, text: np.ndarray) -> FMIndex:
        """The index of ids of which the last is 0."""
        return cls(_before(text), _before(text[::-1]))

    def _searchable(self, bwt: np.ndarray) -> np.ndarray:
        """(id, row) in order as one number: the place of (x, row) in it is where the rows before
        ``row`` with ``x`` before them end once they begin with ``x``."""
        order = np.argsort(bwt, kind="stable")
        return bwt[order].astype(np.int64) * self.rows + order

    def single(self) -> Phrases:
        """Every id that occurs, as a phrase of one word."""
        found = np.flatnonzero(self.totals)
        found = found[found > 0]
        start = (np.cumsum(self.totals) - self.totals)[found]
        return Phrases(found[:, None], start, start, self.totals[found])

    def _extended(
        self, phrases: Phrases, bwt: np.ndarray, search: np.ndarray, near: np.ndarray, far: np.ndarray
    ) -> list[np.ndarray]:
        """Of each phrase and each id next to it: phrase, id, both intervals and their length."""
        size = phrases.count
        start = np.cumsum(size) - size
        rows = np.arange(size.sum()) + np.repeat(near - start, size)
        pairs, count = np.unique(
            np.repeat(np.arange(len(size)), size) * self.ids + bwt[rows], return_counts=True)
        owner, word = pairs // self.ids, pairs % self.ids
        smaller = np.cumsum(count) - count - start[owner]
        at = np.searchsorted(search, word * self.rows + near[owner])
        real = word > 0
        return [x[real] for x in (owner, word, at, far[owner] + smaller, count)]

    def extend_right(self, phrases: Phrases) -> Phrases:
        owner, word, backward, forward, count = self._extended(
            phrases, self.right, self._to_right, phrases.backward, phrases.forward)
        return Phrases(np.column_stack([phrases.words[owner], word]), forward, backward, count)

    def extend_left(self, phrases: Phrases) -> Phrases:
        owner, word, forward, backward, count = self._extended(
            phrases, self.left, self._to_left, phrases.forward, phrases.backward)
        return Phrases(np.column_stack([word, phrases.words[owner]]), forward, backward, count)
