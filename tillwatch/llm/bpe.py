"""Byte-level BPE encoding and decoding, by DuckDB inside each Spark task.

A text is cut into the pattern's matches (words). The distinct words a worker has not seen
yet become token-position rows; a recursive query joins neighbouring tokens with the merge
table and contracts each word's leftmost pair of minimum rank until no pair merges. Decoding
joins the ids with the vocabulary and puts the bytes together by an ordered aggregation.

The merge table has every way to split a vocabulary entry in two; a pair's rank is the id of
what it merges to. A word that is a vocabulary entry itself is that one id. Words longer than
``LONG_WORD`` bytes, of which each round would cost as much as all their bytes, are contracted
by the same rule with a heap.

Memory: texts are cut between words into segments of ``SEGMENT`` characters and worked on in
groups of about that size; ids leave in batches of about that much text; a worker remembers at
most about ``REMEMBERED`` words and pieces.

Defined results: a null text is encoded as an empty one (no ids, no bytes); lone surrogates
cannot occur in Spark strings; a null id column decodes to null; other columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from collections.abc import Iterator
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.llm.common import kept

SEGMENT = 1 << 20
REMEMBERED = 500_000
# Words contracted by one query.
WORD_BLOCK = 50_000
LONG_WORD = 400

# White space as the pattern means it. A blank between two other characters always starts a
# word, so the pieces below are whole numbers of words.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+").findall
_CUT = re.compile(f"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")

CONTRACT = """
WITH RECURSIVE state(word, pos, token, next_pos, next_token, live) AS (
    SELECT word, pos, token, lead(pos) OVER w, lead(token) OVER w, true
    FROM given WINDOW w AS (PARTITION BY word ORDER BY pos)
    UNION ALL (
    WITH rows AS MATERIALIZED (SELECT * FROM state WHERE live),
    best AS MATERIALIZED (
        SELECT word, min(m.merged * 4294967296 + pos) AS k
        FROM rows JOIN merges m ON m.first = rows.token AND m.second = rows.next_token GROUP BY word),
    pair AS (
        SELECT best.word, a.pos, (best.k // 4294967296)::INTEGER AS merged, b.pos AS gone,
               b.next_pos, b.next_token
        FROM best JOIN rows a ON a.word = best.word AND a.pos = best.k % 4294967296
        JOIN rows b ON b.word = a.word AND b.pos = a.next_pos)
    SELECT r.word, r.pos, CASE WHEN r.pos = p.pos THEN p.merged ELSE r.token END,
           CASE WHEN r.pos = p.pos THEN p.next_pos ELSE r.next_pos END,
           CASE WHEN r.pos = p.pos THEN p.next_token
                WHEN r.next_pos = p.pos THEN p.merged ELSE r.next_token END,
           p.word IS NOT NULL
    FROM rows r LEFT JOIN pair p ON p.word = r.word
    WHERE p.word IS NULL OR r.pos <> p.gone))
SELECT word, token FROM state WHERE NOT live ORDER BY word, pos
"""

DECODE = """
SELECT text, string_agg(v.hex, '' ORDER BY pos) AS hex
FROM tokens JOIN vocabulary v ON v.id = tokens.id GROUP BY text
"""


class Coder:
    """The vocabulary in a DuckDB of the worker's own, and the words it has encoded."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import duckdb

        self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.words = regex.compile(pattern).findall
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        merges = np.array([
            (self.ids[t[:k]], self.ids[t[k:]], i) for t, i in self.ids.items()
            for k in range(1, len(t)) if t[:k] in self.ids and t[k:] in self.ids
        ] or np.zeros((0, 3)), np.int32)
        self.merged = {(int(a), int(b)): int(m) for a, b, m in merges}
        self.db = duckdb.connect(":memory:", config={
            "threads": 1, "memory_limit": "300MB", "preserve_insertion_order": False})
        given = {"first": merges[:, 0], "second": merges[:, 1], "merged": merges[:, 2].astype(np.int64)}
        self._table("m", given)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM m")
        self._table("v", {"id": np.fromiter(self.ids.values(), np.int32), "hex": [t.hex() for t in self.ids]})
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM v")
        self.names = list(map(str, range(max(self.ids.values(), default=-1) + 1)))
        # Ids as int32 bytes of words and of pieces (a word alone is a piece of one word).
        self.known: dict[str, bytes] = {}

    def _table(self, name: str, columns: dict) -> None:
        self.db.register(name, pa.table(columns))

    def contract(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (neither long nor a vocabulary entry)."""
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        first = np.cumsum(lengths) - lengths
        self._table("given", {"word": owner, "pos": (np.arange(len(data)) - first[owner]),
                              "token": self.bytes[data]})
        found = self.db.execute(CONTRACT).fetchnumpy()
        self.db.unregister("given")
        ends = np.searchsorted(found["word"], np.arange(len(words)), "right")
        return _cut(np.asarray(found["token"], np.int32).tobytes(), ends * 4)

    def contract_long(self, word: bytes) -> bytes:
        """The same rule with a heap of (rank, position)."""
        tokens = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, tokens[i], tokens[i + 1]) for i in range(n - 1)
                if (m := self.merged.get((tokens[i], tokens[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (made := self.merged.get((tokens[left], tokens[right]))) is not None:
                    heapq.heappush(heap, (made, left, tokens[left], tokens[right]))
        return np.array([t for t in tokens if t >= 0], np.int32).tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encodes what is new among ``pieces``."""
        new = pieces.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = _first_half(self.known)
            new = pieces.difference(self.known)
        known = self.known
        # Letters after at most one blank are one word.
        unknown = {p for p in new if p.strip(" ").isalpha()}
        others = {p: self.words(p) for p in new.difference(unknown)}
        unknown.update(chain.from_iterable(others.values()))
        ordinary, data = [], []
        for word in unknown.difference(known):
            given = word.encode()
            if (one := self.ids.get(given)) is not None:
                known[word] = one.to_bytes(4, sys.byteorder)
            elif len(given) > LONG_WORD:
                known[word] = self.contract_long(given)
            else:
                ordinary.append(word)
                data.append(given)
        for first in range(0, len(ordinary), WORD_BLOCK):
            block = slice(first, first + WORD_BLOCK)
            known.update(zip(ordinary[block], self.contract(data[block])))
        for piece, words in others.items():
            if words != [piece]:
                known[piece] = b"".join([known[w] for w in words])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Per text its ids as int32 bytes."""
        cut = [_PIECES(text) for text in texts]
        self.learn({piece for pieces in cut for piece in pieces})
        known = self.known.__getitem__
        for pieces in cut:
            yield b"".join(map(known, pieces))

    def named(self, ids: bytes) -> str:
        """Ids as decimal text, joined by blanks."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, np.int32).tolist()))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Per text the bytes that its ids stand for."""
        sizes = np.array([len(data) // 4 for data in ids])
        if not sizes.sum():
            return [b""] * len(ids)
        self._table("tokens", {"text": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
                               "pos": np.arange(sizes.sum(), dtype=np.int64),
                               "id": np.frombuffer(b"".join(ids), np.int32)})
        out = [b""] * len(ids)
        for text, data in self.db.execute(DECODE).fetchall():
            out[text] = bytes.fromhex(data)
        self.db.unregister("tokens")
        return out


def _cut(data: bytes, ends: np.ndarray) -> list[bytes]:
    """``data`` in the parts that end at ``ends``."""
    last = ends.tolist()
    return [data[a:b] for a, b in zip([0, *last[:-1]], last)]


def _first_half(known: dict) -> dict:
    """What was met first, which is what is met most."""
    return dict(islice(known.items(), REMEMBERED // 2))


def _coder(ranks: bytes, pattern: str) -> Coder:
    key = ("bpe", hashlib.sha256(ranks).digest(), pattern)
    return kept(key, lambda: Coder(ranks, pattern))


def segments(text: str) -> Iterator[str]:
    """``text`` cut where a word begins, about every ``SEGMENT`` characters."""
    start = 0
    while len(text) - start > SEGMENT and (cut := _CUT.search(text, start + SEGMENT)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def _groups(texts: pa.Array) -> Iterator[list[tuple[int, str]]]:
    """(row, segment) in order, in groups of about ``SEGMENT`` characters."""
    group, size = [], 0
    for row in range(len(texts)):
        for part in segments(texts[row].as_py() or ""):
            group.append((row, part))
            size += len(part)
            if size >= SEGMENT:
                yield group
                group, size = [], 0
    yield group


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in batches of about ``SEGMENT`` bytes of ``column``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // SEGMENT
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(first, last - first)


class Vocabulary:
    """A rank file (read on the driver, sent to the executors) and its pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks, self.pattern = Path(path).read_bytes(), pattern

    def encode(self, documents: DataFrame, column: str = "text") -> DataFrame:
        """``documents`` with ``ids``, the token ids of ``column``."""
        ranks, pattern = documents.sparkSession.sparkContext.broadcast(self.ranks), self.pattern

        def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(ranks.value, pattern)
            for batch in _slices(batches, column):
                parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
                for group in _groups(batch.column(column)):
                    for (row, _), ids in zip(group, coder.encode([t for _, t in group])):
                        parts[row].append(ids)
                data = [b"".join(p) for p in parts]
                sizes = np.cumsum([0, *(len(d) // 4 for d in data)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(sizes, np.frombuffer(b"".join(data), np.int32))
                kept = [i for i, name in enumerate(batch.schema.names) if name != "ids"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept), ids],
                    names=[*(batch.schema.names[i] for i in kept), "ids"])

        fields = [f for f in documents.schema if f.name != "ids"]
        return documents.mapInArrow(encoded, T.StructType(
            [*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))

    def decode(self, encoded: DataFrame, column: str = "ids") -> DataFrame:
        """``encoded`` with ``bytes``, the bytes that the ids in ``column`` stand for."""
        ranks, pattern = encoded.sparkSession.sparkContext.broadcast(self.ranks), self.pattern

        def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(ranks.value, pattern)
            for batch in batches:
                out: list[bytes | None] = []
                for row in range(batch.num_rows):
                    ids = batch.column(column)[row]
                    out.append(coder.decode([np.asarray(ids.values, np.int32).tobytes()])[0]
                               if ids.is_valid else None)
                kept = [i for i, name in enumerate(batch.schema.names) if name != "bytes"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept), pa.array(out, pa.binary())],
                    names=[*(batch.schema.names[i] for i in kept), "bytes"])

        fields = [f for f in encoded.schema if f.name != "bytes"]
        return encoded.mapInArrow(decoded, T.StructType(
            [*fields, T.StructField("bytes", T.BinaryType())]))

    def round_trip(self, documents: DataFrame) -> DataFrame:
        """doc_id, n_tokens and the SHA-256 of the decimal ids and of the decoded bytes. Encodes
        and decodes in one pass and streams long texts, so that no ids are moved."""
        ranks, pattern = documents.sparkSession.sparkContext.broadcast(self.ranks), self.pattern

        def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder = _coder(ranks.value, pattern)
            for batch in batches:
                n = batch.num_rows
                counts = np.zeros(n, np.int64)
                ids_sha, text_sha = [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
                for group in _groups(batch.column("text")):
                    ids = list(coder.encode([t for _, t in group]))
                    for (row, _), data in zip(group, ids):
                        if data:
                            ids_sha[row].update((" " * bool(counts[row]) + coder.named(data)).encode())
                        counts[row] += len(data) // 4
                    for (row, _), data in zip(group, coder.decode(ids)):
                        text_sha[row].update(data)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts),
                     pa.array([h.hexdigest() for h in ids_sha]), pa.array([h.hexdigest() for h in text_sha])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        kind = documents.schema["doc_id"].dataType.simpleString()
        return documents.select("doc_id", "text").mapInArrow(
            digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenized(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``documents`` with ``ids`` and ``n_tokens``."""
    return vocabulary.encode(documents).withColumn("n_tokens", F.size("ids").cast("long"))
