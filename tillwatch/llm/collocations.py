"""Phrase collocations from FM-indexes of shards of the corpus.

1. Tasks cut their documents into shards of about ``SHARD_WORDS`` words; a shard's words become
   ids of a lexicon of its own. Word counts are summed across shards.
2. Words that are frequent in the whole corpus get a number. In each shard all others become
   separators, since no frequent phrase holds one, and a bidirectional FM-index is built of what
   is left and written.
3. Every index extends its words to the right. Pairs are dealt to buckets by both words, so a frequent
   word is spread; a shard sends one packed row per bucket, with its pairs and their counts. Where the
   rows of all shards meet, counts are summed and each shard gets back a bit for each pair it has sent.
4. Every index extends its frequent pairs to the right, and those to the left, where all pairs
   inside are frequent. Counts of phrases of three and four words are sent and summed the same way.
   Buckets grow in number with the corpus, not in size.

What a shard needs to know of the whole corpus is joined to it by shard and is never more than
what occurs in it; nothing is sent to all tasks but tables of a measured size. Counts, cuts
and scores are exact, at every size.

Defined results: A-Z are lower-cased; ``.,;:!?`` and line ends of any kind end a piece, blanks and
tabs a word; a null language is ``und``; null, empty and blank texts have no words; repeated rows
count each; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import SMALL, release, small
from tillwatch.llm.fm_index import DEPTH, FMIndex
from tillwatch.operators.joins import left_join_unique
from tillwatch.session import written

LEAST = 30
# A phrase goes if a longer one that holds it has at least this share, in percent, of its count.
COVERED = 80
TOP = 2000
SCALE = 2_000_000
SHARD_WORDS = 1 << 20
PIECES = 4096
RANK_BUCKETS = 32
# Words of the corpus for each bucket of phrases, and the least number of buckets.
SPLIT = 1 << 21
BUCKETS = 32
# What a row of the pairs' totals has in place of a shard, and the pairs in one such row.
ALL = -1
LISTED = 4096

_FOLD = bytearray(range(256))
_FOLD[65:91] = range(97, 123)
for _end in b".,;:!?\x0b\x0c\r":
    _FOLD[_end] = 10
_FOLD = bytes(_FOLD)


class _Lexicon(dict):
    """Ids of the words of one language; ids are dealt from the shard's list of all words."""

    def __init__(self, lang: str, listed: list[tuple[str, bytes]]) -> None:
        super().__init__()
        self.lang, self.listed = lang, listed

    def __missing__(self, word: bytes) -> int:
        self.listed.append((self.lang, word))
        self[word] = out = len(self.listed)
        return out


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, np.int32).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    name, number = TaskContext.get().partitionId(), 0
    listed: list[tuple[str, bytes]] = []
    lexica: dict[str, _Lexicon] = {}
    ids = array("i")

    def shard() -> pa.RecordBatch:
        text = np.frombuffer(ids, np.int32)
        lexicon = pa.StructArray.from_arrays(
            [pa.array([lang for lang, _ in listed], pa.string()),
             pa.array([word for _, word in listed], pa.binary()).cast(pa.string()),
             pa.array(np.bincount(text, minlength=len(listed) + 1)[1:], pa.int64())],
            names=["lang", "word", "n"])
        return pa.RecordBatch.from_arrays(
            [pa.array([(name << 32) + number], pa.int64()), pa.array([_packed(text)], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), lexicon)],
            names=["shard", "text", "lexicon"])

    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for row, lang in enumerate(batch.column("lang").to_pylist()):
            lang = "und" if lang is None else lang
            pieces = (texts[row].as_py() or b"").translate(_FOLD).split(b"\n")
            for first in range(0, len(pieces), PIECES):
                if lang not in lexica:
                    lexica[lang] = _Lexicon(lang, listed)
                known = lexica[lang].__getitem__
                for piece in pieces[first:first + PIECES]:
                    words = piece.split()
                    if words:
                        ids.extend(map(known, words))
                        ids.append(0)
                if len(ids) >= SHARD_WORDS:
                    yield shard()
                    number += 1
                    listed, lexica, ids = [], {}, array("i")
    if ids:
        yield shard()


def _lists(offsets: np.ndarray | list[int], values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _indexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index of each shard over the frequent words, which get ids in the order of their
    numbers."""
    release()
    for batch in batches:
        for row in range(batch.num_rows):
            text = _unpacked(batch.column("text")[row].as_py())
            alive = batch.column("alive")[row].values
            local, number = (alive.field(k).to_numpy(zero_copy_only=False) for k in ("id", "number"))
            order = np.argsort(number)
            to = np.zeros(int(text.max()) + 1, np.int32)
            to[local[order]] = np.arange(1, len(order) + 1)
            text = to[text]
            # One separator is enough between two words, and the text ends with one.
            text = text[(text != 0) | (np.append(text[1:], 0) != 0)]
            index = FMIndex.of(np.append(text, np.int32(0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard").slice(row, 1), _lists([0, len(order)], number[order]),
                 pa.array([_packed(index.left)], pa.binary()), pa.array([_packed(index.right)], pa.binary())],
                names=["shard", "numbers", "left", "right"])


def _loaded(batch: pa.RecordBatch, row: int) -> tuple[FMIndex, np.ndarray]:
    """An index and the number of each of its ids; 0 stands for none."""
    index = FMIndex(*(_unpacked(batch.column(side)[row].as_py()) for side in ("left", "right")))
    numbers = batch.column("numbers")[row].values.to_numpy(zero_copy_only=False)
    return index, np.concatenate([[0], numbers])


def _order(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases, as rows of numbers, dealt to buckets by all of their words: the order in which they are
    sent, the buckets that get any, and where each begins in that order."""
    mixed = np.zeros(len(words), np.uint64)
    for column in words.T:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    bucket = ((mixed >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((words[:, 0], bucket))
    bucket = bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    return order, bucket[starts], starts


def _dealt(shard: int, words: np.ndarray, count: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One packed row per bucket of the phrases of a shard and the number of each."""
    order, dealt, starts = _order(words, buckets)
    columns = np.vstack([words.T, count])[:, order]
    packed = zstandard.ZstdCompressor(level=3)
    data = [packed.compress(_planes(columns[:, low:high]))
            for low, high in zip(starts, np.append(starts[1:], len(order)))]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(starts), shard, np.int64)), pa.array(dealt), pa.array(data, pa.binary())],
        names=["shard", "bucket", "data"])


def _planes(columns: np.ndarray) -> bytes:
    """Numbers byte by byte, the lowest bytes of a column side by side, so that those that are
    mostly zero take no room once packed. The first column, which is ordered, goes as differences."""
    columns = np.ascontiguousarray(np.vstack([np.diff(columns[0], prepend=0), columns[1:]]), "<i8")
    return columns.view(np.uint8).reshape(*columns.shape, 8).transpose(0, 2, 1).tobytes()


def _columns(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, 8, -1)
    columns = planes.transpose(0, 2, 1).copy().view("<i8")[:, :, 0]
    columns[0] = np.cumsum(columns[0])
    return columns


def _pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The pairs of each shard and the number of each, one row per bucket."""
    release()
    for batch in batches:
        for row in range(batch.num_rows):
            index, numbers = _loaded(batch, row)
            found = index.extend_right(index.single())
            yield _dealt(batch.column("shard")[row].as_py(), numbers[found.words], found.count, buckets)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each bucket; rows come sorted by bucket."""
    release()
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        edges = np.flatnonzero(np.diff(bucket, prepend=held[-1].column("bucket")[0].as_py() if held else bucket[0]))
        low = 0
        for high in edges.tolist():
            yield pa.Table.from_batches([*held, batch.slice(low, high - low)])
            held, low = [], high
        held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)


def _merged(rows: pa.Table, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows of a bucket: which of the phrases sent, one row after the other, are frequent, and
    how many each row has; the frequent phrases once each, and their totals."""
    unpack = zstandard.ZstdDecompressor()
    parts = [_columns(unpack.decompress(data), width + 1) for data in rows.column("data").to_pylist()]
    sizes = np.array([part.shape[1] for part in parts])
    sent = np.concatenate(parts, axis=1)
    order = np.lexsort(sent[width - 1::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for column in sent[:width]:
        new[1:] |= np.diff(column[order]) != 0
    starts = np.flatnonzero(new)
    total = np.add.reduceat(sent[width][order], starts)
    frequent = total >= least
    alive = np.zeros(len(order), bool)
    alive[order] = np.repeat(frequent, np.diff(starts, append=len(order)))
    return alive, sizes, sent[:width, order[starts[frequent]]], total[frequent]


def _frequent_pairs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Of each bucket, a bit per pair that a shard has sent, whether it is frequent; and the
    frequent pairs with their totals."""
    release()
    for rows in _buckets(batches):
        alive, sizes, words, total = _merged(rows, 2, least)
        ends = np.cumsum(sizes)
        bits = [np.packbits(alive[low:high]).tobytes() for low, high in zip(ends - sizes, ends)]
        none = np.zeros(len(bits) + 1, np.int32)
        yield pa.RecordBatch.from_arrays(
            [rows.column("shard").combine_chunks(), rows.column("bucket").combine_chunks(),
             pa.array(bits, pa.binary()), *[_lists(none, np.zeros(0, np.int64))] * 3],
            names=["shard", "bucket", "alive", "w1", "w2", "n"])
        starts = np.arange(0, len(total), LISTED)
        if len(starts):
            lists = [_lists(np.append(starts, len(total)), column) for column in (*words, total)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(starts), ALL, np.int64)),
                 pa.array(np.full(len(starts), rows.column("bucket")[0].as_py(), np.int64)),
                 pa.nulls(len(starts), pa.binary()), *lists],
                names=["shard", "bucket", "alive", "w1", "w2", "n"])


def _frequent_phrases(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    release()
    for rows in _buckets(batches):
        _, _, words, total = _merged(rows, DEPTH, least)
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, words), pa.array(total)], names=["w1", "w2", "w3", "w4", "n"])


def _longer(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The phrases of three and four words of each shard whose pairs are all frequent, and the number of
    each, one row per bucket."""
    release()
    for batch in batches:
        for row in range(batch.num_rows):
            index, numbers = _loaded(batch, row)
            two = index.extend_right(index.single())
            # The pairs as ``_pairs`` has sent them, so a bit tells of each whether it is frequent.
            order, dealt, starts = _order(numbers[two.words], buckets)
            bits = {x["bucket"]: x["alive"] for x in batch.column("alive")[row].as_py()}
            alive = np.zeros(len(order), bool)
            for bucket, low, high in zip(dealt.tolist(), starts, np.append(starts[1:], len(order))):
                sent = np.frombuffer(bits[bucket], np.uint8)
                alive[order[low:high]] = np.unpackbits(sent, count=high - low).astype(bool)
            two = two.only(alive)
            if not len(two.count):
                continue
            pairs = two.words[:, 0] * index.ids + two.words[:, 1]

            def frequent(words: np.ndarray) -> np.ndarray:
                key = words[:, 0] * index.ids + words[:, 1]
                return pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key

            three = index.extend_right(two)
            three = three.only(frequent(three.words[:, 1:]))
            four = index.extend_left(three)
            four = four.only(frequent(four.words[:, :2]))
            words = np.zeros((len(three.count) + len(four.count), DEPTH), np.int64)
            words[:len(three.count), :3] = numbers[three.words]
            words[len(three.count):] = numbers[four.words]
            yield _dealt(batch.column("shard")[row].as_py(), words, np.append(three.count, four.count), buckets)


def frequent_phrases(documents: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (number, lang, word, n) and phrases of one to four word numbers (phrase, n) that occur
    at least ``least`` times in a language, and the number of all words of each language."""
    shards = written(documents.select("lang", "text").mapInArrow(
        _shards, "shard long, text binary, lexicon array<struct<lang: string, word: string, n: long>>"), "shards")
    listed = shards.select("shard", F.posexplode("lexicon").alias("at", "entry")).select(
        "shard", (F.col("at") + 1).alias("id"), "entry.*")
    counted = written(listed.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    totals = written(counted.groupBy("lang").agg(F.sum("n").alias("words")), "totals")
    words = written(counted.filter(F.col("n") >= least).select(
        (F.monotonically_increasing_id() + 1).alias("number"), "lang", "word", "n"), "words")
    alive = listed.join(words.select("lang", "word", "number"), ["lang", "word"]).groupBy("shard").agg(
        F.collect_list(F.struct("id", "number")).alias("alive"))
    indexes = written(shards.select("shard", "text").join(alive, "shard").mapInArrow(
        _indexes, "shard long, numbers array<long>, left binary, right binary"), "indexes")
    buckets = max(BUCKETS, (totals.agg(F.sum("words")).first()[0] or 0) // SPLIT)
    sent = "shard long, bucket long, data binary"
    met = indexes.mapInArrow(lambda batches: _pairs(batches, buckets), sent).repartition(
        "bucket").sortWithinPartitions("bucket")
    found = written(met.mapInArrow(
        lambda batches: _frequent_pairs(batches, least),
        "shard long, bucket long, alive binary, w1 array<long>, w2 array<long>, n array<long>"), "pairs")
    pairs = found.filter(F.col("shard") == ALL).select(
        F.explode(F.arrays_zip("w1", "w2", "n")).alias("pair")).select("pair.*")
    alive = found.filter(F.col("shard") != ALL).groupBy("shard").agg(
        F.collect_list(F.struct("bucket", "alive")).alias("alive"))
    longer = indexes.join(alive, "shard").mapInArrow(lambda batches: _longer(batches, buckets), sent).repartition(
        "bucket").sortWithinPartitions("bucket").mapInArrow(
        lambda batches: _frequent_phrases(batches, least), "w1 long, w2 long, w3 long, w4 long, n long")
    phrases = written(words.select(F.array("number").alias("phrase"), "n").unionByName(
        pairs.select(F.array("w1", "w2").alias("phrase"), "n")).unionByName(
        longer.select(F.expr("filter(array(w1, w2, w3, w4), w -> w <> 0)").alias("phrase"), "n")), "phrases")
    return words, phrases, totals


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (two words or more) with a, and l, r and score of their lowest cut."""
    candidates = phrases.filter(F.size("phrase") > 1).withColumnRenamed("n", "a")
    halves = candidates.withColumn("cut", F.explode(F.expr("sequence(1, size(phrase) - 1)"))).withColumn(
        "half", F.explode(F.expr(
            "array(named_struct('first', true, 'part', slice(phrase, 1, cut)),"
            " named_struct('first', false, 'part', slice(phrase, cut + 1, size(phrase) - cut)))"))
    ).select("phrase", "a", "cut", "half.*")
    parts = phrases.select(F.col("phrase").alias("part"), "n")
    cuts = left_join_unique(written(halves, "halves"), parts, ["part"], SMALL).groupBy("phrase", "a", "cut").agg(
        F.max(F.expr("CASE WHEN first THEN n END")).alias("l"),
        F.max(F.expr("CASE WHEN NOT first THEN n END")).alias("r"))
    score = F.expr(f"(CAST(a AS decimal(19, 0)) * CAST({SCALE} AS decimal(10, 0)))"
                   " div (CAST(l AS decimal(19, 0)) + CAST(r AS decimal(19, 0)))")
    return cuts.groupBy("phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")).select("phrase", "a", "lowest.*")


def uncovered(candidates: DataFrame, covered: int = COVERED) -> DataFrame:
    """Candidates that no longer one covers. Between a phrase and a longer one that holds it lie
    only phrases that occur as often as the longer one, so one more word either side tells."""
    exact = "CAST({} AS decimal(20, 0))".format
    outer = candidates.filter(F.size("phrase") > 2).select("a", F.explode(F.expr(
        "array(slice(phrase, 1, size(phrase) - 1), slice(phrase, 2, size(phrase) - 1))")).alias("phrase")
    ).groupBy("phrase").agg(F.max("a").alias("outer"))
    return candidates.join(outer, "phrase", "left").filter(
        f"outer IS NULL OR 100 * {exact('outer')} < {covered} * {exact('a')}").drop("outer")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score."""
    words, phrases, totals = frequent_phrases(documents, least)
    kept = written(uncovered(scored(phrases)), "collocations")
    spelled = kept.select("phrase", F.posexplode("phrase").alias("at", "number"))
    spelled = left_join_unique(spelled, words.select("number", "lang", "word"), ["number"], SMALL).groupBy(
        "phrase").agg(F.max("lang").alias("lang"), F.expr(
            "array_join(transform(array_sort(collect_list(struct(at, word))), x -> x.word), ' ')").alias("spelled"))
    rows = kept.join(spelled, "phrase").drop("phrase").withColumnRenamed("spelled", "phrase")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS)))
    for keys in (["lang", "bucket"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
            F.col("rank") <= top)
    return rows.join(small(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("words").alias("n"), "score")


ORACLE = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
pieces AS (
    SELECT d, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS i
    FROM (SELECT d, lang, regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]') AS p FROM docs)),
words AS (
    SELECT d, lang, i, unnest(w) AS word, generate_subscripts(w, 1) AS j
    FROM (SELECT d, lang, i, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)),
starts AS (
    SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
    FROM words WINDOW p AS (PARTITION BY d, i ORDER BY j)),
counts AS (
    SELECT lang, ws, count(*) AS f FROM (
        SELECT lang, [w1] AS ws FROM starts
        UNION ALL SELECT lang, [w1, w2] FROM starts WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, [w1, w2, w3] FROM starts WHERE w3 IS NOT NULL
        UNION ALL SELECT lang, [w1, w2, w3, w4] FROM starts WHERE w4 IS NOT NULL)
    GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE len(ws) = 1 GROUP BY lang),
candidates AS (SELECT lang, ws, f AS a FROM counts WHERE len(ws) > 1 AND f >= {LEAST}),
cuts AS (
    SELECT lang, ws, a, k, array_to_string(ws[:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
    FROM (SELECT lang, ws, a, unnest(generate_series(1, len(ws) - 1)) AS k FROM candidates)),
spelled AS (SELECT lang, array_to_string(ws, ' ') AS phrase, f FROM counts),
split AS (
    SELECT c.lang, c.ws, c.a, c.k, l.f AS l, r.f AS r,
           ({SCALE}::HUGEINT * c.a // (l.f + r.f))::BIGINT AS score
    FROM cuts c
    JOIN spelled l ON l.lang = c.lang AND l.phrase = c.head
    JOIN spelled r ON r.lang = c.lang AND r.phrase = c.tail),
lowest AS (
    SELECT * FROM split QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
inside AS (
    SELECT lang, ws[s:s + k - 1] AS ws, max(a) AS most
    FROM (SELECT lang, ws, a, unnest(generate_series(2, len(ws) - 1)) AS k FROM candidates),
         generate_series(1, 3) AS g(s)
    WHERE s + k - 1 <= len(ws) GROUP BY ALL),
ranked AS (
    SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank
    FROM lowest LEFT JOIN inside USING (lang, ws)
    WHERE most IS NULL OR 100::HUGEINT * most < {COVERED}::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
