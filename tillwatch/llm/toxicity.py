"""Toxicity by compression distance under two zstandard dictionaries.

Training takes at most ``TRAIN_ROWS`` labelled rows of each class (smallest hashes of their
ids). Letter groups that are far more frequent in toxic rows mark the telling parts of words;
one dictionary is trained on those parts, another on the words of ordinary rows. The toxic
compressor knows both, the ordinary one only its own, so that plain text costs the same under
both and the difference shows toxic parts alone.

A window is one word between two fixed fillers, which keep the frame from ending in raw bytes
and the word out of the last eight bytes, where the compressor looks for no matches. A
document's features are the largest difference of its windows and how many windows reach each
of three differences; a logistic model on the training rows turns them into the score.

Windows of equal words compress equally, so a task compresses each distinct word once and
remembers a bounded number of them. Whole texts are scored, and all of them alike.

Defined results: a null or wordless text has no windows and gets the score of zero features; a
missing class in the labels gives every row that class's base rate (0 without labels);
repeated ids in ``labels`` count as toxic if any of their rows does; null labels and ids teach
nothing; a null ``doc_id`` is scored like any other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import crc32_of_id, kept, unused
from tillwatch.session import written

TRAIN_ROWS = 10_000
FOLDS, HELD_OUT = 5, 0
GRAM = 5
# A letter group tells if it is in this share of toxic rows, and this many times as frequent
# there as in ordinary rows.
MIN_SHARE, MIN_RATIO, MIN_ROWS = 0.015, 40.0, 4
# Bounds on what the driver sees of the training rows: words, and bytes of each dictionary.
MAX_WORDS = 20_000
ORDINARY_BYTES, TOXIC_BYTES = 4096, 4096
ROUNDS = 50
DIFFERENCES = (3, 4, 5)
REMEMBERED = 200_000
FILLER = b"\n~~~~~~~~0123456789abcdefghij~~~~\n"
_BREAKS = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_BREAKS).split()


def _grams(word: bytes) -> set[str]:
    padded = f" {word.decode('utf-8', 'replace')} "
    return {padded[i:i + GRAM] for i in range(len(padded) - GRAM + 1)}


def _telling_parts(word: bytes, telling: set[str]) -> list[bytes]:
    padded, parts, i = f" {word.decode('utf-8', 'replace')} ", [], 0
    while i <= len(padded) - GRAM:
        if padded[i:i + GRAM] in telling:
            j = i + 1
            while j <= len(padded) - GRAM and padded[j:j + GRAM] in telling:
                j += 1
            parts.append(padded[i:j - 1 + GRAM].encode())
            i = j
        else:
            i += 1
    return parts


def training_rows(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and label of the bounded training sample."""
    label = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    ).filter(F.pmod(crc32_of_id(), F.lit(FOLDS)) != HELD_OUT)
    present = label.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = [present.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
              for k in (0, 1)]
    both = written(chosen[0].union(chosen[1]), "labelled")
    return documents.select("doc_id", "text").join(F.broadcast(both), "doc_id")


def _word_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen = [Counter(), Counter()]
        for text, toxic in zip(batch["text"], batch["toxic"]):
            seen[int(toxic > 0)].update(set(words_of(text)))
        for k in (0, 1):
            yield pd.DataFrame({"word": list(seen[k]), "toxic": k, "rows": list(seen[k].values())},
                               ).astype({"word": object, "toxic": np.int32, "rows": np.int64})


def _gram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        plain, bad = Counter(), Counter()
        for word, ordinary, toxic in zip(batch["word"], batch["ordinary"], batch["toxic"]):
            for gram in _grams(bytes(word)):
                plain[gram] += ordinary
                bad[gram] += toxic
        yield pd.DataFrame({"gram": list(plain), "ordinary": list(plain.values()),
                            "toxic": [bad[g] for g in plain]}).astype(
            {"gram": object, "ordinary": np.int64, "toxic": np.int64})


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[:size]


def train(rows: DataFrame) -> tuple[bytes, bytes] | None:
    """The ordinary and the toxic dictionary content; None unless both classes have rows."""
    n = {r["toxic"]: r["count"] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    if len(n) < 2:
        return None
    words = written(rows.select("text", "toxic").mapInPandas(
        _word_rows, "word binary, toxic int, rows long").groupBy("word").agg(
        F.sum(F.expr("if(toxic = 0, rows, 0)")).alias("ordinary"),
        F.sum(F.expr("if(toxic = 1, rows, 0)")).alias("toxic")), "words")
    grams = words.mapInPandas(_gram_rows, "gram string, ordinary long, toxic long").groupBy("gram").agg(
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    least = max(MIN_ROWS, MIN_SHARE * n[1])
    telling = {r["gram"] for r in grams.filter(
        (F.col("toxic") >= least)
        & (F.col("toxic") / n[1] >= MIN_RATIO * (F.col("ordinary") + 0.5) / n[0])
    ).orderBy(F.col("toxic").desc(), "gram").limit(MAX_WORDS).collect()}
    order = [F.col("toxic").desc(), F.col("word")]
    bad = words.filter("toxic > ordinary").orderBy(*order).limit(MAX_WORDS).collect()
    plain = words.filter("ordinary > 0").orderBy(F.col("ordinary").desc(), "word").limit(MAX_WORDS).collect()
    weighed = [(_telling_parts(bytes(r["word"]), telling), r["toxic"]) for r in bad]
    # Round by round, so that frequent parts are spread over the samples.
    parts = [p for turn in range(ROUNDS) for found, rows in weighed if rows > turn for p in found]
    toxic = [b" ".join(parts[i:i + 8]) for i in range(0, len(parts), 8)]
    ordinary = [b" " + bytes(r["word"]) + b" " for r in plain if not _telling_parts(bytes(r["word"]), telling)]
    ordinary = [b"".join(ordinary[i::len(ordinary) // 10 + 1]) for i in range(len(ordinary) // 10 + 1)]
    return _dictionary(ordinary, ORDINARY_BYTES), _dictionary(toxic, TOXIC_BYTES)


class Differences(dict):
    """Compressed length under the ordinary less that under the toxic dictionary, per word."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        super().__init__()
        settings = zstd.ZstdCompressionParameters(
            window_log=14, hash_log=15, chain_log=15, search_log=8, target_length=16, min_match=5,
            strategy=zstd.STRATEGY_LAZY2, write_content_size=False, write_checksum=False,
            write_dict_id=False)
        self.compressors = []
        # The shared content and the filler come last, so that their matches cost the same.
        for content in (ordinary + FILLER, toxic + ordinary + FILLER):
            known = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=settings)
            self.compressors.append(zstd.ZstdCompressor(dict_data=known, compression_params=settings))

    def __missing__(self, word: bytes) -> int:
        window = FILLER + b" " + word + b" " + FILLER
        plain, bad = (len(c.compress(window)) for c in self.compressors)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = plain - bad
        return plain - bad

    def features(self, text: str | None) -> list[float]:
        words = words_of(text)
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        top = float(found.max()) if len(words) else 0.0
        return [max(top, 0.0), *(float(np.log1p((found >= d).sum())) for d in DIFFERENCES),
                float(np.log1p(len(words)))]


def _feature_column(dictionaries: tuple[bytes, bytes]) -> Callable[[Column], Column]:
    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        known = kept(("toxicity", *dictionaries), lambda: Differences(*dictionaries))
        return pd.Series([known.features(t) for t in texts])

    return features


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 60, penalty: float = 1e-2) -> np.ndarray:
    """Weights of a penalised logistic model, the constant last (Newton's method)."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


SCORES = ("held_out", "score", "predicted")


def score(documents: DataFrame, labels: DataFrame, names: tuple[str, ...] = SCORES) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` and ``predicted``, or ``names`` in their place."""
    rows = training_rows(documents, labels)
    dictionaries = train(rows)
    is_held, points, predicted = names
    held_out = F.pmod(crc32_of_id(), F.lit(FOLDS)) == HELD_OUT
    columns = [c for c in documents.columns if c not in names]
    if dictionaries is None:
        rate = rows.agg(F.avg("toxic").cast("double")).first()[0] or 0.0
        return documents.select(*columns, held_out.alias(is_held), F.lit(rate).alias(points),
                                F.lit(int(rate >= 0.5)).alias(predicted))
    (x,) = unused(documents, "_x")
    features = _feature_column(dictionaries)
    known = rows.select(features(F.col("text")).alias("x"), "toxic").collect()
    weights = calibrate(np.array([r["x"] for r in known]), np.array([float(r["toxic"] > 0) for r in known]))
    linear = F.lit(float(weights[-1]))
    for i, weight in enumerate(weights[:-1]):
        linear = linear + F.lit(float(weight)) * F.col(x)[i]
    return (
        documents.select(*columns, held_out.alias(is_held), features(F.col("text")).alias(x))
        .withColumn(points, 1 / (1 + F.exp(-linear)))
        .withColumn(predicted, (F.col(points) >= 0.5).cast("int")).drop(x)
    )


def digest(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "held_out", "score", "predicted")


def keep_civil(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` without the rows that are predicted toxic."""
    names = unused(documents, *SCORES)
    return score(documents, labels, tuple(names)).filter(F.col(names[-1]) == 0).drop(*names)
