"""Language identification by interpolated Kneser-Ney letter models.

Spark counts the letter 4-grams of the words of all training rows, per language. From these
counts come the models: discounted probabilities of the seen grams of every order, and the
weight that each context leaves to the next shorter one, kept as sorted arrays of 64-bit
hashes that are searched by bisection. Lower orders use continuation counts.

A text's cross-entropy per letter (word ends count as letters) is taken under each language,
and the lowest wins; ties go to the language that sorts first. ``score`` is the winner's share
of the likelihood at ``SHARPNESS`` letters. ``rejected`` marks texts whose cross-entropy is
beyond what training rows of that language show (mean plus four deviations).

Every counted gram is in the model, whatever its size. Up to ``SENT_GRAMS`` grams, which is
checked before anything is collected, the driver builds the models and sends them to all
workers. Beyond, Spark builds them as tables by gram and by context, and the texts' grams are
joined to these. Both ways give the same cross-entropies.

Defined results: words are runs of letters, lower-cased; a null text or one without a letter
is ``und`` with score 0; without training rows all rows are ``und``; rows with a null language
teach nothing; repeated rows count one by one; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import crc32_of_id, kept
from tillwatch.operators.joins import salted_left_join
from tillwatch.session import written

ORDER = 4
FOLDS, HELD_OUT = 4, 2
# Grams of all languages whose models may go through the driver.
SENT_GRAMS = 1_000_000
SHARPNESS = 20.0
REMEMBERED = 150_000
# Words of a batch that are counted before their grams are handed on.
COUNTED = 200_000
START, END = "\x02", "\x03"
UNSEEN = 1.0 / 65536

_letters = re.compile(r"[^\W\d_]+").findall
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    found = _letters((text or "").lower())
    return [w for w in (w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in found) if w]


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words: dict[str, Counter] = {}

    def grams() -> pd.DataFrame:
        out = []
        for lang, counted in words.items():
            found: Counter = Counter()
            for word, n in counted.items():
                padded = START * (ORDER - 1) + word + END
                for i in range(len(word) + 1):
                    found[padded[i:i + ORDER]] += n
            out.append(pd.DataFrame({"lang": lang, "gram": list(found), "n": list(found.values())}))
        words.clear()
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "gram": [], "n": []}).astype(
            {"lang": object, "gram": object, "n": np.int64})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            words.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, words.values())) > COUNTED:
                yield grams()
    yield grams()


def gram_counts(documents: DataFrame) -> DataFrame:
    """lang, gram and count over all training rows, as a written table."""
    rows = documents.filter("lang is not null and text is not null").filter(
        F.pmod(crc32_of_id(), F.lit(FOLDS)) != HELD_OUT)
    return written(rows.select("lang", "text").mapInPandas(
        _gram_counts, "lang string, gram string, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")), "grams")


def _hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of letters; the length is part of it."""
    out = np.full(len(codes), codes.shape[1] + 1, np.uint64)
    for k in range(codes.shape[1]):
        out = (out ^ codes[:, k].astype(np.uint64)) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


class _Sorted:
    """Values by 64-bit hash, searched by bisection."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, self.values[at]


class Model:
    """One language's probabilities and context weights, by order."""

    def __init__(self, grams: list[str], counts: np.ndarray) -> None:
        codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
        tables = {ORDER: (codes, counts.astype(np.float64))}
        for k in range(ORDER - 1, 0, -1):
            shorter, n = np.unique(tables[k + 1][0][:, 1:], axis=0, return_counts=True)
            tables[k] = shorter, n.astype(np.float64)
        self.grams: dict[int, _Sorted] = {}
        self.contexts: dict[int, _Sorted] = {}
        lower: _Sorted | None = None
        for k in range(1, ORDER + 1):
            codes, n = tables[k]
            once, twice = (n == 1).sum(), (n == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context, owner = np.unique(_hash(codes[:, :-1]), return_inverse=True)
            total = np.bincount(owner, n)
            weight = discount * np.bincount(owner) / total
            below = np.exp(lower.find(_hash(codes[:, 1:]))[1]) if lower else np.full(len(n), UNSEEN)
            p = (n - discount) / total[owner] + weight[owner] * below
            lower = self.grams[k] = _Sorted(_hash(codes), np.log(p))
            self.contexts[k] = _Sorted(context, np.log(weight))

    def log_p(self, grams: dict[int, np.ndarray], contexts: dict[int, np.ndarray]) -> np.ndarray:
        n = len(grams[1])
        out, open_ = np.zeros(n), np.arange(n)
        for k in range(ORDER, 0, -1):
            seen, value = self.grams[k].find(grams[k][open_])
            out[open_[seen]] += value[seen]
            open_ = open_[~seen]
            known, weight = self.contexts[k].find(contexts[k][open_])
            out[open_[known]] += weight[known]
        out[open_] += np.log(UNSEEN)
        return out


class Scorer:
    """Log-probability of words under every language; remembers a bounded number of words."""

    def __init__(self, models: dict[str, Model]) -> None:
        self.langs = sorted(models)
        self.models = [models[lang] for lang in self.langs]
        self.place: dict[str, int] = {}
        self.known = np.zeros((0, len(self.langs) + 1))

    def learn(self, words: list[str]) -> None:
        text = "".join([START * (ORDER - 1) + w + END for w in words])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        owner = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(owner)) + (owner + 1) * (ORDER - 1)
        near = np.stack([codes[at - k] for k in range(ORDER - 1, -1, -1)], axis=1)
        grams = {k: _hash(near[:, ORDER - k:]) for k in range(1, ORDER + 1)}
        contexts = {k: _hash(near[:, ORDER - k:-1]) for k in range(1, ORDER + 1)}
        rows = [np.bincount(owner, m.log_p(grams, contexts), len(words)) for m in self.models]
        self.known = np.vstack([self.known, np.stack([*rows, lengths], axis=1)])

    def entropies(self, texts: pd.Series) -> list[list[float] | None]:
        """Cross-entropy per letter under each language; None for a text without letters."""
        cut = [words_of(t) for t in texts]
        if len(self.place) > REMEMBERED:
            self.place, self.known = {}, self.known[:0]
        new = list({w for words in cut for w in words if w not in self.place})
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        if new:
            self.learn(new)
        out = []
        for words in cut:
            total = self.known[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)
            out.append((-total[:-1] / total[-1]).tolist() if len(words) else None)
        return out


def train(counts: DataFrame) -> dict[str, Model]:
    rows = counts.orderBy("lang", "gram").toPandas()
    return {lang: Model(of["gram"].tolist(), of["n"].to_numpy()) for lang, of in rows.groupby("lang")}


def model_tables(counts: DataFrame, langs: list[str]) -> dict[int, tuple[DataFrame, DataFrame]]:
    """By order: each gram's log-probabilities and each context's log-weights, as maps from a
    language's place in ``langs``."""
    place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1
    of_order = {ORDER: written(counts.select(place.alias("lang"), "gram", "n"), "order")}
    for k in range(ORDER - 1, 0, -1):
        of_order[k] = written(of_order[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(
            F.count(F.lit(1)).alias("n")), "order")

    def by_place(df: DataFrame, key: str, value: str) -> DataFrame:
        return written(df.groupBy(key).agg(F.map_from_entries(F.collect_list(
            F.struct("lang", F.log(value)))).alias("by_lang")), "model")

    tables, lower = {}, None
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    for k in range(1, ORDER + 1):
        grams = of_order[k].withColumn("context", F.substring("gram", 1, k - 1))
        discounts = of_order[k].groupBy("lang").agg(
            F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5).alias("discount"))
        contexts = written(
            grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            .join(F.broadcast(discounts), "lang").withColumn(
                "weight", F.col("discount") * F.col("kinds") / F.col("total")), "contexts")
        p = (F.col("n") - F.col("discount")) / F.col("total") + F.col("weight") * F.col("below")
        near = grams.join(contexts, ["lang", "context"])
        if lower is None:
            near = near.withColumn("below", F.lit(UNSEEN))
        else:
            near = near.withColumn("suffix", F.substring("gram", 2, k - 1)).join(
                lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
        lower = written(near.select("lang", "gram", p.alias("p")), "probabilities")
        tables[k] = by_place(lower, "gram", "p"), by_place(contexts, "context", "weight")
    return tables


def gram_values(grams: DataFrame, tables: dict[int, tuple[DataFrame, DataFrame]], n_langs: int) -> DataFrame:
    """gram and its log-probability under each language, for every row of ``grams``: what is
    seen of the gram, else its context's weight and the value of the next shorter one."""
    of_order = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):
        of_order[k] = written(of_order[k + 1].select(F.substring("gram", 2, k).alias("gram")).distinct(), "suffixes")
    values = None
    for k in range(1, ORDER + 1):
        seen, weights = tables[k]
        near = of_order[k].withColumn("context", F.substring("gram", 1, k - 1)).join(
            seen.withColumnRenamed("by_lang", "seen"), "gram", "left").join(
            weights.withColumnRenamed("by_lang", "weights"), "context", "left")
        if values is None:
            near = near.withColumn("below", F.array_repeat(F.log(F.lit(UNSEEN)), n_langs))
        else:
            near = near.withColumn("suffix", F.substring("gram", 2, k - 1)).join(
                values.select(F.col("gram").alias("suffix"), F.col("value").alias("below")), "suffix")
        values = written(near.select("gram", F.transform("below", lambda below, i: F.coalesce(
            F.col("seen")[i], F.coalesce(F.col("weights")[i], F.lit(0.0)) + below)).alias("value")), "values")
    return values


def _grams_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for first in range(0, len(batch), 500):
            part = batch.iloc[first:first + 500]
            grams, counts = [], []
            for text in part["text"]:
                found: Counter = Counter()
                for word, n in Counter(words_of(text)).items():
                    padded = START * (ORDER - 1) + word + END
                    for i in range(len(word) + 1):
                        found[padded[i:i + ORDER]] += n
                grams.append(list(found))
                counts.append(list(found.values()))
            yield part.drop(columns="text").assign(grams=grams, counts=counts)


def _joined_entropies(documents: DataFrame, counts: DataFrame, langs: list[str]) -> DataFrame:
    """Like ``_entropies``, from models that stay tables."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = written(documents.withColumn("row", F.monotonically_increasing_id()).mapInPandas(
        _grams_of, f"doc_id {kind}, held_out boolean, lang string, row long, grams array<string>, counts array<long>"),
        "texts")
    pairs = texts.select("row", F.explode(F.arrays_zip("grams", "counts")).alias("pair")).select(
        "row", F.col("pair.grams").alias("gram"), F.col("pair.counts").alias("n"))
    values = gram_values(
        written(pairs.select("gram").distinct(), "texts-grams"), model_tables(counts, langs), len(langs))
    sums = [F.sum(F.col("value")[i] * F.col("n")) for i in range(len(langs))]
    entropies = salted_left_join(pairs, values, ["gram"]).groupBy("row").agg(
        F.array(*[-total / F.sum("n") for total in sums]).alias("entropy"))
    return texts.join(entropies, "row", "left").select("doc_id", "held_out", "lang", "entropy")


def _entropies(documents: DataFrame, models: Broadcast) -> DataFrame:
    name = uuid.uuid4().hex

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = kept(("language", name), lambda: Scorer(models.value))
        for batch in batches:
            out = []
            for first in range(0, len(batch), 500):
                out += scorer.entropies(batch["text"].iloc[first:first + 500])
            yield batch[["doc_id", "held_out", "lang"]].assign(entropy=out)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInPandas(
        scored, f"doc_id {kind}, held_out boolean, lang string, entropy array<double>")


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy and rejected of every row."""
    spark = documents.sparkSession
    rows = documents.select(
        "doc_id", (F.pmod(crc32_of_id(), F.lit(FOLDS)) == HELD_OUT).alias("held_out"), "lang", "text")
    counts = gram_counts(documents)
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not names:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    langs = F.array(*map(F.lit, names))
    if counts.count() <= SENT_GRAMS:
        found = _entropies(rows, spark.sparkContext.broadcast(train(counts)))
    else:
        found = _joined_entropies(rows, counts, names)
    entropies = written(found, "entropies")
    best = F.array_min("entropy")
    judged = entropies.withColumn("cross_entropy", best).withColumn(
        "lang_pred", F.when(F.col("entropy").isNull(), "und").otherwise(
            F.element_at(langs, F.array_position("entropy", F.col("cross_entropy")).cast("int")))
    ).withColumn("score", F.when(F.col("entropy").isNull(), 0.0).otherwise(
        1 / F.aggregate("entropy", F.lit(0.0), lambda s, h: s + F.exp(SHARPNESS * (F.col("cross_entropy") - h)))))
    usual = judged.filter("not held_out and lang = lang_pred").groupBy("lang_pred").agg(
        (F.avg("cross_entropy") + 4 * F.coalesce(F.stddev_pop("cross_entropy"), F.lit(0.0))).alias("limit"))
    return judged.join(F.broadcast(usual), "lang_pred", "left").select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy",
        F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(True)).alias("rejected"))


def digest(identified: DataFrame) -> DataFrame:
    return identified.select("doc_id", "held_out", "lang_pred", "score", "rejected")
