"""Near duplicates by SimHash, joined by meet-in-the-middle ball hashing.

A fingerprint has a bit set where over half of the text's shingle hashes have it. Two fingerprints
within ``radius`` bits (an even number) share a variant within half the radius of both, so every
distinct fingerprint emits all its variants in that ball, rows are shuffled on the variants, and
what meets there is verified on the fingerprints themselves.

Texts are reduced to distinct fingerprints first, so a group of copies is one row whatever its
size, and a variant gathers at most as many fingerprints as its ball holds (65 for radius 2).
Any two fingerprints under one variant are at most the radius apart, so they all link, and each is
paired with the smallest of them alone. Pairs are made distinct, verified, and contracted to
components.

Defined results: words are separated by ASCII white space; A-Z are lower-cased; a text of fewer
words than a shingle has its whole sequence as the only one; null, empty and blank texts have
fingerprint zero, which links like any other; repeated rows are treated alike; a null doc_id gets
the component of its text, whose name is the smallest id that is not null; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import SMALL, release
from tillwatch.llm.components import components
from tillwatch.operators.joins import left_join_unique
from tillwatch.session import written

BITS = 64
WORDS = 3
SEED = 42
RADIUS = 2
# Shingles whose bits are counted at once.
CHUNK = 1 << 18


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = [0, *ends[:-words].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())),
        np.uint64, len(starts))


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The SimHash of each text, as signed 64-bit numbers."""
    values = texts.cast(pa.large_binary())
    counts, sizes = np.zeros((len(values), BITS), np.int64), np.zeros(len(values), np.int64)
    held: list[np.ndarray] = []
    rows: list[int] = []

    def count() -> None:
        flat = np.concatenate(held)
        first = np.cumsum([0, *map(len, held[:-1])])
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add.at(counts, rows, np.add.reduceat(bits, first, axis=0, dtype=np.int64))
        held.clear()
        rows.clear()

    size = 0
    for row in range(len(values)):
        hashes = shingle_hashes(values[row].as_py() or b"")
        sizes[row] = len(hashes)
        for at in range(0, len(hashes), CHUNK):
            held.append(hashes[at:at + CHUNK])
            rows.append(row)
            size += len(held[-1])
            if size >= CHUNK:
                count()
                size = 0
    if held:
        count()
    over = (2 * counts > sizes[:, None]).astype(np.uint8)
    return np.packbits(over, axis=1, bitorder="little").reshape(-1).view(np.int64)


def simhash(documents: DataFrame) -> DataFrame:
    """doc_id and ``bits`` (the fingerprint as a long) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fingerprints(batch.column("text")), pa.int64())],
                names=["doc_id", "bits"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(hashed, f"doc_id {kind}, bits long")


def ball(radius: int) -> list[int]:
    """The masks of at most ``radius`` bits, as signed numbers."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def linked(bits: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct pairs (a, b) of the distinct fingerprints in ``bits``, ``radius`` or fewer bits
    apart, that connect all which are."""
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius // 2)])
    variants = bits.select("bits", F.explode(F.transform(masks, lambda m: F.col("bits").bitwiseXOR(m))).alias("variant"))
    met = variants.withColumn("b", F.min("bits").over(Window.partitionBy("variant"))).filter(
        "bits > b").select(F.col("bits").alias("a"), "b")
    return met.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id that links
    of ``radius`` or fewer bits reach, of every row."""
    rows = written(simhash(documents), "fingerprints")
    distinct = written(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct")
    groups = written(components(linked(distinct.select("bits"), radius)), "groups")
    grouped = left_join_unique(distinct, groups.withColumnRenamed("node", "bits"), ["bits"], SMALL)
    grouped = written(grouped.withColumn("component", F.coalesce("component", "bits")), "grouped")
    least = written(grouped.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    named = written(left_join_unique(
        grouped.select("bits", "component"), least, ["component"], SMALL).select("bits", "component_id"), "named")
    return left_join_unique(rows, named, ["bits"], SMALL).select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), BITS // 4, "0").alias("fingerprint"), "component_id")
