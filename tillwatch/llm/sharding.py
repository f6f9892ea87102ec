"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

A group is all rows of one text. A group above 1/64 of a shard's bytes is split by row into
pieces, so that copies that make up a third of the table still spread evenly. Each piece is
placed on the shard where the dot product of its size vector with the residual capacity is
highest, largest pieces first. Pieces above 1/4096 of a shard in any dimension (at most
``3 * shards * LARGE`` of them, by their definition) are packed first, together; the others
are packed in blocks of bounded size, each against its share of the capacity that is left, so
the work spreads over tasks however many groups there are.

Rows of a shard are numbered without gaps: counts per (shard, chunk) give each chunk its
offset, and rows are numbered inside their chunk, so no shard meets in one task.

Defined results: ``size`` is the UTF-8 bytes of the text plus 1, and 1 for null; null texts
are one group, empty ones another; tokens are the words between white space; repeated rows
count one by one; a null ``doc_id`` is a row like any other; an empty table gives an empty one;
further columns are ignored. The law is ``bytes``, and sizes differ by far less than 1 %.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import small
from tillwatch.session import written

SHARDS = 8
PIECES = 64
LARGE = 4096
BLOCK_PIECES = 50_000
CHUNK_ROWS = 20_000
DIMENSIONS = ["bytes", "tokens", "rows"]


def pack(sizes: np.ndarray, capacity: np.ndarray, first: int = 0) -> np.ndarray:
    """The shard of each size vector (n x 3) for residual capacities (shards x 3). Ties go
    to the shard that comes first when counting from ``first``."""
    scale = np.maximum(capacity.sum(axis=0), 1.0)
    wanted, left = sizes / scale, np.roll(capacity / scale, -first, axis=0)
    out = np.empty(len(sizes), np.int64)
    for i in np.argsort(-wanted.max(axis=1), kind="stable"):
        best = int((left @ wanted[i]).argmax())
        left[best] -= wanted[i]
        out[i] = best
    return (out + first) % len(capacity)


def measured(documents: DataFrame) -> DataFrame:
    """One narrow row per row: id, sizes and the group's name; as a written table."""
    text = F.coalesce("text", F.lit(""))
    return written(documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.size(F.array_remove(F.split(text, r"\s+"), "")).cast("long").alias("tokens"),
        F.coalesce(F.md5("text"), F.lit("")).alias("group"),
        F.monotonically_increasing_id().alias("row")), "measured")


def _pieces(rows: DataFrame, shards: int, total: int) -> DataFrame:
    """``rows`` with ``piece``, which tells apart the parts of a split group. Less than
    ``shards * PIECES`` groups can be split."""
    most = math.ceil(total / (shards * PIECES))
    split = rows.groupBy("group").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).filter(
        (F.col("b") > most) & (F.col("n") > 1)
    ).select("group", F.ceil(F.col("b") / F.lit(most)).alias("parts"))
    return rows.join(F.broadcast(split), "group", "left").withColumn(
        "piece", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")


def place(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``measured`` with their ``shard``."""
    rows = measured(documents)
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    total = np.array([float(x or 0) for x in total])
    cut = _pieces(rows, shards, int(total[0]) or 1)
    sizes = written(cut.groupBy("group", "piece").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")),
        "pieces")
    large = " OR ".join(f"{d} * {shards * LARGE}D >= {t}D" for d, t in zip(DIMENSIONS, total))
    equal = np.tile(total / shards, (shards, 1))

    def pack_large(given: pd.DataFrame) -> pd.DataFrame:
        given = given.sort_values(["group", "piece"], ignore_index=True)
        given["shard"] = pack(given[DIMENSIONS].to_numpy(np.float64), equal)
        return given.drop(columns="block")

    schema = "group string, piece int, bytes long, tokens long, rows long, shard int"
    head = written(sizes.filter(large).withColumn("block", F.lit(0)).groupBy("block").applyInPandas(pack_large, schema), "large")
    taken = np.zeros((shards, 3))
    for row in head.groupBy("shard").agg(*(F.sum(d) for d in DIMENSIONS)).collect():
        taken[row[0]] = row[1:]
    room = np.maximum(equal - taken, 0.0)
    share = room / np.maximum(room.sum(axis=0), 1.0)

    def pack_block(given: pd.DataFrame) -> pd.DataFrame:
        given = given.sort_values(["group", "piece"], ignore_index=True)
        vectors = given[DIMENSIONS].to_numpy(np.float64)
        given["shard"] = pack(vectors, share * vectors.sum(axis=0), int(given["block"].iloc[0]) % shards)
        return given.drop(columns="block")

    rest = sizes.filter(f"NOT ({large})")
    blocks = math.ceil(rest.count() / BLOCK_PIECES) or 1
    tail = rest.withColumn("block", F.pmod(F.xxhash64("group", "piece"), F.lit(blocks))).groupBy(
        "block").applyInPandas(pack_block, schema)
    placed = head.unionByName(tail).select("group", "piece", "shard")
    return cut.join(placed, ["group", "piece"])


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    rows = written(place(documents, shards).select("doc_id", "size", "text_crc32", "shard", "row"), "placed")
    chunks = math.ceil(rows.count() / (shards * CHUNK_ROWS)) or 1
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n")), "chunks").withColumn(
        "offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "chunk").orderBy("row")
    return rows.withColumn("at", F.row_number().over(inside) - 1).join(
        small(offsets), ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("at")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
