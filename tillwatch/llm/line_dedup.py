"""Removal of lines that many sites share.

Each line's sites are counted by a HyperLogLog sketch per line hash; sketches of one line are
merged by the aggregation, so a line in a third of all documents is a few bytes per task.
Lines whose estimate is within the sketch's error of the threshold get an exact distinct count.
Lines are split, compared and hashed once, into a written table that all steps read.
A line of at least ``MIN_SITES`` sites is boilerplate: its first occurrence (smallest doc_id,
then smallest text hash, then position) stays, all others are cut. Only DataFrame functions.

Defined results: lines are compared without the white space around them, and white space of any
kind and length inside them is one blank; lines of fewer than ``MIN_WORDS`` words and fewer than
``MIN_BYTES`` UTF-8 bytes are too short to tell and stay, as do empty ones (scripts without
blanks have few words but many bytes); a null site counts as no site; a null text has no lines and stays null; a null doc_id comes before all others; rows
with equal doc_id and text are treated alike; an empty table gives an empty one. Other columns
pass through, whatever their names, but for ``lines_before`` and ``lines_cut``, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import small, unused
from tillwatch.session import written

MIN_SITES = 5
MIN_WORDS = 3
MIN_BYTES = 24
# White space of every script but blank and line end, and marks of no width put between words.
_SPACE = (r"[\t\x0B\f\r\x1C-\x1F\x85\xA0\u1680\u2000-\u200B\u2028\u2029\u202F\u205F\u2060"
          r"\u3000\uFEFF]")
LG_K = 12
# Relative standard error of the sketch's estimate, and how many of them count as near.
ERROR = 1.06 / math.sqrt(2**LG_K)
NEAR = 4


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def _lines(documents: DataFrame, site: str) -> DataFrame:
    """Every line long enough to compare: its document, position, hash and site."""
    each = documents.select(
        F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash")).alias("doc"),
        F.col(site).alias("site"), F.posexplode(lines_of(F.regexp_replace("text", _SPACE, " "))).alias("at", "line"),
    ).withColumn("line", F.trim("line")).withColumn("line", F.when(
        F.contains("line", F.lit("  ")), F.regexp_replace("line", " +", " ")).otherwise(F.col("line")))
    long_enough = (F.octet_length("line") >= MIN_BYTES) | (F.size(F.split("line", " ")) >= MIN_WORDS)
    return each.filter(long_enough).select(
        "doc", "site", "at", F.unhex(F.md5("line")).alias("line_hash"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """line_hash and the first occurrence (document, position) of each boilerplate line."""
    margin = max(1, math.ceil(NEAR * ERROR * min_sites))
    suspects = written(
        lines.groupBy("line_hash").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"),
            F.min(F.struct("doc", "at")).alias("first"),
        ).filter(F.col("sites") >= min_sites - margin), "suspects")
    near = suspects.filter(F.col("sites") <= min_sites + margin)
    exact = lines.join(small(near.select("line_hash")), "line_hash", "left_semi").groupBy(
        "line_hash").agg(F.countDistinct("site").alias("exact"))
    return suspects.join(small(written(exact, "exact")), "line_hash", "left").filter(
        F.coalesce("exact", "sites") >= min_sites).select("line_hash", "first")


def removals(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Positions of the lines to cut, per document that has any."""
    lines = written(_lines(documents, site), "lines")
    shared = written(boilerplate(lines, min_sites), "boilerplate")
    return (
        lines.join(small(shared), "line_hash")
        .filter(~F.struct("doc", "at").eqNullSafe(F.col("first")))
        .groupBy("doc").agg(F.collect_set("at").alias("cut"))
    )


def cut_lines(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``documents`` with ``text`` freed from boilerplate, plus ``lines_before`` and
    ``lines_cut``."""
    doc_id, text_hash, cut = unused(documents, "_id", "_hash", "_cut")
    cuts = written(removals(documents, site, min_sites).select(
        F.col("doc.doc_id").alias(doc_id), F.col("doc.text_hash").alias(text_hash),
        F.col("cut").alias(cut)), "cut")
    columns = [documents[c] for c in documents.columns if c not in ("text", "lines_before", "lines_cut")]
    text, lines = documents["text"], lines_of(documents["text"])
    match = documents["doc_id"].eqNullSafe(F.col(doc_id)) & (F.xxhash64(text) == F.col(text_hash))
    kept = F.array_join(
        F.filter(lines, lambda line, i: ~F.array_contains(cut, i)), "\n")
    return documents.join(small(cuts), match, "left").select(
        *columns,
        F.when(F.col(cut).isNull(), text).otherwise(kept).alias("text"),
        F.greatest(F.coalesce(F.size(lines), F.lit(0)), F.lit(0)).alias("lines_before"),
        F.greatest(F.coalesce(F.size(cut), F.lit(0)), F.lit(0)).alias("lines_cut"))


def digest(cut: DataFrame) -> DataFrame:
    return cut.select(
        "doc_id", F.col("lines_before").cast("long").alias("n_lines"),
        F.col("lines_cut").cast("long").alias("n_cut"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


ORACLE = f"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents),
longer AS (
    SELECT doc_id, source, pos, trim(line) AS line FROM lines
    WHERE len(regexp_split_to_array(trim(line), ' +')) >= {MIN_WORDS}),
shared AS (
    SELECT line, min((doc_id, pos)) AS first FROM longer GROUP BY line
    HAVING count(DISTINCT source) >= {MIN_SITES}),
cut AS (
    SELECT doc_id, pos FROM longer JOIN shared USING (line) WHERE (doc_id, pos) <> first),
kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_cut,
           string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE c.pos IS NULL) AS text
    FROM lines l LEFT JOIN cut c ON c.doc_id = l.doc_id AND c.pos = l.pos GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_cut, length(coalesce(text, '')) AS n_chars,
       sha256(coalesce(text, '')) AS text_sha256
FROM kept
UNION ALL
SELECT doc_id, 0, 0, NULL, NULL FROM documents WHERE text IS NULL
"""
