"""Keyed serving folders at rest: batch folders folded into one base.

A stream leaves a folder per micro-batch. ``fold`` merges the closed ones into a base that holds
the newest row of each key per arrival day and key bucket, and rewrites only the (day, bucket)
partitions that the batches touch. The base lies in ``_base``, which plain reads of the folder pass
over:

    _base/gen=12/arrival_date=.../bucket=...   what fold 12 has rewritten
    _base/manifest/000000000012                which generation each partition is in, and up
                                               to which number each query's batches are folded

A fold is published by its manifest alone, which is written last and of which each number can be
written once: a crashed fold leaves nothing visible, the slower of two folds at a time fails, and a
reader sees the batches either in the base or as folders, never in both. What a fold replaces
stays until the next one, for reads that have been planned on it.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators.joins import latest_by_key
from tillwatch.sources import files

BUCKETS = 16
KEEP = 2
_BATCH = re.compile(r"batch=(.+)-(\d+)$")


@dataclass
class Manifest:
    number: int = 0
    buckets: int = BUCKETS
    # "day/bucket" to the generation that holds it.
    parts: dict[str, int] = field(default_factory=dict)
    # Query to the number of its last folded batch.
    folded: dict[str, int] = field(default_factory=dict)

    def holds(self, query: str, number: int) -> bool:
        return number <= self.folded.get(query, -1)


def _manifests(spark: SparkSession, location: str) -> list[str]:
    """Published manifests, oldest first."""
    found = files.children(spark, f"{location}/_base/manifest")
    return sorted(f for f in found if files.exists(spark, f"{f}/_SUCCESS"))


def _load(spark: SparkSession, path: str) -> Manifest:
    return Manifest(**json.loads(spark.read.schema("value string").text(path).first()[0]))


def manifest(spark: SparkSession, location: str) -> Manifest:
    found = _manifests(spark, location)
    return _load(spark, found[-1]) if found else Manifest()


def _batches(spark: SparkSession, location: str) -> list[tuple[str, int, str]]:
    """(query, number, path) of the batch folders."""
    found = ((_BATCH.search(path), path) for path in files.children(spark, location))
    return [(m[1], int(m[2]), path) for m, path in found if m]


def _open_batches(spark: SparkSession, location: str, now: Manifest) -> list[tuple[str, int, str]]:
    return [b for b in _batches(spark, location) if not now.holds(b[0], b[1])]


def _read(
    spark: SparkSession, fmt: str, schema: T.StructType, base: str, paths: list[str], options: dict
) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).options(**options).option("basePath", base).schema(schema).load(paths)


def stored(
    spark: SparkSession, location: str, schema: T.StructType, since: date | None = None,
    fmt: str = "parquet", options: dict | None = None,
) -> DataFrame:
    """Base and newer batches as one table in the columns of ``schema``, which end with ``batch``
    and ``arrival_date``. Partitions of days before ``since`` are not listed."""
    now = manifest(spark, location)
    return _base_rows(spark, location, schema, now, since, fmt, options).unionByName(
        _batch_rows(spark, location, schema, _open_batches(spark, location, now), fmt, options, since))


def _base_rows(spark, location, schema, now, since, fmt, options, only=None) -> DataFrame:
    parts = now.parts if only is None else {p: now.parts[p] for p in only if p in now.parts}
    paths = [
        f"{location}/_base/gen={gen}/arrival_date={day}/bucket={bucket}"
        for part, gen in sorted(parts.items()) for day, bucket in [part.split("/")]
        if since is None or day >= since.isoformat()]
    rows = _read(spark, fmt, schema, f"{location}/_base", paths, options or {})
    return rows.select(*schema.fieldNames())


def _batch_rows(spark, location, schema, batches, fmt, options, since=None) -> DataFrame:
    paths = [path for _, _, path in batches]
    if since is not None:
        paths = [child for path in paths for day, child in _days_of(spark, path) if day >= since]
    return _read(spark, fmt, schema, location, paths, options or {}).select(*schema.fieldNames())


def _days_of(spark: SparkSession, batch: str) -> list[tuple[date, str]]:
    found = ((re.search(r"arrival_date=(\d{4}-\d{2}-\d{2})$", path), path) for path in files.children(spark, batch))
    return [(date.fromisoformat(m[1]), path) for m, path in found if m]


def days(spark: SparkSession, location: str) -> list[date]:
    """The days on which anything arrived, newest first."""
    now = manifest(spark, location)
    found = {date.fromisoformat(part.split("/")[0]) for part in now.parts}
    for _, _, path in _open_batches(spark, location, now):
        found.update(day for day, _ in _days_of(spark, path))
    return sorted(found, reverse=True)


def newest_first(arrival: str) -> list:
    """Last write wins: by arrival, then by the number of the micro-batch."""
    number = F.regexp_extract(F.col("batch"), r"-(\d+)$", 1).cast("long")
    return [arrival, number.desc_nulls_last(), "batch"]


def fold(
    spark: SparkSession, location: str, keys: list[str], arrival: str, schema: T.StructType,
    fmt: str = "parquet", options: dict | None = None, buckets: int = BUCKETS, ended: bool = False,
) -> int:
    """Fold the closed batches into the base; the number of partitions rewritten. A batch is closed
    once its query has written a later one, or with ``ended`` at once. The number of
    buckets is the one of the first fold."""
    published = _manifests(spark, location)
    now = _load(spark, published[-1]) if published else Manifest(buckets=buckets)
    if published:
        _clean(spark, location, published)
    open_ = _open_batches(spark, location, now)
    newest: dict[str, int] = {}
    for query, number, _ in open_:
        newest[query] = max(number, newest.get(query, -1))
    closed = [b for b in open_ if ended or b[1] < newest[b[0]]]
    if not closed:
        return 0
    bucket = F.pmod(F.xxhash64(*keys), F.lit(now.buckets)).cast("int")
    new = _batch_rows(spark, location, schema, closed, fmt, options)
    touched = [f"{r[0].isoformat()}/{r[1]}" for r in new.select(
        "arrival_date", bucket.alias("bucket")).distinct().collect()]
    old = _base_rows(spark, location, schema, now, None, fmt, options, touched)
    # Versions of a key that arrived on different days stay apart, so a row never has to be
    # looked for in the whole history; reads keep the newest.
    merged = latest_by_key(old.unionByName(new), [*keys, "arrival_date"], newest_first(arrival))
    number = now.number + 1
    merged.withColumn("bucket", bucket).hint("rebalance", "arrival_date", "bucket").write.format(fmt).options(
        **(options or {})).mode("overwrite").partitionBy("arrival_date", "bucket").save(
        f"{location}/_base/gen={number}")
    folded = now.folded | {
        query: max(n for q, n, _ in closed if q == query) for query in {q for q, _, _ in closed}}
    after = Manifest(number, now.buckets, now.parts | dict.fromkeys(touched, number), folded)
    spark.createDataFrame([(json.dumps(after.__dict__),)], "value string").coalesce(1).write.text(
        f"{location}/_base/manifest/{number:012d}")
    return len(touched)


def _clean(spark: SparkSession, location: str, published: list[str]) -> None:
    """Drop what none of the last ``KEEP`` manifests points to: folded batch folders, replaced
    partitions and older manifests."""
    kept = [_load(spark, path) for path in published[-KEEP:]]
    if len(published) >= KEEP:
        for query, number, path in _batches(spark, location):
            if kept[0].holds(query, number):
                files.delete(spark, path)
    used = {(gen, part) for m in kept for part, gen in m.parts.items()}
    for root in files.children(spark, f"{location}/_base"):
        if not (m := re.search(r"gen=(\d+)$", root)) or int(m[1]) > kept[-1].number:
            continue
        for day in files.children(spark, root):
            for path in files.children(spark, day) if "arrival_date=" in day else []:
                part = "/".join(p.split("=")[1] for p in path.rsplit("/", 2)[1:])
                if (int(m[1]), part) not in used:
                    files.delete(spark, path)
    for path in published[:-KEEP]:
        files.delete(spark, path)
