"""Insert-only merge and keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.joins import latest_by_key
from tillwatch.schemas import MESSAGE_KEY


def has_key(keys: list[str] = MESSAGE_KEY) -> Column:
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def new_rows(
    target: DataFrame, source: DataFrame, keys: list[str] = MESSAGE_KEY,
    order: list[str | Column] | None = None, small_source: bool = False,
) -> DataFrame:
    """Source rows the target does not hold yet, one per key.

    Copies of a key inside the source collapse to the first by ``order`` (arrival by
    default). Rows without a full key are left to ``unkeyed_rows``: a NULL key never
    matches and would be inserted again at each replay. With ``small_source``, for a
    source whose size the caller has checked, its keys are sent to the target, so that
    only the keys found there are moved instead of the target.
    """
    order = [F.col("ingest_time").asc(), F.col("transaction_id").asc()] if order is None else order
    firsts = latest_by_key(source.filter(has_key(keys)), keys, order)
    known = target.select(*keys)
    if small_source:
        known = known.join(F.broadcast(source.select(*keys)), keys, "left_semi")
    return firsts.join(known, keys, "left_anti").select(*source.columns)


def unkeyed_rows(source: DataFrame, keys: list[str] = MESSAGE_KEY) -> DataFrame:
    return source.filter(~has_key(keys))


def merge_insert(
    target: DataFrame, source: DataFrame, keys: list[str] = MESSAGE_KEY,
    order: list[str | Column] | None = None,
) -> DataFrame:
    """Content of the target after an insert-only merge of the source."""
    return target.unionByName(new_rows(target, source, keys, order))


def upsert(
    existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str | Column]
) -> DataFrame:
    """Content of a keyed table after the batch: the newest row of each key stays."""
    return latest_by_key(existing.unionByName(batch), keys, order)
