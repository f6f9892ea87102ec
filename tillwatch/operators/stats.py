"""Batch counters and their running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.session import written

COUNTERS = ["total", "flagged", "geo_hits"]
# Batches in one block of a long ledger.
BLOCK = 4096


def batch_counters() -> list[Column]:
    """Total rows, flagged rows and rows where the geo rule fired."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_flagged").alias("flagged"),
        F.count_if(F.col("score_geo") > 0).alias("geo_hits"),
    ]


def batch_stats(scored: DataFrame) -> DataFrame:
    return scored.agg(*batch_counters())


def running_totals(ledger: DataFrame) -> DataFrame:
    """Cumulative counters of each query over its batches, in batch order.

    One pass: rows meet per query, sorted, and a running sum holds a single row at a time. A
    ledger has one row per micro-batch, so a query with a batch every ten seconds brings three
    million short rows a year.
    """
    if "query_id" not in ledger.columns:
        ledger = ledger.withColumn("query_id", F.lit(""))
    so_far = Window.partitionBy("query_id").orderBy("batch_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return ledger.select(
        "query_id", "batch_id", *COUNTERS,
        *[F.sum(c).over(so_far).alias(f"acc_{c}") for c in COUNTERS],
    )


def running_totals_in_blocks(ledger: DataFrame, block: int = BLOCK) -> DataFrame:
    """The same for ledgers of any length: no task receives a whole query.

    The ledger is written once. A query's batches are cut into blocks by number; each block's
    total is one row, the totals before it are its carry, and sums run inside the blocks. What meets
    per query is one row per ``block`` batches."""
    if "query_id" not in ledger.columns:
        ledger = ledger.withColumn("query_id", F.lit(""))
    ledger = written(ledger.select(
        "query_id", "batch_id", F.floor(F.col("batch_id") / block).alias("block"), *COUNTERS), "ledger")
    blocks = ledger.groupBy("query_id", "block").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    before = Window.partitionBy("query_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carries = blocks.select("query_id", "block", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"carry_{c}") for c in COUNTERS])
    so_far = Window.partitionBy("query_id", "block").orderBy("batch_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = ledger.select("query_id", "block", "batch_id", *COUNTERS, *[
        F.sum(c).over(so_far).alias(f"acc_{c}") for c in COUNTERS])
    return inside.join(carries, ["query_id", "block"]).select(
        "query_id", "batch_id", *COUNTERS,
        *[(F.col(f"acc_{c}") + F.col(f"carry_{c}")).alias(f"acc_{c}") for c in COUNTERS])
