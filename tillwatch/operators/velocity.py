"""Transactions per user within a time span, as batch operators.

No window runs over the rows of a user: times are counted before any shuffle, and running
sums go over counted times, cut into slots so that a user spreads over many tasks. Joins are
left to adaptive execution, which knows the sizes at run time and splits hot partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
# Slots that a span is cut into.
SLOTS_PER_SPAN = 8


def velocity_per_user(txns: DataFrame, seconds: int) -> DataFrame:
    """(user_id, velocity_5min): rows of each user no older than ``seconds`` before the
    user's newest event, both ends included. Two aggregates that combine map-side, over two
    columns."""
    newest = txns.groupBy("user_id").agg(F.max("event_time").alias("_newest"))
    start = F.col("_newest") - F.expr(f"INTERVAL {seconds} SECONDS")
    return (
        txns.select("user_id", "event_time").join(newest, "user_id")
        .filter(F.col("event_time") >= start)
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("velocity_5min"))
    )


def velocity_snapshot(txns: DataFrame, seconds: int = 300) -> DataFrame:
    """The streaming rule with all input as one batch: the user's count is stamped on
    every row of the user."""
    return txns.join(velocity_per_user(txns, seconds), "user_id", "left")


def velocity_trailing(txns: DataFrame, seconds: int = 300) -> DataFrame:
    """Per row, the user's transactions from ``seconds`` before it up to it.

    An event adds one at its time and takes it away just after it has left the span, so the
    trailing count is a running sum, linear in the events. The sum runs inside slots of time;
    what a user carries into a slot is the running sum of one row per earlier slot.
    """
    span = seconds * MICROS
    slot = max(span // SLOTS_PER_SPAN, MICROS)
    counted = txns.groupBy("user_id", F.unix_micros("event_time").alias("_t")).agg(
        F.count(F.lit(1)).alias("_n")).filter("user_id IS NOT NULL AND _t IS NOT NULL")
    changes = counted.select("user_id", F.explode(F.expr(
        f"array(struct(_t AS at, _n AS n, true AS event),"
        f" struct(_t + {span + 1} AS at, -_n AS n, false AS event))")).alias("c"))
    at_time = changes.groupBy("user_id", F.col("c.at").alias("_t")).agg(
        F.sum("c.n").alias("_n"), F.max("c.event").alias("_event")
    ).withColumn("_slot", F.expr(f"_t div {slot}"))
    in_slot = Window.partitionBy("user_id", "_slot").orderBy("_t").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("user_id").orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = at_time.groupBy("user_id", "_slot").agg(F.sum("_n").alias("_n")).select(
        "user_id", "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carried"))
    per_time = (
        at_time.withColumn("_sum", F.sum("_n").over(in_slot)).filter("_event")
        .join(carried, ["user_id", "_slot"])
        .select("user_id", F.timestamp_micros("_t").alias("event_time"),
                (F.col("_sum") + F.col("_carried")).alias("velocity_5min"))
    )
    return txns.join(per_time, ["user_id", "event_time"], "left")
