"""Per-user risk profiles and locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.joins import latest_by_key
from tillwatch.operators.serving import recent


def risk_profiles(txns: DataFrame, as_of: Column | None = None, days: int = 30) -> DataFrame:
    """Profile of each user over the last ``days`` days, full precision.

    ``avg_velocity_1h`` is the count over 24 and the location is the largest latitude
    and the largest longitude, whatever the span: those are the defined formulas.
    ``latest_per_user`` gives the location a user was really seen at.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    return recent(txns, "event_time", f"{days} DAYS", as_of).groupBy("user_id").agg(
        F.avg("amount").alias("avg_amount_30d"),
        F.stddev_pop("amount").alias("stddev_amount"),
        (F.count(F.lit(1)) / F.lit(24.0)).alias("avg_velocity_1h"),
        F.max("merchant_lat").alias("last_merchant_lat"),
        F.max("merchant_lon").alias("last_merchant_lon"),
    ).withColumn("updated_at", as_of)


def latest_per_user(txns: DataFrame) -> DataFrame:
    """The newest transaction of each user; message position breaks ties."""
    return latest_by_key(
        txns, ["user_id"], ["event_time", "k_partition", "k_offset"]
    )


def last_locations(txns: DataFrame) -> DataFrame:
    """(user_id, last_merchant_lat, last_merchant_lon, updated_at) from the newest row."""
    return latest_per_user(txns).select(
        "user_id",
        F.col("merchant_lat").alias("last_merchant_lat"),
        F.col("merchant_lon").alias("last_merchant_lon"),
        F.col("event_time").alias("updated_at"),
    )


def merge_profiles(profiles: DataFrame, locations: DataFrame) -> DataFrame:
    """Daily aggregates with the newer streaming location.

    The two column groups have their own writers, so a streamed location never wipes
    the aggregates of the daily build. A location counts when it is newer than the
    profile; users seen only in the stream have NULL aggregates.
    """
    moved = locations.select(
        "user_id",
        F.struct("last_merchant_lat", "last_merchant_lon", "updated_at").alias("_new"),
    )
    newer = F.col("_new").isNotNull() & (
        F.col("updated_at").isNull() | (F.col("_new.updated_at") > F.col("updated_at"))
    )
    return profiles.join(moved, "user_id", "full").select(
        "user_id", "avg_amount_30d", "stddev_amount", "avg_velocity_1h",
        *[
            F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in ("last_merchant_lat", "last_merchant_lon", "updated_at")
        ],
    )
