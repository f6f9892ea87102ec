"""Dashboard queries. Every "now" is the ``as_of`` argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.rules import score_band

MAX_LIMIT = 1000


def recent(df: DataFrame, column: str, interval: str, as_of: Column | None = None) -> DataFrame:
    """Rows whose time is within ``interval`` before ``as_of``. The bare column stands
    on one side, so the filter reaches the file scan."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return df.filter(F.col(column) >= as_of - F.expr(f"INTERVAL {interval}"))


def _checked(n: int) -> int:
    if not 1 <= n <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    return n


def recent_fraud_scores(scores: DataFrame, n: int = 20) -> DataFrame:
    """The newest alerts, newest first."""
    return (
        scores.select("transaction_id", "user_id", "fraud_score", "reasons", "flagged_at")
        .orderBy(F.col("flagged_at").desc(), "transaction_id").limit(_checked(n))
    )


def dashboard_stats(txns: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Counters of the last hour by event time; an empty hour gives 0 and NULLs."""
    return recent(txns, "event_time", "1 HOUR", as_of).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.when(F.col("is_flagged"), 1).otherwise(0)).alias("flagged_count"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        F.max("ingest_time").alias("last_ingest"),
    )


def with_flag_rate(stats: DataFrame) -> DataFrame:
    """Flagged share in percent with one decimal, NULL without transactions."""
    share = F.try_divide(F.col("flagged_count"), F.col("total_transactions"))
    return stats.withColumn("flag_rate", F.round(share * 100, 1))


def stat_cards(stats: DataFrame) -> DataFrame:
    """The four headline figures as text, an em dash where there is none."""
    dash = F.lit("—")
    one_decimal = F.format_string("%.1f", F.col("avg_fraud_score"))
    percent = F.format_string("%.1f%%", F.col("flag_rate"))
    return with_flag_rate(stats).select(
        F.col("total_transactions").cast("string").alias("total_transactions"),
        F.coalesce(F.col("flagged_count").cast("string"), dash).alias("flagged_count"),
        F.when(F.col("avg_fraud_score").isNull(), dash).otherwise(one_decimal)
        .alias("avg_fraud_score"),
        F.when(F.col("flag_rate").isNull(), dash).otherwise(percent).alias("flag_rate"),
    )


def top_risky_users(scores: DataFrame, as_of: Column | None = None, n: int = 10) -> DataFrame:
    """Users with most alerts in the last 24 hours; user id breaks ties."""
    return (
        recent(scores, "flagged_at", "24 HOURS", as_of).groupBy("user_id").agg(
            F.count(F.lit(1)).alias("flagged_count"), F.max("fraud_score").alias("max_score")
        )
        .orderBy(F.col("flagged_count").desc(), "user_id").limit(_checked(n))
    )


def scores_timeline(recent_scores: DataFrame, threshold: int = 60) -> DataFrame:
    """The recent alerts oldest first, as chart points with the threshold line."""
    return recent_scores.orderBy("flagged_at", F.col("transaction_id").desc()).select(
        F.date_format("flagged_at", "HH:mm:ss").alias("time"),
        F.col("fraud_score").alias("score"),
        F.col("user_id").alias("user"),
        F.lit(threshold).alias("threshold"),
    )


def present_alerts(scores: DataFrame) -> DataFrame:
    """Display columns of an alert: short id, both time formats and the score band."""
    return scores.select(
        "*",
        F.substring("transaction_id", 1, 8).alias("short_id"),
        F.date_format("flagged_at", "yyyy-MM-dd HH:mm:ss").alias("display_time"),
        F.date_format("flagged_at", "HH:mm:ss").alias("chart_time"),
        score_band(F.col("fraud_score")).alias("band"),
    )
