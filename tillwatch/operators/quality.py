"""Freshness and completeness checks, and the gate that lists their verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.operators.serving import recent

# Alert limits of the checks.
MAX_LAG_SECONDS = 600
MIN_PROFILES = 45


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def freshness(txns: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Whole seconds from the newest event to ``as_of``; NULL for an empty table."""
    newest = txns.agg(F.max("event_time").alias("newest"))
    return newest.select(
        F.timestamp_diff("SECOND", F.col("newest"), _now(as_of)).alias("lag_seconds")
    )


def recent_count(txns: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Rows that arrived in the last hour."""
    return recent(txns, "ingest_time", "1 HOUR", as_of).agg(
        F.count(F.lit(1)).alias("recent_rows")
    )


def profile_counts(profiles: DataFrame, as_of: Column | None = None) -> DataFrame:
    """All profiles, and those not refreshed on the day of ``as_of``, in one pass."""
    midnight = F.date_trunc("DAY", _now(as_of))
    return profiles.agg(
        F.count(F.lit(1)).alias("profiles"),
        F.count_if(F.col("updated_at") < midnight).alias("stale"),
    )


def _verdicts(counts: DataFrame, checks: list[tuple[str, str, int, Column]]) -> DataFrame:
    """One row per check from a single row of counts, which is evaluated once."""
    rows = [
        F.struct(
            F.lit(check).alias("check"), F.col(value).cast("long").alias("value"),
            F.lit(threshold).cast("long").alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )
        for check, value, threshold, passed in checks
    ]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def stream_checks(txns: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Hourly checks in one pass: the stream is fresh, and rows did arrive."""
    arrived = F.col("ingest_time") >= _now(as_of) - F.expr("INTERVAL 1 HOUR")
    counts = txns.agg(
        F.timestamp_diff("SECOND", F.max("event_time"), _now(as_of)).alias("lag_seconds"),
        F.count_if(arrived).alias("recent_rows"),
    )
    return _verdicts(counts, [
        ("freshness_lag", "lag_seconds", MAX_LAG_SECONDS, F.col("lag_seconds") <= MAX_LAG_SECONDS),
        ("recent_ingest_count", "recent_rows", 1, F.col("recent_rows") >= 1),
    ])


def profile_checks(
    profiles: DataFrame, as_of: Column | None = None, min_count: int = MIN_PROFILES
) -> DataFrame:
    """Daily checks in one pass: enough profiles, all of them refreshed today."""
    return _verdicts(profile_counts(profiles, as_of), [
        ("profile_min_count", "profiles", min_count, F.col("profiles") >= min_count),
        ("profile_stale_count", "stale", 0, F.col("stale") <= 0),
    ])


def quality_gate(checks: list[DataFrame]) -> DataFrame:
    """(check, value, threshold, passed) of all checks, one row each."""
    return reduce(DataFrame.unionByName, checks)


class QualityError(RuntimeError):
    """At least one check did not pass."""


def require(gate: DataFrame) -> None:
    """Raise when a check failed. The gate has one row per check, so it is small."""
    failed = [row.asDict() for row in gate.filter(~F.col("passed")).collect()]
    if failed:
        raise QualityError(f"checks failed: {failed}")
