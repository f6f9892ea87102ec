"""Customer and risk-profile columns for transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.config import DEFAULT_JOIN, JoinPolicy
from tillwatch.operators.joins import Size, latest_by_key, left_join_unique


def customer_dim(customers: DataFrame) -> DataFrame:
    """One row per customer with the columns scoring needs. Duplicates do not fan out:
    the row with the largest average (then plan) stays."""
    narrow = customers.select(
        "user_id", "plan", F.col("avg_amount_30d").cast("double").alias("avg_amount_30d")
    )
    return latest_by_key(narrow, ["user_id"], ["avg_amount_30d", "plan"])


def risk_dim(risk: DataFrame) -> DataFrame:
    """One row per user, the last updated: where the user was and when."""
    narrow = risk.select("user_id", "last_merchant_lat", "last_merchant_lon", "updated_at")
    return latest_by_key(
        narrow, ["user_id"], ["updated_at", "last_merchant_lat", "last_merchant_lon"]
    )


def fill_defaults(df: DataFrame) -> DataFrame:
    """Unknown customers get plan 'unknown' and average 0.0."""
    return df.withColumns({
        "plan": F.coalesce("plan", F.lit("unknown")),
        "avg_amount_30d": F.coalesce("avg_amount_30d", F.lit(0.0)),
    })


def enrich_customers(
    df: DataFrame, customers: DataFrame, policy: JoinPolicy = DEFAULT_JOIN,
    size: Size | None = None,
) -> DataFrame:
    """Left join to customers; rows without one are kept with NULLs."""
    return left_join_unique(df, customer_dim(customers), ["user_id"], policy, size)


def enrich_risk(
    df: DataFrame, risk: DataFrame, policy: JoinPolicy = DEFAULT_JOIN, size: Size | None = None
) -> DataFrame:
    """Left join to the last known location of the user."""
    return left_join_unique(df, risk_dim(risk), ["user_id"], policy, size)


def user_features(per_user: DataFrame, customers: DataFrame, risk: DataFrame) -> DataFrame:
    """Gather every per-user column next to ``per_user`` (one row per user), so that the
    transactions are joined once instead of once per table."""
    return (
        per_user.join(customer_dim(customers), "user_id", "left")
        .join(risk_dim(risk), "user_id", "left")
    )
