"""Rules, total score, flag and reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.config import DEFAULT_SCORING, ScoringConfig
from tillwatch.functions import geo, rules
from tillwatch.operators.enrich import fill_defaults, user_features
from tillwatch.operators.velocity import velocity_per_user


def with_geo_speed(df: DataFrame) -> DataFrame:
    """Speed from the last known location to this transaction; 0 without one."""
    distance = geo.haversine_km(
        F.col("last_merchant_lat"), F.col("last_merchant_lon"),
        F.col("merchant_lat"), F.col("merchant_lon"),
    )
    return df.withColumn(
        "geo_speed_kmh", geo.speed_kmh(distance, F.col("updated_at"), F.col("event_time"))
    )


def with_zscore(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "amount_zscore", rules.amount_zscore(F.col("amount"), F.col("avg_amount_30d"))
    )


def score(df: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING) -> DataFrame:
    """From the three features to points, total, flag and reasons."""
    return (
        df.withColumns({
            "score_velocity": rules.score_velocity(F.col("velocity_5min"), cfg),
            "score_zscore": rules.score_zscore(F.col("amount_zscore"), cfg),
            "score_geo": rules.score_geo(F.col("geo_speed_kmh"), cfg),
        })
        .withColumn("fraud_score", F.expr("score_velocity + score_zscore + score_geo"))
        .withColumns({
            "is_flagged": F.col("fraud_score") >= cfg.cutoff,
            "reasons": rules.reasons(),
        })
    )


def score_enriched(df: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING) -> DataFrame:
    """Score rows that carry velocity, customer and location columns."""
    return score(with_geo_speed(with_zscore(fill_defaults(df))), cfg)


def score_transactions(
    txns: DataFrame, customers: DataFrame, risk: DataFrame, cfg: ScoringConfig = DEFAULT_SCORING,
) -> DataFrame:
    """Batch scoring of validated transactions, all input as one batch.

    Velocity, customer and location are gathered per user first, so the wide rows are
    joined once. No job runs while the plan is built: adaptive execution picks broadcast or
    shuffle from the sizes it finds, and splits the partitions of hot users.
    """
    features = user_features(velocity_per_user(txns, cfg.velocity_seconds), customers, risk)
    return score_enriched(txns.join(features, "user_id", "left"), cfg)


def flagged(df: DataFrame) -> DataFrame:
    return df.filter("is_flagged")
