"""The scoring rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwatch.config import DEFAULT_SCORING, ScoringConfig

# Points and reason name of each rule, in reporting order.
VELOCITY_POINTS = 40
ZSCORE_POINTS = 30
GEO_POINTS = 30
REASONS = [
    ("score_velocity", "HIGH_VELOCITY"),
    ("score_zscore", "AMOUNT_ANOMALY"),
    ("score_geo", "GEO_IMPOSSIBLE"),
]

# The spread of a customer's amounts is taken as this share of the average.
SPREAD_SHARE = 0.3


def amount_zscore(amount: Column, average: Column) -> Column:
    return F.when(average > 0, (amount - average) / (average * F.lit(SPREAD_SHARE))).otherwise(
        F.lit(0.0)
    )


def _points(condition: Column, points: int) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))


def score_velocity(velocity: Column, cfg: ScoringConfig = DEFAULT_SCORING) -> Column:
    return _points(velocity > cfg.velocity_threshold, VELOCITY_POINTS)


def score_zscore(zscore: Column, cfg: ScoringConfig = DEFAULT_SCORING) -> Column:
    return _points(zscore > cfg.zscore_threshold, ZSCORE_POINTS)


def score_geo(speed: Column, cfg: ScoringConfig = DEFAULT_SCORING) -> Column:
    return _points(speed > cfg.geo_kmh_threshold, GEO_POINTS)


def reasons() -> Column:
    """Comma list of the rules that fired, '' when none did."""
    return F.concat_ws(",", *[F.when(F.col(rule) > 0, F.lit(name)) for rule, name in REASONS])


def score_band(score: Column) -> Column:
    return (
        F.when(score >= 80, F.lit("critical")).when(score >= 60, F.lit("high"))
        .otherwise(F.lit("medium"))
    )
