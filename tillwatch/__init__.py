"""Payment-risk analytics on Spark: every operator is a DataFrame function that
batch jobs and streaming queries share."""

from tillwatch.config import JoinPolicy, ScoringConfig

__all__ = ["JoinPolicy", "ScoringConfig"]
