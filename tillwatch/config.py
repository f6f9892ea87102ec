"""Settings: rule thresholds and the limits that decide how joins run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class ScoringConfig:
    """Thresholds of the three risk rules. The comparisons are strict (>) for the
    rules and inclusive (>=) for the flag."""

    velocity_threshold: int = 5
    zscore_threshold: float = 3.0
    geo_kmh_threshold: float = 500.0
    cutoff: int = 60
    velocity_seconds: int = 300
    idle_ms: int = 600_000

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> ScoringConfig:
        """Read the four tunable thresholds from environment-style settings."""
        env = os.environ if env is None else env
        base = cls()
        return cls(
            velocity_threshold=int(env.get("TILLWATCH_VELOCITY_THRESHOLD", base.velocity_threshold)),
            zscore_threshold=float(env.get("TILLWATCH_ZSCORE_THRESHOLD", base.zscore_threshold)),
            geo_kmh_threshold=float(env.get("TILLWATCH_GEO_KMH_THRESHOLD", base.geo_kmh_threshold)),
            cutoff=int(env.get("TILLWATCH_SCORE_CUTOFF", base.cutoff)),
        )


@dataclass(frozen=True)
class JoinPolicy:
    """How a fact table is joined to a table with one row per key.

    A side is broadcast only when its measured rows and bytes are both within the
    limits. Beyond them the join shuffles, and a key with at least ``hot_rows``
    facts is spread over ``ceil(rows / hot_rows)`` salts. At most ``hot_keys`` keys
    (the heaviest) are salted, which bounds the broadcast list of hot keys; the
    adaptive skew-join rule deals with whatever unevenness is left.
    """

    max_broadcast_rows: int = 1_000_000
    max_broadcast_bytes: int = 64 * 1024 * 1024
    hot_rows: int = 2_000_000
    hot_keys: int = 4096


DEFAULT_SCORING = ScoringConfig()
DEFAULT_JOIN = JoinPolicy()
