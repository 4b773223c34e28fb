"""Parameters of the rules and scores."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Defaults are the production values; times are in seconds."""

    dedup_ttl: int = 3600
    window: int = 600
    slide: int = 60
    lateness: int = 3600
    trigger: int = 60
    z_threshold: float = 3.0
    z_critical: float = 5.0
    min_repeats: int = 3
    #: Amounts are alike when equal to a multiple of this: cents.
    amount_step: str = "0.01"
    fallback_score: int = 25
    weight_anomaly: int = 15
    weight_velocity: int = 10
    weight_duplicate: int = 5
    excellent: int = 90
    good: int = 70
    moderate: int = 50
    history_days: int = 90
    short_rows: int = 7
    long_rows: int = 30
    as_of: dt.date = dt.date(2024, 1, 31)
