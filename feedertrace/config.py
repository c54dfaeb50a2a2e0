"""Constants of the topology engine."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    window_days: int = 60
    intervals_per_day: int = 96
    radius_m: float = 175.0
    min_correlation: float = 0.96
    min_overlap: int = 4000
    min_daily_overlap: int = 60
    top_k: int = 5
    recent_days: int = 7
    max_offset_m: float = 100.0
    min_gap: float = 0.5
    min_mapped: int = 4
    min_peer_stability: float = 0.7
    min_recommendation_stability: float = 0.7
    ledger_values: int = 60

    @property
    def signature_length(self) -> int:
        return self.window_days * self.intervals_per_day


DEFAULT = Config()
EARTH_RADIUS_M = 6_371_000.0
