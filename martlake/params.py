"""Run parameters, passed explicitly to every job (no environment lookups)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MartParams:
    # Product categories that get their own revenue column, and the column
    # name each one is written to (``<name>_revenue``).
    categories: tuple[str, ...] = ("ECONOMY", "STANDARD", "PROMO")
    # Unit cost as a share of list price (the test tables carry no cost).
    cost_ratio: str = "0.6"
    # Reference time for recency; a literal, never now() per task.
    as_of: str = "2001-08-02 00:00:00"
    active_days: int = 180
    at_risk_days: int = 540
    high_value_revenue: int = 2_000_000
    medium_value_revenue: int = 500_000


@dataclass(frozen=True)
class QualityParams:
    freshness_hours: float = 2.0
    reconcile_ratio: float = 0.05
    reconcile_floor: int = 10
    zscore_limit: float = 3.0
    trailing_days: int = 28


@dataclass(frozen=True)
class RunContext:
    """Identity of one run: used for batch ids, audit columns and marks."""
    pipeline: str = "martlake"
    run_id: str = "run-0"
    as_of: str = "2024-01-31 00:00:00"
    extra: dict = field(default_factory=dict)
