"""Parameters of the jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class BuildConfig:
    """Every job takes one of these; a run with the same inputs and config gives the same tables."""

    sample: bool = False
    start_date: date = date(1900, 1, 1)
    volume_from: date = date(2016, 1, 1)
    stockout_from: date = date(2016, 1, 1)
    lookback_days: int = 28
    min_expected_units: float = 3.0
    min_receipts_share: float = 0.5
    post_promo_days: int = 7
    opening_grace_days: int = 7
    sample_cities: tuple[str, ...] = ("Quito", "Guayaquil")
    sample_per_city: int = 3
    full_month_min_days: int = 25
    target_growth: Decimal = Decimal("0.03")
    false_discovery_rate: float = 0.05
    bootstrap_replicates: int = 200


def full_config() -> BuildConfig:
    return BuildConfig()


def sample_config() -> BuildConfig:
    """The busiest stores of the sample cities, from 2016 on."""
    return BuildConfig(sample=True, start_date=date(2016, 1, 1))
