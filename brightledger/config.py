"""Settings of the analyses, in one frozen record."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    """Fixed values of the analyses; a query passes its own where the data call for it."""

    first_day: dt.date = dt.date(2006, 1, 1)
    snapshot_day: dt.date = dt.date(2026, 1, 6)
    least_amount: float = 1.0
    large_amount: float = 1e10
    band_width: Decimal = Decimal("0.10")
    band_support: int = 30
    agency_year_support: int = 30
    day_notices: int = 3
    day_threshold: str = "small_purchase"
    change_years: tuple[int, ...] = (2024, 2025)
    change_months: tuple[int, int] = (3, 8)
    change_amounts: tuple[int, int] = (1_000_000, 2_000_000)
    focus_amount: int = 1_000_000
    yoy_first_year: int = 2014
    yoy_ratio: tuple[float, float] = (0.5, 1.75)
    duplicate_value_share: float = 0.10
    listed_awards: int = 100
    ranked: int = 50
    ranked_years: int = 8
    histogram_amounts: tuple[int, ...] = (1_000_000, 1_500_000)
    histogram_span: int = 20
    similarity_floor: float = 0.80
    bands: tuple[tuple[float, float], ...] = field(default=((0.80, 0.90), (0.90, 0.95), (0.95, 0.99), (0.99, 1.0001)))
    pairs_per_band: int = 75


DEFAULT = Settings()
OPEN_END = dt.date(9999, 12, 31)
