"""The documents that are published: small files made from the marts, behind the gate of the checks. None of them names a supplier."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.config import Settings
from brightledger.operators import marts, serve
from brightledger.plans.pipeline import Build
from brightledger.sources import io


class NotPublishable(Exception):
    """A check of severity error failed."""


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) if n else serve.whole(F.col(c)) for c, n in digits.items()})


def _settings(cfg: Settings, area: str) -> dict:
    return {
        "band_width": float(cfg.band_width), "band_support": cfg.band_support, "agency_year_support": cfg.agency_year_support, "day_notices": cfg.day_notices,
        "listed_awards": cfg.listed_awards, "focus_area": area,
    }


def documents(b: Build, report: dict, area: str, manifest: dict | None = None, matching: dict | None = None) -> dict[str, object]:
    """The twelve documents by name, each in a total order, so that a rerun gives the same bytes."""
    m, cfg = b.marts, b.cfg
    years = sorted(r.award_year for r in m.yearly.select("award_year").filter("award_year IS NOT NULL").collect())
    year = serve.last_complete_year(years, cfg.snapshot_day.year)
    named = b.agencies.select("agency_id", "agency_name", "agency_type")
    by_type = serve.bunching_by_type(m.bunching_agency, named, cfg.focus_amount)
    listing = serve.directory(b.agencies, b.area_agency, cfg.listed_awards).orderBy(F.desc("awards"), "agency_name", "agency_id")
    profile = serve.agency_profile(m.agency_year, m.concentration, m.bunching_agency, m.same_day_agency, b.agencies, cfg.focus_amount, cfg.listed_awards).orderBy("agency_id", "award_year")
    ranked = serve.pattern_rankings(m.concentration, m.bunching_agency, m.same_day_agency, named, cfg.focus_amount, cfg.ranked, cfg.ranked_years)
    patterns: dict[str, dict[str, list]] = {str(y): {p: [] for p in ("bunching", "same_day", "concentration")} for y in years[-cfg.ranked_years :]}
    for r in ranked.orderBy("award_year", "pattern", "place").collect():  # ranks, patterns and years bound its rows
        patterns[str(r.award_year)][r.pattern].append({k: v for k, v in r.asDict().items() if k not in ("pattern", "award_year", "place")})
    duplicates = b.duplicate_profile.filter("award_year IS NOT NULL").orderBy("award_year")
    return {
        "summary": {
            "snapshot_date": report["snapshot_date"], "source": (manifest or {}).get("source"), "revision": (manifest or {}).get("revision"), "counts": report["summary"], "checks": report["checks"],
            "publishable": report["publishable"], "matching": matching, "settings": _settings(cfg, area), "duplicates_by_year": _rounded(duplicates, raw_value=0, duplicate_value=0),
            "thresholds": b.thresholds.orderBy("threshold", "effective_from", "amount"), "amounts": b.amounts.orderBy("round_amount"),
        },
        "yearly": served_yearly(m.yearly).orderBy("award_year"),
        "bunching": served_bunching(m.bunching_national).orderBy("award_year", "round_amount"),
        "cliff": {"year": year, "span": cfg.histogram_span, "amounts": {str(a): serve.histogram(b.facts, a, cfg.histogram_span, year).select("step", "awards").orderBy("step") for a in cfg.histogram_amounts}},
        "bunching_by_type": by_type.orderBy("award_year", "agency_type"),
        "rule_change": {"monthly": m.change_monthly.orderBy("award_month"), "summary": m.change_summary.orderBy("award_year")},
        "same_day": _rounded(marts.same_day_yearly(m.same_day), total_value=0).orderBy("award_year"),
        "concentration": _rounded(marts.concentration_yearly(m.concentration), p25=4, median_share=4, p75=4, p90=4).orderBy("award_year"),
        "agencies": io.Columns(listing),
        "agency_years": io.Columns(profile),
        "patterns": patterns,
        "focus_area": {
            "area": area, "yearly": serve.focus_yearly(b.area_year, area).orderBy("award_year"), "agencies": serve.focus_agencies(b.area_agency, named, area, cfg.ranked).orderBy("place").drop("place"),
            "by_type": _rounded(serve.focus_types(b.area_agency, named, area).orderBy(F.desc_nulls_last("total_value"), "agency_type"), total_value=0),
        },
    }


def served_yearly(yearly: DataFrame) -> DataFrame:
    return _rounded(yearly, total_value=0, share_with_reference_id=4)


def served_bunching(national: DataFrame) -> DataFrame:
    out = national.select("award_year", "round_amount", "amount_kind", "in_force", "awards_under", "awards_over", F.col("under_over_ratio").alias("ratio"), "placebo_ratio", F.col("excess_over_placebo").alias("excess"))
    return _rounded(out, ratio=3, placebo_ratio=3, excess=3)


def publish(folder: str | Path, b: Build, report: dict, area: str, manifest: dict | None = None, matching: dict | None = None) -> dict[str, int]:
    """Writes the documents and returns their names and sizes; refuses where a check of severity error failed in ``report``."""
    if not report["publishable"]:
        raise NotPublishable(", ".join(c["name"] for c in report["checks"] if c["severity"] == "error" and not c["passed"]))
    return io.export_json(folder, documents(b, report, area, manifest, matching))
