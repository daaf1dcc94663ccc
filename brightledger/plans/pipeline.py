"""The whole batch: raw awards to staged and rejected ones, entities, facts, marts and checks. Lazy plans; shared tables are written once."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.config import DEFAULT, Settings
from brightledger.operators import checks, marts, resolve, serve, staging
from brightledger.session import table, written


class Marts:
    """Patterns and rollups of a fact table, each made when first asked for."""

    def __init__(self, facts: DataFrame, amounts: DataFrame, thresholds: DataFrame, cfg: Settings = DEFAULT):
        self.facts, self.amounts, self.thresholds, self.cfg = facts, amounts, thresholds, cfg

    @cached_property
    def bands(self) -> DataFrame:
        return marts.bands(self.facts, self.amounts, self.cfg.band_width)

    @cached_property
    def bunching_agency(self) -> DataFrame:
        return marts.bunching_agency(self.bands, self.cfg.band_support)

    @cached_property
    def bunching_national(self) -> DataFrame:
        return marts.bunching_national(self.bunching_agency, self.amounts, self.thresholds, self.cfg)

    @cached_property
    def change_monthly(self) -> DataFrame:
        return marts.change_monthly(self.facts, self.bands, self.cfg.change_amounts, self.cfg.change_years)

    @cached_property
    def change_summary(self) -> DataFrame:
        return marts.change_summary(self.change_monthly, self.cfg.change_years, self.cfg.change_months)

    @cached_property
    def same_day(self) -> DataFrame:
        return marts.same_day_groups(self.facts, self.thresholds, self.cfg.day_threshold, self.cfg.day_notices)

    @cached_property
    def same_day_agency(self) -> DataFrame:
        return marts.same_day_agency(self.same_day)

    @cached_property
    def concentration(self) -> DataFrame:
        return marts.concentration(self.facts, self.cfg.agency_year_support)

    @cached_property
    def yearly(self) -> DataFrame:
        return marts.yearly(self.facts)

    @cached_property
    def agency_year(self) -> DataFrame:
        return marts.rollup(self.facts, "agency_id", "award_year")


class Build:
    """All tables of a batch, each made when first asked for. ``keep`` writes those with several readers to the shared folder."""

    def __init__(self, raw: DataFrame, areas: DataFrame, amounts: DataFrame, thresholds: DataFrame, reviewed: DataFrame | None = None, cfg: Settings = DEFAULT, level: int = 3, keep: bool = True):
        self.source, self.areas, self.reviewed, self.cfg, self.level = raw, areas, reviewed, cfg, level
        self.amounts, self.thresholds = marts.typed_amounts(amounts), marts.typed_thresholds(thresholds)
        self._save: Callable[[DataFrame, str], DataFrame] = written if keep else lambda df, name: df

    @cached_property
    def raw(self) -> DataFrame:
        return staging.typed(self.source)

    @cached_property
    def agency_names(self) -> DataFrame:
        return self._save(resolve.fold_names(self.raw, "agency_raw"), "agency_names")

    @cached_property
    def supplier_names(self) -> DataFrame:
        return self._save(resolve.fold_names(self.raw, "supplier_raw"), "supplier_names")

    @cached_property
    def ruled(self) -> DataFrame:
        return self._save(staging.ruled(self.raw, self.agency_names, self.supplier_names, self.reviewed, self.cfg), "ruled")

    @cached_property
    def rejected(self) -> DataFrame:
        return staging.quarantine(self.ruled)[0]

    @cached_property
    def staged(self) -> DataFrame:
        return staging.quarantine(self.ruled)[1]

    @cached_property
    def award_tokens(self) -> DataFrame:
        return staging.exploded(self.staged, "award_id", "area_raw", self.areas)

    @cached_property
    def award_areas(self) -> DataFrame:
        return self.award_tokens.filter(F.col("area_name").isNotNull()).select("award_id", "area_name", "kind").distinct()

    @cached_property
    def duplicate_profile(self) -> DataFrame:
        return staging.duplicate_profile(self.ruled)

    @cached_property
    def matches(self) -> DataFrame:
        return resolve.resolve(self.supplier_names.select("key"), self.level)

    @cached_property
    def agencies(self) -> DataFrame:
        return self._save(resolve.agencies(self.staged), "agencies")

    @cached_property
    def aliases(self) -> DataFrame:
        return self._save(resolve.supplier_aliases(self.staged, self.matches), "aliases")

    @cached_property
    def suppliers(self) -> DataFrame:
        return resolve.suppliers(self.aliases)

    @cached_property
    def facts(self) -> DataFrame:
        return self._save(resolve.facts(self.staged, self.agencies, self.aliases), "facts")

    @cached_property
    def marts(self) -> Marts:
        return Marts(self.facts, self.amounts, self.thresholds, self.cfg)

    @cached_property
    def area_year(self) -> DataFrame:
        return marts.by_area(self.facts, self.award_areas, "award_year")

    @cached_property
    def area_agency(self) -> DataFrame:
        return marts.by_area(self.facts, self.award_areas, "agency_id")

    @cached_property
    def summary(self) -> DataFrame:
        return serve.run_summary(self.raw, self.staged, self.rejected, self.agency_names, self.supplier_names, self.agencies, self.suppliers, self.aliases, self.level)

    def tables(self) -> dict[str, DataFrame]:
        """All tables by name, as the checks, the warehouse and the export take them."""
        own = ("areas", "thresholds", "raw", "agency_names", "supplier_names", "ruled", "rejected", "staged", "award_tokens", "award_areas", "duplicate_profile", "matches", "agencies", "aliases", "suppliers", "facts", "area_year", "area_agency")
        of_facts = ("bands", "bunching_agency", "bunching_national", "change_monthly", "change_summary", "same_day", "same_day_agency", "concentration", "yearly", "agency_year")
        t = {n: getattr(self, n) for n in own} | {n: getattr(self.marts, n) for n in of_facts} | {"analysis_amounts": self.amounts}
        return t if self.reviewed is None else t | {"large_amount_allowlist": self.reviewed}


def build(raw: DataFrame, areas: DataFrame, amounts: DataFrame, thresholds: DataFrame, reviewed: DataFrame | None = None, cfg: Settings = DEFAULT, level: int = 3, keep: bool = True) -> dict[str, DataFrame]:
    """All tables by name; see ``Build``."""
    return Build(raw, areas, amounts, thresholds, reviewed, cfg, level, keep).tables()


class FolderBuild(Build):
    """A batch over the tables of a folder, each opened when first asked for; ``reviewed`` picks the reviewed large amounts from the typed awards."""

    def __init__(self, spark: SparkSession, folder: str, reviewed: Callable[[DataFrame], DataFrame] | None = None, cfg: Settings = DEFAULT, level: int = 3):
        self.cfg, self.level, self._save, self._pick = cfg, level, written, reviewed
        self._table = lambda name: table(spark, folder, name)

    @cached_property
    def source(self) -> DataFrame:
        return self._table("raw_awards")

    @cached_property
    def areas(self) -> DataFrame:
        return self._table("areas")

    @cached_property
    def amounts(self) -> DataFrame:
        return marts.typed_amounts(self._table("analysis_amounts"))

    @cached_property
    def thresholds(self) -> DataFrame:
        return marts.typed_thresholds(self._table("core_thresholds"))

    @cached_property
    def reviewed(self) -> DataFrame | None:
        return self._pick(self.raw) if self._pick else None


def report(b: Build, snapshot: str | None = None) -> dict:
    """The run's report: its measures, check results, and whether it may be published."""
    results = [r.asDict() for r in checks.run_checks(b.tables(), b.cfg).orderBy("name").collect()]
    measures = {r.measure: r.value for r in b.summary.orderBy("position", F.desc("value"), "measure").collect()}
    return {"snapshot_date": snapshot or b.cfg.snapshot_day.isoformat(), "summary": measures, "checks": results, "publishable": not any(r["severity"] == "error" and not r["passed"] for r in results)}
