"""Data-quality checks: each counts violations, all come back in one table, and one failed error check blocks publication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.config import DEFAULT, Settings
from brightledger.operators.joins import differences, overlaps

Tables = dict[str, DataFrame]
#: Relative difference up to which sums of doubles count as equal.
TOLERANCE = 1e-9


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations"))


def _where(df: DataFrame, bad: Column) -> DataFrame:
    return df.agg(F.coalesce(F.count_if(bad), F.lit(0)).alias("violations"))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _added(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.agg(F.sum("violations").alias("violations"))


def _exact(c: str) -> Column:
    """Sum of doubles that does not depend on their order (to four decimals)."""
    return F.coalesce(F.sum(F.col(c).cast("decimal(38,4)")), F.lit(0).cast("decimal(38,4)")).cast("double")


def reconcile(raw: DataFrame, kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """Years in which raw rows are not kept plus rejected ones; a year missing on either side counts."""
    year = lambda df, n: df.groupBy(F.year("award_date").alias("y")).agg(F.count(F.lit(1)).alias(n))
    a = year(raw, "raw_rows")
    b = year(kept, "n").unionByName(year(rejected, "n")).groupBy("y").agg(F.sum("n").alias("done"))
    j = a.join(b.withColumnRenamed("y", "z"), F.col("y").eqNullSafe(F.col("z")), "full")
    return j.select(F.coalesce("y", "z").alias("award_year"), F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"), F.coalesce("done", F.lit(0)).alias("done_rows")).filter("raw_rows <> done_rows")


def yoy(df: DataFrame, first_year: int, before: int, ratio: tuple[float, float]) -> DataFrame:
    """Years whose value is out of ``ratio`` times the year's before. One row a year meets on one task."""
    from pyspark.sql import Window

    y = df.groupBy(F.year("award_date").alias("y")).agg(F.sum("contract_amount").alias("v"))
    r = y.withColumn("ratio", F.try_divide("v", F.nullif(F.lag("v").over(Window.orderBy(F.col("y").asc_nulls_last())), F.lit(0.0))))
    return r.filter((F.col("y") >= first_year) & (F.col("y") < before) & ((F.col("ratio") < ratio[0]) | (F.col("ratio") > ratio[1])))


def checks(cfg: Settings = DEFAULT) -> list[tuple[str, str, Callable[[Tables], DataFrame]]]:
    """(name, severity, count of violations from the tables)."""
    d, a = F.col("award_date"), F.col("contract_amount")

    def large(t: Tables) -> DataFrame:
        reviewed = t.get("large_amount_allowlist")
        big = t["staged"].filter(a > cfg.large_amount)
        return _count(big if reviewed is None else big.join(reviewed, "award_id", "left_anti"))

    def marts(t: Tables) -> DataFrame:
        core = t["facts"].agg(F.count(F.lit(1)).alias("n"), _exact("contract_amount").alias("v"))
        rolled = None
        for name in ("yearly", "agency_year", "concentration"):
            r = t[name].agg(F.sum("awards").alias("rn"), _exact("total_value").alias("rv"))
            rolled = r if rolled is None else rolled.unionByName(r)
        j = rolled.crossJoin(F.broadcast(core))  # one row
        return _where(j, ~F.coalesce("rn", F.lit(0)).eqNullSafe(F.col("n")) | (F.abs(F.col("rv") - F.col("v")) > TOLERANCE * F.greatest("v", F.lit(1.0))))

    def bunching(t: Tables) -> DataFrame:
        # Counted anew from the facts, by comparison with each amount's bounds, without the range join that the mart came from.
        up, down = float(1 + cfg.band_width), float(1 - cfg.band_width)
        each = [r.round_amount for r in t["analysis_amounts"].select("round_amount").distinct().collect()]  # a settings table
        hits = F.array(*[F.when((a >= g * down) & (a <= g * up), F.struct(F.lit(g).cast("bigint").alias("round_amount"), (a <= g).alias("under"))) for g in each])
        direct = t["facts"].select("award_year", F.inline(F.filter(hits, lambda x: x.isNotNull()))).groupBy("award_year", "round_amount").agg(F.count_if("under").alias("awards_under"), F.count_if(~F.col("under")).alias("awards_over"))
        return _count(differences(direct, t["bunching_national"], ["award_year", "round_amount"], ["awards_under", "awards_over"]))

    def same_value(t: Tables) -> DataFrame:
        s, c = t["staged"].agg(_exact("contract_amount").alias("s")), t["facts"].agg(_exact("contract_amount").alias("c"))
        return _where(s.crossJoin(F.broadcast(c)), F.abs(F.col("s") - F.col("c")) > TOLERANCE * F.greatest(F.col("s"), F.lit(1.0)))

    def complete(t: Tables) -> DataFrame:
        s, c = t["staged"].agg(F.count(F.lit(1)).alias("s")), t["facts"].agg(F.count(F.lit(1)).alias("c"))
        gap = s.crossJoin(F.broadcast(c)).select(F.abs(F.col("s") - F.col("c")).alias("violations"))
        return _added(gap, _where(t["facts"], F.col("agency_id").isNull() | F.col("supplier_id").isNull()), _count(repeated(t["facts"], "award_id")))

    def ids(t: Tables) -> DataFrame:
        shared = t["aliases"].groupBy("supplier_id").agg(F.countDistinct("match_key").alias("n")).filter("n > 1")
        return _added(_count(repeated(t["agencies"], "agency_id")), _count(shared))

    def amounts(t: Tables) -> DataFrame:
        g = t["analysis_amounts"]
        known = g.filter("amount_kind = 'threshold'").select(F.col("round_amount").cast("double").alias("amount")).distinct()
        few = g.agg((F.count_if(F.col("amount_kind") == "placebo") < 3).cast("bigint").alias("violations"))
        odd = _where(g, ~F.coalesce(F.col("amount_kind").isin("threshold", "placebo", "unexplained"), F.lit(True)))
        return _added(_count(t["thresholds"].join(known, "amount", "left_anti")), few, odd)

    share, hhi = F.col("top_supplier_share"), F.col("herfindahl")
    names = lambda t: t["agency_names"].select("key", "dropped").unionByName(t["supplier_names"].select("key", "dropped"))
    return [
        ("row_counts_reconcile", "error", lambda t: _count(reconcile(t["raw"], t["staged"], t["rejected"]))),
        ("award_id_unique", "error", lambda t: _count(repeated(t["staged"], "award_id"))),
        ("no_exact_duplicates", "error", lambda t: _count(repeated(t["staged"], "content_hash"))),
        ("award_date_in_range", "error", lambda t: _where(t["staged"], d.isNull() | (d < F.lit(cfg.first_day)) | (d > F.lit(cfg.snapshot_day)))),
        ("amount_in_range", "error", lambda t: _added(_where(t["staged"], a.isNull() | (a < cfg.least_amount)), large(t))),
        ("name_keys_are_ascii", "error", lambda t: _where(names(t), F.col("key").rlike(r"[^\x20-\x7E]"))),
        ("name_keys_are_lossless", "error", lambda t: _where(names(t), F.col("dropped") > 0)),
        ("names_present", "error", lambda t: _where(t["staged"], F.coalesce(F.col("agency_key") == "", F.lit(True)) | F.coalesce(F.col("supplier_key") == "", F.lit(True)))),
        ("area_tokens_known", "error", lambda t: _count(t["award_tokens"].filter(~F.col("is_known")).select("token").distinct())),
        ("yearly_value_within_tolerance", "error", lambda t: _count(yoy(t["staged"], cfg.yoy_first_year, cfg.snapshot_day.year, cfg.yoy_ratio))),
        ("core_awards_complete", "error", complete),
        ("entity_ids_unique", "error", ids),
        ("alias_maps_to_one_supplier", "error", lambda t: _count(repeated(t["aliases"], "supplier_raw"))),
        ("core_value_matches_staging", "error", same_value),
        ("thresholds_do_not_overlap", "error", lambda t: _count(overlaps(t["thresholds"], "threshold", "effective_from", "effective_to"))),
        ("marts_reconcile_to_core", "error", marts),
        ("bunching_counts_match_core", "error", bunching),
        ("concentration_shares_valid", "error", lambda t: _where(t["concentration"], (share <= 0) | (share > 1 + 1e-9) | (hhi <= 0) | (hhi > share + 1e-9))),
        ("same_day_groups_meet_definition", "error", lambda t: _where(t["same_day"], (F.col("notices") < cfg.day_notices) | (F.col("largest_notice") > F.col("ceiling")) | (F.col("total_value") <= F.col("ceiling")))),
        ("analysis_amounts_consistent", "error", amounts),
        ("raw_duplicate_value_share", "warn", lambda t: _where(t["duplicate_profile"], F.col("award_year").isNotNull() & (F.col("raw_value") > 0) & (F.col("duplicate_value") / F.nullif("raw_value", F.lit(0.0)) > cfg.duplicate_value_share))),
    ]


def run_checks(tables: Tables, cfg: Settings = DEFAULT) -> DataFrame:
    """(name, severity, violations, passed) of all checks, as one union."""
    out: DataFrame | None = None
    for name, severity, count in checks(cfg):
        row = count(tables).select(F.lit(name).alias("name"), F.lit(severity).alias("severity"), F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("passed", F.col("violations") == 0)


def publishable(results: DataFrame) -> bool:
    """Whether no check of severity error failed."""
    return results.filter("severity = 'error' AND NOT passed").limit(1).count() == 0
