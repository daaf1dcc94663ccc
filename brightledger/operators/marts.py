"""Statistical patterns and rollups over a fact table, generic in its roles.

The fact table has award_id, agency_id, supplier_id, award_date, award_year, contract_amount, reference_id; sums are doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightledger.config import DEFAULT, Settings
from brightledger.operators.joins import effective_join, range_join


def typed_amounts(seed: DataFrame) -> DataFrame:
    return seed.select(F.col("round_amount").cast("bigint").alias("round_amount"), "amount_kind", "note")


def typed_thresholds(seed: DataFrame) -> DataFrame:
    return seed.select("threshold", F.col("amount").cast("double").alias("amount"), F.to_date("effective_from").alias("effective_from"), F.to_date("effective_to").alias("effective_to"), "applies_to", "legal_basis", "source")


def bands(facts: DataFrame, amounts: DataFrame, width: Decimal = DEFAULT.band_width) -> DataFrame:
    """(award_id, agency_id, award_year, award_date, round_amount, is_under): awards within ``width`` of a round amount, both outer ends inclusive.

    An award exactly at the amount is under it. Bounds are exact decimals.
    """
    g = amounts.select("round_amount", (F.col("round_amount") * F.lit(1 - width)).cast("double").alias("lo"), (F.col("round_amount") * F.lit(1 + width)).cast("double").alias("hi"))
    cols = ["award_id", "agency_id", "award_year", "award_date", "contract_amount"]
    out = range_join(facts.select(*cols), g, F.col("contract_amount"), "lo", "hi")
    return out.select("award_id", "agency_id", "award_year", "award_date", "round_amount", (F.col("contract_amount") <= F.col("round_amount")).alias("is_under"))


def bunching_agency(banded: DataFrame, support: int = DEFAULT.band_support) -> DataFrame:
    """Awards under and over each amount by agency and year, and whether there are enough to speak of."""
    u = F.col("is_under")
    return banded.groupBy("agency_id", "award_year", "round_amount").agg(F.count_if(u).alias("awards_under"), F.count_if(~u).alias("awards_over"), (F.count(F.lit(1)) >= support).alias("enough_data"))


def bunching_national(by_agency: DataFrame, amounts: DataFrame, thresholds: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Sums over agencies, their ratio, whether a rule of that amount was in force in the year, and the ratio against the median one of amounts without a rule."""
    n = by_agency.groupBy("award_year", "round_amount").agg(F.sum("awards_under").alias("awards_under"), F.sum("awards_over").alias("awards_over"))
    n = n.withColumn("under_over_ratio", F.try_divide("awards_under", F.nullif("awards_over", F.lit(0)))).join(amounts.select("round_amount", "amount_kind"), "round_amount")
    rules = thresholds.select(F.col("amount").cast("bigint").alias("round_amount"), F.year("effective_from").alias("y0"), F.year(F.coalesce("effective_to", F.lit(cfg.snapshot_day))).alias("y1")).distinct()
    in_force = n.join(rules, (n.round_amount == rules.round_amount) & n.award_year.between(rules.y0, rules.y1), "left_semi").select("award_year", "round_amount").withColumn("in_force", F.lit(True))
    base = n.filter("amount_kind = 'placebo'").groupBy("award_year").agg(F.median("under_over_ratio").alias("placebo_ratio"))
    out = n.join(in_force, ["award_year", "round_amount"], "left").withColumn("in_force", F.coalesce("in_force", F.lit(False))).join(base, "award_year", "left")
    return out.select("award_year", "round_amount", "awards_under", "awards_over", "under_over_ratio", "amount_kind", "in_force", "placebo_ratio", F.try_divide("under_over_ratio", F.nullif("placebo_ratio", F.lit(0.0))).alias("excess_over_placebo"))


def change_monthly(facts: DataFrame, banded: DataFrame, amounts: tuple[int, int], years: tuple[int, ...]) -> DataFrame:
    """Awards by month from the year before the first of ``years``, and those under and over two amounts. An award counts once, also where bands overlap."""
    a, b = amounts
    first = min(years) - 1
    month = lambda: F.trunc("award_date", "month").alias("award_month")
    all_ = facts.filter(F.col("award_year") >= first).groupBy(month()).agg(F.count(F.lit(1)).alias("awards"))
    hit = lambda g, u: F.count_if((F.col("round_amount") == g) & (F.col("is_under") == u))
    some = banded.filter(F.col("round_amount").isin(a, b) & (F.col("award_year") >= first)).groupBy(month()).agg(hit(a, True).alias("under_a"), hit(a, False).alias("over_a"), hit(b, True).alias("under_b"), hit(b, False).alias("over_b"))
    out = all_.join(some.withColumnRenamed("award_month", "m"), F.col("award_month").eqNullSafe(F.col("m")), "left")
    return out.select("award_month", "awards", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("under_a", "over_a", "under_b", "over_b")])


def change_summary(monthly: DataFrame, years: tuple[int, ...], months: tuple[int, int]) -> DataFrame:
    """The same calendar months of ``years``, with ratios that are null where nothing is over."""
    m = monthly.filter(F.year("award_month").isin(*years) & F.month("award_month").between(*months))
    s = m.groupBy(F.year("award_month").alias("award_year")).agg(*[F.sum(c).alias(c) for c in ("awards", "under_a", "over_a", "under_b", "over_b")])
    return s.withColumn("ratio_a", F.try_divide("under_a", F.nullif("over_a", F.lit(0)))).withColumn("ratio_b", F.try_divide("under_b", F.nullif("over_b", F.lit(0))))


def same_day_groups(facts: DataFrame, thresholds: DataFrame, threshold: str, least: int) -> DataFrame:
    """Several notices of one agency to one supplier on a day, each within the ceiling in force that day and together above it.

    Rows of one reference are lots of one notice; rows without a reference are left out.
    """
    notices = facts.filter(F.col("reference_id").isNotNull()).groupBy("agency_id", "supplier_id", "award_date", "reference_id").agg(F.sum("contract_amount").alias("v"))
    days = notices.groupBy("agency_id", "supplier_id", "award_date").agg(F.count(F.lit(1)).alias("notices"), F.sum("v").alias("total_value"), F.max("v").alias("largest_notice")).filter(F.col("notices") >= least)
    ceilings = thresholds.filter(F.col("threshold") == threshold).select(F.col("amount").alias("ceiling"), "effective_from", "effective_to")
    out = effective_join(days, ceilings, "award_date", "effective_from", "effective_to").filter((F.col("largest_notice") <= F.col("ceiling")) & (F.col("total_value") > F.col("ceiling")))
    return out.select("agency_id", "supplier_id", "award_date", F.year("award_date").alias("award_year"), "notices", "total_value", "largest_notice", "ceiling")


def same_day_agency(groups: DataFrame) -> DataFrame:
    return groups.groupBy("agency_id", "award_year").agg(F.count(F.lit(1)).alias("groups"), F.sum("notices").alias("notices"), F.sum("total_value").alias("total_value"))


def same_day_yearly(groups: DataFrame) -> DataFrame:
    return groups.groupBy("award_year").agg(F.count(F.lit(1)).alias("groups"), F.sum("notices").alias("notices"), F.sum("total_value").alias("total_value"), F.countDistinct("agency_id").alias("agencies"))


def concentration(facts: DataFrame, support: int = DEFAULT.agency_year_support) -> DataFrame:
    """By agency and year: awards, suppliers, value, the largest supplier's share and the Herfindahl index of shares."""
    by = facts.groupBy("agency_id", "award_year", "supplier_id").agg(F.count(F.lit(1)).alias("n"), F.sum("contract_amount").alias("v"))
    # The window sees one row per supplier of an agency-year, not the awards.
    w = Window.partitionBy("agency_id", "award_year")
    s = by.withColumn("share", F.try_divide(F.col("v"), F.sum("v").over(w)))
    return s.groupBy("agency_id", "award_year").agg(
        F.sum("n").alias("awards"), F.count(F.lit(1)).alias("suppliers"), F.sum("v").alias("total_value"), F.max("share").alias("top_supplier_share"),
        F.sum(F.col("share") * F.col("share")).alias("herfindahl"), (F.sum("n") >= support).alias("enough_data"),
    )


def concentration_yearly(conc: DataFrame) -> DataFrame:
    """Quartiles of the largest share over agencies with enough data, and how many are above one half."""
    s = F.col("top_supplier_share")
    return conc.filter("enough_data").groupBy("award_year").agg(
        F.count(F.lit(1)).alias("agencies"), F.percentile(s, 0.25).alias("p25"), F.median(s).alias("median_share"), F.percentile(s, 0.75).alias("p75"), F.percentile(s, 0.9).alias("p90"), F.count_if(s > 0.5).alias("above_half")
    )


def yearly(facts: DataFrame) -> DataFrame:
    return facts.groupBy("award_year").agg(
        F.count(F.lit(1)).alias("awards"), F.sum("contract_amount").alias("total_value"), F.countDistinct("agency_id").alias("agencies"), F.countDistinct("supplier_id").alias("suppliers"),
        F.avg(F.col("reference_id").isNotNull().cast("int")).alias("share_with_reference_id"),
    )


def rollup(facts: DataFrame, *keys: str) -> DataFrame:
    """Awards and value by ``keys``."""
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("awards"), F.sum("contract_amount").alias("total_value"))


def by_area(facts: DataFrame, award_areas: DataFrame, *keys: str) -> DataFrame:
    """Awards and value by area and ``keys``; an award counts once in each of its areas, so areas add up to more than the whole."""
    return rollup(facts.join(award_areas.select("award_id", "area_name").distinct(), "award_id"), "area_name", *keys)
