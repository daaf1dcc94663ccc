"""Small result tables for serving: histograms, profiles, rankings, directories, searches, run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """``value`` without decimals. Hundredths are rounded first, so that a half does not fall by the order in which it was summed."""
    return F.round(F.round(value, 2))


def histogram(facts: DataFrame, amount: int, span: int, year: int | None = None) -> DataFrame:
    """(amount, step, awards): awards in 1 % steps around ``amount``, each step open below and closed above, from -span to span - 1 without gaps.

    ``year`` None takes all years.
    """
    a = F.col("contract_amount")
    lo, hi = amount * (100 - span) / 100, amount * (100 + span) / 100
    f = facts if year is None else facts.filter(F.col("award_year") == year)
    n = f.filter((a > lo) & (a <= hi)).groupBy((F.ceil((a - amount) / (amount / 100.0)).cast("int") - 1).alias("step")).agg(F.count(F.lit(1)).alias("awards"))
    steps = facts.sparkSession.range(-span, span).select(F.col("id").cast("int").alias("step"))
    return steps.join(n, "step", "left").select(F.lit(amount).cast("bigint").alias("amount"), "step", F.coalesce("awards", F.lit(0).cast("bigint")).alias("awards"))


def last_complete_year(years: list[int], snapshot_year: int) -> int | None:
    """The latest year before the one that precedes the snapshot's; of none such, the latest."""
    done = [y for y in years if y < snapshot_year - 1] or years
    return max(done) if done else None


def agency_profile(agency_year: DataFrame, conc: DataFrame, bunching: DataFrame, same_day: DataFrame, agencies: DataFrame, amount: int, least: int) -> DataFrame:
    """One row per agency and year with its patterns side by side, zero where there is none; agencies of ``least`` awards or more."""
    big = agencies.filter(F.col("award_count") >= least).select("agency_id")
    b = bunching.filter(F.col("round_amount") == amount).select("agency_id", "award_year", F.col("awards_under").alias("under"), F.col("awards_over").alias("over"))
    s = same_day.select("agency_id", "award_year", "groups", F.col("total_value").alias("day_value"))
    k = ["agency_id", "award_year"]
    out = agency_year.join(big, "agency_id").join(conc.select(*k, "top_supplier_share", "herfindahl", "suppliers"), k).join(b, k, "left").join(s, k, "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return out.select(
        *k, "awards", whole(F.col("total_value")).alias("total_value"), F.round("top_supplier_share", 4).alias("top_supplier_share"), F.round("herfindahl", 4).alias("herfindahl"), "suppliers",
        zero("under").alias("under"), zero("over").alias("over"), zero("groups").alias("same_day_groups"), whole(F.coalesce("day_value", F.lit(0.0))).alias("same_day_value"),
    )


def rank_by(df: DataFrame, parts: list[str], measure: Column, ties: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each part by falling ``measure``, ties in order of ``ties``; with their ``place``."""
    w = Window.partitionBy(*parts).orderBy(measure.desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def pattern_rankings(conc: DataFrame, bunching: DataFrame, same_day: DataFrame, agencies: DataFrame, amount: int, most: int, years: int) -> DataFrame:
    """Each pattern's top agencies of each of the latest ``years`` years, with all patterns side by side.

    (pattern, award_year, place, agency_id, agency_name, agency_type, awards, total_value, under, over, same_day_groups, same_day_value,
    top_supplier_share, suppliers); the order is by the exact measure, then by the agency's name and id, and only what is shown is rounded.
    """
    k = ["agency_id", "award_year"]
    latest = conc.select("award_year").distinct().filter(F.col("award_year").isNotNull()).orderBy(F.desc("award_year")).limit(years)
    b = bunching.filter(F.col("round_amount") == amount).select(*k, F.col("awards_under").alias("under"), F.col("awards_over").alias("over"), F.col("enough_data").alias("banded"))
    s = same_day.select(*k, F.col("groups"), F.col("total_value").alias("day_value"))
    rows = conc.join(F.broadcast(latest), "award_year", "left_semi").join(agencies.select("agency_id", "agency_name", "agency_type"), "agency_id").join(b, k, "left").join(s, k, "left")
    measure = lambda name, c, hit: F.when(hit, F.struct(F.lit(name).alias("pattern"), F.col(c).cast("double").alias("measure")))
    each = F.array(measure("bunching", "under", F.col("banded")), measure("same_day", "groups", F.col("groups") > 0), measure("concentration", "top_supplier_share", F.col("enough_data")))
    ranked = rank_by(rows.select("*", F.inline(F.filter(each, lambda x: x.isNotNull()))), ["pattern", "award_year"], F.col("measure"), ["agency_name", "agency_id"], most)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    return ranked.select(
        "pattern", "award_year", "place", "agency_id", "agency_name", "agency_type", "awards", whole(F.col("total_value")).alias("total_value"), zero("under").alias("under"), zero("over").alias("over"),
        zero("groups").alias("same_day_groups"), whole(F.coalesce("day_value", F.lit(0.0))).alias("same_day_value"), F.round("top_supplier_share", 4).alias("top_supplier_share"), "suppliers",
    )


def focus_yearly(area_year: DataFrame, area: str) -> DataFrame:
    return area_year.filter(F.col("area_name") == area).select("award_year", "awards", whole(F.col("total_value")).alias("total_value"))


def focus_agencies(area_agency: DataFrame, agencies: DataFrame, area: str, most: int) -> DataFrame:
    """The area's ``most`` agencies by exact value, ties by name and id, with their ``place``."""
    rows = area_agency.filter(F.col("area_name") == area).join(agencies.select("agency_id", "agency_name", "agency_type"), "agency_id")
    top = rows.orderBy(F.desc_nulls_last("total_value"), "agency_name", "agency_id").limit(most)
    w = Window.orderBy(F.desc_nulls_last("total_value"), "agency_name", "agency_id")  # of ``most`` rows
    return top.select(F.row_number().over(w).alias("place"), "agency_id", "agency_name", "agency_type", "awards", whole(F.col("total_value")).alias("total_value"))


def focus_types(area_agency: DataFrame, agencies: DataFrame, area: str) -> DataFrame:
    return by_kind(area_agency.filter(F.col("area_name") == area), agencies, "agency_id", "agency_type", [], ["awards", "total_value"])


def bunching_by_type(bunching: DataFrame, agencies: DataFrame, amount: int) -> DataFrame:
    return by_kind(bunching.filter(F.col("round_amount") == amount), agencies, "agency_id", "agency_type", ["award_year"], ["awards_under", "awards_over"])


def month_ratios(monthly: DataFrame, first_month: str, least: int) -> DataFrame:
    """(award_month, ratio_a, ratio_b): awards under to over both amounts, of months from ``first_month`` on with ``least`` awards over the second."""
    m = monthly.filter((F.col("award_month") >= F.to_date(F.lit(first_month))) & (F.col("over_b") >= least))
    return m.select("award_month", F.try_divide("under_a", "over_a").alias("ratio_a"), F.try_divide("under_b", "over_b").alias("ratio_b"))


def type_ratios(by_type: DataFrame, year: int) -> DataFrame:
    """(agency_type, awards_under, awards_over, ratio) of one year, of types with awards over the amount."""
    t = by_type.filter((F.col("award_year") == year) & (F.col("awards_over") > 0))
    return t.select("agency_type", "awards_under", "awards_over", (F.col("awards_under") / F.col("awards_over")).alias("ratio"))


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """The rows of one key; the filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def main_value(df: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """(key, value): for each key the value of the greatest weight, ties in order."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(-F.col(weight), F.col(value))).alias(value))


def directory(agencies: DataFrame, area_agency: DataFrame, least: int) -> DataFrame:
    """Agencies of ``least`` awards or more with their first and last year and main area (null if none)."""
    main = main_value(area_agency, "agency_id", "area_name", "awards").withColumnRenamed("area_name", "main_area")
    big = agencies.filter(F.col("award_count") >= least)
    return big.join(main, "agency_id", "left").select(
        "agency_id", "agency_name", "agency_type", F.col("award_count").alias("awards"), whole(F.col("total_value")).alias("total_value"), F.year("first_award_date").alias("first_year"), F.year("last_award_date").alias("last_year"), "main_area"
    )


def by_kind(rows: DataFrame, kinds: DataFrame, key: str, kind: str, also: list[str], sums: list[str]) -> DataFrame:
    """Sums of ``sums`` by ``also`` and the kind of ``key``."""
    return rows.join(kinds.select(key, kind), key).groupBy(*also, kind).agg(*[F.sum(s).alias(s) for s in sums])


def search(df: DataFrame, column: str, text: str, kind: str | None = None, kind_column: str | None = None, most: int = 200) -> DataFrame:
    """Rows whose ``column`` holds every word of ``text`` in any letter case (and whose kind is ``kind``), the first ``most`` in order."""
    hit = F.lit(True)
    for w in text.split():
        hit = hit & F.upper(column).contains(w.upper())
    if kind is not None and kind_column:
        hit = hit & (F.col(kind_column) == kind)
    return df.filter(hit).orderBy(*[column, *[c for c in df.columns if c != column]]).limit(most)


def unpacked_arrays(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of objects from one row of column arrays."""
    return df.select(F.explode(F.arrays_zip(*columns)).alias("x")).select("x.*")


def suppressed(share: Column, awards: Column, least: int) -> Column:
    """``share`` where there are ``least`` awards or more, else null."""
    return F.when(awards >= least, share)


def duplicate_share(profile: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Share of duplicates in value by year, of years with a value."""
    p = profile.filter(F.col("award_year").between(first_year, last_year) & (F.col("raw_value") > 0))
    return p.select("award_year", (F.col("duplicate_value") / F.col("raw_value")).alias("duplicate_share"))


def unit_text(amount: Column) -> Column:
    """An amount with one decimal and the unit K, M, B or T."""
    a = F.abs(amount)
    out = F.format_number(amount, 0)
    for size, unit in ((1e3, "K"), (1e6, "M"), (1e9, "B"), (1e12, "T")):
        out = F.when(a >= size, F.concat(F.format_number(amount / size, 1), F.lit(unit))).otherwise(out)
    return out


def run_summary(raw: DataFrame, staged: DataFrame, rejected: DataFrame, agency_names: DataFrame, supplier_names: DataFrame, agencies: DataFrame, suppliers: DataFrame, aliases: DataFrame, level: int) -> DataFrame:
    """(position, measure, value): what a run took in, rejected by rule, folded, resolved by rule and kept, in the order of ``position``, then of falling values. One aggregate a table."""
    n = F.count(F.lit(1))

    def of(df: DataFrame, **measures: tuple[int, Column]) -> DataFrame:
        row = df.agg(*[c.cast("double").alias(m) for m, (_, c) in measures.items()])
        each = F.array(*[F.struct(F.lit(at).alias("position"), F.lit(m).alias("measure"), F.coalesce(m, F.lit(0.0)).alias("value")) for m, (at, _) in measures.items()])
        return row.select(F.inline(each))

    def by_rule(df: DataFrame, at: int, name: str) -> DataFrame:
        return df.groupBy("rule").agg(n.cast("double").alias("value")).select(F.lit(at).alias("position"), F.concat(F.lit(name + ":"), "rule").alias("measure"), "value")

    looks = F.count_if(F.col("confusables") > 0)
    out = of(raw, raw_rows=(1, n)).unionByName(of(staged, staged_rows=(2, n), staged_value=(11, F.sum("contract_amount")))).unionByName(of(rejected, quarantined_rows=(3, n))).unionByName(by_rule(rejected, 4, "rejected"))
    out = out.unionByName(of(agency_names, agency_names_raw=(5, n), agency_keys=(6, F.countDistinct("key")))).unionByName(of(supplier_names, supplier_names_raw=(7, n), supplier_keys=(8, F.countDistinct("key"))))
    out = out.unionByName(of(agency_names.select("confusables").unionByName(supplier_names.select("confusables")), names_with_look_alikes=(10, looks)))
    out = out.unionByName(of(agencies, agencies=(12, n))).unionByName(of(suppliers, suppliers=(13, n))).unionByName(of(aliases, supplier_aliases=(14, n))).unionByName(by_rule(aliases, 15, "alias"))
    return out.unionByName(raw.sparkSession.range(1).select(F.lit(16).alias("position"), F.lit("match_level").alias("measure"), F.lit(float(level)).alias("value")))
