"""Queries of the analytics operators over the award tables, and their SQL.

Those over ``core_awards`` take it as the fact table; those of the batch start from ``raw_awards`` and go through folding, staging, resolution and facts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.config import DEFAULT
from brightledger.operators import checks, evaluate, joins, marts, resolve, serve, staging
from brightledger.plans import chain_sql, export, pipeline
from brightledger.session import shared_folder, table, written
from brightledger.sources import io

#: Settings that suit the amounts, rules and years of the award tables.
CFG = replace(DEFAULT, day_notices=2, change_years=(2022, 2023), change_amounts=(499_000, 990_000), focus_amount=150_000, histogram_amounts=(150_000, 250_000), listed_awards=20, band_support=5, agency_year_support=10)
AREA = "Kundimaran"
LEVEL = 3


class _Tables(pipeline.Marts):
    """The tables of a folder, each made when first asked for; ``core_awards`` are the facts, ``batch`` starts from the raw awards."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.cfg = spark, folder, CFG

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @cached_property
    def facts(self) -> DataFrame:
        return self.table("core_awards")

    @cached_property
    def amounts(self) -> DataFrame:
        return marts.typed_amounts(self.table("analysis_amounts"))

    @cached_property
    def thresholds(self) -> DataFrame:
        return marts.typed_thresholds(self.table("core_thresholds"))

    @cached_property
    def batch(self) -> pipeline.Build:
        """The batch; large amounts with a contract number count as reviewed."""
        reviewed = lambda raw: raw.filter((F.col("contract_amount") > CFG.large_amount) & F.col("contract_no").isNotNull()).select("award_id")
        return pipeline.FolderBuild(self.spark, self.folder, reviewed, CFG, LEVEL)

    @cached_property
    def flagged(self) -> DataFrame:
        return staging.flag_duplicates(self.batch.raw)

    @cached_property
    def pool(self) -> DataFrame:
        return written(evaluate.pair_pool(self.batch.aliases, "supplier_key", "clean_key"), "pool")

    @cached_property
    def year(self) -> int | None:
        years = [r.award_year for r in self.facts.select("award_year").filter("award_year IS NOT NULL").distinct().collect()]
        return serve.last_complete_year(years, CFG.snapshot_day.year)


def _r(df: DataFrame, **digits: int) -> DataFrame:
    for c, n in digits.items():
        df = df.withColumn(c, F.round(c, n))
    return df


def _quarantine_counts(t: _Tables) -> DataFrame:
    bad, kept = staging.quarantine(t.batch.ruled)
    return bad.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).unionByName(kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("rule"), "n"))


def _by_year(t: _Tables) -> DataFrame:
    """Raw, kept and rejected rows by year, and how many rows are in neither."""
    rows = lambda df, n: df.groupBy(F.year("award_date").alias(f"y_{n}")).agg(F.count(F.lit(1)).alias(n))
    raw, kept, bad = rows(t.batch.raw, "raw_rows"), rows(t.batch.staged, "kept_rows"), rows(t.batch.rejected, "rejected_rows")
    j = raw.join(kept, F.col("y_raw_rows").eqNullSafe(F.col("y_kept_rows")), "left").join(bad, F.col("y_raw_rows").eqNullSafe(F.col("y_rejected_rows")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    off = {r.award_year for r in checks.reconcile(t.batch.raw, t.batch.staged, t.batch.rejected).collect()}  # years, none if all is well
    return j.select(F.col("y_raw_rows").alias("award_year"), "raw_rows", zero("kept_rows"), zero("rejected_rows"), F.col("y_raw_rows").isin(*off).alias("is_off") if off else F.lit(False).alias("is_off"))


def _full_diff(t: _Tables) -> DataFrame:
    a = marts.rollup(t.facts, "award_year").withColumnRenamed("awards", "n")
    b = marts.rollup(t.facts.filter(F.col("supplier_id").isNotNull()), "award_year").withColumnRenamed("awards", "n")
    return joins.differences(a, b, ["award_year"], ["n"])


def _union(t: _Tables) -> DataFrame:
    out = None
    for name, df in (("yearly", t.yearly), ("agency_year", t.agency_year), ("concentration", t.concentration)):
        r = df.agg(F.sum("awards").alias("awards"), F.round(F.sum("total_value"), 1).alias("total_value")).select(F.lit(name).alias("source"), "awards", "total_value")
        out = r if out is None else out.unionByName(r)
    return out


def _profile(t: _Tables) -> DataFrame:
    big = t.facts.filter(F.col("agency_id").isNotNull()).groupBy("agency_id").agg(F.count(F.lit(1)).alias("award_count"))
    return serve.agency_profile(t.agency_year, t.concentration, t.bunching_agency, t.same_day_agency, big, CFG.focus_amount, CFG.listed_awards)


def _rankings(t: _Tables) -> DataFrame:
    m = t.batch.marts
    return serve.pattern_rankings(m.concentration, m.bunching_agency, m.same_day_agency, t.batch.agencies, CFG.focus_amount, CFG.ranked, CFG.ranked_years)


def _yoy(t: _Tables) -> DataFrame:
    return _r(checks.yoy(t.facts, CFG.yoy_first_year, CFG.snapshot_day.year, (0.95, 1.1)).select(F.col("y").cast("int").alias("award_year"), "ratio"), ratio=6)


def _labels(t: _Tables) -> DataFrame:
    """The sampled pairs, labelled by a rule that stands in for people: by their first two words, unsure where lengths differ much."""
    words = lambda c: F.slice(F.split(c, " "), 1, 2)
    far = F.abs(F.length("key_a") - F.length("key_b")) > 9
    return evaluate.stratified_sample(t.pool).withColumn("label", F.when(far, "unsure").when(words("key_a") == words("key_b"), "same").otherwise("different"))


def _evaluation(t: _Tables) -> DataFrame:
    sizes = t.pool.select(evaluate.band_of().alias("band")).filter("band IS NOT NULL").groupBy("band").agg(F.count(F.lit(1)).alias("pool_size"))
    out = evaluate.evaluate(_labels(t).drop("pool_size"), sizes, keys=t.batch.supplier_names)
    return _r(out, precision=6, recall=6, weighted_precision=6, weighted_recall=6)


def _names(t: _Tables) -> DataFrame:
    of = lambda side, df: df.select(F.lit(side).alias("side"), "raw", "key", "confusables", "dropped")
    return of("agency", t.batch.agency_names).unionByName(of("supplier", t.batch.supplier_names))


def _directory(t: _Tables) -> DataFrame:
    return serve.directory(t.batch.agencies, t.batch.area_agency, CFG.listed_awards)


def _by_type(t: _Tables) -> DataFrame:
    return serve.bunching_by_type(t.batch.marts.bunching_agency, t.batch.agencies, CFG.focus_amount)


def _listing(t: _Tables) -> DataFrame:
    """The directory packed as one row of column arrays, and unpacked again."""
    rows = _directory(t).select("agency_id", "agency_name", "awards")
    packed = rows.agg(F.sort_array(F.collect_list(F.struct(*rows.columns))).alias("x")).select(*[F.col(f"x.{c}").alias(c) for c in rows.columns])
    return serve.unpacked_arrays(packed, rows.columns)


def _largest(t: _Tables) -> DataFrame:
    """The listed agency of most awards, by its id."""
    rows = written(_directory(t).select("agency_id", "agency_name", "awards"), "directory")
    top = rows.orderBy(F.desc("awards"), "agency_id").limit(1).collect()
    return serve.lookup(rows, "agency_id", top[0].agency_id if top else None)


def _shares(t: _Tables) -> DataFrame:
    c = t.concentration
    return c.select("agency_id", "award_year", F.round(serve.suppressed(F.col("top_supplier_share"), F.col("awards"), 30), 6).alias("shown_share"), serve.unit_text(serve.whole(F.col("total_value"))).alias("shown_value"))


def _path(t: _Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _seed_csv(t: _Tables) -> DataFrame:
    """The areas written as a seed file and read as one."""
    path = _path(t, "areas.csv")
    t.table("areas").select("token", "canonical", "kind").write.option("header", True).option("escape", '"').csv(path)
    return io.scan_seed(t.spark, path, "areas")


def _json_lines(t: _Tables) -> DataFrame:
    """Folded names written as lines of JSON and read with their schema."""
    path = _path(t, "names.json")
    t.batch.supplier_names.write.json(path)
    return io.scan_json_lines(t.spark, path, "raw string, key string, confusables int, dropped int")


def _saved(t: _Tables) -> DataFrame:
    """A table of the warehouse, written twice (the second replaces the first)."""
    folder = _path(t, "warehouse")
    io.save_table(t.table("analysis_amounts").limit(0), folder, "analysis_amounts")
    saved = io.save_table(t.table("analysis_amounts"), folder, "analysis_amounts")
    io.save_view(saved, "saved_amounts")
    return t.spark.table("saved_amounts")


_T: dict[str, Callable[[_Tables], DataFrame]] = {
    "award_bands": lambda t: t.bands.drop("award_date"),
    "bunching_agency": lambda t: t.bunching_agency,
    "bunching_national": lambda t: _r(t.bunching_national, under_over_ratio=6, placebo_ratio=6, excess_over_placebo=6),
    "threshold_in_force": lambda t: t.bunching_national.filter("in_force").select("award_year", "round_amount"),
    "bunching_by_category": lambda t: serve.by_kind(
        t.bands.filter(F.col("round_amount") == CFG.focus_amount).withColumns({"under": F.col("is_under").cast("int"), "over": (~F.col("is_under")).cast("int")}),
        t.facts.select("award_id", "business_category"), "award_id", "business_category", ["award_year"], ["under", "over"]),
    "rule_change_monthly": lambda t: t.change_monthly,
    "rule_change_summary": lambda t: _r(t.change_summary, ratio_a=6, ratio_b=6),
    "month_ratios": lambda t: _r(serve.month_ratios(t.change_monthly, "2022-01-01", 2), ratio_a=6, ratio_b=6),
    "same_day_groups": lambda t: _r(t.same_day, total_value=2, largest_notice=2),
    "same_day_agency": lambda t: _r(t.same_day_agency, total_value=2),
    "same_day_yearly": lambda t: _r(marts.same_day_yearly(t.same_day), total_value=2),
    "effective_ceiling": lambda t: joins.effective_join(t.facts.select("award_id", "award_date"), t.thresholds, "award_date", "effective_from", "effective_to").select("award_id", "threshold", "amount"),
    "supplier_concentration": lambda t: _r(t.concentration, total_value=2, top_supplier_share=6, herfindahl=6),
    "concentration_distribution": lambda t: _r(marts.concentration_yearly(t.concentration), p25=5, median_share=5, p75=5, p90=5),
    "yearly_rollup": lambda t: _r(t.yearly, total_value=2, share_with_reference_id=6),
    "served_yearly": lambda t: export.served_yearly(t.yearly),
    "served_bunching": lambda t: export.served_bunching(t.bunching_national),
    "agency_year": lambda t: _r(t.agency_year, total_value=2),
    "suppressed_shares": _shares,
    "cliff_histogram": lambda t: serve.histogram(t.facts, 150_000, 20, t.year).unionByName(serve.histogram(t.facts, 250_000, 20, t.year)),
    "agency_profile": _profile,
    "yoy_tripwire": _yoy,
    "interval_overlap": lambda t: joins.overlaps(t.thresholds.withColumn("effective_from", F.date_sub("effective_from", 1)), "threshold", "effective_from", "effective_to"),
    "full_join_diff": _full_diff,
    "union_reconcile": _union,
    "anti_join_missing": lambda t: t.thresholds.select(F.col("amount").cast("bigint").alias("round_amount")).join(t.amounts.filter("amount_kind = 'placebo'").select("round_amount"), "round_amount", "left_anti"),
    "seed_tables": lambda t: t.thresholds.select("threshold", "amount", "effective_from", "effective_to"),
    "seed_csv": _seed_csv,
    "json_lines": _json_lines,
    "saved_table": _saved,
    "typed_awards": lambda t: t.batch.raw,
    "duplicate_flags": lambda t: t.flagged.select("award_id", "keep_id", "is_duplicate"),
    "duplicate_profile": lambda t: _r(staging.duplicate_profile(t.flagged), raw_value=2, duplicate_value=2),
    "duplicate_share": lambda t: _r(serve.duplicate_share(staging.duplicate_profile(t.flagged), 2006, 2026), duplicate_share=6),
    "first_failing_rule": lambda t: t.batch.ruled.select("award_id", "rule"),
    "quarantine_counts": _quarantine_counts,
    "reconcile": _by_year,
    "fold_names": _names,
    "resolve_names": lambda t: t.batch.matches,
    "split_alias": lambda t: t.batch.award_tokens,
    "unknown_tokens": lambda t: t.batch.award_tokens.filter(~F.col("is_known")).groupBy("token").agg(F.countDistinct("award_id").alias("awards")),
    "entity_display_name": lambda t: _r(t.batch.agencies, total_value=2),
    "supplier_aliases": lambda t: _r(t.batch.aliases, total_value=2),
    "suppliers": lambda t: _r(t.batch.suppliers, total_value=2),
    "fact_table": lambda t: t.batch.facts,
    "area_year": lambda t: _r(t.batch.area_year, total_value=2),
    "area_agency": lambda t: _r(t.batch.area_agency, total_value=2),
    "pattern_rankings": _rankings,
    "bunching_by_type": _by_type,
    "type_ratios": lambda t: _r(serve.type_ratios(_by_type(t), 2022), ratio=6),
    "agency_directory": _directory,
    "packed_listing": _listing,
    "keyword_search": lambda t: serve.search(t.batch.agencies.select("agency_id", "agency_name", "agency_type"), "agency_name", "national school", "national_or_other", "agency_type").select("agency_id", "agency_name"),
    "agency_lookup": _largest,
    "focus_yearly": lambda t: serve.focus_yearly(t.batch.area_year, AREA),
    "focus_agencies": lambda t: serve.focus_agencies(t.batch.area_agency, t.batch.agencies, AREA, CFG.ranked),
    "focus_types": lambda t: _r(serve.focus_types(t.batch.area_agency, t.batch.agencies, AREA), total_value=2),
    "pair_pool": lambda t: t.pool.select("key_a", "key_b", F.round("similarity", 7).alias("similarity")),
    "stratified_sample": lambda t: evaluate.stratified_sample(t.pool).select("band", "key_a", "key_b", "pool_size"),
    "matcher_evaluation": _evaluation,
    "run_summary": lambda t: _r(t.batch.summary, value=2).orderBy("position", F.desc("value"), "measure"),
    "dq_report": lambda t: checks.run_checks(t.batch.tables(), CFG),
}


def _query(f: Callable[[_Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: f(_Tables(spark, folder))


QUERIES = {k: _query(f) for k, f in _T.items()}

# SQL building blocks.
_BANDS = """(SELECT a.award_id, a.agency_id, a.award_year, a.award_date, g.round_amount, a.contract_amount <= g.round_amount AS is_under FROM core_awards a
    JOIN analysis_amounts g ON a.contract_amount BETWEEN g.round_amount * 0.9 AND g.round_amount * 1.1)"""
_BUNCH = f"""(SELECT agency_id, award_year, round_amount, count(*) FILTER (is_under) AS awards_under, count(*) FILTER (NOT is_under) AS awards_over,
    count(*) >= {CFG.band_support} AS enough_data FROM {_BANDS} GROUP BY ALL)"""
_COUNTED = f"""(SELECT n.*, awards_under / nullif(awards_over, 0) AS r, g.amount_kind, EXISTS (SELECT 1 FROM core_thresholds t WHERE t.amount = n.round_amount
    AND n.award_year BETWEEN year(t.effective_from) AND year(coalesce(t.effective_to, DATE '2026-01-06'))) AS in_force
    FROM (SELECT award_year, round_amount, sum(awards_under)::BIGINT AS awards_under, sum(awards_over)::BIGINT AS awards_over FROM {_BUNCH} GROUP BY ALL) n
    JOIN analysis_amounts g USING (round_amount))"""
_A, _B = CFG.change_amounts
_MONTHLY = f"""(SELECT date_trunc('month', a.award_date)::DATE AS award_month, count(DISTINCT a.award_id) AS awards,
    count(*) FILTER (round_amount = {_A} AND is_under) AS under_a, count(*) FILTER (round_amount = {_A} AND NOT is_under) AS over_a,
    count(*) FILTER (round_amount = {_B} AND is_under) AS under_b, count(*) FILTER (round_amount = {_B} AND NOT is_under) AS over_b
    FROM core_awards a LEFT JOIN {_BANDS} b ON b.award_id = a.award_id AND b.round_amount IN ({_A}, {_B}) WHERE a.award_year >= {min(CFG.change_years) - 1} GROUP BY 1)"""
_DAY = f"""(SELECT d.agency_id, d.supplier_id, d.award_date, year(d.award_date)::INT AS award_year, d.notices, d.total_value, d.largest_notice, t.amount AS ceiling
    FROM (SELECT agency_id, supplier_id, award_date, count(*) AS notices, sum(v) AS total_value, max(v) AS largest_notice FROM
        (SELECT agency_id, supplier_id, award_date, reference_id, sum(contract_amount) AS v FROM core_awards WHERE reference_id IS NOT NULL GROUP BY ALL) GROUP BY ALL) d
    JOIN core_thresholds t ON t.threshold = 'small_purchase' AND d.award_date BETWEEN t.effective_from AND coalesce(t.effective_to, DATE '9999-12-31')
    WHERE notices >= {CFG.day_notices} AND largest_notice <= t.amount AND total_value > t.amount)"""
_DAY_AGENCY = f"(SELECT agency_id, award_year, count(*) AS groups, sum(notices)::BIGINT AS notices, sum(total_value) AS total_value FROM {_DAY} GROUP BY ALL)"
_CONC = f"""(SELECT agency_id, award_year, sum(n)::BIGINT AS awards, count(*) AS suppliers, sum(v) AS total_value, max(v / s) AS top_supplier_share, sum((v / s) * (v / s)) AS herfindahl,
    sum(n) >= {CFG.agency_year_support} AS enough_data FROM (SELECT *, sum(v) OVER (PARTITION BY agency_id, award_year) AS s FROM
        (SELECT agency_id, award_year, supplier_id, count(*) AS n, sum(contract_amount) AS v FROM core_awards GROUP BY ALL)) GROUP BY agency_id, award_year)"""


def _chained(sql: str) -> str:
    """``sql`` over the facts of the batch instead of ``core_awards``."""
    return sql.replace("core_awards", "c_facts")


_CHAIN = chain_sql.chain(CFG, LEVEL)
_DIRECTORY = f"""(SELECT agency_id, agency_name, agency_type, award_count AS awards, round(round(total_value, 2)) AS total_value, year(first_award_date)::INT AS first_year, year(last_award_date)::INT AS last_year,
    (SELECT arg_min(area_name, (-m.awards, area_name)) FROM c_area_agency m WHERE m.agency_id = a.agency_id) AS main_area FROM c_agencies a WHERE award_count >= {CFG.listed_awards})"""
_POOL = f"""(SELECT a.key AS key_a, b.key AS key_b, jaro_winkler_similarity(a.name, b.name) AS similarity FROM (SELECT DISTINCT supplier_key AS key, clean_key AS name FROM c_aliases) a
    JOIN (SELECT DISTINCT supplier_key AS key, clean_key AS name FROM c_aliases) b ON split_part(a.name, ' ', 1) = split_part(b.name, ' ', 1) AND a.key < b.key AND length(split_part(a.name, ' ', 1)) >= 3
    WHERE jaro_winkler_similarity(a.name, b.name) >= 0.8)"""
_BAND = "CASE WHEN similarity < 0.9 THEN 0 WHEN similarity < 0.95 THEN 1 WHEN similarity < 0.99 THEN 2 WHEN similarity < 1.0001 THEN 3 END::INT"
_SAMPLE = f"""(SELECT band, key_a, key_b, pool_size FROM (SELECT *, count(*) OVER (PARTITION BY band) AS pool_size, row_number() OVER (PARTITION BY band ORDER BY md5(key_a || chr(31) || key_b)) AS r FROM
    (SELECT *, {_BAND} AS band FROM {_POOL})) WHERE r <= 75)"""
_LABELLED = f"""(SELECT s.*, pool_size / count(*) OVER (PARTITION BY band) AS w, CASE WHEN abs(length(key_a) - length(key_b)) > 9 THEN 'unsure'
    WHEN string_split(key_a, ' ')[1:2] = string_split(key_b, ' ')[1:2] THEN 'same' ELSE 'different' END AS label FROM {_SAMPLE} s)"""
_LEVELS = " UNION ALL ".join(f"SELECT {n} AS level, key, match_key FROM {chain_sql.matches_sql('c_supplier_names', n)}" for n in (1, 2, 3))
_BY_TYPE = f"""(SELECT award_year, agency_type, sum(awards_under)::BIGINT AS awards_under, sum(awards_over)::BIGINT AS awards_over FROM {_chained(_BUNCH)} JOIN c_agencies USING (agency_id)
    WHERE round_amount = {CFG.focus_amount} GROUP BY 1, 2)"""
_YEAR = f"(SELECT coalesce(max(award_year) FILTER (award_year < {CFG.snapshot_day.year - 1}), max(award_year)) FROM core_awards)"
_UNITS = "CASE WHEN abs(v) >= 1e12 THEN format('{:,.1f}', v / 1e12) || 'T' WHEN abs(v) >= 1e9 THEN format('{:,.1f}', v / 1e9) || 'B' WHEN abs(v) >= 1e6 THEN format('{:,.1f}', v / 1e6) || 'M' WHEN abs(v) >= 1e3 THEN format('{:,.1f}', v / 1e3) || 'K' ELSE format('{:,.0f}', v) END"


def _histogram_sql(g: int) -> str:
    return f"""SELECT {g}::BIGINT AS amount, s.step, coalesce(n, 0)::BIGINT AS awards FROM (SELECT unnest(range(-20, 20))::INT AS step) s LEFT JOIN
        (SELECT (ceil((contract_amount - {g}) / ({g} / 100.0)) - 1)::INT AS step, count(*) AS n FROM core_awards WHERE award_year = {_YEAR} AND contract_amount > {g} * 0.8 AND contract_amount <= {g} * 1.2 GROUP BY 1) USING (step)"""


def _area_sql(key: str) -> str:
    return f"SELECT area_name, {key}, awards, round(total_value, 2) AS total_value FROM c_area_{key.split('_')[1] if key == 'award_year' else 'agency'}"


_BATCH = {
    "typed_awards": "SELECT * FROM c_typed",
    "duplicate_flags": "SELECT award_id, keep_id, is_duplicate FROM c_flagged",
    "duplicate_profile": """SELECT year(award_date)::INT AS award_year, count(*) AS raw_rows, count(*) FILTER (is_duplicate) AS duplicate_rows, round(sum(contract_amount), 2) AS raw_value,
        round(coalesce(sum(contract_amount) FILTER (is_duplicate), 0), 2) AS duplicate_value FROM c_flagged GROUP BY 1""",
    "duplicate_share": """SELECT year(award_date)::INT AS award_year, round(coalesce(sum(contract_amount) FILTER (is_duplicate), 0) / sum(contract_amount), 6) AS duplicate_share FROM c_flagged
        WHERE year(award_date) BETWEEN 2006 AND 2026 GROUP BY 1 HAVING sum(contract_amount) > 0""",
    "first_failing_rule": "SELECT award_id, rule FROM c_ruled",
    "quarantine_counts": "SELECT coalesce(rule, 'kept') AS rule, count(*) AS n FROM c_ruled GROUP BY 1",
    "reconcile": """SELECT year(award_date)::INT AS award_year, any_value(n) AS raw_rows, count(*) FILTER (rule IS NULL) AS kept_rows, count(*) FILTER (rule IS NOT NULL) AS rejected_rows,
        count(*) <> any_value(n) AS is_off
        FROM c_ruled LEFT JOIN (SELECT year(award_date) AS y, count(*) AS n FROM raw_awards GROUP BY 1) ON y IS NOT DISTINCT FROM year(award_date) GROUP BY 1""",
    "fold_names": "SELECT 'agency' AS side, * FROM c_agency_names UNION ALL SELECT 'supplier', * FROM c_supplier_names",
    "json_lines": "SELECT * FROM c_supplier_names",
    "resolve_names": "SELECT * FROM c_matches",
    "split_alias": "SELECT * FROM c_tokens",
    "unknown_tokens": "SELECT token, count(DISTINCT award_id) AS awards FROM c_tokens WHERE NOT is_known GROUP BY 1",
    "entity_display_name": "SELECT * REPLACE (round(total_value, 2) AS total_value) FROM c_agencies",
    "supplier_aliases": "SELECT * REPLACE (round(total_value, 2) AS total_value) FROM c_aliases",
    "suppliers": "SELECT * REPLACE (round(total_value, 2) AS total_value) FROM c_suppliers",
    "fact_table": "SELECT * FROM c_facts",
    "area_year": _area_sql("award_year"),
    "area_agency": _area_sql("agency_id"),
    "pattern_rankings": f"""SELECT pattern, award_year, place, agency_id, agency_name, agency_type, awards, round(round(total_value, 2)) AS total_value, coalesce(under, 0) AS under, coalesce(over, 0) AS over,
        coalesce(same_day_groups, 0) AS same_day_groups, round(round(coalesce(day_value, 0), 2)) AS same_day_value, round(top_supplier_share, 4) AS top_supplier_share, suppliers FROM
        (SELECT *, row_number() OVER (PARTITION BY pattern, award_year ORDER BY measure DESC, agency_name, agency_id)::INT AS place FROM
            (SELECT c.*, a.agency_name, a.agency_type, b.awards_under AS under, b.awards_over AS over, s.groups AS same_day_groups, s.total_value AS day_value,
                unnest([{{'pattern': 'bunching', 'measure': CASE WHEN b.enough_data THEN b.awards_under END::DOUBLE}}, {{'pattern': 'same_day', 'measure': CASE WHEN s.groups > 0 THEN s.groups END::DOUBLE}},
                    {{'pattern': 'concentration', 'measure': CASE WHEN c.enough_data THEN c.top_supplier_share END}}], recursive := true)
            FROM {_chained(_CONC)} c JOIN c_agencies a USING (agency_id) LEFT JOIN (SELECT * FROM {_chained(_BUNCH)} WHERE round_amount = {CFG.focus_amount}) b USING (agency_id, award_year)
            LEFT JOIN {_chained(_DAY_AGENCY)} s USING (agency_id, award_year)) WHERE measure IS NOT NULL AND award_year IN (SELECT DISTINCT award_year FROM c_facts ORDER BY award_year DESC LIMIT {CFG.ranked_years}))
        WHERE place <= {CFG.ranked}""",
    "bunching_by_type": f"SELECT * FROM {_BY_TYPE}",
    "type_ratios": f"SELECT agency_type, awards_under, awards_over, round(awards_under / awards_over, 6) AS ratio FROM {_BY_TYPE} WHERE award_year = 2022 AND awards_over > 0",
    "agency_directory": f"SELECT * FROM {_DIRECTORY}",
    "packed_listing": f"SELECT agency_id, agency_name, awards FROM {_DIRECTORY}",
    "agency_lookup": f"SELECT agency_id, agency_name, awards FROM {_DIRECTORY} WHERE agency_id = (SELECT agency_id FROM {_DIRECTORY} ORDER BY awards DESC, agency_id LIMIT 1)",
    "keyword_search": "SELECT agency_id, agency_name FROM c_agencies WHERE contains(upper(agency_name), 'NATIONAL') AND contains(upper(agency_name), 'SCHOOL') AND agency_type = 'national_or_other' ORDER BY agency_name, agency_id LIMIT 200",
    "focus_yearly": f"SELECT award_year, awards, round(round(total_value, 2)) AS total_value FROM c_area_year WHERE area_name = '{AREA}'",
    "focus_agencies": f"""SELECT row_number() OVER (ORDER BY m.total_value DESC NULLS LAST, agency_name, agency_id)::INT AS place, agency_id, agency_name, agency_type, awards, round(round(m.total_value, 2)) AS total_value
        FROM c_area_agency m JOIN c_agencies USING (agency_id) WHERE area_name = '{AREA}' ORDER BY place LIMIT {CFG.ranked}""",
    "focus_types": f"SELECT agency_type, sum(awards)::BIGINT AS awards, round(sum(m.total_value), 2) AS total_value FROM c_area_agency m JOIN c_agencies USING (agency_id) WHERE area_name = '{AREA}' GROUP BY 1",
    "pair_pool": f"SELECT key_a, key_b, round(similarity, 7) AS similarity FROM {_POOL}",
    "stratified_sample": f"SELECT * FROM {_SAMPLE}",
    "matcher_evaluation": f"""SELECT level, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round(wtp / nullif(wtp + wfp, 0), 6) AS weighted_precision,
        round(wtp / nullif(wtp + wfn, 0), 6) AS weighted_recall FROM (SELECT level, count(*) FILTER (s AND h) AS tp, count(*) FILTER (NOT s AND h) AS fp, count(*) FILTER (s AND NOT h) AS fn, count(*) FILTER (NOT s AND NOT h) AS tn,
            coalesce(sum(w) FILTER (s AND h), 0) AS wtp, coalesce(sum(w) FILTER (NOT s AND h), 0) AS wfp, coalesce(sum(w) FILTER (s AND NOT h), 0) AS wfn FROM
            (SELECT a.level, w, label = 'same' AS s, a.match_key = b.match_key AS h FROM {_LABELLED} l JOIN ({_LEVELS}) a ON a.key = l.key_a JOIN ({_LEVELS}) b ON b.key = l.key_b AND b.level = a.level WHERE label <> 'unsure') GROUP BY level)""",
    "run_summary": """SELECT position, measure, round(value, 2) AS value FROM (SELECT 1 AS position, 'raw_rows' AS measure, count(*)::DOUBLE AS value FROM raw_awards UNION ALL SELECT 2, 'staged_rows', count(*) FROM c_staged
        UNION ALL SELECT 3, 'quarantined_rows', count(*) FROM c_rejected UNION ALL SELECT 4, 'rejected:' || rule, count(*) FROM c_rejected GROUP BY rule UNION ALL SELECT 5, 'agency_names_raw', count(*) FROM c_agency_names
        UNION ALL SELECT 6, 'agency_keys', count(DISTINCT key) FROM c_agency_names UNION ALL SELECT 7, 'supplier_names_raw', count(*) FROM c_supplier_names UNION ALL SELECT 8, 'supplier_keys', count(DISTINCT key) FROM c_supplier_names
        UNION ALL SELECT 10, 'names_with_look_alikes', count(*) FROM (SELECT confusables FROM c_agency_names UNION ALL SELECT confusables FROM c_supplier_names) WHERE confusables > 0
        UNION ALL SELECT 11, 'staged_value', coalesce(sum(contract_amount), 0) FROM c_staged UNION ALL SELECT 12, 'agencies', count(*) FROM c_agencies UNION ALL SELECT 13, 'suppliers', count(*) FROM c_suppliers
        UNION ALL SELECT 14, 'supplier_aliases', count(*) FROM c_aliases UNION ALL SELECT 15, 'alias:' || rule, count(*) FROM c_aliases GROUP BY rule UNION ALL SELECT 16, 'match_level', 3)""",
    "dq_report": chain_sql.checks_sql(CFG, _chained(_BANDS), f"(SELECT award_year, round_amount, sum(awards_under) AS awards_under, sum(awards_over) AS awards_over FROM {_chained(_BUNCH)} GROUP BY 1, 2)", _chained(_CONC), _chained(_DAY)),
}

ORACLES = {k: _CHAIN + sql for k, sql in _BATCH.items()} | {
    "month_ratios": f"""SELECT award_month, round(under_a / nullif(over_a, 0), 6) AS ratio_a, round(under_b / nullif(over_b, 0), 6) AS ratio_b FROM {_MONTHLY} WHERE award_month >= DATE '2022-01-01' AND over_b >= 2""",
    "served_yearly": """SELECT award_year, count(*) AS awards, round(round(sum(contract_amount), 2)) AS total_value, count(DISTINCT agency_id) AS agencies, count(DISTINCT supplier_id) AS suppliers,
        round(avg((reference_id IS NOT NULL)::INT), 4) AS share_with_reference_id FROM core_awards GROUP BY 1""",
    "served_bunching": f"""SELECT award_year, round_amount, amount_kind, in_force, awards_under, awards_over, round(r, 3) AS ratio, round(p, 3) AS placebo_ratio, round(r / nullif(p, 0), 3) AS excess
        FROM {_COUNTED} LEFT JOIN (SELECT award_year, median(r) AS p FROM {_COUNTED} WHERE amount_kind = 'placebo' GROUP BY 1) USING (award_year)""",
    "suppressed_shares": f"SELECT agency_id, award_year, CASE WHEN awards >= 30 THEN round(top_supplier_share, 6) END AS shown_share, {_UNITS} AS shown_value FROM (SELECT *, round(round(total_value, 2)) AS v FROM {_CONC})",
    "seed_csv": "SELECT token, nullif(canonical, '') AS canonical, kind FROM areas",
    "saved_table": "SELECT * FROM analysis_amounts",
    "award_bands": f"SELECT award_id, agency_id, award_year, round_amount, is_under FROM {_BANDS}",
    "bunching_agency": f"SELECT * FROM {_BUNCH}",
    "bunching_national": f"""SELECT award_year, round_amount, awards_under, awards_over, round(r, 6) AS under_over_ratio, amount_kind, in_force, round(p, 6) AS placebo_ratio,
        round(r / nullif(p, 0), 6) AS excess_over_placebo FROM {_COUNTED} LEFT JOIN (SELECT award_year, median(r) AS p FROM {_COUNTED} WHERE amount_kind = 'placebo' GROUP BY 1) USING (award_year)""",
    "threshold_in_force": f"SELECT award_year, round_amount FROM {_COUNTED} WHERE in_force",
    "bunching_by_category": f"""SELECT b.award_year, c.business_category, sum(b.is_under::INT)::BIGINT AS under, sum((NOT b.is_under)::INT)::BIGINT AS over FROM {_BANDS} b
        JOIN core_awards c USING (award_id) WHERE round_amount = {CFG.focus_amount} GROUP BY ALL""",
    "rule_change_monthly": f"SELECT * FROM {_MONTHLY}",
    "rule_change_summary": f"""SELECT year(award_month)::INT AS award_year, sum(awards)::BIGINT AS awards, sum(under_a)::BIGINT AS under_a, sum(over_a)::BIGINT AS over_a, sum(under_b)::BIGINT AS under_b, sum(over_b)::BIGINT AS over_b,
        round(sum(under_a) / nullif(sum(over_a), 0), 6) AS ratio_a, round(sum(under_b) / nullif(sum(over_b), 0), 6) AS ratio_b FROM {_MONTHLY}
        WHERE year(award_month) IN (2022, 2023) AND month(award_month) BETWEEN 3 AND 8 GROUP BY 1""",
    "same_day_groups": f"SELECT agency_id, supplier_id, award_date, award_year, notices, round(total_value, 2) AS total_value, round(largest_notice, 2) AS largest_notice, ceiling FROM {_DAY}",
    "same_day_agency": f"SELECT agency_id, award_year, groups, notices, round(total_value, 2) AS total_value FROM {_DAY_AGENCY}",
    "same_day_yearly": f"SELECT award_year, count(*) AS groups, sum(notices)::BIGINT AS notices, round(sum(total_value), 2) AS total_value, count(DISTINCT agency_id) AS agencies FROM {_DAY} GROUP BY 1",
    "effective_ceiling": "SELECT award_id, threshold, amount FROM core_awards JOIN core_thresholds ON award_date BETWEEN effective_from AND coalesce(effective_to, DATE '9999-12-31')",
    "supplier_concentration": f"SELECT agency_id, award_year, awards, suppliers, round(total_value, 2) AS total_value, round(top_supplier_share, 6) AS top_supplier_share, round(herfindahl, 6) AS herfindahl, enough_data FROM {_CONC}",
    "concentration_distribution": f"""SELECT award_year, count(*) AS agencies, round(quantile_cont(top_supplier_share, 0.25), 5) AS p25, round(median(top_supplier_share), 5) AS median_share,
        round(quantile_cont(top_supplier_share, 0.75), 5) AS p75, round(quantile_cont(top_supplier_share, 0.9), 5) AS p90, count(*) FILTER (top_supplier_share > 0.5) AS above_half FROM {_CONC} WHERE enough_data GROUP BY 1""",
    "yearly_rollup": """SELECT award_year, count(*) AS awards, round(sum(contract_amount), 2) AS total_value, count(DISTINCT agency_id) AS agencies, count(DISTINCT supplier_id) AS suppliers,
        round(avg((reference_id IS NOT NULL)::INT), 6) AS share_with_reference_id FROM core_awards GROUP BY 1""",
    "agency_year": "SELECT agency_id, award_year, count(*) AS awards, round(sum(contract_amount), 2) AS total_value FROM core_awards GROUP BY 1, 2",
    "cliff_histogram": _histogram_sql(150_000) + " UNION ALL " + _histogram_sql(250_000),
    "agency_profile": f"""SELECT y.agency_id, y.award_year, y.awards, round(round(y.total_value, 2)) AS total_value, round(c.top_supplier_share, 4) AS top_supplier_share, round(c.herfindahl, 4) AS herfindahl, c.suppliers,
        coalesce(b.awards_under, 0) AS under, coalesce(b.awards_over, 0) AS over, coalesce(s.groups, 0) AS same_day_groups, round(round(coalesce(s.total_value, 0), 2)) AS same_day_value
        FROM (SELECT agency_id, award_year, count(*) AS awards, sum(contract_amount) AS total_value FROM core_awards GROUP BY 1, 2) y
        JOIN (SELECT agency_id FROM core_awards WHERE agency_id IS NOT NULL GROUP BY 1 HAVING count(*) >= {CFG.listed_awards}) USING (agency_id) JOIN {_CONC} c USING (agency_id, award_year)
        LEFT JOIN (SELECT * FROM {_BUNCH} WHERE round_amount = {CFG.focus_amount}) b USING (agency_id, award_year) LEFT JOIN {_DAY_AGENCY} s USING (agency_id, award_year)""",
    "yoy_tripwire": """SELECT y AS award_year, round(ratio, 6) AS ratio FROM (SELECT y, v / lag(v) OVER (ORDER BY y) AS ratio FROM (SELECT year(award_date)::INT AS y, sum(contract_amount) AS v FROM core_awards GROUP BY 1))
        WHERE y >= 2014 AND y < 2026 AND (ratio < 0.95 OR ratio > 1.1)""",
    "interval_overlap": """WITH t AS (SELECT threshold, effective_from - 1 AS f, coalesce(effective_to, DATE '9999-12-31') AS e FROM core_thresholds)
        SELECT a.threshold, a.f AS first_from, a.e AS first_to, b.f AS second_from FROM t a JOIN t b ON a.threshold = b.threshold AND a.f < b.f AND a.e >= b.f""",
    "full_join_diff": """SELECT award_year, l.n AS n_left, r.n AS n_right FROM (SELECT award_year, count(*) AS n FROM core_awards GROUP BY 1) l FULL JOIN
        (SELECT award_year, count(*) AS n FROM core_awards WHERE supplier_id IS NOT NULL GROUP BY 1) r USING (award_year) WHERE l.n IS DISTINCT FROM r.n""",
    "union_reconcile": " UNION ALL ".join(f"SELECT '{s}' AS source, count(*) AS awards, round(sum(contract_amount), 1) AS total_value FROM core_awards" for s in ("yearly", "agency_year", "concentration")),
    "anti_join_missing": "SELECT amount::BIGINT AS round_amount FROM core_thresholds WHERE amount::BIGINT NOT IN (SELECT round_amount FROM analysis_amounts WHERE amount_kind = 'placebo')",
    "seed_tables": "SELECT threshold, amount, effective_from, effective_to FROM core_thresholds",
}
