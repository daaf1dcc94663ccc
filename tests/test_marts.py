import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from brightledger.config import DEFAULT
from brightledger.operators import checks, marts, serve
from brightledger.plans import pipeline

D = dt.date
SCHEMA = "award_id string, agency_id string, supplier_id string, award_date date, award_year int, contract_amount double, business_category string, reference_id string"


def facts(spark, rows):
    full = []
    for i, r in enumerate(rows):
        r = {"agency": "A", "supplier": "S", "day": D(2024, 3, 1), "amount": 50_000.0, "ref": f"r{i}"} | r
        full.append((str(i), r["agency"], r["supplier"], r["day"], r["day"].year, r["amount"], "b", r["ref"]))
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def amounts(spark):
    return spark.createDataFrame([(1_000_000, "threshold", ""), (2_000_000, "threshold", ""), (500_000, "placebo", ""), (300_000, "placebo", ""), (100_000, "placebo", "")], "round_amount bigint, amount_kind string, note string")


@pytest.fixture(scope="module")
def thresholds(spark):
    return spark.createDataFrame([("small_purchase", 1_000_000.0, D(2016, 1, 1), D(2025, 2, 24), "", "", ""), ("small_purchase", 2_000_000.0, D(2025, 2, 25), None, "", "", "")], "threshold string, amount double, effective_from date, effective_to date, applies_to string, legal_basis string, source string")


def test_band_edges(spark, amounts):
    f = facts(spark, [{"amount": x} for x in (950_000.0, 1_000_000.0, 1_000_000.01, 1_100_001.0, 899_999.0, 900_000.0, 1_100_000.0, 110_000.0)])
    got = {(r.round_amount, r.is_under): r.n for r in marts.bands(f, amounts).groupBy("round_amount", "is_under").agg(F.count("*").alias("n")).collect()}
    assert got == {(1_000_000, True): 3, (1_000_000, False): 2, (100_000, False): 1}


def test_national_baseline_is_a_median(spark, amounts, thresholds):
    rows = []
    for amount, under, over in ((1_000_000, 8, 1), (500_000, 2, 1), (300_000, 4, 1), (100_000, 9, 1)):
        rows += [{"amount": float(amount)}] * under + [{"amount": amount * 1.01}] * over
    m = pipeline.Marts(facts(spark, rows), amounts, thresholds)
    got = {r.round_amount: r for r in m.bunching_national.collect()}
    assert got[1_000_000].placebo_ratio == 4 and got[1_000_000].excess_over_placebo == 2
    assert got[1_000_000].in_force and not got[500_000].in_force


def test_ratio_without_over_is_null(spark, amounts, thresholds):
    m = pipeline.Marts(facts(spark, [{"amount": 1_000_000.0}]), amounts, thresholds)
    r = m.bunching_national.collect()[0]
    assert (r.under_over_ratio, r.excess_over_placebo, r.in_force) == (None, None, True)


@pytest.mark.parametrize(("n", "enough"), [(29, False), (30, True)])
def test_support(spark, amounts, n, enough):
    b = marts.bunching_agency(marts.bands(facts(spark, [{"amount": 1_000_000.0}] * n), amounts))
    assert b.collect()[0].enough_data == enough


def test_rule_change(spark, amounts):
    days = [D(2024, 2, 1), D(2024, 3, 1), D(2024, 8, 31), D(2024, 9, 1), D(2025, 3, 5), D(2025, 5, 1), D(2022, 3, 1)]
    f = facts(spark, [{"day": d, "amount": 1_000_000.0} for d in days] + [{"day": D(2025, 4, 1), "amount": 1_050_000.0}, {"day": D(2025, 4, 2), "amount": 5.0}])
    monthly = marts.change_monthly(f, marts.bands(f, amounts), (1_000_000, 2_000_000), (2024, 2025))
    assert monthly.agg(F.min("award_month")).first()[0] == D(2024, 2, 1)
    got = {r.award_year: r for r in marts.change_summary(monthly, (2024, 2025), (3, 8)).collect()}
    assert (got[2024].awards, got[2024].under_a, got[2024].ratio_a) == (2, 2, None)
    assert (got[2025].awards, got[2025].under_a, got[2025].over_a, got[2025].ratio_a) == (4, 2, 1, 2.0)


def groups(spark, thresholds, rows):
    return marts.same_day_groups(facts(spark, rows), thresholds, "small_purchase", 3).collect()


def test_same_day(spark, thresholds):
    g = groups(spark, thresholds, [{"amount": 400_000.0}] * 3)
    assert [(r.notices, r.total_value, r.ceiling) for r in g] == [(3, 1_200_000.0, 1_000_000.0)]


@pytest.mark.parametrize(
    "rows",
    [
        [{"amount": 600_000.0}] * 2,
        [{"amount": 300_000.0}] * 3,
        [{"amount": 400_000.0}] * 2 + [{"amount": 1_000_001.0}],
        [{"amount": 400_000.0, "ref": "one"}] * 3,
        [{"amount": 400_000.0, "ref": None}] * 3 + [{"amount": 400_000.0}],
        [{"amount": 400_000.0, "supplier": s} for s in "ABC"],
        [{"amount": 400_000.0, "day": D(2024, 3, i)} for i in (1, 2, 3)],
        [{"amount": 400_000.0, "day": D(2015, 12, 31)}] * 3,
    ],
)
def test_no_same_day_group(spark, thresholds, rows):
    assert groups(spark, thresholds, rows) == []


def test_ceiling_of_the_day(spark, thresholds):
    rows = [{"amount": 900_000.0, "day": d} for d in (D(2025, 2, 24), D(2025, 2, 25)) for _ in range(3)]
    assert sorted((r.award_date, r.ceiling) for r in groups(spark, thresholds, rows)) == [(D(2025, 2, 24), 1e6), (D(2025, 2, 25), 2e6)]


def test_concentration(spark):
    f = facts(spark, [{"supplier": s, "amount": a} for s, a in (("A", 60_000.0), ("B", 15_000.0), ("C", 15_000.0), ("D", 10_000.0))])
    r = marts.concentration(f).collect()[0]
    assert (r.suppliers, round(r.top_supplier_share, 9), round(r.herfindahl, 9), r.enough_data) == (4, 0.6, 0.415, False)


def test_areas_count_once_each(spark):
    f = facts(spark, [{"amount": 10.0, "ref": None}, {"amount": 30.0}])
    areas = spark.createDataFrame([("0", "X"), ("0", "Y"), ("1", "X"), ("1", "X")], "award_id string, area_name string")
    assert sorted((r.area_name, r.awards, r.total_value) for r in marts.by_area(f, areas, "award_year").collect()) == [("X", 2, 40.0), ("Y", 1, 10.0)]
    assert marts.yearly(f).collect()[0].share_with_reference_id == 0.5


def test_histogram(spark):
    f = facts(spark, [{"amount": float(x)} for x in (999_000, 1_000_000, 1_000_001, 800_001, 800_000, 1_200_000, 1_200_001)] + [{"amount": 1e6, "day": D(2025, 1, 1)}])
    got = {r.step: r.awards for r in serve.histogram(f, 1_000_000, 20, 2024).collect()}
    assert len(got) == 40 and {k: v for k, v in got.items() if v} == {-1: 2, 0: 1, -20: 1, 19: 1}
    assert serve.last_complete_year([2022, 2023, 2024, 2025], 2026) == 2024 and serve.last_complete_year([2025], 2026) == 2025


def test_rankings_and_search(spark):
    df = spark.createDataFrame([("y", "b", 2.0), ("y", "a", 2.0), ("y", "c", 5.0), ("z", "a", None)], "p string, name string, m double")
    assert [(r.p, r.name, r.place) for r in serve.rank_by(df, ["p"], F.col("m"), ["name"], 2).orderBy("p", "place").collect()] == [("y", "c", 1), ("y", "a", 2), ("z", "a", 1)]
    names = spark.createDataFrame([("City High School", "s"), ("High Court", "c"), (None, "s")], "name string, kind string")
    assert [r.name for r in serve.search(names, "name", "high CITY").collect()] == ["City High School"]
    assert serve.search(names, "name", "high", "c", "kind").count() == 1


def test_small_pieces(spark):
    df = spark.createDataFrame([([1, 2], ["a", "b"])], "n array<int>, s array<string>")
    assert [(r.n, r.s) for r in serve.unpacked_arrays(df, ["n", "s"]).collect()] == [(1, "a"), (2, "b")]
    x = spark.createDataFrame([(1_234.0, 5), (2.5e9, 50)], "v double, n int")
    assert [r.t for r in x.select(serve.unit_text(F.col("v")).alias("t")).collect()] == ["1.2K", "2.5B"]
    assert [r.t for r in x.select(serve.suppressed(F.col("v"), F.col("n"), 30).alias("t")).collect()] == [None, 2.5e9]


# Checks: a sound build passes, and each corruption makes exactly its checks fail.

CFG = replace(DEFAULT, band_support=1)


@pytest.fixture(scope="module")
def batch(spark, amounts, thresholds):
    from tests.test_staging import award, frame

    rows = [award(i, contract_amount=[400_000.0, 950_000.0, 1_050_000.0, 20_000.0][i % 4], area_of_delivery="A", awardee_name=["ACME", "ACME INC", "ACME INC - X", "BEST"][i % 4]) for i in range(24)]
    rows += [award(50 + i, contract_amount=400_000.0, area_of_delivery="A, B") for i in range(3)] + [award(90, reference_id="r0", contract_amount=400_000.0, area_of_delivery="A", awardee_name="ACME")]
    rows += [award(70 + i, contract_amount=400_000.0, awardee_name="GAMMA") for i in range(3)]
    areas = spark.createDataFrame([("A", "Alpha", "province"), ("B", "Beta", "province")], "token string, canonical string, kind string")
    return pipeline.Build(frame(spark, rows), areas, amounts.withColumn("round_amount", F.col("round_amount").cast("string")), thresholds, cfg=CFG)


@pytest.fixture(scope="module")
def built(batch):
    return {k: v.cache() for k, v in batch.tables().items()}


def failed(tables):
    return {r.name: r.violations for r in checks.run_checks(tables, CFG).filter("NOT passed").collect()}


def test_sound_build(batch, built):
    results = checks.run_checks(built, CFG)
    assert results.count() == 21 and failed(built) == {} and checks.publishable(results)
    report = pipeline.report(batch)
    assert report["publishable"] and report["summary"]["suppliers"] == 3 and report["summary"]["rejected:exact_duplicate"] == 1
    assert built["suppliers"].count() == 3 and built["rejected"].count() == 1


def bad(df, **cols):
    for c, v in cols.items():
        df = df.withColumn(c, F.when(F.col("award_id") == "0001", F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return df


CORRUPTIONS = {
    "row_counts_reconcile": lambda t: {"rejected": t["rejected"].limit(0)},
    "award_id_unique": lambda t: {"staged": t["staged"].withColumn("award_id", F.when(F.col("award_id") == "0001", "0002").otherwise(F.col("award_id")))},
    "no_exact_duplicates": lambda t: {"staged": t["staged"].withColumn("content_hash", F.when(F.col("award_id").isin("0001", "0002"), "x").otherwise(F.col("content_hash")))},
    "amount_in_range": lambda t: {"staged": bad(t["staged"], contract_amount=None), "facts": bad(t["facts"], contract_amount=None)},
    "name_keys_are_ascii": lambda t: {"agency_names": t["agency_names"].withColumn("key", F.lit("é"))},
    "name_keys_are_lossless": lambda t: {"supplier_names": t["supplier_names"].withColumn("dropped", F.when(F.col("raw") == "BEST", 1).otherwise(0))},
    "names_present": lambda t: {"staged": bad(t["staged"], agency_key="")},
    "area_tokens_known": lambda t: {"award_tokens": t["award_tokens"].withColumn("is_known", F.col("token") != "B")},
    "core_awards_complete": lambda t: {"facts": t["facts"].filter("award_id <> '0003'")},
    "entity_ids_unique": lambda t: {"agencies": t["agencies"].unionByName(t["agencies"])},
    "alias_maps_to_one_supplier": lambda t: {"aliases": t["aliases"].withColumn("supplier_raw", F.lit("x")).limit(2)},
    "thresholds_do_not_overlap": lambda t: {"thresholds": t["thresholds"].withColumn("effective_to", F.lit(None).cast("date"))},
    "marts_reconcile_to_core": lambda t: {"yearly": t["yearly"].withColumn("awards", F.col("awards") + 1)},
    "bunching_counts_match_core": lambda t: {"bunching_national": t["bunching_national"].withColumn("awards_under", F.when(F.col("round_amount") == 1_000_000, 0).otherwise(F.col("awards_under")))},
    "concentration_shares_valid": lambda t: {"concentration": t["concentration"].withColumn("herfindahl", F.lit(2.0))},
    "same_day_groups_meet_definition": lambda t: {"same_day": t["same_day"].limit(1).withColumn("notices", F.lit(1))},
    "analysis_amounts_consistent": lambda t: {"analysis_amounts": t["analysis_amounts"].filter("round_amount <> 500000")},
    "raw_duplicate_value_share": lambda t: {"duplicate_profile": t["duplicate_profile"].withColumn("duplicate_value", F.col("raw_value") * 0.2)},
    "award_date_in_range": lambda t: {"staged": t["staged"].withColumn("award_date", F.when(F.col("award_id") == "0001", F.lit("2005-01-01").cast("date")).otherwise(F.col("award_date")))},
    "core_value_matches_staging": lambda t: {"facts": t["facts"].withColumn("contract_amount", F.when(F.col("award_id") == "0003", 1.0).otherwise(F.col("contract_amount")))},
}


@pytest.mark.parametrize("name", list(CORRUPTIONS))
def test_corruption_is_found(built, name):
    got = failed(built | CORRUPTIONS[name](built))
    assert name in got and got[name] >= 1


def test_fault_in_the_range_join_is_found(built):
    # The check counts from the facts anew, so bands that lost rows do not agree with themselves.
    bands = built["bands"].filter("award_id <> '0001'")
    by = marts.bunching_agency(bands, 1)
    assert "bunching_counts_match_core" in failed(built | {"bands": bands, "bunching_national": marts.bunching_national(by, built["analysis_amounts"], built["thresholds"], CFG)})


def test_yoy(spark):
    f = facts(spark, [{"day": D(2020, 1, 1), "amount": 100.0}, {"day": D(2021, 1, 1), "amount": 1000.0}])
    assert [r.y for r in checks.yoy(f, 2014, 2026, (0.5, 1.75)).collect()] == [2021]
