import datetime as dt

from pyspark.sql import functions as F

from brightledger.config import DEFAULT
from brightledger.operators import staging
from brightledger.schemas import raw_awards

DAY = dt.datetime(2024, 3, 1)


def award(i, **kw):
    row = {"id": f"{i:04d}", "reference_id": f"r{i}", "contract_no": "c", "award_title": "t", "notice_title": "n", "awardee_name": "ACME", "organization_name": "CITY OF X", "area_of_delivery": None, "business_category": "b", "contract_amount": 50000.0, "award_date": DAY, "award_status": None}
    return row | kw


def frame(spark, rows):
    s = raw_awards()
    return spark.createDataFrame([tuple(r[f.name] for f in s.fields) for r in rows], s)


def names(spark, *pairs):
    return spark.createDataFrame(list(pairs), "raw string, key string")


def rules(spark, rows, reviewed=None):
    t = staging.typed(frame(spark, rows))
    out = staging.ruled(t, names(spark, ("CITY OF X", "CITY OF X"), ("会", "")), names(spark, ("ACME", "ACME"), ("", "")), reviewed)
    return {r.award_id: r.rule for r in out.collect()}


def test_each_rule(spark):
    rows = [award(0), award(1, award_date=None), award(2, award_date=dt.datetime(1920, 1, 1)), award(3, award_date=dt.datetime(2034, 1, 1)), award(4, contract_amount=0.01), award(5, contract_amount=2e10), award(6, contract_amount=None), award(7, awardee_name=None), award(8, organization_name="会"), award(9, contract_amount=3e10)]
    reviewed = spark.createDataFrame([("0009",)], "award_id string")
    assert rules(spark, rows, reviewed) == {"0000": None, "0001": "missing_award_date", "0002": "award_date_before_first_day", "0003": "award_date_after_snapshot", "0004": "amount_too_small", "0005": "amount_too_large_unreviewed", "0006": "amount_too_small", "0007": "empty_name", "0008": "empty_name", "0009": None}


def test_bounds_are_kept(spark):
    rows = [award(0, award_date=dt.datetime(2006, 1, 1)), award(1, award_date=dt.datetime.combine(DEFAULT.snapshot_day, dt.time(12))), award(2, contract_amount=1.0), award(3, contract_amount=1e10)]
    assert set(rules(spark, rows).values()) == {None}


def test_duplicates_come_before_values(spark):
    same = dict(reference_id="r", award_date=None)
    got = rules(spark, [award(3, **same), award(1, **same), award(2, **same), award(4, reference_id=" r ", award_date=None)])
    assert got == {"0001": "missing_award_date", "0002": "exact_duplicate", "0003": "exact_duplicate", "0004": "exact_duplicate"}


def test_hot_group_of_duplicates(spark):
    df = staging.typed(frame(spark, [award(i, reference_id="r") for i in range(200)] + [award(900)]))
    got = staging.flag_duplicates(df)
    assert got.count() == 201 and got.filter("is_duplicate").count() == 199 and got.filter("NOT is_duplicate AND award_id = '0000'").count() == 1


def test_quarantine_loses_nothing(spark):
    t = staging.flag_duplicates(staging.typed(frame(spark, [award(i, award_date=None if i % 2 else DAY) for i in range(10)])))
    bad, kept = staging.quarantine(t.withColumn("rule", F.when(F.col("award_date").isNull(), "missing")))
    assert (bad.count(), kept.count()) == (5, 5) and "rule" not in kept.columns and "is_duplicate" not in bad.columns


def test_areas(spark):
    listed = spark.createDataFrame([("A", "Alpha", "province"), ("old", "Alpha", "province"), ("bad", "", "invalid")], "token string, canonical string, kind string")
    df = spark.createDataFrame([("1", "A, old,A"), ("2", "bad,?"), ("3", None)], "award_id string, area_raw string")
    got = sorted((r.award_id, r.token, r.area_name, r.is_known) for r in staging.exploded(df, "award_id", "area_raw", listed).collect())
    assert got == [("1", "A", "Alpha", True), ("1", "old", "Alpha", True), ("2", "?", None, False), ("2", "bad", None, True)]


def test_empty(spark):
    e = staging.typed(frame(spark, []))
    assert staging.flag_duplicates(e).count() == 0
    assert staging.duplicate_profile(staging.flag_duplicates(e)).count() == 0
