import pytest
from pyspark.sql import functions as F

from brightledger.functions.text import fold
from brightledger.operators import resolve
from brightledger.plans.mart_queries import QUERIES


def apply(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, key string")
    return [r.x for r in df.select("i", f(F.col("key")).alias("x")).orderBy("i").collect()]


def test_clean(spark):
    cases = {"A.B.C. TRADING": "ABC TRADING", "A. B. C. TRADING INCORPORATED": "ABC TRADING INC", "X & Y CORPORATION": "X AND Y CORP", "MARY'S STORE": "MARYS STORE", "GO COMPANY, LIMITED": "GO CO LTD", "": "", "J R": "JR", "TRADING A B": "TRADING AB"}
    assert apply(spark, resolve.clean, list(cases)) == list(cases.values())


def test_branch_head(spark):
    cases = {"BIG SALES INC. - NAGA": "BIG SALES INC", "BIG SALES INC.-NAGA": "BIG SALES INC", "UP-TOWN SALES INC": None, "BIG INC - NAGA JV": None, "INC - NAGA": None, "SCHOOL - TOWN": None, "BIG SALES CORPORATION -": None}
    assert apply(spark, resolve.branch_head, list(cases)) == list(cases.values())


def test_drop_legal_form(spark):
    assert apply(spark, resolve.drop_legal_form, ["BIG SALES INC", "BIG CO INC", "INC", "INC CORP", "CO OP SALES"]) == ["BIG SALES", "BIG", "INC", "INC", "CO OP SALES"]


def test_resolve(spark):
    keys = spark.createDataFrame([(k,) for k in ("BIG SALES INC", "BIG SALES, INCORPORATED", "BIG SALES INC - NAGA", "LONE SALES INC - CEBU", "RED")], "key string")
    got = {r.key: (r.match_key, r.rule) for r in resolve.resolve(keys, 3).collect()}
    assert got["BIG SALES INC"] == ("BIG SALES", "legal_form_dropped")
    assert got["BIG SALES, INCORPORATED"] == ("BIG SALES", "punctuation+legal_form_dropped")
    assert got["BIG SALES INC - NAGA"] == ("BIG SALES", "punctuation+branch_suffix+legal_form_dropped")
    assert got["LONE SALES INC - CEBU"] == ("LONE SALES INC CEBU", "punctuation")  # its head is no key
    assert got["RED"] == ("RED", "identical")
    assert {r.match_key for r in resolve.resolve(keys, 1).collect()} >= {"BIG SALES INC NAGA", "BIG SALES INC"}
    assert resolve.resolve(keys.limit(0), 3).count() == 0


def test_fold_names(spark):
    df = spark.createDataFrame([("CITY OF TALISAY",), ("CITY OF ΤΑLISAY",), ("会",), (None,), ("CITY OF TALISAY",)], "n string")
    got = {r.raw: (r.key, r.confusables, r.dropped) for r in resolve.fold_names(df, "n").collect()}
    assert got == {"CITY OF TALISAY": ("CITY OF TALISAY", 0, 0), "CITY OF ΤΑLISAY": ("CITY OF TALISAY", 2, 0), "会": ("", 0, 1)}


def test_resolve_names_runs_on_folded_keys(spark, folder, tmp_path):
    raw = ["BIG SОLES INC", "Big Soles, Incorporated", "PEÑA TRADING", "PENA TRADING CORP", "ＲＥＤ  SALES", "RED SALES", "会", None, "RED SALES"]  # a Cyrillic O, an accent, wide letters
    like = spark.read.parquet(f"{folder}/raw_awards.parquet").schema
    rows = [tuple(n if f.name == "awardee_name" else str(i) if f.name == "id" else None for f in like) for i, n in enumerate(raw)]
    spark.createDataFrame(rows, like).write.parquet(str(tmp_path / "raw_awards.parquet"))
    got = {r.key: r.match_key for r in QUERIES["resolve_names"](spark, str(tmp_path)).collect()}
    assert set(got) == {fold(n)[0] for n in raw if n is not None}
    assert got["BIG SOLES INC"] == got["BIG SOLES, INCORPORATED"] == "BIG SOLES" and got["PENA TRADING"] == got["PENA TRADING CORP"]


def test_entities(spark):
    rows = [("CITY OF X", "CITY OF X", "ACME", "ACME", 10.0), ("CITY OF X", "City of X", "ACME INC - A", "ACME INC - A", 5.0), ("CITY OF X", "City of X", "ACME INC - A", "ACME INC - A", 5.0), ("CITY OF X", "CITY OF X", "ACME INC", "ACME INC", 1.0)]
    staged = spark.createDataFrame(rows, "agency_key string, agency_raw string, supplier_raw string, supplier_key string, contract_amount double").withColumn("award_date", F.lit("2024-01-01").cast("date"))
    a = resolve.agencies(staged).collect()
    assert [(r.agency_name, r.agency_type, r.name_variants, r.award_count, r.total_value) for r in a] == [("CITY OF X", "city", 2, 4, 21.0)]
    al = resolve.supplier_aliases(staged, resolve.resolve(staged.select(F.col("supplier_key").alias("key"))))
    s = resolve.suppliers(al).collect()
    # The branch is seen more often, yet the company's own spellings come first.
    assert [(r.match_key, r.supplier_name, r.alias_count, r.award_count) for r in s] == [("ACME", "ACME", 3, 4)]


@pytest.mark.parametrize(("key", "kind"), [("BARANGAY A", "barangay"), ("MUNICIPALITY OF A", "municipality"), ("CITY OF A", "city"), ("PROVINCE OF A", "province"), ("CITYLAND", "national_or_other")])
def test_kinds(spark, key, kind):
    assert apply(spark, lambda c: resolve.type_of(c, resolve.AGENCY_KINDS, "national_or_other"), [key]) == [kind]
