"""Queries of the general data-processing operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.operators.packed import unpack
from brightledger.operators.profile import find_issues, profile_columns
from brightledger.operators.skew import dominant_keys, salted_aggregate
from brightledger.session import table

def area_values(spark: SparkSession, folder: str) -> DataFrame:
    """(id, pos, area_value, pieces): each single value of area_of_delivery."""
    raw = table(spark, folder, "raw_awards").select("id", "load_id", "area_of_delivery")
    return unpack(raw, "area_of_delivery", table(spark, folder, "areas").select("token"), "load_id", value="area_value").select("id", "pos", "area_value", "pieces")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return dominant_keys(table(spark, folder, "core_awards"), ["agency_id", "supplier_id"], 0.01)


def _totals(spark: SparkSession, folder: str, key: str, other: str) -> DataFrame:
    core = table(spark, folder, "core_awards")
    out = salted_aggregate(core, key, {"total": "contract_amount"}, {"date": "award_date"}, {"others": other}, count="awards")
    return out.select(key, "awards", F.round("total", 2).alias("total_value"), "least_date", "greatest_date", F.col("others").alias("partners"))


def p1_by_agency(spark: SparkSession, folder: str) -> DataFrame:
    return _totals(spark, folder, "agency_id", "supplier_id")


def p1_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    return _totals(spark, folder, "supplier_id", "agency_id")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return area_values(spark, folder).filter("pieces > 1").select("id", "pos", "area_value")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_issues(table(spark, folder, "raw_awards"))


def p5_violations(spark: SparkSession, folder: str) -> DataFrame:
    return p5_found(spark, folder).filter("issue = 'violation'")


def p5_profile(spark: SparkSession, folder: str) -> DataFrame:
    out = profile_columns(table(spark, folder, "raw_awards"), ["contract_amount", "award_date", "reference_id"])
    shown = lambda c: F.when(F.col("column_name") == "contract_amount", F.format_string("%.2f", F.col(c).try_cast("double"))).otherwise(F.substring(c, 1, 10))
    return out.withColumn("least", shown("least")).withColumn("greatest", shown("greatest"))


QUERIES = {"p1_found": p1_found, "p1_by_agency": p1_by_agency, "p1_by_supplier": p1_by_supplier, "p4_found": p4_found, "p5_found": p5_found, "p5_violations": p5_violations, "p5_profile": p5_profile}


def _totals_sql(key: str, other: str) -> str:
    return f"""SELECT {key}, count(*) AS awards, round(sum(contract_amount), 2) AS total_value, min(award_date) AS least_date,
        max(award_date) AS greatest_date, count(DISTINCT {other}) AS partners FROM core_awards GROUP BY {key}"""


_PROFILE = """SELECT '{c}' AS column_name, (SELECT count(*) FROM raw_awards) AS rows, (SELECT count(*) FROM raw_awards) - count(v) AS missing,
    count(DISTINCT v) AS distinct_values, {lo} AS least, {hi} AS greatest FROM (SELECT {v} AS v FROM raw_awards)"""

_SHOWN = "CASE WHEN isnan({0}) THEN 'NaN' ELSE printf('%.2f', {0}) END"

_SHAPE = r"regexp_replace(regexp_replace(reference_id, '\p{Nd}', '9', 'g'), '\p{L}', 'A', 'g')"

ORACLES = {
    "p5_violations": f"""WITH f AS (SELECT {_SHAPE} AS form, count(*) AS n FROM raw_awards WHERE trim(reference_id) <> '' GROUP BY 1)
        SELECT 'contract_amount' AS column_name, 'violation' AS issue, id AS item FROM raw_awards WHERE isnan(contract_amount) OR contract_amount < 1 OR contract_amount > 1e10
        UNION ALL SELECT 'award_date', 'violation', id FROM raw_awards WHERE award_date::DATE < DATE '2006-01-01' OR award_date::DATE > loaded_at::DATE
        UNION ALL SELECT 'reference_id', 'violation', id FROM raw_awards JOIN f ON n >= 0.9 * (SELECT sum(n) FROM f) WHERE trim(reference_id) <> '' AND {_SHAPE} <> form""",
    "p1_found": """SELECT 'agency_id' AS key_name, agency_id AS key_value FROM core_awards WHERE agency_id IS NOT NULL GROUP BY agency_id
        HAVING count(*) > 0.01 * (SELECT count(*) FROM core_awards)
        UNION ALL SELECT 'supplier_id', supplier_id FROM core_awards WHERE supplier_id IS NOT NULL GROUP BY supplier_id
        HAVING count(*) > 0.01 * (SELECT count(*) FROM core_awards)""",
    "p1_by_agency": _totals_sql("agency_id", "supplier_id"),
    "p1_by_supplier": _totals_sql("supplier_id", "agency_id"),
    "p5_profile": _PROFILE.format(c="contract_amount", v="contract_amount", lo=_SHOWN.format("min(v)"), hi=_SHOWN.format("max(v)"))
    + " UNION ALL "
    + _PROFILE.format(c="award_date", v="award_date", lo="strftime(min(v), '%Y-%m-%d')", hi="strftime(max(v), '%Y-%m-%d')")
    + " UNION ALL "
    + _PROFILE.format(c="reference_id", v="CASE WHEN trim(reference_id) <> '' THEN reference_id END", lo="substr(min(v), 1, 10)", hi="substr(max(v), 1, 10)"),
}
