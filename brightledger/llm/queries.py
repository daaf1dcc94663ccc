"""Queries of the operators for training data, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.canon import map_values
from brightledger.llm.dupes import find_copies, keyed, keyed_lines
from brightledger.llm.leaks import find_leaks
from brightledger.llm.names import link_names, spelling_pairs, stacked
from brightledger.llm.sentences import split_sentences
from brightledger.llm.tokens import encode_texts
from brightledger.plans.core_queries import area_values
from brightledger.session import table, written


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    areas = table(spark, folder, "areas")
    values = area_values(spark, folder).join(areas.select(F.col("token").alias("area_value")).distinct(), "area_value", "left_anti").select("id", "area_value")
    values = written(values, "values")
    means = map_values(values, "area_value", areas)
    return values.join(means.withColumnRenamed("value", "area_value"), "area_value").select("id", "canonical").distinct()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["award_title", "awardee_name"]
    awards, lines = table(spark, folder, "raw_awards"), table(spark, folder, "award_lines")
    rows = awards.count() + lines.count()
    records = keyed(awards, "id", fields, "contract_amount", "raw_awards").unionByName(keyed_lines(lines, "line_id", "line_text", fields, "contract_amount", "award_lines"))
    return find_copies(records, rows=rows)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_pairs(stacked(table(spark, folder, "raw_awards"), ["awardee_name", "organization_name"])).withColumnRenamed("field", "field_name")


def p6_entities(spark: SparkSession, folder: str) -> DataFrame:
    return link_names(stacked(table(spark, folder, "raw_awards"), ["awardee_name", "organization_name"])).withColumnRenamed("field", "field_name")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_sentences(table(spark, folder, "documents"))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p6_found": p6_found, "p6_entities": p6_entities, "p7_ids": p7_ids, "p8_found": p8_found, "p9_found": p9_found}

def _part(label: str) -> str:
    """SQL of the value of ``label`` in a line of text; quotes and signs around it do not matter to the comparison."""
    others = "|".join(x for x in ("award_title", "awardee_name", "contract_amount") if x != label)
    plain = rf"""regexp_extract(line_text, '(?is){label}["'']?\s*[:=]\s*(.*?)\s*(?:[;|,\t]\s*["'']?(?:{others})["'']?\s*[:=]|$)', 1)"""
    clean = "regexp_replace(line_text, '[[:cntrl:]]', ' ', 'g')"
    return f"CASE WHEN json_valid({clean}) THEN json_extract_string({clean}, '$.{label}') ELSE {plain} END"


def _canon(c: str) -> str:
    return rf"regexp_replace(lower(nfc_normalize({c})), '[^\p{{L}}\p{{M}}\p{{N}}]', '', 'g')"


ORACLES: dict[str, str] = {
    "p3_found": rf"""WITH r AS (SELECT 'raw' AS src, id AS k, award_title AS t, awardee_name AS n, contract_amount AS a FROM raw_awards
        UNION ALL SELECT 'line', line_id, {_part("award_title")}, {_part("awardee_name")}, TRY_CAST(regexp_replace({_part("contract_amount")}, '[^0-9.eE+-]', '', 'g') AS DOUBLE) FROM award_lines),
        g AS (SELECT *, min(k) OVER (PARTITION BY src, {_canon("t")}, {_canon("n")}, a) AS keep FROM r
            WHERE a IS NOT NULL AND regexp_matches(t, '\S') AND regexp_matches(n, '\S'))
        SELECT keep AS keep_id, k AS copy_id FROM g WHERE k <> keep""",
}
