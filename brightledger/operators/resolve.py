"""Deterministic, traceable entity resolution: folded keys, cleaning levels, display names."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger.functions.text import fold
from brightledger.operators.joins import keyed_join
from brightledger.operators.skew import heavy_keys

# Legal words and their short forms, the forms that level 3 drops, and the words of joint ventures.
LEGAL_WORDS = {"INCORPORATED": "INC", "CORPORATION": "CORP", "COMPANY": "CO", "LIMITED": "LTD"}
LEGAL_FORMS = "INC|CORP|CO|LTD|OPC"
BRANCH_FORMS = "INC|INCORPORATED|CORP|CORPORATION|COMPANY|LTD|LIMITED|OPC"
JOINT = r"\b(JV|JOINT VENTURE|CONSORTIUM)\b"


@F.pandas_udf(T.StructType([T.StructField("key", T.StringType()), T.StructField("confusables", T.IntegerType()), T.StructField("dropped", T.IntegerType())]))
def _fold(names: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in names:
        yield pd.DataFrame([fold(x) for x in s], columns=["key", "confusables", "dropped"])


def fold_names(df: DataFrame, column: str) -> DataFrame:
    """(raw, key, confusables, dropped) of the distinct non-null values of ``column``. The function runs on distinct names only."""
    names = df.select(F.col(column).alias("raw")).filter(F.col("raw").isNotNull()).distinct()
    f = names.withColumn("f", _fold("raw"))
    return f.select("raw", "f.key", "f.confusables", "f.dropped")


def clean(key: Column) -> Column:
    """Level 1: no punctuation, runs of single letters joined, legal words shortened."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(key, "&", " AND "), "'", ""), "[^A-Z0-9 ]", " ")
    s = F.trim(F.regexp_replace(s, " +", " "))
    s = F.regexp_replace(s, "(?<=(?:^| )[A-Z]) (?=[A-Z](?: |$))", "")
    for word, short in LEGAL_WORDS.items():
        s = F.regexp_replace(s, rf"(?<=^| ){word}(?= |$)", short)
    return s


def branch_head(key: Column) -> Column:
    """Level 2: the cleaned name before a branch suffix that follows a legal form; null for others and for joint ventures."""
    pattern = rf"^(.*\b(?:{BRANCH_FORMS})\b[.,]?)\s*-\s*\S.*$"
    head = F.regexp_extract(key, pattern, 1)
    ok = key.rlike(pattern) & ~key.rlike(JOINT) & (F.size(F.split(F.trim(head), r"\s+")) >= 2)
    return F.when(ok, clean(head))


def drop_legal_form(cleaned: Column) -> Column:
    """Level 3: trailing legal forms removed while a word is left."""
    return F.regexp_replace(cleaned, rf"( ({LEGAL_FORMS}))+$", "")


def resolve(keys: DataFrame, level: int = 3) -> DataFrame:
    """(key, clean_key, match_key, rule) for each distinct ``key``.

    A branch folds into its head only if some key's clean form is that head, which is a question to the whole set. ``rule`` names the steps
    that changed the key, joined by ``+``, or ``identical``.
    """
    k = keys.select("key").distinct().withColumn("clean_key", clean(F.col("key"))).withColumn("head", branch_head(F.col("key")) if level >= 2 else F.lit(None).cast("string"))
    parents = k.select(F.col("clean_key").alias("head")).distinct().withColumn("has_parent", F.lit(True))
    k = k.join(parents, "head", "left").withColumn("branched", F.coalesce("has_parent", F.lit(False)))
    k = k.withColumn("base", F.when(F.col("branched"), F.col("head")).otherwise(F.col("clean_key")))
    k = k.withColumn("match_key", drop_legal_form(F.col("base")) if level >= 3 else F.col("base"))
    steps = F.concat_ws("+", F.when(F.col("clean_key") != F.col("key"), "punctuation"), F.when(F.col("branched"), "branch_suffix"), F.when(F.col("match_key") != F.col("base"), "legal_form_dropped"))
    return k.select("key", "clean_key", "match_key", F.when(steps == "", "identical").otherwise(steps).alias("rule"))


def entity_id(key: Column) -> Column:
    return F.substring(F.md5(key), 1, 16)


def type_of(key: Column, kinds: list[tuple[str, list[str]]], other: str) -> Column:
    """The kind of the first listed prefix that ``key`` begins with, else ``other``."""
    out: Column | None = None
    for kind, prefixes in kinds:
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | key.startswith(p)
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise(other) if out is not None else F.lit(other)


AGENCY_KINDS = [("barangay", ["BARANGAY "]), ("municipality", ["MUNICIPALITY ", "MUNICIPAL GOVERNMENT "]), ("city", ["CITY OF ", "CITY GOVERNMENT "]), ("province", ["PROVINCE OF ", "PROVINCIAL GOVERNMENT "])]


def agencies(staged: DataFrame) -> DataFrame:
    """One row per agency key: id, most frequent spelling (ties in order), kind, spellings, awards, value, first and last day."""
    v = staged.groupBy("agency_key", "agency_raw").agg(F.count(F.lit(1)).alias("n"), F.sum("contract_amount").alias("value"), F.min("award_date").alias("d0"), F.max("award_date").alias("d1"))
    return v.groupBy("agency_key").agg(
        F.min_by("agency_raw", F.struct(-F.col("n"), F.col("agency_raw"))).alias("agency_name"), F.count(F.lit(1)).alias("name_variants"), F.sum("n").alias("award_count"),
        F.sum("value").alias("total_value"), F.min("d0").alias("first_award_date"), F.max("d1").alias("last_award_date"),
    ).select(entity_id(F.col("agency_key")).alias("agency_id"), "agency_key", "agency_name", type_of(F.col("agency_key"), AGENCY_KINDS, "national_or_other").alias("agency_type"), "name_variants", "award_count", "total_value", "first_award_date", "last_award_date")


def supplier_aliases(staged: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per supplier spelling with its keys, entity id, rule, awards and value."""
    v = staged.groupBy("supplier_raw", "supplier_key").agg(F.count(F.lit(1)).alias("award_count"), F.sum("contract_amount").alias("total_value"))
    m = matches.select(F.col("key").alias("supplier_key"), "clean_key", "match_key", entity_id(F.col("match_key")).alias("supplier_id"), "rule")
    return v.join(m, "supplier_key").select("supplier_raw", "supplier_key", "clean_key", "match_key", "supplier_id", "rule", "award_count", "total_value")


def suppliers(aliases: DataFrame) -> DataFrame:
    """One row per supplier; its name is the most frequent spelling that is not a branch's (ties in order)."""
    return aliases.groupBy("supplier_id").agg(
        F.min("match_key").alias("match_key"), F.min_by("supplier_raw", F.struct(F.col("rule").contains("branch_suffix"), -F.col("award_count"), F.col("supplier_raw"))).alias("supplier_name"),
        F.count(F.lit(1)).alias("alias_count"), F.sum("award_count").alias("award_count"), F.sum("total_value").alias("total_value"),
    )


def facts(staged: DataFrame, agencies: DataFrame, aliases: DataFrame) -> DataFrame:
    """The fact table: staged awards with the ids of their agency and supplier."""
    heavy = heavy_keys(staged, ["agency_key", "supplier_raw"], 0.01)[1]
    out = keyed_join(staged, agencies.select("agency_key", "agency_id"), "agency_key", "inner", heavy=heavy["agency_key"])
    out = keyed_join(out, aliases.select("supplier_raw", "supplier_id"), "supplier_raw", "inner", heavy=heavy["supplier_raw"])
    return out.select("award_id", "agency_id", "supplier_id", "award_date", F.year("award_date").alias("award_year"), "contract_amount", "business_category", "reference_id")
