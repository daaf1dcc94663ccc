"""Raw records to staged ones: typing, content hash, duplicate flag, first failing rule, quarantine, area tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.config import DEFAULT, Settings
from brightledger.operators.joins import keyed_join
from brightledger.operators.skew import heavy_keys

CONTENT = ("reference_id", "contract_no", "award_title", "notice_title", "agency_raw", "supplier_raw", "area_raw", "business_category", "contract_amount", "award_date")


def blank_to_null(c: str) -> Column:
    """A text without outer blanks, null if nothing is left."""
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def typed(raw: DataFrame) -> DataFrame:
    """Raw awards with blanks as nulls, dates as days, and the names the later steps use.

    An amount that is no number (NaN) is missing: the row stays and counts, and sums are of the others.
    """
    return raw.select(
        F.col("id").cast("string").alias("award_id"),
        *[blank_to_null(c).alias(c) for c in ("reference_id", "contract_no", "award_title", "notice_title")],
        F.col("organization_name").alias("agency_raw"), F.col("awardee_name").alias("supplier_raw"), blank_to_null("area_of_delivery").alias("area_raw"),
        "business_category", F.nanvl("contract_amount", F.lit(None).cast("double")).alias("contract_amount"), F.to_date("award_date").alias("award_date"),
    )


def content_hash(columns: tuple[str, ...] | list[str] = CONTENT) -> Column:
    """Digest of the columns' texts; null and the empty text count alike, and a separator keeps neighbours apart."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def flag_duplicates(df: DataFrame, key: str = "award_id", columns: tuple[str, ...] | list[str] = CONTENT, heavy: list | None = None) -> DataFrame:
    """``df`` with ``content_hash``, ``keep_id`` (the smallest key of the equal records) and ``is_duplicate``.

    Group minima are made with partial aggregation and joined back with hot groups broadcast, so a record delivered a
    billion times ends in no single task.
    """
    hashed = df if "content_hash" in df.columns else df.withColumn("content_hash", content_hash(columns))
    keep = hashed.groupBy("content_hash").agg(F.min(key).alias("keep_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    out = keyed_join(hashed, keep, "content_hash", heavy=heavy)
    return out.withColumn("keep_id", F.coalesce("keep_id", key)).withColumn("is_duplicate", ~F.col(key).eqNullSafe(F.col("keep_id")))


def first_rule(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule whose condition holds, null if none does."""
    out: Column | None = None
    for name, bad in rules:
        out = F.when(bad, name) if out is None else out.when(bad, name)
    return out if out is not None else F.lit(None).cast("string")


def award_rules(cfg: Settings = DEFAULT) -> list[tuple[str, Column]]:
    """Rules of staging in order: duplicates before values. Needs ``is_reviewed``, ``agency_key`` and ``supplier_key``."""
    a, d = F.col("contract_amount"), F.col("award_date")
    return [
        ("exact_duplicate", F.col("is_duplicate")),
        ("missing_award_date", d.isNull()),
        ("award_date_before_first_day", d < F.lit(cfg.first_day)),
        ("award_date_after_snapshot", d > F.lit(cfg.snapshot_day)),
        ("amount_too_small", a.isNull() | (a < cfg.least_amount)),
        ("amount_too_large_unreviewed", (a > cfg.large_amount) & ~F.col("is_reviewed")),
        ("empty_name", (F.col("agency_key") == "") | (F.col("supplier_key") == "")),
    ]


def ruled(df: DataFrame, agency_keys: DataFrame, supplier_keys: DataFrame, reviewed: DataFrame | None = None, cfg: Settings = DEFAULT) -> DataFrame:
    """Typed awards with the duplicate flag, name keys and the first rule each fails (null: none).

    ``agency_keys`` and ``supplier_keys``: (raw, key) of the distinct names; a null name has the empty key. ``reviewed`` (award_id) lists large amounts that were
    looked at.
    """
    df = df.withColumn("content_hash", content_hash())
    heavy = heavy_keys(df, ["content_hash", "agency_raw", "supplier_raw"], 0.01)[1]
    out = flag_duplicates(df, heavy=heavy["content_hash"])
    for side, keys in (("agency", agency_keys), ("supplier", supplier_keys)):
        out = keyed_join(out, keys.select(F.col("raw").alias(f"{side}_raw"), F.col("key").alias(f"{side}_key")), f"{side}_raw", heavy=heavy[f"{side}_raw"]).withColumn(f"{side}_key", F.coalesce(f"{side}_key", F.lit("")))
    if reviewed is None:
        out = out.withColumn("is_reviewed", F.lit(False))
    else:
        out = out.join(reviewed.select("award_id").distinct().withColumn("is_reviewed", F.lit(True)), "award_id", "left").withColumn("is_reviewed", F.coalesce("is_reviewed", F.lit(False)))
    return out.withColumn("rule", first_rule(award_rules(cfg))).drop("is_reviewed", "keep_id")


def quarantine(ruled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rejected with their rule, kept without); nothing is lost."""
    return ruled.filter(F.col("rule").isNotNull()).drop("is_duplicate"), ruled.filter(F.col("rule").isNull()).drop("is_duplicate", "rule")


def exploded(df: DataFrame, key: str, packed: str, listed: DataFrame, sign: str = ",") -> DataFrame:
    """(key, token, area_name, kind, is_known), distinct: tokens of a packed column with their listed names; an empty name is null."""
    tokens = df.filter(F.col(packed).isNotNull()).select(key, F.explode(F.split(packed, sign)).alias("token")).withColumn("token", F.trim("token"))
    seeds = listed.select("token", F.nullif("canonical", F.lit("")).alias("area_name"), "kind", F.lit(True).alias("is_known"))
    return tokens.join(seeds, "token", "left").select(key, "token", "area_name", "kind", F.coalesce("is_known", F.lit(False)).alias("is_known")).distinct()


def duplicate_profile(flagged: DataFrame) -> DataFrame:
    """Raw and duplicate rows and value by year; the null year is a group."""
    d = F.col("is_duplicate")
    return flagged.groupBy(F.year("award_date").alias("award_year")).agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(d).alias("duplicate_rows"), F.sum("contract_amount").alias("raw_value"),
        F.coalesce(F.sum(F.when(d, F.col("contract_amount"))), F.lit(0.0)).alias("duplicate_value"),
    )
