"""Schemas of source files, declared and not inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = ("reference_id", "contract_no", "award_title", "notice_title", "awardee_name", "organization_name", "area_of_delivery", "business_category")


def raw_awards(binary_id: bool = False) -> T.StructType:
    """Raw award file; ``binary_id`` for files that keep the id as a 16-byte UUID, which schema inference refuses."""
    return T.StructType(
        [T.StructField("id", T.BinaryType() if binary_id else T.StringType())]
        + [T.StructField(c, T.StringType()) for c in _TEXT]
        + [T.StructField("contract_amount", T.DoubleType()), T.StructField("award_date", T.TimestampNTZType()), T.StructField("award_status", T.StringType())]
    )


def all_text(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


SEEDS = {
    "areas": all_text("token", "canonical", "kind"),
    "analysis_amounts": all_text("round_amount", "amount_kind", "note"),
    "core_thresholds": all_text("threshold", "amount", "effective_from", "effective_to", "applies_to", "legal_basis", "source"),
    "large_amount_allowlist": all_text("award_id", "reviewed_on", "evidence"),
    "supplier_pair_labels": all_text("band", "similarity", "key_a", "key_b", "label", "review_status"),
}
