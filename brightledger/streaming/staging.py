"""Staging of a stream of raw records: the first failing rule and duplicates, as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from brightledger.operators.staging import content_hash, first_rule


def tag_stream(stream: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """``stream`` with the name of the first rule that each record fails (null: none). Stateless."""
    return stream.withColumn("rule", first_rule(rules))


def drop_stream_duplicates(stream: DataFrame, time: str, delay: str, columns: list[str]) -> DataFrame:
    """The first record of each content within ``delay`` of event time; state older than the watermark is let go."""
    return stream.withWatermark(time, delay).withColumn("content_hash", content_hash(columns)).dropDuplicatesWithinWatermark(["content_hash"])
