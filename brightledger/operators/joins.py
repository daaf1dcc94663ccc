"""Joins that Spark has no plan of its own for: ranges, effective dates, hot keys, differences."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.operators.skew import heavy_keys
from brightledger.session import free_name

#: Rows up to which the side with the ranges is broadcast; a longer one is joined by bins.
BROADCAST_ROWS = 5_000


def range_join(left: DataFrame, ranges: DataFrame, point: Column, lo: str, hi: str, equal: list[str] | None = None, how: str = "inner", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``left`` with each range (columns ``lo``, ``hi`` of ``ranges``, both ends inclusive) that holds ``point``.

    ``equal`` are column names that must agree as well; ``how`` is inner or left. ``point``, ``lo`` and ``hi`` are numbers (use days for dates). Null points and ends match
    nothing. Up to ``broadcast_rows`` ranges are broadcast. More are put in bins as wide as the next power of two over their length, so that each
    lies in two bins at most, and joined by bin.
    """
    equal = equal or []
    p = free_name([*left.columns, *ranges.columns], "_p")
    left = left.withColumn(p, point.cast("double"))
    inside = (F.col(p) >= F.col(lo)) & (F.col(p) <= F.col(hi))
    n = ranges.limit(broadcast_rows + 1).count()
    right = ranges
    renamed = {}
    for c in equal:
        renamed[c] = free_name([*left.columns, *ranges.columns], f"_{c}")
        right = right.withColumnRenamed(c, renamed[c])
    cond = inside
    for c in equal:
        cond = cond & (F.col(c) == F.col(renamed[c]))
    if n <= broadcast_rows:
        return left.join(F.broadcast(right), cond, how).drop(p, *renamed.values())
    right = right.filter(F.col(lo) <= F.col(hi)).withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col(hi) - F.col(lo), F.lit(1e-9)))).cast("int")))
    levels = sorted(r[0] for r in right.select("_level").distinct().collect())  # powers of two: some dozens at most
    size = F.pow(F.lit(2.0), F.col("_level"))
    right = right.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))))
    row = free_name([*left.columns, *ranges.columns], "_row")
    left = left.withColumn(row, F.monotonically_increasing_id()) if how == "left" else left
    binned = left.withColumn("_l", F.explode(F.array(*[F.lit(x) for x in levels])))
    binned = binned.withColumn("_b", F.floor(F.col(p) / F.pow(F.lit(2.0), F.col("_l"))))
    got = binned.join(right, (F.col("_l") == F.col("_level")) & (F.col("_b") == F.col("_bin")) & cond).drop("_l", "_b", "_level", "_bin", *renamed.values())
    if how == "left":
        got = got.unionByName(left.join(got.select(row).distinct(), row, "left_anti"), allowMissingColumns=True).drop(row)
    return got.drop(p)


def effective_join(left: DataFrame, dated: DataFrame, day: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Rows of ``left`` with the rows of ``dated`` in force on ``day``; both ends are inclusive and a null end is open."""
    days = lambda c: F.unix_date(c).cast("double")
    a, b = free_name([*left.columns, *dated.columns], "_from"), free_name([*left.columns, *dated.columns], "_to")
    d = dated.withColumn(a, days(F.col(start))).withColumn(b, F.coalesce(days(F.col(end)), F.lit(math.inf)))
    d = d.withColumn(b, F.when(F.col(b) == math.inf, F.lit(2932896.0)).otherwise(F.col(b)))  # the day 9999-12-31
    return range_join(left, d, F.unix_date(day), a, b, how=how).drop(a, b)


def keyed_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", share: float = 0.01, heavy: list | None = None) -> DataFrame:
    """``left`` with the row of ``right`` of the same ``key`` (unique in ``right``, null matches nothing), safe where a few keys hold most of ``left``.

    Rows of ``right`` for the heavy keys of ``left`` (2 / ``share`` at most) are broadcast; the rest is joined by shuffle. ``heavy``: those keys, found by a pass
    over ``left`` if not given; joins one after another take theirs from one pass over what they start from.
    """
    if heavy is None:
        heavy = heavy_keys(left, [key], share)[1][key]
    if not heavy:
        return left.join(right, key, how)
    hot = F.col(key).cast("string").isin(heavy)
    few = left.filter(hot).join(F.broadcast(right.filter(hot)), key, how)
    rest = left.filter(F.coalesce(~hot, F.lit(True))).join(right.filter(~hot), key, how)
    return few.unionByName(rest)


def differences(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Full-join difference: keys with values of both sides (``<value>_left``, ``<value>_right``) wherever any differs, null included."""
    a = left.select(*keys, *[F.col(v).alias(f"{v}_left") for v in values])
    b = right.select(*keys, *[F.col(v).alias(f"{v}_right") for v in values])
    unlike = F.lit(False)
    for v in values:
        unlike = unlike | ~F.col(f"{v}_left").eqNullSafe(F.col(f"{v}_right"))
    return a.join(b, keys, "full").filter(unlike)


def overlaps(dated: DataFrame, name: str, start: str, end: str) -> DataFrame:
    """Pairs of rows of one ``name`` whose dated ranges overlap, the earlier start first; equal starts are not compared."""
    far = F.to_date(F.lit("9999-12-31"))
    a = dated.select(F.col(name).alias("n"), F.col(start).alias("first_from"), F.coalesce(F.col(end), far).alias("first_to"))
    b = dated.select(F.col(name).alias("m"), F.col(start).alias("second_from"))
    return a.join(b, (F.col("n") == F.col("m")) & (F.col("first_from") < F.col("second_from")) & (F.col("first_to") >= F.col("second_from"))).select(F.col("n").alias(name), "first_from", "first_to", "second_from")
