"""Per-key results where a few keys hold most rows: two-stage aggregation with salt on the heavy keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.session import free_name

#: A key is heavy if it holds at least this share of the rows; so at most 1 / HEAVY_SHARE keys are.
HEAVY_SHARE = 0.005
#: Counters of the frequent-items sketch: its error is under 4 / TRACKED of the rows, well below HEAVY_SHARE.
TRACKED = 8192
#: Partial results that a heavy key is spread over.
SALTS = 64


def heavy_keys(df: DataFrame, keys: list[str], share: float = HEAVY_SHARE) -> tuple[int, dict[str, list]]:
    """Number of rows, and for each of ``keys`` (columns) the values that may hold ``share`` of them or more.

    One pass with a mergeable frequent-items sketch a column; what comes to the driver is bounded by 1 / share values a
    column. No heavy value is missed; a value just below may be among them. Null is never listed.
    """
    most = max(1, int(2 / share))
    found = df.agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k(cast(`{k}` as string), {most}, {TRACKED})").alias(f"k{i}") for i, k in enumerate(keys)]).first()
    n = found["n"]
    slack = 4 * n / TRACKED
    return n, {k: [x["item"] for x in (found[f"k{i}"] or []) if x["item"] is not None and x["count"] + slack >= share * n] for i, k in enumerate(keys)}


def salted(key: Column, heavy: list, salts: int = SALTS, seed: int = 7) -> Column:
    """A salt below ``salts`` for heavy and null keys, 0 for others. The seed makes a retried task repeat its salts."""
    hot = key.isNull()
    if heavy:
        hot = hot | key.cast("string").isin(heavy)
    return F.when(hot, F.floor(F.rand(seed) * salts).cast("int")).otherwise(0)


def salted_aggregate(df: DataFrame, key: str, sums: dict[str, str] | None = None, extremes: dict[str, str] | None = None, distinct: dict[str, str] | None = None, count: str = "rows", heavy: list | None = None, salts: int = SALTS) -> DataFrame:
    """One row per ``key`` (null is a key): ``count``, and named sums, (least, greatest) pairs and distinct counts of columns.

    ``sums``: name -> column, null if the key has no value; ``extremes``: name -> column, as columns least_<name> and greatest_<name>; ``distinct``: name ->
    column, counting non-null values. Rows of heavy keys (found with ``heavy_keys`` if not given) get a random salt; partial
    results are made per salt and then merged per key. For distinct counts the salt is a hash of the value, so that the
    partial counts add up. Sums of doubles may differ in their last digits with the order of the rows. An empty table has no rows.
    """
    if heavy is None:
        heavy = heavy_keys(df, [key])[1][key]
    salt = free_name(df.columns, "_salt")
    k = F.col(key)
    sums, extremes, distinct = sums or {}, extremes or {}, distinct or {}
    first = [F.count(F.lit(1)).alias(count)]
    second = [F.sum(count).alias(count)]
    for name, c in sums.items():
        first.append(F.sum(c).alias(name))
        second.append(F.sum(name).alias(name))
    for name, c in extremes.items():
        first += [F.min(c).alias(f"least_{name}"), F.max(c).alias(f"greatest_{name}")]
        second += [F.min(f"least_{name}").alias(f"least_{name}"), F.max(f"greatest_{name}").alias(f"greatest_{name}")]
    out = df.withColumn(salt, salted(k, heavy, salts)).groupBy(key, salt).agg(*first).groupBy(key).agg(*second)
    for name, c in distinct.items():
        hot = k.isNull() | (k.cast("string").isin(heavy) if heavy else F.lit(False))
        by_value = df.filter(F.col(c).isNotNull()).withColumn(salt, F.when(hot, F.pmod(F.xxhash64(c), F.lit(salts)).cast("int")).otherwise(0))
        # Distinct (key, value) pairs are made before anything meets on the key.
        pairs = by_value.select(key, salt, c).distinct() if c != key else by_value.select(key, salt).distinct()
        n = pairs.groupBy(key, salt).agg(F.count(F.lit(1)).alias(name)).groupBy(key).agg(F.sum(name).alias(name))
        other = free_name(out.columns, "_key")
        out = out.join(n.withColumnRenamed(key, other), F.col(key).eqNullSafe(F.col(other)), "left").drop(other).withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return out


def key_counts(df: DataFrame, keys: list[str], salts: int = SALTS) -> tuple[DataFrame, int]:
    """(key_name, key_value, rows) of each value of each of ``keys`` in one pass, null included, and the number of rows."""
    n, heavy = heavy_keys(df, keys)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("key_value"), F.lit(i).alias("at")) for i, k in enumerate(keys)]))
    rows = df.select(each.alias("x")).select("x.*")
    salt = F.lit(0)
    for i, k in enumerate(keys):
        salt = F.when(F.col("at") == i, salted(F.col("key_value"), heavy[k], salts, 7 + i)).otherwise(salt)
    part = rows.withColumn("_salt", salt).groupBy("key_name", "key_value", "_salt").agg(F.count(F.lit(1)).alias("rows"))
    return part.groupBy("key_name", "key_value").agg(F.sum("rows").alias("rows")), n


def dominant_keys(df: DataFrame, keys: list[str], share: float = 0.01, salts: int = SALTS) -> DataFrame:
    """(key_name, key_value) of the non-null values that alone hold more than ``share`` of all rows of ``df``.

    Counted exactly by salted two-stage aggregation over all of ``keys`` at once. An empty table has none.
    """
    counts, n = key_counts(df, keys, salts)
    return counts.filter(F.col("key_value").isNotNull() & (F.col("rows") > F.lit(share) * n)).select("key_name", "key_value")
