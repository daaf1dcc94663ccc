"""Quality of entity matching: candidate pairs, stratified sample, precision and recall by level."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger.config import DEFAULT
from brightledger.functions.text import jaro_winkler_pairs
from brightledger.operators.resolve import resolve


@F.pandas_udf(T.DoubleType())
def similarity(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series(jaro_winkler_pairs(a.tolist(), b.tolist()))


#: Names of one first word that one task compares with all others of it.
BLOCK_POINTS = 2000


def pair_pool(names: DataFrame, key: str, cleaned: str | None = None, floor: float = DEFAULT.similarity_floor, least_block: int = 3) -> DataFrame:
    """(key_a, key_b, similarity), key_a < key_b: keys whose cleaned forms share a first word of ``least_block`` letters or more and have Jaro-Winkler ``floor`` or more.

    ``cleaned`` names the column of cleaned forms (the key itself if not given), one for each key. A pair is compared only if the lengths allow the
    floor at all. A first word with very many names is spread over several tasks. Null and empty names are in no pair.
    """
    k = names.select(F.col(key).alias("key"), F.col(cleaned or key).alias("name")).filter(F.length("name") > 0).groupBy("key").agg(F.min("name").alias("name"))
    k = k.withColumn("block", F.split_part("name", F.lit(" "), F.lit(1))).filter(F.length("block") >= least_block)
    sizes = k.groupBy("block").agg(F.ceil(F.count("*") / BLOCK_POINTS).cast("int").alias("parts")).filter("parts > 1")
    k = k.join(sizes, "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    a = k.select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("key").alias("key_a"), F.col("name").alias("na"))
    b = k.select("block", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), F.col("key").alias("key_b"), F.col("name").alias("nb"))
    short, long = F.least(F.length("na"), F.length("nb")), F.greatest(F.length("na"), F.length("nb"))
    most = (2 + F.try_divide(short, long)) / 3  # Jaro if all letters of the shorter match in order
    pairs = a.join(b, ["block", "part"]).filter(F.col("key_a") < F.col("key_b")).filter(most + 0.4 * (1 - most) >= floor)
    return pairs.withColumn("similarity", similarity("na", "nb")).filter(F.col("similarity") >= floor).select("key_a", "key_b", "similarity")


def band_of(column: str = "similarity", bands: tuple[tuple[float, float], ...] = DEFAULT.bands):
    """Index of the half-open band that holds the similarity, null if none does."""
    out = None
    for i, (lo, hi) in enumerate(bands):
        hit = (F.col(column) >= lo) & (F.col(column) < hi)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def stratified_sample(pool: DataFrame, per_band: int = DEFAULT.pairs_per_band, bands: tuple[tuple[float, float], ...] = DEFAULT.bands) -> DataFrame:
    """(band, key_a, key_b, similarity, pool_size): of each band the first ``per_band`` pairs in order of their digest, the same each time.

    The sample is the feature; sizes are of the whole bands.
    """
    p = pool.withColumn("band", band_of("similarity", bands)).filter(F.col("band").isNotNull()).withColumn("digest", F.md5(F.concat_ws("\x1f", "key_a", "key_b")))
    # Partial first: the least digests of each input partition, so no band meets whole on one task.
    part = Window.partitionBy("band", "slice").orderBy("digest")
    p = p.withColumn("slice", F.substring("digest", 1, 2))
    first = p.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= per_band).drop("r")
    top = first.withColumn("r", F.row_number().over(Window.partitionBy("band").orderBy("digest"))).filter(F.col("r") <= per_band)
    sizes = p.groupBy("band").agg(F.count(F.lit(1)).alias("pool_size"))
    return top.join(F.broadcast(sizes), "band").select("band", "key_a", "key_b", "similarity", "pool_size")


def evaluate(labels: DataFrame, sizes: DataFrame, levels: tuple[int, ...] = (1, 2, 3), keys: DataFrame | None = None) -> DataFrame:
    """(level, tp, fp, fn, tn, precision, recall, weighted_precision, weighted_recall): the matcher against labelled pairs.

    ``labels``: band, key_a, key_b, label (same, different, unsure; unsure pairs are not scored); ``sizes``: band, pool_size. A pair weighs its band's
    size over the band's labelled pairs, unsure ones included. Ratios without a denominator are null. ``keys`` (column key) is the set that decides about branches.
    """
    own = labels.select(F.col("key_a").alias("key")).unionByName(labels.select(F.col("key_b").alias("key")))
    all_keys = own if keys is None else own.unionByName(keys.select("key"))
    weight = labels.groupBy("band").agg(F.count(F.lit(1)).alias("sampled")).join(sizes, "band").select("band", (F.col("pool_size") / F.col("sampled")).alias("w"))
    scored = labels.filter(F.col("label").isin("same", "different")).join(weight, "band", "left")
    out = None
    for level in levels:
        m = resolve(all_keys, level).select("key", "match_key").join(own.distinct(), "key", "left_semi")
        j = scored.join(m.withColumnsRenamed({"key": "key_a", "match_key": "ma"}), "key_a").join(m.withColumnsRenamed({"key": "key_b", "match_key": "mb"}), "key_b")
        same, hit = F.col("label") == "same", F.col("ma") == F.col("mb")
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("w"))), F.lit(0.0))
        ratio = lambda a, b: F.try_divide(a, F.nullif(b, F.lit(0.0)))
        r = j.agg(
            F.count_if(same & hit).alias("tp"), F.count_if(~same & hit).alias("fp"), F.count_if(same & ~hit).alias("fn"), F.count_if(~same & ~hit).alias("tn"),
            total(same & hit).alias("wtp"), total(hit).alias("wh"), total(same).alias("wp"),
        ).select(
            F.lit(level).alias("level"), "tp", "fp", "fn", "tn", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
            ratio("wtp", F.col("wh")).alias("weighted_precision"), ratio("wtp", F.col("wp")).alias("weighted_recall"),
        )
        out = r if out is None else out.unionByName(r)
    return out


def report(labels: DataFrame, sizes: DataFrame, level_in_use: int, keys: DataFrame | None = None) -> dict:
    """The evaluation as one document: counts of labelled, usable and unsure pairs, each level's figures, the pool and the level in use."""
    usable = F.count_if(F.col("label").isin("same", "different"))
    n = labels.agg(F.count(F.lit(1)).alias("labelled"), usable.alias("usable")).first()
    levels = {str(r.level): {k: v for k, v in r.asDict().items() if k != "level"} for r in evaluate(labels, sizes, keys=keys).orderBy("level").collect()}
    pool = {str(r.band): r.pool_size for r in sizes.orderBy("band").collect()}
    return {"labelled_pairs": n.labelled, "usable_pairs": n.usable, "unsure_pairs": n.labelled - n.usable, "levels": levels, "pool_sizes": pool, "level_in_use": level_in_use}
