import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from brightledger.operators import joins


@pytest.mark.parametrize("limit", [1000, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join(spark, limit, how):
    rnd = random.Random(5)
    left = [(i, rnd.choice([None, rnd.uniform(-50, 300)]), rnd.choice("ab")) for i in range(200)]
    right = [(k, rnd.choice("ab"), lo, lo + rnd.choice([0, 0.5, 3, 70])) for k in range(60) for lo in [rnd.uniform(-60, 300)]] + [(99, "a", None, 5.0), (98, "a", 9.0, 1.0)]
    a = spark.createDataFrame(left, "id int, x double, g string")
    b = spark.createDataFrame(right, "k int, g string, lo double, hi double")
    got = sorted((r.id, -1 if r.k is None else r.k) for r in joins.range_join(a, b, F.col("x"), "lo", "hi", ["g"], how, limit).collect())
    want = []
    for i, x, g in left:
        hits = [k for k, h, lo, hi in right if x is not None and lo is not None and g == h and lo <= x <= hi]
        want += [(i, k) for k in hits] or ([(i, -1)] if how == "left" else [])
    assert got == sorted(want)


def test_effective(spark):
    d = dt.date
    t = spark.createDataFrame([("t", 1.0, d(2020, 1, 1), d(2020, 12, 31)), ("t", 2.0, d(2021, 1, 1), None)], "n string, amount double, a date, b date")
    x = spark.createDataFrame([(1, d(2019, 12, 31)), (2, d(2020, 1, 1)), (3, d(2020, 12, 31)), (4, d(2021, 1, 1)), (5, d(9999, 12, 31)), (6, None)], "id int, day date")
    assert sorted((r.id, r.amount) for r in joins.effective_join(x, t, "day", "a", "b").collect()) == [(2, 1.0), (3, 1.0), (4, 2.0), (5, 2.0)]


def test_keyed_join_with_hot_key(spark):
    a = spark.createDataFrame([("hot", i) for i in range(300)] + [(None, 1), ("x", 2), ("y", 3)], "k string, v int")
    b = spark.createDataFrame([("hot", "H"), ("x", "X")], "k string, name string")
    got = joins.keyed_join(a, b, "k")
    assert got.count() == 303 and got.filter("name = 'H'").count() == 300 and got.filter("name IS NULL").count() == 2
    assert joins.keyed_join(a.limit(0), b, "k").count() == 0


def test_differences(spark):
    a = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "k int, n int")
    b = spark.createDataFrame([(1, 1), (2, 2), (4, 4)], "k int, n int")
    assert sorted((r.k, r.n_left, r.n_right) for r in joins.differences(a, b, ["k"], ["n"]).collect()) == [(2, None, 2), (3, 3, None), (4, None, 4)]
