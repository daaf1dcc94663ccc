from collections import Counter

from brightledger.operators import skew

SCHEMA = "k string, v double, w string, rows int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(n=900):
    # One key with a third of the rows, null keys and values, repeated rows, a column named like the count.
    out = [("hot", float(i % 7), f"w{i % 5}", i) for i in range(n // 3)]
    out += [(f"k{i}", None if i % 11 == 0 else 1.0, None if i % 3 == 0 else "x", 0) for i in range(n // 3)]
    return out + [(None, 2.0, "n", 1)] * (n // 3)


def test_aggregate_matches_plain(spark):
    data = rows()
    got = {r.k: r for r in skew.salted_aggregate(table(spark, data), "k", {"total": "v"}, {"v": "v"}, {"kinds": "w"}, count="n").collect()}
    assert set(got) == {r[0] for r in data}
    for k, r in got.items():
        mine = [x for x in data if x[0] == k]
        vals = [x[1] for x in mine if x[1] is not None]
        assert r.n == len(mine)
        assert r.total == (sum(vals) if vals else None)
        assert (r.least_v, r.greatest_v) == ((min(vals), max(vals)) if vals else (None, None))
        assert r.kinds == len({x[2] for x in mine if x[2] is not None})


def test_heavy_keys_finds_every_heavy_one(spark):
    n, heavy = skew.heavy_keys(table(spark, rows()), ["k"], 0.1)
    assert n == 900 and "hot" in heavy["k"] and None not in heavy["k"]


def test_dominant(spark):
    got = {(r.key_name, r.key_value) for r in skew.dominant_keys(table(spark, rows()), ["k", "w"]).collect()}
    counts = {c: Counter(r[i] for r in rows()) for c, i in (("k", 0), ("w", 2))}
    assert got == {(c, v) for c, n in counts.items() for v, m in n.items() if v is not None and m > 9}


def test_share_is_more_than(spark):
    df = spark.createDataFrame([("a",)] + [(f"k{i}",) for i in range(99)], "k string")
    assert skew.dominant_keys(df, ["k"]).count() == 0  # one in a hundred is not more than that


def test_empty(spark):
    e = table(spark, [])
    assert skew.salted_aggregate(e, "k", {"t": "v"}, distinct={"d": "w"}).count() == 0
    assert skew.dominant_keys(e, ["k", "w"]).count() == 0


def test_hot_key_is_split(spark):
    df = table(spark, rows())
    heavy = skew.heavy_keys(df, ["k"])[1]["k"]
    salts = df.filter("k = 'hot'").select(skew.salted(df["k"], heavy).alias("s")).distinct().count()
    assert salts > 16
