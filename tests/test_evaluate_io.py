import json

import pytest
from pyspark.sql import functions as F

from brightledger.operators import evaluate
from brightledger.sources import io


def test_metrics(spark):
    labels = spark.createDataFrame(
        [(0, "ACME INC", "ACME CORP", "same"), (0, "RED", "RED CO", "different"), (0, "BLUE", "BLUES", "same"), (0, "X", "Y", "unsure"), (1, "ONE", "TWO", "different")],
        "band int, key_a string, key_b string, label string",
    )
    sizes = spark.createDataFrame([(0, 400), (1, 20)], "band int, pool_size int")
    got = {r.level: r for r in evaluate.evaluate(labels, sizes).collect()}
    assert (got[1].tp, got[1].fp, got[1].fn, got[1].tn, got[1].precision) == (0, 0, 2, 2, None)
    assert (got[3].tp, got[3].fp, got[3].fn, got[3].tn, got[3].precision, got[3].recall) == (1, 1, 1, 1, 0.5, 0.5)
    assert got[3].weighted_recall == pytest.approx(0.5) and got[3].weighted_precision == pytest.approx(0.5) and got[1].weighted_precision is None
    report = evaluate.report(labels, sizes, 3)
    assert (report["labelled_pairs"], report["usable_pairs"], report["unsure_pairs"], report["level_in_use"]) == (5, 4, 1, 3)
    assert report["levels"]["3"]["tp"] == 1 and report["pool_sizes"] == {"0": 400, "1": 20}


def test_branches_are_decided_by_all_keys(spark):
    labels = spark.createDataFrame([(0, "ACME INC - NAGA", "ACME INCORPORATED - CEBU", "same")], "band int, key_a string, key_b string, label string")
    sizes = spark.createDataFrame([(0, 5)], "band int, pool_size int")
    keys = spark.createDataFrame([("ACME, INC.",)], "key string")
    assert [r.tp for r in evaluate.evaluate(labels, sizes, keys=keys).orderBy("level").collect()] == [0, 1, 1]
    assert [r.tp for r in evaluate.evaluate(labels, sizes).orderBy("level").collect()] == [0, 0, 0]


def test_pool_and_sample(spark):
    names = spark.createDataFrame([(x,) for x in ("ACME TRADING", "ACME TRADIMG", "ACME TRADING", "AB ONE", "AB ONF", "", None, "ZED")], "n string")
    pool = evaluate.pair_pool(names, "n")
    assert [(r.key_a, r.key_b) for r in pool.collect()] == [("ACME TRADIMG", "ACME TRADING")]
    s = evaluate.stratified_sample(pool).collect()
    assert len(s) == 1 and s[0].pool_size == 1
    assert evaluate.pair_pool(names.limit(0), "n").count() == 0
    keys = spark.createDataFrame([("B-ACME", "ACME TRADING"), ("A-ACME", "ACME TRADIMG"), ("X", None)], "k string, n string")
    assert [(r.key_a, r.key_b) for r in evaluate.pair_pool(keys, "k", "n").collect()] == [("A-ACME", "B-ACME")]


def test_hot_first_word_is_split(spark, monkeypatch):
    names = spark.createDataFrame([(f"ACME {a}{b}",) for a in "ABCDEFGH" for b in "ABCDEFGH"], "n string")
    want = sorted(map(tuple, evaluate.pair_pool(names, "n").collect()))
    monkeypatch.setattr(evaluate, "BLOCK_POINTS", 5)
    assert sorted(map(tuple, evaluate.pair_pool(names, "n").collect())) == want and len(want) > 500


def test_sample_is_stable_and_bounded(spark):
    pool = spark.range(500).select(F.concat(F.lit("a"), "id").alias("key_a"), F.lit("z").alias("key_b"), (0.8 + (F.col("id") % 20) / 100).alias("similarity"))
    a, b = (sorted(map(tuple, evaluate.stratified_sample(p, 7).collect())) for p in (pool, pool.repartition(7)))
    assert a == b and all(n <= 7 for n in __import__("collections").Counter(x[0] for x in a).values())


def test_uuid_scan(spark, tmp_path):
    import uuid

    import pyarrow as pa
    import pyarrow.parquet as pq

    u = uuid.UUID("00000000-0000-0000-0000-000000000001")
    t = pa.table({"id": pa.array([u.bytes], pa.binary(16)), "reference_id": ["r"], "contract_amount": [1.0]})
    pq.write_table(t, tmp_path / "x.parquet")
    assert io.scan_raw(spark, str(tmp_path / "x.parquet"), True, "raw_v").first().id == str(u)
    assert spark.sql("SELECT count(*) FROM raw_v").first()[0] == 1


def test_seeds_and_records(spark, tmp_path):
    (tmp_path / "t.csv").write_text("threshold,amount,effective_from,effective_to,applies_to,legal_basis,source\np,100,2020-01-01,,a,b,c\n")
    r = io.scan_seed(spark, str(tmp_path / "t.csv"), "core_thresholds").first()
    assert (r.amount, r.effective_to) == ("100", None)
    assert io.scan_records(spark, [{"a": 1}, {"b": "x"}], "a int, b string").count() == 2


def test_snapshot(tmp_path):
    f = tmp_path / "a.bin"
    f.write_bytes(b"abc")
    pinned = {"files": {"a.bin": {"bytes": 3, "sha256": io.sha256(f)}}}
    assert io.verify_snapshot(tmp_path, pinned) == []
    f.write_bytes(b"abd")
    assert len(io.verify_snapshot(tmp_path, pinned)) == 1
    f.write_bytes(b"ab")
    assert "another size" in io.verify_snapshot(tmp_path, pinned)[0]
    f.unlink()
    assert "missing" in io.verify_snapshot(tmp_path, pinned)[0]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string").withColumn("d", F.lit("2024-01-01").cast("date"))
    (tmp_path / "old.json").write_text("{}")
    sizes = io.export_json(tmp_path, {"rows": df.orderBy("n"), "cols": io.Columns(df.orderBy("n")), "mixed": {"z": [1, df.limit(0)], "a": {"b": None}}})
    assert set(sizes) == {"rows.json", "cols.json", "mixed.json"} and not (tmp_path / "old.json").exists()
    assert all((tmp_path / n).stat().st_size == size for n, size in sizes.items())
    assert (tmp_path / "mixed.json").read_text() == '{"a":{"b":null},"z":[1,[]]}\n'
    assert json.loads((tmp_path / "rows.json").read_text()) == [{"d": "2024-01-01", "n": 1, "s": "a"}, {"d": "2024-01-01", "n": 2, "s": None}]
    assert json.loads((tmp_path / "cols.json").read_text()) == {"d": ["2024-01-01"] * 2, "n": [1, 2], "s": ["a", None]}
    assert io.write_json(tmp_path / "many.json", spark.range(150_000).orderBy("id")) > 1_000_000


def test_save_table(spark, tmp_path):
    df = io.save_table(spark.range(3), str(tmp_path), "t")
    assert df.count() == 3 and io.save_table(spark.range(2), str(tmp_path), "t").count() == 2
