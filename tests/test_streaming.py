import datetime as dt

from pyspark.sql import functions as F

from brightledger.streaming import staging


def test_stream(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 1.0, t), ("a", 1.0, t), ("b", 0.0, t), (None, None, t)]
    spark.createDataFrame(rows, "k string, v double, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, v double, ts timestamp").parquet(str(tmp_path / "in"))
    out = staging.tag_stream(staging.drop_stream_duplicates(stream, "ts", "1 hour", ["k", "v"]), [("missing", F.col("v").isNull()), ("small", F.col("v") < 1)])
    q = out.writeStream.format("memory").queryName("tagged").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = sorted((r.k or "", r.rule or "") for r in spark.sql("SELECT k, rule FROM tagged").collect())
    assert got == [("", "missing"), ("a", ""), ("b", "small")]
