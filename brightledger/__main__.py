"""The batch by command: verify, build, sample-pairs, eval-matching, export. Exit codes: 0 done, 1 a blocking check failed, 2 the snapshot is not as pinned."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.config import DEFAULT, Settings
from brightledger.operators import evaluate
from brightledger.plans import export, pipeline
from brightledger.session import written
from brightledger.sources import io

COMMANDS = ("verify", "build", "sample-pairs", "eval-matching", "export")
LEVEL = 3


class Places:
    """Where a batch reads and writes: raw files and seeds (with ``raw_manifest.json``), the build folder and the folder of published documents."""

    def __init__(self, raw: str, seeds: str, build: str, site: str, awards: str = "awards.parquet"):
        self.raw, self.seeds, self.build, self.site, self.awards = Path(raw), Path(seeds), Path(build), Path(site), awards

    @property
    def warehouse(self) -> str:
        return str(self.build / "warehouse")

    def manifest(self) -> dict:
        return io.read_manifest(self.seeds / "raw_manifest.json")

    def settings(self) -> Settings:
        return replace(DEFAULT, snapshot_day=date.fromisoformat(self.manifest()["snapshot_date"]))

    def seed(self, spark: SparkSession, name: str) -> DataFrame:
        return io.scan_seed(spark, str(self.seeds / f"{name}.csv"), name)

    def batch(self, spark: SparkSession) -> pipeline.Build:
        raw = io.scan_raw(spark, str(self.raw / self.awards), binary_id=_binary(spark, str(self.raw / self.awards)))
        return pipeline.Build(raw, *(self.seed(spark, n) for n in ("areas", "analysis_amounts", "core_thresholds", "large_amount_allowlist")), self.settings(), LEVEL)


def _binary(spark: SparkSession, path: str) -> bool:
    """Whether the file keeps its ids as 16 bytes, which Spark's schema inference refuses."""
    try:
        return dict(spark.read.parquet(path).dtypes).get("id") == "binary"
    except Exception as e:  # noqa: BLE001  refused: "Illegal Parquet type: FIXED_LEN_BYTE_ARRAY"
        if "FIXED_LEN_BYTE_ARRAY" in str(e):
            return True
        raise


class Warehouse(pipeline.Build):
    """The tables of an earlier build, read from its warehouse folder."""

    def __init__(self, spark: SparkSession, places: Places):
        self.cfg, self.level = places.settings(), LEVEL
        read = lambda name: spark.read.parquet(f"{places.warehouse}/{name}")
        t = {n: read(n) for n in json.loads((places.build / "tables.json").read_text())}
        m = pipeline.Marts(t["facts"], t["analysis_amounts"], t["thresholds"], self.cfg)
        own = {"analysis_amounts": "amounts", "large_amount_allowlist": "reviewed"}
        for name, df in t.items():
            # A table takes the place of what would make it.
            of = m.__dict__ if hasattr(pipeline.Marts, name) else self.__dict__
            of[own.get(name, name)] = df
        self.__dict__["marts"] = m


def build(spark: SparkSession, places: Places) -> int:
    b = places.batch(spark)
    io.clear(spark, places.warehouse)
    saved = {n: io.save_table(df, places.warehouse, n) for n, df in b.tables().items()}
    (places.build / "tables.json").write_text(json.dumps(sorted(saved)))
    report = pipeline.report(Warehouse(spark, places), places.settings().snapshot_day.isoformat())
    io.write_json(places.build / "dq_report.json", report)
    print("\n".join(f"{v:>20,.0f}  {k}" for k, v in report["summary"].items()))
    print("\n".join(f"{c['violations']:>20,}  {c['name']} ({'sound' if c['passed'] else c['severity']})" for c in report["checks"]))
    print("The build may be published." if report["publishable"] else "The build may not be published.")
    return 0 if report["publishable"] else 1


def sample_pairs(spark: SparkSession, places: Places) -> int:
    """Candidate pairs for labelling, and the pool they were drawn from. Labels are kept elsewhere and never overwritten."""
    b = Warehouse(spark, places)
    sample = written(evaluate.stratified_sample(evaluate.pair_pool(b.aliases, "supplier_key", "clean_key")), "sample")
    io.export_pairs(sample.select("band", F.round("similarity", 4).alias("similarity"), "key_a", "key_b").orderBy("band", "key_a", "key_b"), str(places.build / "supplier_pair_candidates.csv"))
    sizes = {r.band: r.pool_size for r in sample.select("band", "pool_size").distinct().collect()}
    bands = list(DEFAULT.bands)
    io.write_json(places.build / "supplier_pair_pool.json", {"floor": DEFAULT.similarity_floor, "bands": bands, "pool_sizes": [sizes.get(i, 0) for i in range(len(bands))], "pairs_per_band": DEFAULT.pairs_per_band})
    return 0


def matching(spark: SparkSession, places: Places, b: pipeline.Build) -> dict | None:
    """The evaluation over the labelled pairs of the seeds, None if there are none."""
    pool = places.seeds / "supplier_pair_pool.json"
    if not pool.exists() or not (places.seeds / "supplier_pair_labels.csv").exists():
        return None
    labels = places.seed(spark, "supplier_pair_labels").withColumn("band", F.col("band").cast("int"))
    sizes = io.scan_records(spark, [{"band": i, "pool_size": n} for i, n in enumerate(json.loads(pool.read_text())["pool_sizes"])], "band int, pool_size long")
    return evaluate.report(labels, sizes, LEVEL, b.supplier_names)


def eval_matching(spark: SparkSession, places: Places) -> int:
    report = matching(spark, places, Warehouse(spark, places))
    io.write_json(places.build / "matching_report.json", report)
    for level, row in (report or {"levels": {}})["levels"].items():
        print(level, " ".join(f"{k}={v}" for k, v in row.items()))
    return 0


def publish(spark: SparkSession, places: Places, area: str) -> int:
    b, report = Warehouse(spark, places), json.loads((places.build / "dq_report.json").read_text())
    try:
        sizes = export.publish(places.site, b, report, area, places.manifest(), matching(spark, places, b))
    except export.NotPublishable as e:
        print(f"Nothing is published, as these checks failed: {e}", file=sys.stderr)
        return 1
    for name, size in sizes.items():
        print(f"{size:>10,}  {name}")
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="brightledger", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    for name, default in (("raw", "data/raw"), ("seeds", "seeds"), ("build", "build"), ("site", "site/data"), ("awards", "awards.parquet"), ("area", "")):
        parser.add_argument(f"--{name}", default=default)
    a = parser.parse_args(argv)
    places = Places(a.raw, a.seeds, a.build, a.site, a.awards)
    if a.command in ("verify", "build"):
        problems = io.verify_snapshot(places.raw, places.manifest())
        if problems:
            print("\n".join(problems), file=sys.stderr)
            return 2
        if a.command == "verify":
            print("All files are as pinned.")
            return 0
    places.build.mkdir(parents=True, exist_ok=True)
    spark = spark or SparkSession.builder.appName("brightledger").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "export":
        return publish(spark, places, a.area)
    return {"build": build, "sample-pairs": sample_pairs, "eval-matching": eval_matching}[a.command](spark, places)


if __name__ == "__main__":
    sys.exit(main())
