"""Scans and sinks: Parquet and CSV sources, snapshot verification, tables, views, and JSON and CSV exports."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger import schemas

_UUID = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"


def scan_raw(spark: SparkSession, path: str, binary_id: bool = False, view: str | None = None) -> DataFrame:
    """Raw awards with the declared schema; a binary UUID comes out as its usual text. ``view`` registers a temporary view."""
    df = spark.read.schema(schemas.raw_awards(binary_id)).parquet(path)
    if binary_id:
        df = df.withColumn("id", F.regexp_replace(F.lower(F.hex("id")), _UUID, "$1-$2-$3-$4-$5"))
    if view:
        df.createOrReplaceTempView(view)
    return df


def scan_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A seed CSV with header, every column text, blank cells null."""
    return spark.read.schema(schemas.SEEDS[name]).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def scan_records(spark: SparkSession, rows: Iterable[dict], schema: T.StructType | str) -> DataFrame:
    """Rows computed outside Spark, with an explicit schema."""
    s = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in s.fields) for r in rows], s)


def scan_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, null left out; stays distributed."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def sha256(path: str | Path, block: int = 1 << 20) -> str:
    """Digest of a file, read block by block."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while data := f.read(block):
            h.update(data)
    return h.hexdigest()


def verify_snapshot(folder: str | Path, manifest: dict) -> list[str]:
    """What is wrong with the files of ``manifest`` ({"files": {name: {"bytes", "sha256"}}}); empty if all are as pinned."""

    def fault(path: Path, pinned: dict) -> str | None:
        tests = (("missing", path.is_file), ("another size", lambda: path.stat().st_size == pinned["bytes"]), ("another digest", lambda: sha256(path) == pinned["sha256"]))
        return next((word for word, holds in tests if not holds()), None)

    found = {name: fault(Path(folder) / name, pinned) for name, pinned in manifest["files"].items()}
    return [f"{name}: {word}" for name, word in sorted(found.items()) if word]


def read_manifest(path: str | Path) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def save_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes ``df`` as a table of the warehouse folder, replacing it, and reads it back."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession, folder: str) -> None:
    """Removes a warehouse folder, so that a build starts afresh."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


class Columns:
    """A result to be written as one array per column, which is shorter than row objects. Its rows must be in a total order."""

    def __init__(self, df: DataFrame):
        self.df = df


def _plain(v: object) -> object:
    return v if v is None or isinstance(v, (bool, int, float, str)) else str(v)


def _pieces(data: object) -> Iterator[str]:
    """Compact JSON with sorted keys, piece by piece; a data frame is an array of row objects, read part by part."""
    if isinstance(data, DataFrame):
        yield "["
        for i, r in enumerate(data.toLocalIterator()):
            yield ("," if i else "") + json.dumps({k: _plain(v) for k, v in r.asDict().items()}, sort_keys=True, separators=(",", ":"))
        yield "]"
    elif isinstance(data, Columns):
        yield "{"
        for k, c in enumerate(sorted(data.df.columns)):
            yield ("," if k else "") + json.dumps(c) + ":["
            for i, r in enumerate(data.df.toLocalIterator()):
                yield ("," if i else "") + json.dumps(_plain(r[c]))
            yield "]"
        yield "}"
    elif isinstance(data, dict):
        yield "{"
        for i, (k, v) in enumerate(sorted((str(k), v) for k, v in data.items())):
            yield ("," if i else "") + json.dumps(k) + ":"
            yield from _pieces(v)
        yield "}"
    elif isinstance(data, (list, tuple)):
        yield "["
        for i, v in enumerate(data):
            yield "," if i else ""
            yield from _pieces(v)
        yield "]"
    else:
        yield json.dumps(_plain(data))


def write_json(path: str | Path, data: object) -> int:
    """Writes compact sorted JSON and returns its size in bytes. Data frames in ``data`` may be of any length: they are streamed."""
    n = 0
    with open(path, "wb") as f:
        for piece in chain(_pieces(data), "\n"):
            n += f.write(piece.encode())
    return n


def export_json(folder: str | Path, parts: dict[str, object]) -> dict[str, int]:
    """Writes ``parts`` (name to data) as JSON files, removes files of earlier exports first, and returns names and sizes."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    for old in folder.glob("*.json"):
        old.unlink()
    return {f"{name}.json": write_json(folder / f"{name}.json", data) for name, data in sorted(parts.items())}


def export_pairs(df: DataFrame, path: str) -> None:
    """Candidate pairs for labelling: a CSV with an empty label and the status ``unreviewed``."""
    df.withColumn("label", F.lit("")).withColumn("review_status", F.lit("unreviewed")).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
