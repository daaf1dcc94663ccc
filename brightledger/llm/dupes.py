"""Records that are the same but for formatting: one kept record per group, with the number of copies.

Each record has a canonical text (letters and digits of its fields, case folded) and a hash of it, made once. Every partition
makes two Bloom filters of its hashes, of those it has seen and of those it has seen twice, cut in segments; a hash probes one
segment only, so segments are merged where they meet, whatever their number: bits set in two partitions' first filters
count as seen twice. The merged second filter holds every hash that occurs twice (and a few others). If it is too large to
be broadcast it is folded: segments are laid upon one another, which lets some more records through but none fewer. Only records whose hash is in
it are shuffled, and grouped exactly by canonical text; all others are singletons and leave at once.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger.session import free_name, written

#: Bits of filter per record, and probes per hash.
BITS, PROBES = 10, 5
#: The largest filter that is broadcast, in bytes; one of more records is folded to it.
FILTER_BYTES = 64 << 20
#: Bytes of a filter segment, in which all probes of a hash lie and which partitions' filters are merged by.
SEGMENT = 1 << 16
#: Hashes that a partition's filters take before they are handed on.
HELD = 4_000_000
#: A group with over this share of the repeats is joined by broadcast; there are at most 1 / share such groups.
HOT_SHARE = 0.002

# Blanks of all scripts, so a character that is none of them.
_FULL = r"[^\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_ASCII = re.compile(r"[^0-9a-z]+")


def canonical(s: str) -> str:
    """Letters, marks and digits of ``s`` in one letter case and one composition, nothing else."""
    if s.isascii():
        return _ASCII.sub("", s.lower())
    s = unicodedata.normalize("NFC", unicodedata.normalize("NFC", s).casefold())
    return "".join(c for c in s if unicodedata.category(c)[0] in "LMN")


def parse_line(line: str | None, labels: list[str]) -> list[str] | None:
    """The values of ``labels`` in a record kept as one line, in whatever order and notation; None if one is missing.

    Notations: JSON, ``label: value; ...``, ``label=value | ...``, ``Label = 'value'`` with tabs.
    """
    if not line:
        return None
    text = line.strip()
    if text.startswith("{"):
        try:
            found = {str(k).strip().casefold(): v for k, v in json.loads(text, strict=False).items()}
            out = [found.get(x.casefold()) for x in labels]
            return None if any(v is None or not str(v).strip() for v in out) else [str(v) for v in out]
        except ValueError:
            pass
    spots = []
    for i, label in enumerate(labels):
        m = re.search(rf"(?:^|[\s;|,{{])[\"']?{re.escape(label)}[\"']?\s*[:=]\s*", text, re.IGNORECASE)
        if not m:
            return None
        spots.append((m.start(), m.end(), i))
    spots.sort()
    out = [""] * len(labels)
    for k, (_, b, i) in enumerate(spots):
        value = text[b : spots[k + 1][0] if k + 1 < len(spots) else len(text)].strip(" \t\r\n;|,}")
        if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
            value = value[1:-1]
        out[i] = value
    return None if any(not v.strip() for v in out) else out


def _amount(v: str) -> float | None:
    """A typed amount as a number; None if it is none."""
    try:
        return float(v.replace(",", "").strip())
    except ValueError:
        return None


def _segment(h: np.ndarray, segments: int) -> np.ndarray:
    """Segment of each hash; ``segments`` is a power of two."""
    return (h >> np.uint64(20)) & np.uint64(segments - 1)


def _probes(h: np.ndarray) -> np.ndarray:
    """Positions of each hash within its segment (rows: probes)."""
    a = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    b = (h >> np.uint64(45)) | np.uint64(1)
    return np.stack([(a + np.uint64(k) * b + np.uint64(k * k)) & np.uint64(SEGMENT * 8 - 1) for k in range(PROBES)])


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(bitmap, at >> np.uint64(3), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))


def _pair() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(SEGMENT, np.uint8), np.zeros(SEGMENT, np.uint8)


def add_hashes(once: np.ndarray, twice: np.ndarray, h: np.ndarray) -> None:
    """Puts hashes of one segment into its filters of those seen once and seen twice."""
    h, n = np.unique(h, return_counts=True)
    at = _probes(h)
    _set(twice, at[:, (n > 1) | _has(once, at)])
    _set(once, at)


def merge_bits(once: np.ndarray, twice: np.ndarray, other_once: np.ndarray, other_twice: np.ndarray) -> None:
    """Puts the filters of another partition into those of a segment."""
    twice |= other_twice | (once & other_once)
    once |= other_once


def segments_for(rows: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, rows) * BITS / 8 / SEGMENT)))


def repeats_filter(hashed: DataFrame, segments: int, filter_bytes: int = FILTER_BYTES) -> np.ndarray:
    """The merged filter of hashes (column ``h``) that occur at least twice, folded to ``filter_bytes`` at most.

    A partition hands a segment on as its hashes where that is shorter than the two filters of them. Merging shuffles 8 bytes a record at most.
    """
    folded = min(segments, 1 << int(math.log2(max(1, filter_bytes // SEGMENT))))

    def parts(h: np.ndarray) -> Iterator[pa.RecordBatch]:
        s = _segment(h, segments)
        order = np.argsort(s, kind="stable")
        h, s = h[order], s[order]
        cuts = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(h)]
        rows: list[tuple] = []
        size = 0
        for a, b in zip(cuts, cuts[1:]):
            if (b - a) * 8 <= 2 * SEGMENT:
                rows.append((int(s[a]), h[a:b].tobytes(), None, None))
            else:
                once, twice = _pair()
                add_hashes(once, twice, h[a:b])
                rows.append((int(s[a]), None, once.tobytes(), twice.tobytes()))
            size += min((b - a) * 8, 2 * SEGMENT)
            if size > 16 << 20 or b == len(h):
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["s", "hashes", "once", "twice"])
                rows, size = [], 0

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                n += batch.num_rows
            if n > HELD:
                yield from parts(np.concatenate(held))
                held, n = [], 0
        if n:
            yield from parts(np.concatenate(held))

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = _pair()
        for t in batches:
            for h, a, b in zip(*(t.column(c).to_pylist() for c in ("hashes", "once", "twice"))):
                if h is not None:
                    add_hashes(once, twice, np.frombuffer(h, np.uint64))
                else:
                    merge_bits(once, twice, np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([twice.tobytes()], pa.binary())], names=["s", "twice"])

    def fold(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SEGMENT, np.uint8)
        for t in batches:
            for b in t.column("twice").to_pylist():
                bits |= np.frombuffer(b, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["s", "twice"])

    merged = hashed.select("h").mapInArrow(build, "s long, hashes binary, once binary, twice binary").groupBy("s").applyInArrow(merge, "s long, twice binary")
    if folded < segments:
        merged = merged.withColumn("s", F.pmod("s", F.lit(folded))).groupBy("s").applyInArrow(fold, "s long, twice binary")
    out = np.zeros(folded * SEGMENT, np.uint8)
    for r in merged.toLocalIterator():  # ``filter_bytes`` in all at most
        out[r.s * SEGMENT : (r.s + 1) * SEGMENT] = np.frombuffer(bytes(r.twice), np.uint8)
    return out


def maybe_repeats(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may occur twice, by the (folded) filter."""
    return _has(bitmap, _probes(h) + _segment(h, len(bitmap) // SEGMENT) * np.uint64(SEGMENT * 8))


def collapse(records: DataFrame, key: str, rows: int | None = None, filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """Groups and members of ``records`` (columns ``src``, ``key``, ``canon``, ``h``).

    Groups: (src, canon, keep, copies) for each canonical text that occurs more than once in its source; members: (src, key, canon) of
    the records in them. Records whose canonical text is unique are in neither. ``rows`` is the number of records, counted if not given.
    The records are written once, and read twice: to build the filter and to probe it.
    """
    spark = records.sparkSession
    records = written(records, "records")
    n = records.count() if rows is None else rows
    data = spark.sparkContext.broadcast(repeats_filter(records, segments_for(n), filter_bytes).tobytes())

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(data.value, np.uint8)
        for batch in batches:
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield batch.filter(pa.array(maybe_repeats(bitmap, h) if len(h) else np.zeros(0, bool)))

    maybe = written(records.mapInArrow(probe, records.schema).select("src", "key", "canon"), "repeats")
    groups = maybe.groupBy("src", "canon").agg(F.min(key).alias("keep"), F.count("*").alias("copies")).filter(F.col("copies") > 1)
    return groups, maybe


def link_copies(groups: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """(src, key, keep, copies) of the members of groups. Groups with very many members are joined by broadcast, not shuffle."""
    groups = written(groups, "groups")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    least = max(10_000, total * HOT_SHARE)
    hot = groups.filter(F.col("copies") > least)
    cold = groups.filter(F.col("copies") <= least)
    out = members.join(cold, ["src", "canon"])
    n_hot = hot.count()
    if n_hot:  # at most 1 / HOT_SHARE rows
        out = members.join(F.broadcast(hot), ["src", "canon"]).unionByName(out)
    return out.select("src", key, "keep", "copies")


@F.pandas_udf(T.StringType())
def _folded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(canonical, na_action="ignore")


def canonical_column(c: Column) -> Column:
    """``canonical`` of a text column: plain ASCII stays in the JVM, only other texts go through Python."""
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.lower(F.regexp_replace(c, "[^0-9A-Za-z]+", ""))).otherwise(_folded(F.when(~plain, c)))


def _records(d: DataFrame, fields: int, src: str) -> DataFrame:
    """(src, key, canon, h) of the rows (key, f0, f1, ..., amount) of ``d`` with all fields present."""
    d = d.filter(F.col("key").isNotNull() & F.col("amount").isNotNull())
    for i in range(fields):
        d = d.filter(F.col(f"f{i}").rlike(_FULL))
    canon = F.concat_ws("\x1f", *[canonical_column(F.col(f"f{i}")) for i in range(fields)], (F.col("amount") + F.lit(0.0)).cast("string"))
    return d.select(F.lit(src).alias("src"), "key", canon.alias("canon")).withColumn("h", F.xxhash64("src", "canon"))


def keyed(df: DataFrame, key: str, fields: list[str], amount: str, src: str = "") -> DataFrame:
    """(src, key, canon, h) of the records with all fields present; ``amount`` is compared as a number."""
    d = df.select(F.col(key).cast("string").alias("key"), *[F.col(f).cast("string") for f in fields], F.col(amount).cast("double").alias("_amount")).toDF("key", *[f"f{i}" for i in range(len(fields))], "amount")
    return _records(d, len(fields), src)


def keyed_lines(df: DataFrame, key: str, line: str, fields: list[str], amount: str, src: str = "") -> DataFrame:
    """As ``keyed``, for records kept as one line of text each with the fields under their labels."""
    d = df.select(F.col(key).cast("string").alias("key"), F.col(line).cast("string").alias("line")).filter(F.col("key").isNotNull() & F.col("line").isNotNull())
    names = ["key", *[f"f{i}" for i in range(len(fields))], "amount"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                got = parse_line(text, [*fields, amount])
                if got and (x := _amount(got[-1])) is not None:
                    rows.append(r)
                    out.append((*got[:-1], x))
            cols = [pa.array([x[i] for x in out], pa.string()) for i in range(len(fields))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *cols, pa.array([x[-1] for x in out], pa.float64())], names=names)

    return _records(d.mapInArrow(run, ", ".join([*[f"{n} string" for n in names[:-1]], "amount double"])), len(fields), src)


def find_copies(records: DataFrame, filter_bytes: int = FILTER_BYTES, rows: int | None = None) -> DataFrame:
    """(keep_id, copy_id) for each record (src, key, canon, h) that is a copy of the smallest key of its group.

    ``rows`` sizes the filters (about as many as there are records, counted if not given). Keys are compared as text. A key that occurs on several rows of one group is one record. An empty table has no copies.
    """
    groups, members = collapse(records, "key", rows, filter_bytes)
    pairs = link_copies(groups, members, "key").filter(F.col("key") != F.col("keep"))
    return pairs.select(F.col("keep").alias("keep_id"), F.col("key").alias("copy_id")).distinct()


def collapse_records(df: DataFrame, key: str, fields: list[str], amount: str, out: str = "copies") -> DataFrame:
    """The kept row of each group of records of ``df`` that agree in canonical ``fields`` and ``amount``, with its number of copies in ``out``.

    The smallest ``key`` (as text) is kept; records with a missing field (null, blank) are each their own group with one
    copy, as are records with a null key. ``key`` is taken to be unique. Other columns pass unchanged; one named like
    ``out`` makes the new column get underscores. Repeated, tied and empty inputs are fine.
    """
    out = free_name(df.columns, out)
    groups, members = collapse(keyed(df, key, fields, amount), "key", df.count())
    linked = written(link_copies(groups, members, "key"), "linked")
    kept = linked.filter(F.col("key") == F.col("keep")).select(F.col("key").alias("_k"), F.col("copies").alias("_n")).distinct()
    gone = linked.filter(F.col("key") != F.col("keep")).select(F.col("key").alias("_k"), F.lit(-1).cast("long").alias("_n")).distinct()
    k = F.col(key).cast("string")
    marks = kept.unionByName(gone)
    return df.join(marks, k == F.col("_k"), "left").filter(F.col("_n").isNull() | (F.col("_n") > 0)).withColumn(out, F.coalesce("_n", F.lit(1).cast("long"))).drop("_k", "_n")
