"""Evaluation passages that occur in training texts.

Word n-grams that are rare among the passages are the seeds. A document with enough seeds of a passage is aligned with
it by Smith-Waterman, where words that many passages share count little when they agree; so shared stock wording around
other names and numbers scores below zero, and a copied or slightly edited passage far above.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from brightledger.llm.dupes import SEGMENT, add_hashes, maybe_repeats, segments_for
from brightledger.session import free_name, spread, written

#: Words of a seed.
SEED = 4
#: Passages that share a word or seed at most for it to be rare, whatever their number.
RARE = 2
#: Bytes of passage text that are looked for at once; with more of them, documents are first sifted by their seeds.
BLOCK_BYTES = 4_000_000
#: Bytes of the filter that sifts documents.
SIEVE_BYTES = 32 << 20

# Single characters are words in scripts written without blanks.
_WORD = re.compile(r"[぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ฀-๿຀-໿က-႟ក-៿]|(?:(?![぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ฀-๿຀-໿က-႟ក-៿])[^\W_])+")


# Marks that copies add or leave out; those of Indic and Thai letters stay.
_SILENT = regex.compile(r"[[\p{Mn}\p{Cf}]--[\u0900-\u0DFF\u0E00-\u0E7F]]+", regex.V1)
# Points and commas within a number, which copies add or leave out.
_INNER = re.compile(r"(?<=\d)[.,](?=\d)")


def words(text: str | None) -> list[str]:
    """Words of ``text`` without regard to case, width, blanks and punctuation; a number is one word."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        text = _SILENT.sub("", text)
    return _WORD.findall(_INNER.sub("", text.casefold()))


#: What an added word costs; a mismatch costs at least as much.
ADDED = 0.3


def _next_row(up: np.ndarray, same: np.ndarray, w: float, ramp: np.ndarray) -> np.ndarray:
    """The next row of the alignment table, for an item word of weight ``w``."""
    row = np.empty(len(up))
    row[0] = 0.0
    row[1:] = up[:-1] + np.where(same, w, -max(w, ADDED))
    np.maximum(row, up - (0.1 + w / 2), out=row)
    np.maximum(row, 0.0, out=row)
    return np.maximum.accumulate(row + ramp) - ramp


def align(item: np.ndarray, weight: np.ndarray, doc: np.ndarray) -> tuple[float, int, int, int, int, np.ndarray]:
    """Best local alignment of ``item`` in ``doc`` (word ids, 0 = unknown).

    Returns score, begin and end in the item, begin and end in the document, and which item words matched. A match
    earns the word's weight, a mismatch costs it (``ADDED`` at least), a missing word 0.1 and half its weight, an added
    word ``ADDED``. The best end is found with one row at a time; the table is kept only for the words before it that an alignment can reach, as
    more added words than the item's weight pays for never pay. So memory is that of the item, however long the document.
    """
    n, m = len(item), len(doc)
    if not n or not m:
        return 0.0, 0, 0, 0, 0, np.zeros(n, bool)
    ramp = np.arange(m + 1, dtype=np.float64) * ADDED
    reach = n + int(weight.sum() / ADDED) + 2
    table = np.zeros((n + 1, m + 1)) if m <= reach else None
    up = np.zeros(m + 1)
    best, i1, j1 = 0.0, 0, 0
    for i in range(1, n + 1):
        up = _next_row(up, doc == item[i - 1], weight[i - 1], ramp)
        if table is not None:
            table[i] = up
        j = int(up.argmax())
        if up[j] > best:
            best, i1, j1 = float(up[j]), i, j
    matched = np.zeros(n, bool)
    lo = max(0, j1 - reach)
    doc = doc[lo:j1]
    if table is None:
        table = np.zeros((i1 + 1, len(doc) + 1))
        for i in range(1, i1 + 1):
            table[i] = _next_row(table[i - 1], doc == item[i - 1], weight[i - 1], ramp[: len(doc) + 1])
    i, j = i1, len(doc)
    while i > 0 and j > 0 and table[i, j] > 1e-9:
        w, here = weight[i - 1], table[i, j]
        same = doc[j - 1] == item[i - 1]
        if abs(here - (table[i - 1, j - 1] + (w if same else -max(w, ADDED)))) < 1e-7:
            i, j = i - 1, j - 1
            matched[i] = same
        elif abs(here - (table[i - 1, j] - 0.1 - w / 2)) < 1e-7:
            i -= 1
        else:
            j -= 1
    return best, int(i), i1, lo + int(j), j1, matched


class _Passages:
    """A block of passages, ready to be looked for."""

    def __init__(self, rows: list[tuple], word_df: dict[str, int], seed_df: dict[str, int], rare: int = RARE):
        self.number: dict[str, int] = {}
        self.ids, self.words, self.weight, self.length, self.telling, self.seeds = [], [], [], [], [], []
        owners: dict[tuple[int, int], list[int]] = {}
        for item_ids, tokens in rows:
            k = len(self.ids)
            self.ids.append(item_ids)
            self.words.append(np.array([self.number.setdefault(t, len(self.number) + 1) for t in tokens], np.int64))
            df = np.array([word_df[t] for t in tokens])
            self.weight.append(np.where(df <= 1, 1.0, np.where(df <= rare, 0.4, 0.2)))
            self.length.append(np.array([len(t) for t in tokens]))
            self.telling.append(self.length[-1] * self.weight[-1])
            own = {tuple(tokens[i : i + SEED]) for i in range(len(tokens) - SEED + 1)} or {tuple(tokens)}
            own = {s for s in own if seed_df[" ".join(s)] <= rare} or own
            self.seeds.append(len(own))
            for s in own:
                owners.setdefault((len(s), self._key([self.number[t] for t in s])), []).append(k)
        # Seeds by their length: those of passages under ``SEED`` words are shorter.
        self.keys = {n: np.array(sorted(k for m, k in owners if m == n), np.int64) for n in sorted({m for m, _ in owners})}
        self.owners = {n: [owners[n, k] for k in keys.tolist()] for n, keys in self.keys.items()}

    @staticmethod
    def _key(ids: list[int]) -> int:
        k = 0
        for i in ids:
            k = (k * 1_000_003 + i) & 0x7FFFFFFFFFFFFFFF
        return k

    def search(self, text: str | None, seeds_least: float, cover_least: float, same_least: float) -> Iterator[tuple[int, float, float]]:
        """Passages (number, covered share, share of it that matches) that ``text`` holds."""
        tokens = words(text)
        if not tokens:
            return
        get = self.number.get
        doc = np.array([get(t, 0) for t in tokens], np.int64)
        seen: dict[int, list] = {}
        for n, keys in self.keys.items():
            if n > len(doc):
                break
            key = np.zeros(len(doc) - n + 1, np.int64)
            known = np.ones(len(key), bool)
            for s in range(n):
                part = doc[s : len(doc) - n + 1 + s]
                key = (key * 1_000_003 + part) & 0x7FFFFFFFFFFFFFFF
                known &= part > 0
            at = np.searchsorted(keys, key)
            at[at == len(keys)] = 0
            for p in np.flatnonzero(known & (keys[at] == key)).tolist():
                for k in self.owners[n][at[p]]:  # a passage has seeds of one length
                    s = seen.setdefault(k, [set(), []])
                    s[0].add(int(at[p]))
                    s[1].append(p)
        for k, (own, places) in sorted(seen.items()):
            if len(own) < max(1.0, seeds_least * self.seeds[k]):
                continue
            size, length = len(self.words[k]), self.length[k]
            best = None
            for lo, hi in _stretches(places, size):
                part = doc[max(0, lo - size) : hi + size]
                if not self._may_hold(k, part, cover_least, same_least):
                    continue
                score, i0, i1, _, _, matched = align(self.words[k], self.weight[k], part)
                telling = self.telling[k][i0:i1]
                share = length[i0:i1].sum() / length.sum()
                same = telling[matched[i0:i1]].sum() / max(1e-9, telling.sum())
                if share >= cover_least and same >= same_least and (best is None or score > best[0]):
                    best = score, float(share), float(same)
            if best is not None:
                yield k, best[1], best[2]

    def _may_hold(self, k: int, part: np.ndarray, cover_least: float, same_least: float) -> bool:
        """Whether some stretch of the passage of the least share could agree enough, if all its words that occur in ``part`` matched.

        No alignment can do better, so nothing is lost by not aligning the others.
        """
        length, telling = self.length[k], self.telling[k]
        gain = np.concatenate([[0.0], np.cumsum(np.where(np.isin(self.words[k], part), telling, 0.0) - same_least * telling)])
        at = np.concatenate([[0], np.cumsum(length)])
        last = np.searchsorted(at, at - cover_least * at[-1] + 1e-9, side="right") - 1  # the last begin that leaves enough
        fit = last >= 0
        return bool((gain[fit] - np.minimum.accumulate(gain)[last[fit]] >= -1e-6).any())


def _stretches(places: list[int], size: int) -> list[tuple[int, int]]:
    """Seed places of one passage as stretches of the document, apart where two are over two passages away."""
    out = [[places[0], places[0] + SEED]]
    for p in places[1:]:
        if p - out[-1][1] > 2 * size:
            out.append([p, p + SEED])
        out[-1][1] = max(out[-1][1], p + SEED)
    return [(a, b) for a, b in out]


def sifted(docs: DataFrame, seeds: DataFrame, sizes: list[int]) -> DataFrame:
    """The rows (key, text) of ``docs`` whose text has an n-gram (of one of ``sizes`` words) with a hash in ``seeds`` (column h), and a few others."""
    spark = docs.sparkSession
    segments = min(segments_for(seeds.count()), SIEVE_BYTES // SEGMENT)

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, rest = np.zeros(SEGMENT, np.uint8), np.zeros(SEGMENT, np.uint8)
        for t in batches:
            add_hashes(bits, rest, t.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["s", "bits"])

    placed = seeds.select("h", F.shiftrightunsigned("h", 20).bitwiseAND(F.lit(segments - 1)).alias("s"))
    bitmap = np.zeros(segments * SEGMENT, np.uint8)
    for r in placed.groupBy("s").applyInArrow(build, "s long, bits binary").toLocalIterator():  # SIEVE_BYTES in all at most
        bitmap[r.s * SEGMENT : (r.s + 1) * SEGMENT] = np.frombuffer(bytes(r.bits), np.uint8)
    data = spark.sparkContext.broadcast(bitmap.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(data.value, np.uint8)
        for batch in batches:
            keep = []
            for text in batch.column(1).to_pylist():
                w = words(text)
                h = np.array([xxhash.xxh64_intdigest(" ".join(w[i : i + n]), seed=42) for n in sizes for i in range(len(w) - n + 1)], np.uint64)
                keep.append(bool(len(h)) and bool(maybe_repeats(bits, h).any()))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "text",
    seeds_least: float = 0.1, cover_least: float = 0.48, same_least: float = 0.65, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows (doc_key, item_key, covered, same): documents that hold a passage whole or a stretch of it.

    ``covered`` is the share of the passage (in letters) that the aligned stretch takes, ``same`` the part of the stretch
    that agrees, where rare words count by their weight. Kept from ``cover_least`` and ``same_least`` on. A document is aligned with a passage if it has
    ``seeds_least`` of its seeds; a passage of fewer than ``SEED`` words is one seed. Passages equal in words stand for each other; each is reported. Null, empty and
    wordless texts on either side have no rows; repeated document keys are searched row by row and give one row a pair; other columns are not
    read. With no passages or documents the result is empty.

    Passages are broadcast in blocks of ``block_bytes``. With one block documents are read once and nothing of them is shuffled or written; with more they
    are read once by a filter of all seeds (``SIEVE_BYTES`` at most), and the blocks go over those that hold any.
    """
    spark = docs.sparkSession
    d = spread(docs.select(F.col(doc_key), F.col(doc_text).alias(free_name([doc_key], "text"))))
    kind = items.schema[item_key].dataType
    item_type = to_arrow_type(kind)
    item_out = free_name([doc_key], item_key)
    schema = T.StructType([d.schema.fields[0], T.StructField(item_out, kind), T.StructField("covered", T.DoubleType()), T.StructField("same", T.DoubleType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([words(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))], names=["k", "w"])

    tokens = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).mapInArrow(split, T.StructType([T.StructField("k", kind), T.StructField("w", T.ArrayType(T.StringType()))])).filter(F.size("w") > 0)
    classes = written(tokens.groupBy("w").agg(F.sort_array(F.collect_set("k")).alias("ks")).withColumn("c", F.md5(F.concat_ws(" ", "w"))), "passages")
    grams = F.when(F.size("w") < SEED, F.array(F.concat_ws(" ", "w"))).otherwise(F.transform(F.sequence(F.lit(1), F.size("w") - SEED + 1), lambda i: F.concat_ws(" ", F.slice("w", i, SEED))))
    parts = classes.select("c", F.explode(F.array_distinct(F.concat(F.transform("w", lambda x: F.concat(F.lit("1"), x)), F.transform(grams, lambda x: F.concat(F.lit("n"), x))))).alias("g"))
    counted = written(parts.join(parts.groupBy("g").agg(F.count("*").alias("n")), "g"), "grams")
    known = counted.groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("g", "n"))).alias("df"))
    if (classes.agg(F.sum(F.aggregate("w", F.lit(0).cast("long"), lambda n, x: n + F.length(x))).alias("n")).first().n or 0) > block_bytes:
        seeds = counted.filter(F.col("g").startswith("n"))
        rare = seeds.groupBy("c").agg(F.min("n").alias("least"))
        own = seeds.join(rare, "c").filter((F.col("n") <= RARE) | (F.col("least") > RARE)).select(F.xxhash64(F.substr("g", F.lit(2))).alias("h")).distinct()
        sizes = sorted(r.n for r in classes.select(F.least(F.size("w"), F.lit(SEED)).alias("n")).distinct().collect())
        d = written(sifted(d, own, sizes), "sifted")

    out = None
    block: list[tuple] = []
    maps: dict[str, int] = {}
    size = 0

    def search(block: list[tuple], maps: dict[str, int]) -> DataFrame:
        data = spark.sparkContext.broadcast((block, {g[1:]: n for g, n in maps.items() if g[0] == "1"}, {g[1:]: n for g, n in maps.items() if g[0] == "n"}))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            passages = _Passages(*data.value)
            for batch in batches:
                at, item, covered, same = [], [], [], []
                for r, text in enumerate(batch.column(1).to_pylist()):
                    for k, a, b in passages.search(text, seeds_least, cover_least, same_least):
                        for x in passages.ids[k]:
                            at.append(r)
                            item.append(x)
                            covered.append(a)
                            same.append(b)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, item_type), pa.array(covered, pa.float64()), pa.array(same, pa.float64())], names=[doc_key, item_out, "covered", "same"])

        return d.mapInArrow(run, schema)

    for row in classes.join(known, "c").select("ks", "w", "df").toLocalIterator():
        block.append((list(row.ks), list(row.w)))
        maps.update(row.df)
        size += sum(len(w) for w in row.w)
        if size >= block_bytes:
            part = search(block, maps)
            out = part if out is None else out.unionByName(part)
            block, maps, size = [], {}, 0
    if block:
        part = search(block, maps)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.groupBy(doc_key, item_out).agg(F.max("covered").alias("covered"), F.max("same").alias("same"))
