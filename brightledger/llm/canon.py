"""Freely typed values mapped to a list of names.

Values are deduplicated and normalised. Candidates come from an inverted index of character n-grams over the surface
forms of the listed names, whose lists add up to the cosine of n-gram weights (rare n-grams weigh more) of letters and of sounds; the best is
accepted if it is good enough and far enough ahead of the next name.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger.functions.text import plain
from brightledger.llm.names import edit
from brightledger.session import fanned

# Words that say what kind of place a name is, not which.
KIND_WORDS = frozenset("prov province provincial lalawigan ng of the whole area region city".split())
# Words of direction and rank in other languages or shortened, and the listed word they stand for.
SAME_WORD = {
    "north": "norte", "nte": "norte", "south": "sur", "east": "oriental", "eastern": "oriental", "west": "occidental", "western": "occidental",
    "northern": "norte", "southern": "sur", "occ": "occidental", "or": "oriental", "ctr": "central", "centre": "central", "center": "central", "cntrl": "central",
    "sn": "san", "pto": "puerto", "mtro": "metro",
}

#: Score from which on the best name is accepted, and its lead on the next.
LEAST, MARGIN = 0.45, 0.03
#: The most that a form unlike the value's can score: others may have all of its n-grams, and sums of doubles may come out above 1.
UNLIKE = math.nextafter(1.0, 0.0)
#: Listed names of one pass; a longer list takes more passes over the distinct values.
BLOCK_NAMES = 200_000


def name_words(value: str, known: frozenset[str] = frozenset()) -> list[str]:
    """Words of a typed name: folded, marks inside words removed, kind words left out (unless listed names have them)."""
    s = plain(value)
    s = re.sub(r"(?<=[^\W_])[-.'’`](?=[^\W_])", "", s)
    words = [SAME_WORD.get(w, w) for w in re.findall(r"[^\W_]+", s)]
    kept = [w for w in words if w not in KIND_WORDS or w in known]
    return kept or words


def grams(s: str) -> Counter:
    """Letters, bigrams, trigrams and bigrams over one letter of ``s``, with its ends marked."""
    t = f"^{s}$"
    c = Counter(s)
    c.update(t[i : i + 2] for i in range(len(t) - 1))
    c.update(t[i : i + 3] for i in range(len(t) - 2))
    c.update(t[i] + "_" + t[i + 2] for i in range(len(t) - 2))
    return c


def sound(s: str) -> str:
    """``s`` with letters of like sound made one and doubled letters single."""
    s = s.replace("ph", "f").replace("qu", "k").replace("ly", "l").translate(str.maketrans("cqyvzoe", "kkibsui"))
    return re.sub(r"(.)\1+", r"\1", s)


def bones(s: str) -> str:
    return re.sub(r"[aeiou]", "", s)


class Grams:
    """Inverted n-gram index of strings, scored by the cosine of weighted n-grams."""

    def __init__(self, forms: list[str], df: dict[str, int] | None = None, total: int = 0):
        """``df`` and ``total``: the counts of a longer list of which ``forms`` are a part."""
        if df is None:
            df, total = Counter(g for f in forms for g in set(grams(f))), len(forms)
        self.n = len(forms)
        self.rest = math.log(1 + total)
        self.idf = {g: math.log(1 + total / k) for g, k in df.items()}
        lists: dict[str, tuple[list[int], list[float]]] = {}
        norms = []
        for i, f in enumerate(forms):
            v, norm = self.weighed(f)
            norms.append(norm)
            for g, x in v.items():
                at, weights = lists.setdefault(g, ([], []))
                at.append(i)
                weights.append(x)
        self.norms = np.array(norms)
        self.post = {g: (np.array(at, np.int32), np.array(w)) for g, (at, w) in lists.items()}

    def weighed(self, s: str) -> tuple[dict[str, float], float]:
        """The vector of ``s`` of length 1, and its length before."""
        v = {g: math.sqrt(k) * self.idf.get(g, self.rest) for g, k in grams(s).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / norm for g, x in v.items()}, norm

    def scores(self, v: dict[str, float]) -> np.ndarray:
        """The cosine of ``v`` with each form."""
        out = np.zeros(self.n)
        for g, x in v.items():
            if g in self.post:
                at, w = self.post[g]
                out[at] += x * w  # a form is once in each list
        return out

    def begun(self, f: str) -> list[float]:
        """The square of the length of each beginning of ``f`` (by its letters) before it is made 1, but for the n-grams at its end."""
        sq = lambda g: self.idf.get(g, self.rest) ** 2
        out, t = [0.0], "^" + f
        for k in range(1, len(t)):
            x = out[-1] + sq(t[k]) + sq(t[k - 1 : k + 1])
            if k > 1:
                x += sq(t[k - 2 : k + 1]) + sq(t[k - 2] + "_" + t[k])
            out.append(x)
        return out


def letter_set(s: str) -> int:
    """The letters of ``s`` as bits; one slip changes two bits at most."""
    m = 0
    for c in s:
        m |= 1 << ord(c) % 64
    return m


def letter_counts(s: str) -> list[int]:
    """How often ``s`` has each letter (modulo 64); two slips change these by four in all at most."""
    out = [0] * 64
    for c in s:
        out[ord(c) % 64] += 1
    return out


def listed_kinds(token: str) -> set[str]:
    return {w for w in re.findall(r"[^\W_]+", plain(token)) if w in KIND_WORDS}


def surface(token: str, known: frozenset[str]) -> list[str]:
    """The forms that a listed name is compared by: its words joined, and in reverse order."""
    words = name_words(token, known)
    return ["".join(words), *(["".join(reversed(words))] if 1 < len(words) <= 4 else [])]


class Index:
    """The surface forms of listed names, as typed and by sound."""

    def __init__(self, rows: list[tuple[str, str]], whole: tuple | None = None):
        """``rows``: (token, canonical); ``whole``: kind words, forms and n-gram counts (of letters, of sounds) of the list that they are a part of."""
        known, total, letters, sounds = whole or (frozenset().union(*(listed_kinds(t) for t, _ in rows)), 0, None, None)
        self.known = known
        forms: dict[str, set[str]] = defaultdict(set)
        for token, canonical in rows:
            for f in surface(token, known):
                forms[f].add(canonical)
        self.forms = sorted(forms)
        self.means = [forms[f] for f in self.forms]
        self.exact = {f: i for i, f in enumerate(self.forms)}
        self.letters = Grams(self.forms, letters, total)
        self.sounds = Grams([sound(f) for f in self.forms], sounds, total)
        self.bones: dict[str, list[int]] = defaultdict(list)
        for i, f in enumerate(self.forms):
            if len(bones(f)) >= 4:
                self.bones[bones(f)].append(i)
        self.sizes = np.array([len(f) for f in self.forms], np.int32)
        self.first = np.array([ord(f[0]) if f else 0 for f in self.forms], np.int32)
        self.at = np.concatenate([[0], np.cumsum(self.sizes + 1)])[:-1].astype(np.int64)
        self.begun = np.array([x for f in self.forms for x in self.letters.begun(f)])
        self.sets = np.array([letter_set(f) for f in self.forms], np.uint64)
        self.counts = np.array([letter_counts(f) for f in self.forms], np.int32).reshape(-1, 64)

    def best(self, value: str, least: float = LEAST - MARGIN) -> list[tuple[float, str]]:
        """The canonical names that ``value`` may mean with their scores from ``least`` on, the best first."""
        words = name_words(value, self.known)
        joined = "".join(words)
        if not joined:
            return []
        if joined in self.exact:
            return [(1.0, c) for c in sorted(self.means[self.exact[joined]])]
        score: dict[int, float] = {}

        def raised(i: int, x: float) -> None:
            x = min(x, UNLIKE)
            if x > score.get(i, 0.0):
                score[i] = x

        v, norm = self.letters.weighed(joined)
        cosine = self.letters.scores(v)
        for i in np.flatnonzero(cosine >= least).tolist():
            raised(i, float(cosine[i]))
        by_sound = 0.95 * self.sounds.scores(self.sounds.weighed(sound(joined))[0])
        for i in np.flatnonzero(by_sound >= least).tolist():
            raised(i, float(by_sound[i]))
        # A cut-off name is compared with as much of the listed one.
        n = len(joined)
        if n >= 4:
            k = bisect_left(self.forms, joined)
            while k < len(self.forms) and self.forms[k].startswith(joined):
                if len(self.forms[k]) > n + 1:
                    raised(k, 0.97)
                k += 1
        if n >= 6:
            maybe = np.flatnonzero((self.first == ord(joined[0])) & (self.sizes > n + 1))
            # No more than all n-grams shared with the whole form, and those at the end, can agree.
            end = norm * sum(x * x for g, x in v.items() if g[-1] == "$")
            most = cosine[maybe] * self.letters.norms[maybe] + end
            for i in maybe[most >= least / 0.9 * np.sqrt(self.begun[self.at[maybe] + n]) - 1e-9].tolist():
                f = self.forms[i]
                if not f.startswith(joined):
                    cut = self.letters.weighed(f[:n])[0]
                    raised(i, 0.9 * sum(x * cut.get(g, 0.0) for g, x in v.items()))
        # So is one typed without (some) vowels, by its consonants.
        for i in self.bones.get(bones(joined), ()):
            raised(i, 0.9)
        # Two slips in one short name change most of its n-grams: all forms that their letters let be so near are looked at letter by letter.
        if n >= 6:
            maybe = np.flatnonzero((np.abs(self.sizes - n) <= 2) & (np.bitwise_count(self.sets ^ np.uint64(letter_set(joined))) <= 4))
            maybe = maybe[np.abs(self.counts[maybe] - np.array(letter_counts(joined), np.int32)).sum(axis=1) <= 4]
            for i in maybe.tolist():
                if score.get(i, 0.0) < 0.55 and edit(joined, self.forms[i], 2) <= 2:
                    score[i] = 0.55
        by: dict[str, float] = {}
        for i, s in score.items():
            for c in self.means[i]:
                if s > by.get(c, 0.0):
                    by[c] = s
        return sorted(((s, c) for c, s in by.items() if s >= least), key=lambda x: (-x[0], x[1]))[:3]


def whole_list(names: DataFrame) -> tuple:
    """(kind words, number of forms, n-gram counts of letters, of sounds) of all listed names (column t), as ``Index`` takes them. N-grams come to the driver, not names."""

    def column(f, name: str = "x"):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([x for v in batch.column(0).to_pylist() for x in f(v)], pa.string())], names=[name])

        return run

    known = frozenset(r.x for r in names.select("t").mapInArrow(column(listed_kinds), "x string").distinct().collect())
    forms = names.select("t").mapInArrow(column(lambda t: surface(t, known)), "x string").distinct()
    counted = lambda f: {r.x: r["count"] for r in forms.mapInArrow(column(f), "x string").groupBy("x").count().collect()}
    return known, forms.count(), counted(lambda v: set(grams(v))), counted(lambda v: set(grams(sound(v))))


_indexes: dict[str, tuple[Index, dict[str, str]]] = {}


def _shared(name: str, data: Broadcast) -> tuple[Index, dict[str, str]]:
    """The index of a broadcast block in this worker process, made once for all of its tasks. One is kept."""
    if name not in _indexes:
        _indexes.clear()
        rows, whole = data.value
        _indexes[name] = Index(rows, whole), dict(rows)
    return _indexes[name]


def map_values(df: DataFrame, value: str, listed: DataFrame, token: str = "token", canonical: str = "canonical", least: float = LEAST, margin: float = MARGIN, none: str = "", out: str = "canonical") -> DataFrame:
    """(value, ``out``, score) for each distinct non-null ``value``: the canonical name it means, ``none`` if it means no listed one.

    A value equal to a token has the token's canonical name and score 1. Otherwise the best n-gram cosine must reach
    ``least`` and be ``margin`` ahead of the best of another canonical name. A null canonical name counts as ``none``.
    Blank values mean nothing listed. With an empty list every value is unmatched. Repeated tokens are one; a token with
    several canonical names means the first in order. Values may be of any length.

    The listed names are broadcast in blocks of ``BLOCK_NAMES``; the best of each block are merged by value. N-grams weigh by the whole
    list, only an equal form scores 1, and ties go by name, so blocks do not matter to results.
    """
    spark = df.sparkSession
    vals = df.select(F.col(value).cast("string").alias("value")).filter(F.col("value").isNotNull()).distinct()
    names = listed.select(F.col(token).cast("string").alias("t"), F.coalesce(F.col(canonical).cast("string"), F.lit(none)).alias("c")).filter(F.col("t").isNotNull()).groupBy("t").agg(F.min("c").alias("c"))
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("found", T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("canonical", T.StringType())])))])

    def look(block: list[tuple[str, str]]) -> DataFrame:
        data, name = spark.sparkContext.broadcast((block, whole)), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, exact = _shared(name, data)
            for batch in batches:
                found = []
                for v in batch.column(0).to_pylist():
                    got = [(2.0, exact[v])] if v in exact else index.best(v, least - margin)
                    found.append([{"score": s, "canonical": c} for s, c in got])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.struct([("score", pa.float64()), ("canonical", pa.string())])))], names=["value", "found"])

        return fanned(vals).mapInArrow(run, schema)

    whole = whole_list(names) if names.count() > BLOCK_NAMES else None
    parts, block = [], []
    for r in names.toLocalIterator():
        block.append((r.t, r.c))
        if len(block) == BLOCK_NAMES:
            parts.append(look(block))
            block = []
    if block or not parts:
        parts.append(look(block))
    found = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            found = found.unionByName(p)
        each = found.select("value", F.explode_outer("found").alias("x")).groupBy("value", F.col("x.canonical").alias("canonical")).agg(F.max("x.score").alias("score"))
        found = each.groupBy("value").agg(F.slice(F.sort_array(F.collect_list(F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("below"), "canonical", "score")))), 1, 3).alias("found"))
    first, second = F.get("found", F.lit(0)), F.get("found", F.lit(1))
    good = (first["score"] >= least) & ((first["score"] > 1) | second.isNull() | ((first["score"] == 1) & (second["score"] < 1)) | (first["score"] - second["score"] >= margin))
    return found.select("value", F.when(good, first["canonical"]).otherwise(F.lit(none)).alias(out), F.least(F.coalesce(first["score"], F.lit(0.0)), F.lit(1.0)).alias("score"))
