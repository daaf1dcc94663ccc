"""Several values packed in one field: one row per value, with its position.

Which signs part values is inferred for each source. A candidate sign scores by how regular the types of the pieces on its two sides
are, and by how consistent the counts of pieces are from record to record. A piece is of the type of a value if it is one that stands alone in other
records (or on a list of values, if there is one); where the column's values hardly recur, types are shapes (words, letter case,
digits), and a sign is regular as far as the pieces beside it are of one shape. Signs that
occur within values, such as a hyphen in a name, fall through. Splitting then honours quotes, list numbers and listed
names that hold a sign.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger.functions.text import plain
from brightledger.operators.joins import keyed_join
from brightledger.session import free_name, spread, written

#: Candidate signs: name -> pattern.
CANDIDATES = {
    "newline": r"[\r\n]+",
    "tab": r"\t+",
    "semicolon": r";+",
    "pipe": r"\|+",
    "comma": r",+",
    "slash": r"/+",
    "ampersand": r"&+",
    "plus": r"\++",
    "spaced hyphen": r"(?<=\s)[-–—]+(?=\s)",
    "tight hyphen": r"(?<=\w)-(?=\w)",
    "and": r"(?<=[\s,;])and(?=\s)",
    "at": r"(?<=[\s,;])at(?=\s)",
    "stop": r"\.(?=\s)",
    "colon": r":",
    "blank": r"(?<=\w) (?=\w)",
}
_PATTERN = {k: re.compile(v) for k, v in CANDIDATES.items()}
#: Signs that bound a piece while another sign is scored.
_BASE = "newline", "tab", "semicolon", "pipe", "comma"
_QUOTES = {'"': '"', "“": "”", "'": "'", "‘": "’", "«": "»", "„": "“"}
_NUMBER = re.compile(r"(?:(?<=\s)|(?<=[;,|/])|^)\(?\d{1,3}[.)](?=\s)")
_NOT_GIVEN = re.compile(r"\b[nN]/[aA]\b")

# Signs that part values in most writing; beside the others, one shape of pieces shows nothing, as words of one name have one shape too.
PARTING = frozenset("newline tab semicolon pipe comma slash ampersand plus".split())
_WHOLE = r"[\r\n\t;|,/&+]"

#: Observations of the pooled score that a source's own score is mixed with.
PRIOR = 50
#: Letters of packed fields that one output batch repeats.
OUT_LETTERS = 50_000_000
#: A sign is taken from this score on.
LEAST = 0.35
#: Counters of the sketch that finds recurring values of the column; listed values that score signs from memory (more of them are joined, to the same scores).
TRACKED, LISTED = 8_192, 200_000
#: Bytes of listed names with signs in one broadcast; more of them take further passes over the rows, each narrow.
HELD_BYTES = 16 << 20
#: Sources whose signs are broadcast; the signs of more are joined by shuffle, hot sources apart.
FEW_SOURCES = 20_000
#: Listed names with signs up to which they are one pattern; more are looked up by their first letters.
PATTERN_NAMES = 300


def type_key(piece: str) -> str:
    """What two typings of a listed name have in common."""
    return re.sub(r"[\W_]+", "", plain(piece))


class _Folded(dict):
    """Letters without their case, one for one."""

    def __missing__(self, c: int) -> int:
        forms = chr(c).casefold(), chr(c).lower()
        self[c] = ord(next((x for x in forms if len(x) == 1), chr(c)))
        return self[c]


_FOLDED = _Folded({ord("İ"): ord("i"), ord("ı"): ord("i")})


def caseless(text: str) -> str:
    """``text`` without letter case, as long as before."""
    return text.lower() if text.isascii() else text.translate(_FOLDED)


def shape(piece: str) -> str:
    """Type of a piece by its look: number of words (about), letter case and digits."""
    words = piece.split()
    letters = [c for c in piece if c.isalpha()]
    case = "none" if not letters else "upper" if piece.isupper() else "lower" if piece.islower() else "title" if all(w[0].isupper() or not w[0].isalpha() for w in words) else "mixed"
    digits = sum(c.isdigit() for c in piece)
    return f"{min(len(words), 3) if len(words) < 6 else 6} {case} {'digits' if digits * 2 > len(piece) else 'some' if digits else ''}"


class Held:
    """Listed names that hold a candidate sign, to be found in texts whatever their letter case."""

    def __init__(self, names: list[str]):
        names = sorted({caseless(x) for x in names if has_sign(x)}, key=lambda x: (-len(x), x))
        self.pattern = re.compile(r"(?<!\w)(?=((?:" + "|".join(map(re.escape, names)) + r")(?!\w)))") if 0 < len(names) <= PATTERN_NAMES else None
        self.by: dict[str, list[str]] = {}
        if self.pattern is None:
            for x in names:
                self.by.setdefault(x[:3], []).append(x)
        self.starts = sorted({len(x) for x in self.by}, reverse=True)  # names of one or two letters are known by these

    @staticmethod
    def _end(names: list[str], low: str, i: int) -> int:
        """Where the first of ``names`` that stands whole at ``i`` ends; 0 if none does."""
        for x in names:
            end = i + len(x)
            if low.startswith(x, i) and not (end < len(low) and (low[end].isalnum() or low[end] == "_")):
                return end
        return 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        """The longest name at each place of ``text`` where one begins."""
        low = caseless(text)
        if self.pattern is not None:
            return [(m.start(), m.end(1)) for m in self.pattern.finditer(low)]
        out = []
        if not self.by:
            return out
        word = False
        for i, c in enumerate(low):
            if not word and (end := next((e for k in self.starts if (names := self.by.get(low[i : i + k])) and (e := self._end(names, low, i))), 0)):
                out.append((i, end))
            word = c.isalnum() or c == "_"
        return out


def has_sign(name: str) -> bool:
    return any(_PATTERN[k].search(name) for k in CANDIDATES if k not in ("blank", "stop"))


def _mask(text: str) -> str:
    """``text`` with quoted parts and words for no value replaced by NUL (same length)."""
    out = list(text)

    def blot(a: int, b: int) -> None:
        out[a:b] = "\0" * (b - a)

    i, n = 0, len(text)
    fresh = True  # a value may begin here
    while i < n:
        c = text[i]
        if fresh and c in _QUOTES:
            close = _QUOTES[c]
            j = i + 1
            while (j := text.find(close, j)) >= 0:
                after = text[j + 1 : j + 2]
                if not after or not (after.isalnum() or after == "_"):
                    break
                j += 1
            if j > 0:
                blot(i, j + 1)
                i, fresh = j + 1, False
                continue
        if c in "\t\r\n":
            fresh = True
        elif not c.isspace():
            fresh = c in ";,|/&+-–—)." or (c in "dt" and re.search(r"(?:^|[\s,;])(?:and|at)$", text[max(0, i - 4) : i + 1]) is not None)
        i += 1
    for m in _NOT_GIVEN.finditer("".join(out)):
        blot(*m.span())
    return "".join(out)


def _hold(masked: str, spans: list[tuple[int, int]]) -> str:
    """``masked`` with held names blotted out too: the leftmost first, of one place the longest."""
    at, parts, last = 0, [], 0
    for a, b in sorted(spans, key=lambda x: (x[0], -x[1])):
        if a >= last:
            parts += [masked[at:a], "\0" * (b - a)]
            at = last = b
    return "".join([*parts, masked[at:]]) if parts else masked


def split_value(text: str | None, signs: frozenset[str] | set[str], held: Held | None = None, spans: list[tuple[int, int]] | None = None) -> list[str]:
    """The values of ``text`` in order, without signs, list numbers, surrounding quotes and outer blanks; no empty ones.

    ``spans``: where further held names are.
    """
    if text is None or not text.strip():
        return []
    masked = _mask(text)
    masked = _hold(masked, [*(spans or ()), *(held.spans(masked) if held else ())])
    cuts = [m.span() for m in _NUMBER.finditer(masked)]
    for s in signs:
        cuts.extend(m.span() for m in _PATTERN[s].finditer(masked))
    cuts.sort()
    out, at = [], 0
    for a, b in [*cuts, (len(text), len(text))]:
        if a > at or a == len(text):
            piece = text[at:a].strip()
            while len(piece) > 1 and piece[0] in _QUOTES and piece[-1] == _QUOTES[piece[0]]:
                piece = piece[1:-1].strip()
            if piece and not all(c in "\"'“”‘’«»" for c in piece):
                out.append(piece)
        at = max(at, b)
    return out


def pairs(places: list[int] | None) -> list[tuple[int, int]]:
    return list(zip(places[::2], places[1::2])) if places else []


def held_blocks(listed: DataFrame | list[str] | None) -> tuple[list[Held], list[str] | DataFrame]:
    """The listed names with signs in blocks of ``HELD_BYTES``, and all listed values as ``infer_signs`` takes them: a list up to ``LISTED``, else a table."""
    if listed is None or isinstance(listed, list):
        return [Held(listed or [])], listed or []
    names = listed.select(F.col(listed.columns[0]).cast("string").alias("x")).filter(F.col("x").isNotNull()).distinct()
    some = sorted(r.x for r in names.limit(LISTED + 1).collect())
    if len(some) <= LISTED and sum(map(len, some)) * 4 <= HELD_BYTES:
        return [Held(some)], some
    names = written(names, "listed")
    signed = names.filter(F.col("x").rlike(r"[^\p{L}\p{N} ]|(?i)\b(?:and|at)\b"))
    blocks, block, size = [], [], 0
    for r in signed.toLocalIterator():
        if has_sign(r.x):
            block.append(r.x)
            size += len(r.x.encode())
            if size > HELD_BYTES:
                blocks.append(Held(block))
                block, size = [], 0
    if block or not blocks:
        blocks.append(Held(block))
    return blocks, names


def type_keys(names: DataFrame) -> DataFrame:
    """(key) of the first column's values, each once and none empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([type_key(x) for x in batch.column(0).to_pylist()], pa.string())], names=["key"])

    named = names.select(F.col(names.columns[0]).cast("string").alias("x")).filter(F.col("x").isNotNull())
    return named.mapInArrow(run, "key string").filter("key <> ''").distinct()


def standing_values(df: DataFrame, column: str) -> tuple[dict[str, int], int]:
    """Values that recur as whole fields without a parting sign, with their counts, and the number of such fields.

    A value is one if at least 4 / ``TRACKED`` of these fields and two more hold it. What may be one comes to the driver from a mergeable sketch, which
    misses none, and is then counted, so that neither the rows nor their order decide where the sketch is not exact.
    """
    v = F.trim(F.col(column).cast("string"))
    whole = df.filter((F.length(v) > 0) & ~F.col(column).cast("string").rlike(_WHOLE)).select(v.alias("v"))
    found = whole.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(v, {TRACKED}, {TRACKED})").alias("top")).first()
    least = 2 + 4 * found.n / TRACKED
    maybe = [x["item"] for x in (found.top or []) if x["item"] is not None and x["count"] >= least]
    if not maybe:
        return {}, found.n
    few = df.sparkSession.createDataFrame([(x,) for x in maybe], "v string")
    counts = whole.join(F.broadcast(few), "v", "left_semi").groupBy("v").count().filter(F.col("count") >= least)
    return {r.v: r["count"] for r in counts.collect()}, found.n


def infer_signs(df: DataFrame, column: str, source: str | None, listed: DataFrame | list[str] | None = None, held: Held | None = None, places: str | None = None) -> tuple[DataFrame, dict[str, float]]:
    """(source, signs) of each source, and the pooled score of each sign.

    ``listed`` are known values, if any (a list, or a table's first column, whose names with signs ``held`` has to have); ``source`` names the column that tells sources apart (null is a source); ``places`` that of where further held names are.
    A sign's score is the regularity of the pieces beside it, lowered where that differs between records of other piece counts, times the consistency of
    piece counts (1 / (1 + the square of their logarithm's mean deviation), which one long field does not spoil); a source's own score is mixed with the pooled one of all sources. A side is regular if its piece is a
    standing or listed value. Of other sides, beside a parting sign, as many count as two of the sign's sides are alike in shape, less the share of
    whole fields that standing and listed values explain: where values recur, a piece that never does is none. Counts are taken over all records.
    A table of listed values is not brought together: sides that are no standing values are counted by their keys and joined with its keys.
    """
    far = written(type_keys(listed), "keys") if isinstance(listed, DataFrame) else None
    longest = far.agg(F.max(F.length("key"))).first()[0] or 0 if far is not None else 0
    listed = listed if far is None and listed else []
    standing, whole = standing_values(df, column)
    types = (frozenset(type_key(x) for x in listed) | frozenset(map(type_key, standing))) - {""}
    covered = min(1.0, sum(n for x, n in standing.items() if type_key(x) in types) / whole) if whole else 0.0
    src = df.select((F.col(source) if source else F.lit(None)).cast("string").alias("source"), F.col(column).cast("string").alias("v"), *([F.col(places).alias("places")] if places else []))
    alone = ["source", "sign", "pieces", "shape"]
    parts = [*alone, "key"] if longest else alone
    out = T.StructType([T.StructField(c, T.IntegerType() if c == "pieces" else T.StringType()) for c in parts] + [T.StructField(c, T.LongType()) for c in ("places", "sides", "known")])
    held = held or Held(listed)

    def observed(v: str, places: list[int] | None) -> list[tuple]:
        """((sign, pieces, shape, and a key that a table may list), places, sides, known sides) of one field; the places of a sign are counted with its first shape."""
        masked = _mask(v)
        masked = _hold(masked, [*held.spans(masked), *pairs(places)])
        numbers = [m.span() for m in _NUMBER.finditer(masked)]
        base = numbers + [m.span() for k in _BASE for m in _PATTERN[k].finditer(masked)]
        out = []
        for k, pattern in _PATTERN.items():
            here = [m.span() for m in pattern.finditer(masked)]
            if not here:
                continue
            cuts = sorted({*base, *here})
            edge = [0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(v)]
            texts = [v[a:b].strip() for a, b in zip(*edge)]
            at = {c: i for i, c in enumerate(cuts)}
            parted = [i for i in (at[c] for c in here) if texts[i] and texts[i + 1]]
            if parted:
                sides, known = Counter(), Counter()
                good: dict[str, tuple[tuple, bool]] = {}
                for i in parted:
                    for x in (texts[i], texts[i + 1]):
                        if x not in good:
                            key = type_key(x)
                            good[x] = (shape(x), *([key if key not in types and 0 < len(key) <= longest else None] if longest else [])), key in types
                        s, is_known = good[x]
                        sides[s] += 1
                        known[s] += is_known
                out.extend(((k, len(here) + 1, *s), len(parted) if i == 0 else 0, n, known[s]) for i, (s, n) in enumerate(sides.items()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[tuple]] = {}
        for batch in batches:
            total: dict[tuple, list[int]] = {}
            for s, v, *places in zip(*(c.to_pylist() for c in batch.columns)):
                if v is None or not v.strip():
                    continue
                got = seen.get(v)
                if got is None:
                    got = observed(v, places[0] if places else None)
                    if len(v) <= 1000:
                        if len(seen) > 50_000:
                            seen.clear()
                        seen[v] = got
                for k, m, n, r in got:
                    x = total.setdefault((s, *k), [0, 0, 0])
                    x[0] += m
                    x[1] += n
                    x[2] += r
            rows = [(*k, *x) for k, x in total.items()]
            kinds = [pa.int32() if c == "pieces" else pa.string() for c in parts] + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=out.names)

    added = lambda df, keys: df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("places", "sides", "known")])
    counts = added(spread(src).mapInArrow(run, out), parts)
    if longest:
        met = counts.join(far.withColumn("met", F.lit(True)), "key", "left")
        counts = added(met.withColumn("known", F.when(F.col("met"), F.col("sides")).otherwise(F.col("known"))), alone)
    counts = written(counts, "signs")
    keys = ["source", "sign"]
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("sign") == F.col("k"))
    # How alike in shape two sides of a sign are, for its unknown ones.
    forms = counts.groupBy(*keys, "shape").agg(F.sum("sides").alias("sides"), F.sum("known").alias("known"))
    alike = forms.groupBy(F.col("source").alias("s"), F.col("sign").alias("k")).agg((F.sum((F.col("sides") - F.col("known")) * F.col("sides")) / F.greatest(F.sum("sides") * F.sum(F.col("sides") - F.col("known")), F.lit(1))).alias("alike"))
    by = counts.groupBy(*keys, "pieces").agg(F.sum("places").alias("n"), F.sum("sides").alias("sides"), F.sum("known").alias("known")).join(alike, same).drop("s", "k")
    weight = F.when(F.col("sign").isin(*PARTING), F.lit(1 - covered)).otherwise(0.0)
    by = by.withColumn("regular", (F.col("known") + weight * F.col("alike") * (F.col("sides") - F.col("known"))) / F.col("sides")).withColumn("fields", F.col("n") / F.greatest(F.col("pieces") - 1, F.lit(1)))
    mean = lambda x, w: F.sum(F.col(w) * x) / F.sum(w)
    log, whole_sign = F.log(F.col("pieces").cast("double")), Window.partitionBy(*keys)  # of some rows, one a count of pieces
    by = by.withColumn("usual", F.sum(F.col("fields") * log).over(whole_sign) / F.sum("fields").over(whole_sign))
    each = by.groupBy(*keys).agg(
        F.sum("n").alias("n"), mean(F.col("regular"), "n").alias("regular"), mean(F.pow("regular", 2), "n").alias("square"),
        mean(F.abs(log - F.col("usual")), "fields").alias("deviation"),
    )
    scatter = F.sqrt(F.greatest(F.lit(0.0), F.col("square") - F.col("regular") * F.col("regular")))
    consistent = 1 / (1 + F.col("deviation") * F.col("deviation"))
    each = each.select("source", "sign", "n", (F.col("regular") * (1 - scatter) * consistent).alias("score"))
    pooled = {r.sign: r.score for r in each.groupBy("sign").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("score")).collect()}
    prior = F.create_map(*[x for k, s in pooled.items() for x in (F.lit(k), F.lit(s))]) if pooled else F.lit(None).cast("map<string,double>")
    mixed = (F.col("n") * F.col("score") + PRIOR * prior[F.col("sign")]) / (F.col("n") + PRIOR)
    signs = each.withColumn("mixed", mixed).filter(F.col("mixed") >= LEAST).groupBy("source").agg(F.sort_array(F.collect_set("sign")).alias("signs"))
    return signs, pooled


def unpack(df: DataFrame, column: str, listed: DataFrame | list[str] | None = None, source: str | None = None, value: str = "value", pos: str = "pos", count: str = "pieces") -> DataFrame:
    """One row for each value of ``column``: the columns of ``df`` and ``pos`` (int, from 1), ``value``, ``pieces`` (values of the record).

    Signs are inferred for each ``source`` (see ``infer_signs``). Null and blank fields have no rows, nor have empty
    places between signs. ``listed`` (a list, or a table's first column, of any size) holds known values, which are one more sign of what a value is and keep the signs
    within them; it may be missing or empty. Repeated records each give their rows; columns named like the new ones stay, and the new ones get
    underscores. An empty table gives an empty table. Nothing is shuffled but the few counts of signs.
    """
    blocks, some = held_blocks(listed)
    at = df.columns.index(column)
    taken = list(df.columns)
    names = []
    for wanted in (pos, value, count):
        names.append(free_name([*taken, *names], wanted))
    s, k, more = (free_name([*taken, *names], x) for x in ("_signs", "_source", "_held"))
    # Names of further blocks are looked for in passes of their own; their places go along with the row. (A column of arrays is dear to hand over, so there is none otherwise.)
    several = len(blocks) > 1
    rows = df.withColumn(more, F.lit(None).cast("array<int>")) if several else df
    wide = rows.schema

    def look(block: Held) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = batch.column(len(batch.columns) - 1).to_pylist()
                found = [[*(k or ()), *(x for ab in block.spans(_mask(v)) for x in ab)] if v else None for k, v in zip(known, batch.column(at).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.int32()))], names=batch.schema.names)

        return run

    for block in blocks[1:]:
        rows = rows.mapInArrow(look(block), wide)
    if several:
        rows = written(rows, "held")
    signs, _ = infer_signs(rows, column, source, some, blocks[0], more if several else None)
    key = (F.col(source) if source else F.lit(None)).cast("string")
    joined = spread(rows).withColumn(k, F.coalesce(F.concat(F.lit("="), key), F.lit("null")))
    signs = signs.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias(k), F.col("signs").alias(s))
    few = signs.limit(FEW_SOURCES + 1).collect()
    if len(few) <= FEW_SOURCES:
        signs = F.broadcast(df.sparkSession.createDataFrame(few, signs.schema))
        joined = joined.join(signs, k, "left").select(*rows.columns, s)
    else:
        joined = keyed_join(joined, written(signs, "signs"), k).select(*rows.columns, s)
    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.IntegerType(), False), T.StructField(names[1], T.StringType(), False), T.StructField(names[2], T.IntegerType(), False)])
    held = blocks[0]
    kept_columns, signs_at = len(df.columns), len(wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list[str]] = {}
        for batch in batches:
            rows, pos, values, counts, letters = [], [], [], [], 0

            def out(batch=batch) -> pa.RecordBatch:
                kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:kept_columns]]
                return pa.RecordBatch.from_arrays([*kept, pa.array(pos, pa.int32()), pa.array(values, pa.string()), pa.array(counts, pa.int32())], names=[*batch.schema.names[:kept_columns], *names])

            for r, (v, own, *places) in enumerate(zip(*(batch.column(c).to_pylist() for c in (at, signs_at, *range(kept_columns, signs_at))))):
                key = (v, tuple(own or ()))
                got = seen.get(key)
                if got is None:
                    got = split_value(v, set(key[1]), held, pairs(places[0] if places else None))
                    if len(v or "") <= 1000:
                        if len(seen) > 50_000:
                            seen.clear()
                        seen[key] = got
                for i, x in enumerate(got):
                    rows.append(r)
                    pos.append(i + 1)
                    values.append(x)
                    counts.append(len(got))
                    letters += len(v)
                    if letters > OUT_LETTERS:  # the whole field goes with each of its values
                        yield out()
                        rows, pos, values, counts, letters = [], [], [], [], 0
            yield out()

    return joined.mapInArrow(run, schema)
