"""Spellings of one organisation or person, linked.

A name is read into a kind (the sorted words that say what it is: "state university", "auto parts center", "person") and
a core (what sets it apart). Names of one kind form a metric space under the edit distance of their cores. It is
partitioned by pivots: a core goes to the cells of its distances from a few pivots, and those near a cell's edge also to the
next cell, as far as the triangle inequality lets a partner within the radius lie there. Each cell is joined exactly: all pairs of a small one, in a larger
one those that share one of the segments that so few edits cannot all touch. Further pivots discard pairs before the distance itself is computed. Links then need evidence that one side is a misspelling
and not another name: its differing word is not used by other names. All links that have it hold together, except where they would join keys that exclude each other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brightledger.functions.text import plain
from brightledger.session import fanned, written

# Legal forms, which do not tell names apart.
LEGAL = frozenset("limited ltd corporation corp company co incorporated inc opc llc plc gmbh".split())
# Words that say what kind of organisation a name is of.
KINDS = frozenset(
    """trading enterprises enterprise construction builders supply supplies hardware lumber general merchandise medical pharma pharmacy
    distributors distributor office systems software solutions printing press catering services service security agency auto parts
    center fuel station water equipment industrial sales electrical works agri ventures textile garments
    national high school elementary college state university district hospital provincial jail city municipality province barangay
    regional bridge bureau authority administration commission board command house store stores department division
    government council committee institute foundation cooperative association bank court police""".split()
)
# Usual short forms that are no prefix and no letter sequence of one kind word, or of several.
SHORT = {
    "wd": "water district", "nhs": "national high school", "hs": "high school", "es": "elementary school", "brgy": "barangay", "bgy": "barangay", "bgry": "barangay",
    "mun": "municipality", "municipal": "municipality", "lgu": "lgu", "dist": "district", "hosp": "hospital", "univ": "university", "prov": "provincial", "natl": "national",
    "regl": "regional", "ofc": "office", "ofcs": "office", "off": "office", "govt": "government", "gov": "government", "bu": "bureau", "admin": "administration", "adm": "administration", "comm": "commission",
    "const": "construction", "constr": "construction", "ent": "enterprises", "entps": "enterprises", "entp": "enterprises", "sw": "software", "mdse": "merchandise", "gen": "general", "ctr": "center", "cntr": "center",
    "sec": "security", "agcy": "agency", "svcs": "services", "svc": "services", "serv": "services", "sup": "supply", "med": "medical", "equipt": "equipment", "eqpt": "equipment", "sys": "systems",
    "provl": "provincial", "cmd": "command", "brd": "board", "fin": "finance", "indl": "industrial", "ind": "industrial", "elec": "electrical", "electl": "electrical", "hdwe": "hardware", "hdw": "hardware", "stn": "station", "sta": "station", "bldrs": "builders", "trdg": "trading", "trdng": "trading",
    "distribtrs": "distributors", "distr": "distributors", "sch": "school", "soln": "solutions", "solns": "solutions", "wrks": "works", "pwr": "power", "bldg": "building", "bldgs": "buildings", "meds": "medicines",
    "autoparts": "auto parts", "agr": "agri", "agriventures": "agri ventures", "fuelstation": "fuel station", "dept": "department", "pharm": "pharma", "pres": "press", "prtg": "printing", "intl": "international",
}
# Words left out of kinds and cores.
FILLERS = frozenset("of the and for no num number region regional de la ng".split())
# Titles before a person's name.
TITLES = frozenset("engr dr atty mr mrs ms arch prof hon capt col gen rev sir".split())
# Nicknames and the given names they stand for.
NICKNAMES = {
    "vicky": "victoria", "viki": "victoria", "toria": "victoria", "naty": "natividad", "naty": "natividad", "ferdie": "fernando", "nanding": "fernando", "nards": "leonardo", "narding": "leonardo", "leo": "leonardo",
    "edong": "eduardo", "eddie": "eduardo", "ed": "eduardo", "edgar": "edgardo", "ben": "benjamin", "benjie": "benjamin", "benny": "benjamin", "tonyo": "antonio", "tony": "antonio", "ton": "antonio", "kiko": "francisco", "isko": "francisco", "paco": "francisco", "frank": "francisco",
    "pat": "patricia", "tricia": "patricia", "patty": "patricia", "greg": "gregorio", "goryo": "gregorio", "ric": "ricardo", "ricky": "ricardo", "carding": "ricardo", "manoling": "manuel", "maning": "manuel", "manny": "manuel", "manolo": "manuel", "manding": "armando",
    "sam": "samuel", "sammy": "samuel", "bert": "roberto", "berto": "roberto", "bobby": "roberto", "obet": "roberto", "rob": "roberto", "josie": "josefina", "pina": "josefina", "pining": "josefina", "jo": "josefina", "cora": "corazon", "cory": "corazon", "azon": "corazon",
    "tess": "teresita", "tessie": "teresita", "sita": "teresita", "terry": "teresita", "cathy": "catalina", "lina": "catalina", "cata": "catalina", "caty": "catalina", "margie": "margarita", "rita": "margarita", "marga": "margarita", "itang": "margarita", "maggie": "margarita",
    "alex": "alejandro", "andro": "alejandro", "ali": "alejandro", "jun": "junior", "boy": "", "nene": "", "inday": "", "dodong": "",
    "pepe": "jose", "peping": "jose", "joe": "jose", "juaning": "juan", "johnny": "juan", "pedring": "pedro", "peter": "pedro", "charing": "rosario", "chayong": "rosario", "lourdes": "lourdes", "lulu": "lourdes", "baby": "",
    "nita": "juanita", "luz": "luzviminda", "luzvi": "luzviminda", "mila": "milagros", "remy": "remedios", "conching": "concepcion", "connie": "concepcion", "chito": "jose", "nonoy": "", "totoy": "",
}

_ROMAN = re.compile(r"(?=[ivxl])(x{0,3})(ix|iv|v?i{0,3})")


def _roman(w: str) -> int | None:
    m = _ROMAN.fullmatch(w)
    if not m or not w:
        return None
    ones = {"": 0, "i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9}
    return 10 * len(m[1]) + ones[m[2]]


def edit(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance with unrestricted transpositions (a metric), or ``most + 1`` if it is larger."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    if a == b:
        return 0
    big = n + m
    last: dict[str, int] = {}
    rows = [[big] * (m + 2), [big, *range(m + 1)]]
    for i in range(1, n + 1):
        row = [big, i] + [big] * m
        rows.append(row)
        at = 0
        lo, hi = max(1, i - most), min(m, i + most)
        for j in range(lo, hi + 1):
            k, w = last.get(b[j - 1], 0), at
            if a[i - 1] == b[j - 1]:
                cost, at = 0, j
            else:
                cost = 1
            row[j + 1] = min(rows[i][j] + cost, row[j] + 1, rows[i][j + 1] + 1, rows[k][w] + (i - k - 1) + 1 + (j - w - 1))
        last[a[i - 1]] = i
    d = rows[n + 1][m + 1]
    return d if d <= most else most + 1


@lru_cache(200_000)
def _kind_word(w: str) -> str | None:
    """The kind word(s) that ``w`` stands for: itself, a short form or a misspelling; None for other words."""
    if w in KINDS or w in LEGAL:
        return w
    if w in SHORT:
        return SHORT[w]
    if len(w) >= 6:
        near = [k for k in KINDS | LEGAL if abs(len(k) - len(w)) <= 1 and len(k) >= 5 and edit(w, k, 1) <= 1]
        if len(near) == 1:
            return near[0]
    return None


def _words(name: str) -> list[str]:
    s = plain(name)
    s = re.sub(r"(?<=\w)'(?=\w)", "", s).replace("s/w", "sw").replace("&", " and ")
    return re.findall(r"[^\W_]+", s)


def _cut(word: str) -> list[str]:
    """A run-together word as [rest, kind word] or [kind word, kind word]; itself if it does not end in a kind word."""
    if len(word) < 6 or word in KINDS or word in LEGAL or word in SHORT:
        return [word]
    known = lambda w: w in KINDS or w in LEGAL or w in SHORT or w == "and"
    for i in range(3, len(word) - 1):
        if known(word[:i]) and known(word[i:]):
            return [word[:i], word[i:]]
    if len(word) < 8:
        return [word]
    for k in sorted(KINDS | LEGAL, key=len, reverse=True):
        if len(k) >= 4 and word.endswith(k) and len(word) - len(k) >= 3:
            return [*_cut(word[: -len(k)]), k]
    return [word]


def read_person(words: list[str]) -> tuple[str, str, str] | None:
    """(surname, given or its initial, middle initial) of a personal name's words, or None.

    Orders: given [middle] surname; surname given; surname, given [middle]; initials surname.
    """
    words = [w for w in words if w not in TITLES]
    initials = [w for w in words if len(w) == 1]
    full = [w for w in words if len(w) > 1]
    if not full or len(words) > 4 or len(words) < 2:
        return None
    given = [w for w in full if w in GIVEN or w in NICKNAMES or any(edit(w, g, 1) <= 1 for g in GIVEN if len(g) > 4)]
    if len(full) == 1 and initials:
        surname = full[0]
        if surname in GIVEN:
            return None
        order = [w for w in words if len(w) == 1]
        return surname, order[0], order[1] if len(order) > 1 else ""
    if len(full) == 2 and given:
        g = given[0]
        surname = next(w for w in full if w != g) if full.count(g) < 2 else g
        return surname, _given(g), initials[0] if initials else ""
    return None


# Given names that nicknames stand for.
GIVEN = frozenset(x for x in NICKNAMES.values() if x)


def _given(w: str) -> str:
    if w in NICKNAMES:
        return NICKNAMES[w]
    if w in GIVEN:
        return w
    near = [g for g in GIVEN if len(g) > 4 and edit(w, g, 1) <= 1]
    return near[0] if len(near) == 1 else w


def read_name(name: str | None) -> tuple[str, list[str], str, str] | None:
    """(kind, core words, given, middle) of a name; None if it has no words. Given and middle are for persons."""
    if name is None:
        return None
    words = _words(name)
    if not words:
        return None
    # A short form of the rest put before it.
    if len(words) > 3 and words[0] not in KINDS and 2 < len(words[0]) <= 6:
        rest = [w for w in words[1:]]
        if words[0] in ("".join(w[0] for w in rest), "".join(w[0] for w in rest if w not in FILLERS)):
            words = rest
    if "branch" in words and words.index("branch") > 1:
        i = words.index("branch")
        words = words[: i - 1] + words[i + 1 :]
    parts: list[str] = []
    for w in words:
        parts.extend(_cut(w))
    out, kind = [], []
    for i, w in enumerate(parts):
        if w.isdigit():
            out.append(str(int(w)))
            continue
        r = _roman(w)
        if r and (i == len(parts) - 1 or parts[i - 1] in ("no", "region")) and i:
            out.append(str(r))
            continue
        if w in FILLERS:
            continue
        if w == "st" and parts[i + 1 : i + 2] in (["university"], ["univ"]):
            w = "state"
        k = _kind_word(w)
        if k is None:
            out.append(w)
            continue
        for x in k.split():
            if x in FILLERS:
                continue
            if x in KINDS or x == "lgu":
                kind.append(x if x == "press" else x.rstrip("s"))
            elif x not in LEGAL:
                out.append(x)
    if not kind and (p := read_person(words)):
        return "person", [p[0]], p[1], p[2]
    ks = set(kind)
    if "lgu" in ks:
        ks.discard("lgu")
        ks.add("city" if "city" in ks else "municipality")
    if ks & {"city", "municipality", "province"}:
        ks.discard("government")
    if "pharma" in ks and "district" in ks:  # "dist." means both
        ks = ks - {"district"} | {"distributor"}
    return " ".join(sorted(ks)), out, "", ""


#: Radius of the join (Levenshtein; a swap of neighbours counts two).
RADIUS = 2
#: Width of a cell along one pivot's distance, pivots that make cells (the empty name, whose distance is the length, is one more), and pivots that only filter.
WIDTH, CELL_PIVOTS, FILTER_PIVOTS = 5, 2, 6
PIVOT_LETTERS = 64
#: Points of a bucket (a small cell, or one segment of a larger one) that one task joins with its visitors; larger ones are split.
CELL_POINTS = 4000
#: Points from which on a cell is joined by segments.
SMALL_CELL = 1000


def read_names(names: DataFrame) -> DataFrame:
    """(field, name, kind, words, given, middle, key, points) of each row (field, name) of ``names`` that has words.

    ``key`` joins what needs no edit to agree; ``points`` are the core's letters in the orders a partner may have.
    """
    schema = "field string, name string, kind string, words array<string>, given string, middle string, key string, points array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for f, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = read_name(n)
                if got is None:
                    continue
                kind, words, given, middle = got
                joined = "".join(words)
                two = len(words) == 2 and min(map(len, words)) >= 4 and not any(w.isdigit() for w in words)
                points = sorted({joined, words[1] + words[0]}) if two else [joined]
                if two:
                    words = sorted(words)
                rows.append((f, n, kind, words, given, middle, "|".join([kind, " ".join(words), given, middle]), points))
            cols = list(zip(*rows)) or [()] * 8
            kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["field", "name", "kind", "words", "given", "middle", "key", "points"])

    return fanned(names.select("field", "name")).mapInArrow(run, schema)


def choose_pivots(points: DataFrame, n: int, sample: int = 96) -> list[str]:
    """``n`` pivots far apart, from a sample of ``sample`` points in order of their hash (so the choice is the same each time).

    Points over ``PIVOT_LETTERS`` are no pivots, so that a distance costs little whatever the point's length.
    """
    found = [r.point for r in points.filter(F.length("point") <= PIVOT_LETTERS).select("point").distinct().orderBy(F.md5("point"), "point").limit(sample).collect()]
    chosen: list[str] = []
    while found and len(chosen) < n:
        best = max(found, key=lambda x: (min((edit(x, c, 99) for c in chosen), default=len(x)), x))
        chosen.append(best)
        found.remove(best)
    return chosen


def _bounds(length: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Begin (from 0) and width of segment ``i`` of a text of ``length`` cut evenly in ``parts``."""
    at = F.floor(i * length / parts).cast("int")
    return at, F.floor((i + 1) * length / parts).cast("int") - at


def segments(point: Column, radius: int) -> Column:
    """(size, i, text) of each of the radius + 1 segments of a point."""
    n = F.length(point)

    def one(i: Column) -> Column:
        at, width = _bounds(n, i, radius + 1)
        return F.struct(n.alias("size"), i.alias("i"), F.substr(point, at + 1, width).alias("text"))

    return F.transform(F.sequence(F.lit(0), F.lit(radius)), one)


def probes(point: Column, radius: int) -> Column:
    """(size, i, text) of the places of a point where an untouched segment of a partner of each possible size may lie.

    Of a pair within ``radius`` one segment is untouched. If it lies d places later in the point, whose length exceeds the partner's by D, its left side
    took |d| edits at least and its right side |D - d|, so the two add up to ``radius`` at most.
    """
    n = F.length(point)

    def size(m: Column) -> Column:
        over = n - m
        first, last = F.ceil((over - radius) / 2).cast("int"), F.floor((over + radius) / 2).cast("int")

        def segment(i: Column) -> Column:
            at, width = _bounds(m, i, radius + 1)
            there = F.transform(F.sequence(first, last), lambda d: F.struct(m.alias("size"), i.alias("i"), (at + d).alias("at"), width.alias("width")))
            there = F.filter(there, lambda x: (x["at"] >= 0) & (x["at"] + x["width"] <= n))
            return F.transform(there, lambda x: F.struct(x["size"], x["i"], F.substr(point, x["at"] + 1, x["width"]).alias("text")))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(radius)), segment))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(n - radius, F.lit(0)), n + radius), size)))


def candidates(points: DataFrame, block: list[str], radius: int = RADIUS, width: int = WIDTH, cell_points: int = CELL_POINTS, small: int = SMALL_CELL) -> tuple[DataFrame, int]:
    """Pairs of ``points`` (columns ``block``, ``point``, ``id``) that meet in a bucket, with their pivot distances (da, db), and the number of pivots."""
    pivots = choose_pivots(points, CELL_PIVOTS + FILTER_PIVOTS)
    dist = points.withColumn("d", F.array(F.length("point"), *[F.levenshtein("point", F.lit(p)) for p in pivots]))
    dims = min(1 + CELL_PIVOTS, 1 + len(pivots))
    home = dist.withColumn("cell", F.array(*[F.floor(F.col("d")[i] / width) for i in range(dims)]))
    cells = written(home.groupBy(*block, "cell").agg((F.count("*") > small).alias("big")), "cells")
    whole = F.array(F.struct(F.lit(-1).alias("size"), F.lit(0).alias("i"), F.lit("").alias("text")))
    bucket = lambda df, of: df.withColumn("b", F.explode(F.when(F.col("big"), of(F.col("point"), radius)).otherwise(whole))).select("*", "b.*").drop("b", "big")
    keys = [*block, "cell", "size", "i", "text"]
    home = bucket(home.join(cells, [*block, "cell"]), segments)
    parts = home.groupBy(*keys).agg(F.ceil(F.count("*") / cell_points).cast("int").alias("parts")).filter("parts > 1")
    home = home.join(parts, keys, "left").withColumn("part", F.pmod(F.xxhash64("id", "point"), F.coalesce("parts", F.lit(1))).cast("int"))
    visit = dist
    for i in range(dims):
        visit = visit.withColumn(f"c{i}", F.explode(F.sequence(F.floor((F.col("d")[i] - radius) / width), F.floor((F.col("d")[i] + radius) / width))))
    visit = bucket(visit.withColumn("cell", F.array(*[f"c{i}" for i in range(dims)])).join(cells, [*block, "cell"]), probes)
    visit = visit.join(parts, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    a = visit.select(*keys, "part", F.col("id").alias("id_a"), F.col("point").alias("pa"), F.col("d").alias("da"))
    b = home.select(*keys, "part", F.col("id").alias("id_b"), F.col("point").alias("pb"), F.col("d").alias("db"))
    return a.join(b, [*keys, "part"]).filter(F.col("id_a") < F.col("id_b")), len(pivots)


def radius_join(points: DataFrame, block: list[str], point: str, radius: int = RADIUS, width: int = WIDTH, cell_points: int = CELL_POINTS, small: int = SMALL_CELL) -> DataFrame:
    """Pairs of ``points`` (columns ``block``, ``point``, ``id``) of one block whose points are within ``radius``: (id_a, id_b, distance), id_a < id_b.

    Exact: every such pair is found. A point is at home in the cell of its pivot distances and visits the cells in which
    a partner's distances may lie (each differs by ``radius`` at most). Cells of over ``small`` points are joined by segments, so pairs looked at grow with
    the points that share one, not with the square of the cell.
    """
    pts = points.withColumnRenamed(point, "point") if point != "point" else points
    met, pivots = candidates(pts, block, radius, width, cell_points, small)
    near = F.lit(True)
    for i in range(1 + pivots):
        near = near & (F.abs(F.col("da")[i] - F.col("db")[i]) <= radius)
    pairs = met.filter(near).withColumn("distance", F.levenshtein("pa", "pb", radius)).filter(F.col("distance") >= 0)
    return pairs.groupBy("id_a", "id_b").agg(F.min("distance").alias("distance"))


def _compatible(a: tuple[str, str], b: tuple[str, str]) -> bool:
    """Whether two persons' (given, middle) may be one person's."""
    (g, m), (h, k) = a, b
    if m and k and m != k:
        return False
    if not g or not h:
        return True
    if len(g) == 1 or len(h) == 1:
        return g[0] == h[0]
    return g == h


#: A word used by at most this share of the names that use its neighbour (or by one name only) counts as its misspelling.
RARE_SHARE = 0.2
#: The same share where a letter is swapped, left out or added.
SLIP_SHARE = 0.5


def _rare(a: str, b: str, used_a: int, used_b: int) -> bool:
    """Whether one word is rare enough beside the other to be its misspelling. Words of other letters (and as many) need the most evidence."""
    slip = len(a) != len(b) or sorted(a) == sorted(b)
    return min(used_a, used_b) <= max(1, (SLIP_SHARE if slip else RARE_SHARE) * max(used_a, used_b))


def evidence(wa: list[str], wb: list[str], ua: list[int], ub: list[int], pa_: tuple, pb: tuple, distance: int) -> bool:
    """Whether two keys of one kind within the radius name the same: see the module's text."""
    if pa_[0] or pb[0]:  # persons: core is the surname
        if not _compatible(pa_, pb):
            return False
        if not distance:
            return True
        if edit(wa[0], wb[0], 1) > 1:
            return False
        return (pa_ == pb and len(pa_[0]) > 1) or _rare(wa[0], wb[0], ua[0], ub[0])
    if not distance:
        return True
    if sorted(w for w in wa if w.isdigit()) != sorted(w for w in wb if w.isdigit()):
        return False
    ja, jb = "".join(wa), "".join(wb)
    if len(wa) == len(wb):
        # Words that differ, in the pairing that leaves the fewest.
        rest_a, rest_b = list(wa), list(wb)
        for w in wa:
            if w in rest_b:
                rest_a.remove(w)
                rest_b.remove(w)
        if not rest_a:
            return True
        if len(rest_a) == 2:  # a slip in each of two words, which both must be misspellings
            x, y = rest_a
            v, w = rest_b if edit(x, rest_b[0], 1) <= 1 else rest_b[::-1]
            count_a, count_b = (lambda t: ua[wa.index(t)]), (lambda t: ub[wb.index(t)])
            sure = lambda t, u: min(len(t), len(u)) >= 5 and edit(t, u, 1) <= 1 and _rare(t, u, count_a(t), count_b(u)) and min(count_a(t), count_b(u)) <= 1
            return sure(x, v) and sure(y, w)
        if len(rest_a) > 2:
            return False
        a, b = rest_a[0], rest_b[0]
        used_a, used_b = ua[wa.index(a)], ub[wb.index(b)]
        if len(a) < 4 or len(b) < 4:
            return False
        if edit(a, b, 1) <= 1:
            return _rare(a, b, used_a, used_b)
        return len(ja) >= 14 and len(a) >= 8 and _rare(a, b, used_a, used_b) and max(used_a, used_b) > 1
    odd_a, odd_b = [w for w in wa if w not in wb], [w for w in wb if w not in wa]
    once = min(max((ua[wa.index(w)] for w in odd_a), default=0), max((ub[wb.index(w)] for w in odd_b), default=0))
    return len(ja) >= 8 and distance <= 2 and once <= 1


def excluded(a: dict, b: dict) -> bool:
    """Whether two keys of one kind (words, used, given, middle) cannot name the same: persons of other names, other numbers, or differing words that names use too much to be misspellings of one another."""
    pa_, pb = (a["given"], a["middle"]), (b["given"], b["middle"])
    if pa_[0] or pb[0]:
        if not _compatible(pa_, pb):
            return True
        if pa_ == pb and len(pa_[0]) > 1:
            return False
    used = dict(zip(a["words"], a["used"])), dict(zip(b["words"], b["used"]))
    rest_a, rest_b = list(a["words"]), list(b["words"])
    for w in a["words"]:
        if w in rest_b:
            rest_a.remove(w)
            rest_b.remove(w)
    if sorted(w for w in rest_a if w.isdigit()) != sorted(w for w in rest_b if w.isdigit()):
        return "".join(a["words"]) != "".join(b["words"])
    if len(rest_a) != len(rest_b) or sorted("".join(rest_a)) == sorted("".join(rest_b)):
        return False
    while rest_a:  # each word beside the one most like it
        x, y = min(((x, y) for x in rest_a for y in rest_b), key=lambda p: (edit(*p, 99), p))
        rest_a.remove(x)
        rest_b.remove(y)
        few, many = sorted((used[0][x], used[1][y]))
        if few > max(1, SLIP_SHARE * many):  # a lesser share leaves a chain of links its say
            return True
    return False


def components(links: DataFrame) -> DataFrame:
    """(id, component) of each key in ``links`` (id, to): the least key that links lead to from it."""
    both = written(links.unionByName(links.select(F.col("to").alias("id"), F.col("id").alias("to"))), "links")
    at = written(both.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("component")), "components")
    while True:
        near = both.join(at.select(F.col("id").alias("to"), F.col("component").alias("c")), "to").groupBy("id").agg(F.min("c").alias("c"))
        lower = at.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "c").alias("component"))
        # The least key reached has been further itself: the way left halves each time.
        further = at.select(F.col("id").alias("component"), F.col("component").alias("next"))
        moved = written(lower.join(further, "component", "left").select("id", "was", F.least("component", "next").alias("component")), "components")
        at = moved.select("id", "component")
        if not moved.filter(F.col("was") != F.col("component")).limit(1).count():
            return at


def divided(links: list[dict]) -> list[tuple[str, str]]:
    """(key, entity) of the keys of one component's ``links`` (id, to, distance, a, b).

    All links hold unless they would bring together keys that exclude each other; then those of the strongest key (by fullness,
    spellings, links) hold. The entity is the least key.
    """
    keys = {x["id"]: x["a"] for x in links} | {x["to"]: x["b"] for x in links}
    degree = Counter(k for x in links for k in (x["id"], x["to"]))
    strength = lambda k: (keys[k]["full"], keys[k]["n"], degree[k], k)
    group = {k: [k] for k in keys}
    for x in sorted(links, key=lambda x: (x["distance"] > 0, *[[-v for v in strength(k)[:3]] + [k] for k in sorted((x["id"], x["to"]), key=strength, reverse=True)])):
        one, other = group[x["id"]], group[x["to"]]
        if one is other or any(excluded(keys[j], keys[k]) for j in one for k in other):
            continue
        one.extend(other)
        for k in other:
            group[k] = one
    return [(k, min(g)) for k, g in group.items()]


def link_names(names: DataFrame) -> DataFrame:
    """(field, name, entity) for each row (field, name) of ``names`` that has words; names of one field and entity are spellings of one another.

    Fields are resolved apart. Null and wordless names have no rows; repeated rows are one. A name alike only by an initial
    or nickname to several persons that exclude each other stays by itself. An empty table gives an empty table.
    """
    read = read_names(names.filter(F.col("name").isNotNull()).distinct())
    read = written(read.withColumn("id", F.md5(F.concat_ws("|", "field", "key"))).drop("key"), "names")
    keys = read.groupBy("id").agg(*[F.min(c).alias(c) for c in ("field", "kind", "words", "given", "middle")], F.count(F.lit(1)).alias("n"), F.flatten(F.collect_set("points")).alias("points"))
    usage = keys.select("id", F.posexplode("words").alias("at", "w"))
    used = usage.select("w", "id").distinct().groupBy("w").agg(F.count("*").alias("u"))
    each = usage.join(used, "w").groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "u"))), lambda x: x["u"]).alias("used"))
    keys = keys.join(each, "id", "left").withColumn("used", F.coalesce("used", F.array().cast("array<bigint>")))
    # Persons' fullness: given and middle name, given name, initials.
    full = F.when(F.col("kind") != "person", 0).otherwise(2 * (F.length("given") > 1).cast("int") + (F.length("middle") > 0).cast("int"))
    keys = written(keys.withColumn("full", full), "keys")
    points = keys.select("field", "kind", "id", F.explode(F.array_distinct("points")).alias("point"))
    pairs = radius_join(written(points, "points"), ["field", "kind"], "point")
    side = lambda s: keys.select(F.col("id").alias(f"id_{s}"), F.struct("words", "used", "given", "middle", "n", "full").alias(s))
    pairs = pairs.join(side("a"), "id_a").join(side("b"), "id_b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                evidence(a["words"], b["words"], a["used"], b["used"], (a["given"], a["middle"]), (b["given"], b["middle"]), d)
                for a, b, d in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("distance").to_pylist())
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    good = pairs.select("id_a", "id_b", "distance", "a", "b").mapInArrow(judge, pairs.select("id_a", "id_b", "distance", "a", "b").schema)
    both = good.select(F.col("id_a").alias("id"), "a", F.col("id_b").alias("to"), "b", "distance").unionByName(good.select(F.col("id_b").alias("id"), F.col("b").alias("a"), F.col("id_a").alias("to"), F.col("a").alias("b"), "distance"))
    # Seen from the weaker key of each link.
    rank = lambda s, i: F.struct(F.col(f"{s}.full").alias("full"), F.col(f"{s}.n").alias("n"), F.col(i).alias("id"))
    up = written(both.filter(rank("b", "to") > rank("a", "id")), "links")
    # Persons whose partners leave open who is meant: several given names, or several middle initials.
    several = lambda c, least: F.size(F.collect_set(F.when(F.length(c) > least, F.col(c)))) > 1
    unclear = up.groupBy("id").agg(F.max(F.length("a.given") > 0).alias("person"), several("b.given", 1).alias("givens"), several("b.middle", 0).alias("middles")).filter(F.col("person") & (F.col("givens") | F.col("middles")))
    links = written(up.join(unclear.select("id"), "id", "left_anti"), "links")
    whole = links.join(components(links.select("id", "to")), "id").groupBy("component").agg(F.collect_list(F.struct("id", "to", "distance", "a", "b")).alias("links"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [x for c in batch.column("links").to_pylist() for x in divided(c)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["id", "entity"])

    found = read.select("field", "name", "id").join(whole.select("links").mapInArrow(part, "id string, entity string"), "id", "left")
    return found.select("field", "name", F.coalesce("entity", "id").alias("entity"))


#: Spellings of one entity that one task pairs with all its others.
ENTITY_POINTS = 2000


def spelling_pairs(names: DataFrame) -> DataFrame:
    """(field, name_a, name_b), name_a < name_b: each pair of different spellings in ``names`` (field, name) of one entity.

    ``link_names`` gives the same as membership, in one row a name. Entities of very many spellings are spread over several tasks.
    """
    linked = written(link_names(names), "linked")
    parts = linked.groupBy("field", "entity").agg(F.ceil(F.count("*") / ENTITY_POINTS).cast("int").alias("parts")).filter("parts > 1")
    linked = linked.join(F.broadcast(parts) if parts.limit(10_001).count() <= 10_000 else parts, ["field", "entity"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    a = linked.select("field", "entity", F.col("name").alias("name_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    b = linked.select("field", "entity", F.col("name").alias("name_b"), F.pmod(F.xxhash64("name"), F.col("parts")).cast("int").alias("part"))
    return a.join(b, ["field", "entity", "part"]).filter(F.col("name_a") < F.col("name_b")).select("field", "name_a", "name_b")


def stacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-empty values of ``columns`` as rows (field, name)."""
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("name")) for c in columns]))
    return df.select(kinds.alias("x")).select("x.field", "x.name").filter(F.length("name") > 0).distinct()
