import itertools
import random

import pytest

from brightledger.llm import names

SAME = [
    ["DABIGOLO LOLODOTA TRADING CORPORATION", "dabigolo lolodota trdg. corp", "LOLODOTA DABIGOLO TRADING", "DABIGOLOLOLODOTA TRADING CORP.", "DABI GOLO LOLODOTA TRADING", "«Dabigolo-Lolodota Trading»", "DABIGOLO LOODOTA TRADING", "DАBIGOLO LOLODOTA TRADING CORPORATION - NAGA BRANCH"],
    ["DABIGOLO MIKABUMI MEDICAL SUPPLY", "DABIGOLO MIKABUMI MED. SUP. INC"],
    ["LOLODOTA MIKABUMI AUTO PARTS CENTER", "Lolodota Mikabumi Autoparts Ctr."],
    ["REGIONAL BRIDGE OFFICE NO. XVI", "REG'L BRIDGE OFFICE NO.XVI", "BRIDGE OFFICE, REGION 16", "REGIONAL BRIDGE OFFICE #16"],
    ["REGIONAL BRIDGE OFFICE NO. XV", "Regional Bridge Ofc. No. 15"],
    ["CITY OF DOVAGOLA", "DOVAGOLA CITY", "CITY GOV'T OF DOVAGOLA", "LGU DOVAGOLA CITY"],
    ["MUNICIPALITY OF DOVAGOLA, EMBARRADO", "MUN. OF DOVAGOLA, EMBARRADO", "LGU-DOVAGOLA EMBARRADO", "DOVAGOLA MUNICIPALITY (EMBARRADO)"],
    ["MUNICIPALITY OF DOVAGOLA, CALINDORO"],
    ["DOVAGOLA NHS", "DOVAGOLA National High Sch.", "NATIONAL HIGH SCHOOL, DOVAGOLA"],
    ["NRCA - NATIONAL ROADS & CULVERTS AUTHORITY", "NATIONAL ROADS AND CULVERTS AUTHORITY"],
    ["Fernando C. Lenibukima", "NANDING LENIBUKIMA", "LENIBUKIMA, FERNANDO C.", "Engr. Fernando C. Lenibukima"],
    ["Catalina B. Lenibukima", "LENIBUKIMA, C."],
    ["Roberto C. Gakakabimi", "R. C. GAKAKABIMI"],
    ["Natividad C. Gakakabimi"],
]


def test_spellings(spark):
    data = [("f", n) for g in SAME for n in g]
    df = spark.createDataFrame([*data, *data, ("f", None), ("f", " "), ("f", "---"), ("g", SAME[0][0]), ("g", "word " * 4_000)], "field string, name string")
    got = {(r.field, r.name_a, r.name_b) for r in names.spelling_pairs(df).collect()}
    want = {("f", *sorted(p, key=lambda s: s.encode())) for g in SAME for p in itertools.combinations(g, 2)}
    assert got - want == set() and want - got == set()


def test_empty(spark):
    assert names.spelling_pairs(spark.createDataFrame([], "field string, name string")).count() == 0


def test_initial_of_two_persons_links_to_neither(spark):
    df = spark.createDataFrame([("f", n) for n in ("Manuel B. Tadobe", "Margarita B. Tadobe", "TADOBE, M.")], "field string, name string")
    assert names.spelling_pairs(df).count() == 0


def test_real_words_are_not_misspellings(spark):
    # Two words a letter apart, each used by several names.
    kinds = ["TRADING", "FUEL STATION", "CONSTRUCTION", "OFFICE SYSTEMS"]
    df = spark.createDataFrame([("f", f"{w} MIKABUMI {k}") for w in ("GIBELAMO", "GOBELAMO") for k in kinds], "field string, name string")
    assert names.spelling_pairs(df).count() == 0


STARS = [["TABODAKI BOBEDUKU", "TABODDAKI BOBEDUKU", "TABODAKI BOEBDUKU"], ["GIMOLATE RISOPADU", "GIMOLLATE RISOPADU", "GIMOLATE RISSOPADU", "GIMOLAET RISOPADU"]]


def test_misspellings_of_one_name_meet_whichever_key_is_least(spark):
    # All keys have one spelling, so their hashes order them; the kinds give each order its turn.
    kinds = ["SECURITY AGENCY", "FUEL STATION", "AUTO PARTS", "LUMBER", "OFFICE SYSTEMS", "TEXTILE", "PRINTING PRESS", "HARDWARE"]
    groups = [[f"{n} {k}" for n in g] for i, g in enumerate(STARS) for k in kinds[4 * i : 4 * i + 4]]
    # The words of a star's kinds are told apart, so that each misspelling is used once.
    groups = [[n.replace("O", "AEIU"[i % 4]).replace("U ", "O ") if i % 4 else n for n in g] for i, g in enumerate(groups)]
    got = {(r.name_a, r.name_b) for r in names.spelling_pairs(spark.createDataFrame([("f", n) for g in groups for n in g], "field string, name string")).collect()}
    assert got == {tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2)}


def test_misspelling_between_two_real_names_does_not_join_them(spark):
    kinds = ["TRADING", "FUEL STATION", "CONSTRUCTION", "OFFICE SYSTEMS"]
    real = [f"{w} MIKABUMI {k}" for w in ("GIBELAMO", "GOBELAMU") for k in kinds]
    df = spark.createDataFrame([("f", n) for n in [*real, "GOBELAMO MIKABUMI TRADING"]], "field string, name string")
    got = {(r.name_a, r.name_b) for r in names.spelling_pairs(df).collect()}
    assert len(got) == 1 and "GOBELAMO MIKABUMI TRADING" in next(iter(got))


def test_persons_of_one_entity_do_not_exclude_each_other(spark):
    # The initials fit the name without a middle initial, which is that of another person.
    df = spark.createDataFrame([("f", n) for n in ("Roberto B. Gakakabimi", "Roberto Gakakabimi", "R. C. GAKAKABIMI")], "field string, name string")
    got = {(r.name_a, r.name_b) for r in names.spelling_pairs(df).collect()}
    assert got == {("Roberto B. Gakakabimi", "Roberto Gakakabimi")}


def test_components_against_brute_force(spark):
    rnd = random.Random(5)
    links = [(f"{a:03d}", f"{b:03d}") for a, b in [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)] if a != b] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(30)]
    root = {k: k for x in links for k in x}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.component for r in names.components(spark.createDataFrame(links, "id string, to string")).collect()}
    assert got == root


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize(("cell_points", "small"), [(4000, 1000), (3, 1000), (4000, 0), (2, 4)])
def test_radius_join_against_brute_force(spark, cell_points, small):
    rnd = random.Random(8)
    base = ["".join(rnd.choice("abk") + rnd.choice("aeo") for _ in range(rnd.randint(1, 7))) for _ in range(60)]
    pts = list(dict.fromkeys(base + [b[:k] + rnd.choice("xyz") + b[k + 1 :] for b in base for k in [rnd.randrange(len(b))]] + [""]))
    data = [(rnd.choice("pq"), p, f"{i:03d}") for i, p in enumerate(pts)]
    df = spark.createDataFrame(data, "g string, point string, id string")
    got = {(r.id_a, r.id_b): r.distance for r in names.radius_join(df, ["g"], "point", cell_points=cell_points, small=small).collect()}
    want = {(i, j): lev(p, q) for (g, p, i), (h, q, j) in itertools.permutations(data, 2) if g == h and i < j and lev(p, q) <= names.RADIUS}
    assert got == want


def slow_edit(a, b):
    """Damerau-Levenshtein by breadth-first search over edits (short strings)."""
    seen, front, d = {a}, {a}, 0
    letters = set(a + b)
    while b not in front:
        d += 1
        nxt = set()
        for s in front:
            for i in range(len(s) + 1):
                nxt |= {s[:i] + c + s[i:] for c in letters}
                if i < len(s):
                    nxt.add(s[:i] + s[i + 1 :])
                    nxt |= {s[:i] + c + s[i + 1 :] for c in letters}
                if i + 1 < len(s):
                    nxt.add(s[:i] + s[i + 1] + s[i] + s[i + 2 :])
        front = {s for s in nxt - seen if len(s) <= len(b) + 2}
        seen |= nxt
    return d


def test_edit_is_damerau_levenshtein():
    rnd = random.Random(9)
    for _ in range(60):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 3))) for _ in range(2))
        assert names.edit(a, b, 9) == slow_edit(a, b), (a, b)
        assert names.edit(a, b, 1) == min(2, slow_edit(a, b))


def planted(seed=5, firms=150):
    """Names whose kind words are on no list, with typed variants; (rows, pairs that name the same)."""
    rnd = random.Random(seed)
    kinds = ["Bakery", "Clinic", "Laundry", "Pawnshop", "Quarry Works Yard", "Bookbinders", "Ice Plant", "Tannery"]
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(3, 5)))
    rows, groups = set(), []
    for _ in range(firms):
        own, kind = [word(), word()], rnd.choice(kinds).split()
        forms = set()

        def typed(words, forms=forms):
            s = " ".join(words)
            forms.add(rnd.choice([s, s.upper(), s.title(), s + " Inc.", s + ", Incorporated", s.replace(" ", "  ", 1), s + " Co., Ltd."]))

        for _ in range(4):
            typed(own + kind)
        for k in range(2):
            w = list(own)
            x = w[k]
            i = rnd.randrange(1, len(x) - 1)
            w[k] = rnd.choice([x[:i] + x[i + 1 :], x[:i] + x[i] + x[i:], x[:i] + x[i + 1] + x[i] + x[i + 2 :], x[:i] + "x" + x[i + 1 :]])
            typed(w + kind)
        groups.append(forms)
        rows |= forms
    return sorted(rows), {tuple(sorted(p)) for g in groups for p in itertools.combinations(g, 2)}


def test_kind_words_outside_the_lists(spark):
    rows, want = planted()
    df = spark.createDataFrame([("f", n) for n in rows], "field string, name string")
    got = {tuple(sorted((r.name_a, r.name_b))) for r in names.spelling_pairs(df).collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got & want) >= 0.98 * len(got), (len(want), len(got), len(got & want))


def test_hot_entity_is_split(spark, monkeypatch):
    rows = [("f", "Tabodaki" + " " * k + "Trading" + "." * j) for k in range(1, 8) for j in range(6)]
    df = spark.createDataFrame(rows, "field string, name string")
    monkeypatch.setattr(names, "ENTITY_POINTS", 5)
    got = [(r.name_a, r.name_b) for r in names.spelling_pairs(df).collect()]
    assert len(got) == len(set(got)) == 42 * 41 // 2


def test_a_slip_in_each_of_two_words():
    none = ("", "")
    assert names.evidence(["tabodaki", "bobeduku"], ["tabodaxi", "bobeduxu"], [9, 9], [1, 1], none, none, 2)
    assert names.evidence(["tabodaki", "bobeduku"], ["bobeduxu", "tabodaxi"], [9, 9], [1, 1], none, none, 2)
    assert not names.evidence(["tabodaki", "bobeduku"], ["tabodaxi", "bobeduxu"], [9, 9], [1, 8], none, none, 2)
    assert not names.evidence(["taba", "boba"], ["taxa", "boxa"], [9, 9], [1, 1], none, none, 2)
