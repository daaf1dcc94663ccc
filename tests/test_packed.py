import itertools
import random

import pytest

from brightledger.operators import packed

LISTED = ["Alpha", "Beta Norte", "Bula-Lakan", "Oak, Elm and Ash", "(Town)", "Gamma"]
SIGNS = {"newline", "tab", "semicolon", "pipe", "comma", "slash", "ampersand", "plus", "spaced hyphen", "and", "at"}
HELD = packed.Held(LISTED)


@pytest.mark.parametrize(
    ("text", "values"),
    [
        (None, []),
        ("", []),
        ("  ", []),
        (",;", []),
        ("Alpha", ["Alpha"]),
        (" Alpha ; ;Gamma,", ["Alpha", "Gamma"]),
        ("Bula-Lakan - Alpha", ["Bula-Lakan", "Alpha"]),
        ("1) Alpha 2) Beta Norte", ["Alpha", "Beta Norte"]),
        ("(1) Alpha\n(2) Gamma", ["Alpha", "Gamma"]),
        ("1. Alpha; 2. Gamma", ["Alpha", "Gamma"]),
        ('"Norte, Beta", Gamma', ["Norte, Beta", "Gamma"]),
        ("“Alpha”|'Gamma / x'", ["Alpha", "Gamma / x"]),
        ("Alpha, and Gamma and Beta Norte at Gamma", ["Alpha", "Gamma", "Beta Norte", "Gamma"]),
        ("Oak, Elm and Ash; Alpha", ["Oak, Elm and Ash", "Alpha"]),
        ("(Town)\tAlpha", ["(Town)", "Alpha"]),
        ("N/A / Alpha", ["N/A", "Alpha"]),
        ("Sandy Atoll, Alpha", ["Sandy Atoll", "Alpha"]),
        ("warehouse 3", ["warehouse 3"]),
        ('"Alpha', ['"Alpha']),
    ],
)
def test_split(text, values):
    assert packed.split_value(text, SIGNS, HELD) == values


def data(spark):
    rows = [(1, "s", "Alpha; Gamma"), (2, "s", "Bula-Lakan"), (3, "s", None), (4, None, "Gamma;Alpha;Bula-Lakan"), (5, "t", ""), (1, "s", "Alpha; Gamma")]
    rows += [(10 + i, "s", "Alpha; Bula-Lakan") for i in range(60)]
    return spark.createDataFrame([(*r, "x") for r in rows], "id int, src string, f string, pos string")


def test_signs_are_inferred(spark):
    _, pooled = packed.infer_signs(data(spark), "f", "src", LISTED)
    assert pooled["semicolon"] > packed.LEAST > pooled.get("tight hyphen", 0)


def test_unpack(spark):
    got = packed.unpack(data(spark), "f", LISTED, "src")
    assert got.columns == ["id", "src", "f", "pos", "_pos", "value", "pieces"]
    rows = sorted((r.id, r["_pos"], r.value, r.pieces) for r in got.collect() if r.id < 10)
    assert rows == [(1, 1, "Alpha", 2)] * 2 + [(1, 2, "Gamma", 2)] * 2 + [(2, 1, "Bula-Lakan", 1), (4, 1, "Gamma", 3), (4, 2, "Alpha", 3), (4, 3, "Bula-Lakan", 3)]


def values(df):
    rows = sorted(df.collect(), key=lambda r: (r.id, r.pos))
    return {i: [r.value for r in g] for i, g in itertools.groupby(rows, key=lambda r: r.id)}


def test_signs_show_without_a_list(spark):
    # 300 fields of words that no list holds and that never stand alone.
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("bdgklmnprst") + rnd.choice("aeiou") for _ in range(3)).title()
    data = [(i, "WordA; OtherB; ThirdC") for i in range(300)]
    assert all(v == ["WordA", "OtherB", "ThirdC"] for v in values(packed.unpack(spark.createDataFrame(data, "id int, f string"), "f")).values())
    fresh = [[word() for _ in range(rnd.randint(2, 4))] for _ in range(300)]
    for sign in ("; ", "|", " / "):
        df = spark.createDataFrame([(i, sign.join(w)) for i, w in enumerate(fresh)], "id int, f string")
        assert values(packed.unpack(df, "f")) == dict(enumerate(fresh))
        assert values(packed.unpack(df, "f", ["Nothing", "Known"])) == dict(enumerate(fresh))


def test_signs_within_names_part_nothing_without_a_list(spark):
    rnd = random.Random(2)
    names = [f"{a}-{b}" for a, b in itertools.product(["Bula", "Kuta", "Sama"], ["Lakan", "Ramo", "Ilar"])] + ["Tierra Vieja", "Puerto Damero", "Isla Norte"]
    data = [(i, rnd.choice(names)) for i in range(400)] + [(1000 + i, " + ".join(rnd.sample(names, 2))) for i in range(100)]
    got = values(packed.unpack(spark.createDataFrame(data, "id int, f string"), "f"))
    assert all(got[i] == [v] if i < 1000 else got[i] == v.split(" + ") for i, v in data)


def test_commas_in_running_text_part_nothing(spark):
    rnd = random.Random(3)
    words = "supply delivery and of installation the chairs for office tables 12 units new Metro School in Norte repair".split()
    text = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 9)))
    data = [(i, ", ".join(text() for _ in range(rnd.randint(1, 5)))) for i in range(400)]
    got = values(packed.unpack(spark.createDataFrame(data, "id int, f string"), "f"))
    assert all(got[i] == [v] for i, v in data)


def test_empty_table(spark):
    assert packed.unpack(data(spark).limit(0), "f", LISTED, "src").count() == 0
    assert packed.unpack(data(spark).limit(0), "f").count() == 0


def test_list_as_a_table_of_any_size(spark, monkeypatch):
    rows = [(x,) for x in LISTED] + [(None,), ("Alpha",)] + [(f"Place {i} - {i}",) for i in range(3000)]
    listed = spark.createDataFrame(rows, "token string")
    df = data(spark).unionByName(spark.createDataFrame([(500, "s", "place 17 - 17; oak, elm AND ash; Place 2 - 2 Alpha", "x"), (501, "s", "Place 2999 - 2999 - Alpha", "x")], "id int, src string, f string, pos string"))
    got = []
    for size in (packed.HELD_BYTES, 2000):
        monkeypatch.setattr(packed, "HELD_BYTES", size)
        got.append(sorted((r.id, r["_pos"], r.value) for r in packed.unpack(df, "f", listed, "src").collect()))
    assert got[0] == got[1]
    assert [x[2] for x in got[0] if x[0] == 500] == ["place 17 - 17", "oak, elm AND ash", "Place 2 - 2 Alpha"]
    assert [x[2] for x in got[0] if x[0] == 501] == ["Place 2999 - 2999", "Alpha"]


def test_names_by_first_letters_as_by_pattern(monkeypatch):
    texts = ["Oak, Elm and Ash; (Town)/bula-lakan", "xBula-Lakan Bula-Lakans", "(town), BULA-LAKAN", "", "Ⱥ bula-lakan"]
    want = [packed.Held(LISTED).spans(t) for t in texts]
    monkeypatch.setattr(packed, "PATTERN_NAMES", 0)
    assert [packed.Held(LISTED).spans(t) for t in texts] == want


def test_long_text(spark):
    df = data(spark).select("id", "src", "f").unionByName(spark.createDataFrame([(99, "s", "; ".join(["Alpha"] * 20_000))], "id int, src string, f string"))
    assert packed.unpack(df, "f", LISTED, "src").filter("id = 99").count() == 20_000


def random_fields(n=400):
    """Fields of two or three values parted by a hyphen or "at", which only a list of the values shows to be signs."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("bdgklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4))).title()
    fields = [[word() for _ in range(rnd.randint(2, 3))] for _ in range(n)]
    return [(i, rnd.choice("ab"), rnd.choice([" at ", " - "]).join(x)) for i, x in enumerate(fields)], sorted({w for x in fields for w in x})


def test_all_listed_values_score_signs_whatever_their_number(spark, monkeypatch):
    rows, names = random_fields()
    df = spark.createDataFrame(rows, "id int, src string, f string")
    listed = spark.createDataFrame([(x.upper(),) for x in [*names, *(f"Other {i}" for i in range(500))]] + [("--",), (None,)], "token string")

    def found():
        blocks, some = packed.held_blocks(listed)
        signs, pooled = packed.infer_signs(df, "f", "src", some, blocks[0])
        rows = sorted((r.id, r.pos, r.value) for r in packed.unpack(df, "f", listed, "src").collect())
        return sorted(map(tuple, signs.collect())), {k: round(x, 9) for k, x in pooled.items()}, rows

    want = found()
    assert want[1]["at"] > packed.LEAST and want[1]["spaced hyphen"] > packed.LEAST
    for size in (0, 20, 600):
        monkeypatch.setattr(packed, "LISTED", size)
        assert found() == want


@pytest.mark.parametrize("text", ["İlçe; bula-lakan", "BULA-LAKAN/İ", "a+; R/ & x", "ΣΑΣ-ΟΔΟΣ; σας-οδος, ςας-οδοσ", "Kuta-ſama\u212a", "kuta-samak"])
def test_short_and_foreign_names_by_first_letters_as_by_pattern(monkeypatch, text):
    names = [*LISTED, "a+", "R/", "Σας-Οδος", "Kuta-Samak"]
    want = packed.Held(names).spans(text)
    assert want
    monkeypatch.setattr(packed, "PATTERN_NAMES", 0)
    assert packed.Held(names).spans(text) == want


def test_standing_values_are_counted_and_not_estimated(spark):
    # More distinct values than the sketch holds; those that come last are overrated by what it has dropped by then.
    data = [(f"v{i}",) for i in range(5 * packed.TRACKED)] + [(f"Seldom {i}",) for i in range(20) for _ in range(20)] + [("Often",)] * 40
    least = 2 + 4 * len(data) / packed.TRACKED
    assert 20 < least < 24
    df = spark.createDataFrame(data, "f string")
    for rows in (df.coalesce(1), df.repartition(5)):
        assert packed.standing_values(rows, "f") == ({"Often": 40}, len(data))
