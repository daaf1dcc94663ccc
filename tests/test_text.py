import random

import pytest

from brightledger.functions.text import fold, jaro_winkler, jaro_winkler_pairs, plain


def test_fold():
    assert fold("Café  del\tSol") == ("CAFE DEL SOL", 0, 0)
    assert fold("САМ") == ("CAM", 3, 0)  # Cyrillic letters that look Latin
    assert fold("A &amp; B&#39;s &copy;") == ("A & B'S &COPY;", 0, 0)
    assert fold("会 ABC") == ("ABC", 0, 1)
    assert fold("Ørsted Straße") == ("ORSTED STRASSE", 0, 0)
    assert fold(None) == fold("") == ("", 0, 0)


def test_plain():
    assert plain("HΙNALUPΑΚ") == "hinalupak" and plain("Sika­tunlay") == "sikatunlay" and plain("TALUSÁNIN") == "talusanin"


@pytest.mark.parametrize(("a", "b", "s"), [("MARTHA", "MARHTA", 0.961111), ("DWAYNE", "DUANE", 0.84), ("", "A", 0.0), ("A", "A", 1.0), ("ABC", "XYZ", 0.0)])
def test_jaro_winkler(a, b, s):
    assert jaro_winkler(a, b) == pytest.approx(s, abs=1e-6)


def test_jaro_winkler_against_sql():
    con = pytest.importorskip("duckdb").connect()
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rnd.choice("ABCD ") for _ in range(rnd.randint(1, 12))) for _ in range(2))
        want = con.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchall()[0][0]
        assert jaro_winkler(a, b) == pytest.approx(want, abs=1e-12), (a, b)


def test_jaro_winkler_of_many_pairs():
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("ABCDÑ ") for _ in range(rnd.randint(0, 14)))
    a = [word() for _ in range(2000)]
    b = [x[: len(x) // 2] + word() if rnd.random() < 0.5 else word() for x in a]
    assert jaro_winkler_pairs(a, b).tolist() == pytest.approx([jaro_winkler(x, y) for x, y in zip(a, b)], abs=1e-12)
    assert jaro_winkler_pairs([], []).tolist() == [] and jaro_winkler_pairs(["", ""], ["", "A"]).tolist() == [0.0, 0.0]
