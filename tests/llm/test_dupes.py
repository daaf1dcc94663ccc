import random

import numpy as np
import pytest

from brightledger.llm import dupes

SCHEMA = "id string, title string, name string, amount double, copies int"


def rows():
    return [
        ("b", "Supply of Tires", "ACME, Inc.", 10.0, 0),
        ("a", " supply  of\ttires.", "acme inc", 10.0, 0),
        ("c", "Supplyof TIRES", "«ACME» Inc", 10.0, 0),
        ("d", "Supply of Tires", "ACME Inc", 10.01, 0),
        ("e", "Supply of Tires2", "ACME Inc", 10.0, 0),
        ("f", "Supply of Tirés", "ACME Inc", 10.0, 0),
        ("g", "Supply of Tires", None, 10.0, 0),
        ("h", "Supply of Tires", None, 10.0, 0),
        ("i", " ", "ACME Inc", 10.0, 0),
        ("j", "Twice", "X", float("nan"), 0),
        ("k", "TWICE", "x", float("nan"), 0),
        ("l", "Twice", "X", None, 0),
        ("m", "L" * 200_000, "x", 1.0, 0),
        ("n", "l" * 200_000, "X", 1.0, 0),
        ("o", "Café", "x", 1.0, 0),
        ("p", "CAFÉ", "x", 1.0, 0),
        ("q", "zero \u2028", "x", 0.0, 0),
        ("r", "ZERO", "\u00a0x", -0.0, 0),
        ("s", "\u00a0", "x", 1.0, 0),
        (None, "Twice", "X", 1.0, 0),
    ]


WANT = {("a", "b"), ("a", "c"), ("j", "k"), ("m", "n"), ("o", "p"), ("q", "r")}


def keyed(spark, data):
    return dupes.keyed(spark.createDataFrame(data, SCHEMA), "id", ["title", "name"], "amount", "t")


@pytest.mark.parametrize(("filter_bytes", "count"), [(dupes.FILTER_BYTES, None), (1 << 14, None), (1 << 17, 5_000_000)])
def test_copies(spark, filter_bytes, count):
    got = dupes.find_copies(keyed(spark, rows()), filter_bytes, count)
    assert {(r.keep_id, r.copy_id) for r in got.collect()} == WANT


def test_input_is_read_once_whatever_the_filter(spark):
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(rows(), SCHEMA)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    got = dupes.find_copies(dupes.keyed(df.mapInArrow(watch, df.schema), "id", ["title", "name"], "amount", "t"), 1 << 16, 50_000_000)
    assert {(r.keep_id, r.copy_id) for r in got.collect()} == WANT
    assert seen.value == len(rows())


def test_collapse(spark):
    out = dupes.collapse_records(spark.createDataFrame(rows(), SCHEMA), "id", ["title", "name"], "amount")
    assert out.columns == ["id", "title", "name", "amount", "copies", "_copies"]
    got = {r.id: r["_copies"] for r in out.collect()}
    assert got == {"a": 3, "d": 1, "e": 1, "f": 1, "g": 1, "h": 1, "i": 1, "j": 2, "l": 1, "m": 2, "o": 2, "q": 2, "s": 1, None: 1}


def test_empty(spark):
    assert dupes.find_copies(keyed(spark, [])).count() == 0
    assert dupes.collapse_records(spark.createDataFrame([], SCHEMA), "id", ["title", "name"], "amount").count() == 0


def test_random_against_brute_force(spark, monkeypatch):
    rnd = random.Random(4)
    data = [(f"{i:05d}", rnd.choice(["Ab c", "aB-C", "abd"]) + str(rnd.randint(0, 900)), rnd.choice(["x", "X!"]), float(rnd.randint(1, 2)), 0) for i in range(3000)]
    data += [(f"z{i:05d}", "Hot one", "x", 1.0, 0) for i in range(1500)]
    groups: dict = {}
    for r in data:
        groups.setdefault((dupes.canonical(r[1]), dupes.canonical(r[2]), r[3]), []).append(r[0])
    want = {(min(g), x) for g in groups.values() for x in g if x != min(g)}
    monkeypatch.setattr(dupes, "HOT_SHARE", 0.1)
    got = dupes.find_copies(keyed(spark, data).repartition(7))
    assert {(r.keep_id, r.copy_id) for r in got.collect()} == want


@pytest.mark.parametrize(("segments", "filter_bytes", "let_through"), [(1, 1 << 16, 0.02), (8, 1 << 19, 0.01), (64, 1 << 18, 0.02)])
def test_filter_holds_every_repeat(spark, segments, filter_bytes, let_through, monkeypatch):
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 2**63, 20_000, dtype=np.uint64)
    data = np.concatenate([h, h[:500], h[:100]]).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in data], "h long").repartition(5)
    bitmap = dupes.repeats_filter(df, segments, filter_bytes)
    assert len(bitmap) == min(filter_bytes, segments * dupes.SEGMENT)
    assert dupes.maybe_repeats(bitmap, h[:500]).all()
    assert dupes.maybe_repeats(bitmap, h[500:]).mean() < let_through


def test_segments_merge_as_one_partition_would_make_them():
    rnd = np.random.default_rng(2)
    h = rnd.integers(0, 2**63, 3000, dtype=np.uint64)
    h = np.concatenate([h, h[:300]])
    one, other = dupes._pair(), dupes._pair()
    dupes.add_hashes(*one, h[:1000])
    dupes.add_hashes(*other, h[1000:])
    dupes.merge_bits(*one, *other)
    whole = dupes._pair()
    dupes.add_hashes(*whole, h)
    assert (one[0] == whole[0]).all()
    assert dupes._has(one[1], dupes._probes(h[:300])).all() and dupes._has(whole[1], dupes._probes(h[:300])).all()


@pytest.mark.parametrize(
    "line",
    [
        '{"amount": "1,000.50", "name": "A: B", "title": "T; x=y"}',
        "TITLE: T; x=y; NAME: A: B; AMOUNT: 1000.50",
        " amount=1,000.50 | title=T; x=y | name=A: B ",
        "Title = 'T; x=y'\tAmount = '1000.5'\tName = 'A: B'",
    ],
)
def test_lines(line):
    t, n, a = dupes.parse_line(line, ["title", "name", "amount"])
    assert (t, n, dupes._amount(a)) == ("T; x=y", "A: B", 1000.5)


@pytest.mark.parametrize("line", [None, "", "{}", "title: x", '{"title": "a", "name": null, "amount": 1}', "no labels here", "{broken"])
def test_lines_without_record(line):
    assert dupes.parse_line(line, ["title", "name", "amount"]) is None
