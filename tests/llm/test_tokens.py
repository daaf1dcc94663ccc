import random

import pytest

from brightledger.llm import tokens

RANKS = tokens.read_ranks(open(tokens.DEFAULT_RANKS, "rb").read()) if __import__("os").path.exists(tokens.DEFAULT_RANKS) else None


def made_ranks(seed=1, merges=400):
    """A vocabulary by a rule: the bytes, then joins of earlier tokens picked at random."""
    rnd = random.Random(seed)
    ranks = {bytes([i]): i for i in range(256)}
    pool = [b"a", b"b", b"c", b" ", b"\xe6", b"\x97"]
    while len(ranks) < 256 + merges:
        t = rnd.choice(pool) + rnd.choice(pool)
        if t not in ranks and len(t) < 12:
            ranks[t] = len(ranks)
            pool.append(t)
    return ranks


def test_made_vocabulary_against_the_definition():
    rnd = random.Random(9)
    for seed in (1, 2):
        machine = tokens.Transducer(made_ranks(seed))
        for _ in range(3000):
            data = bytes(rnd.choice(b"abc \xe6\x97z") for _ in range(rnd.randint(0, 40)))
            assert machine.encode(data) == machine.merge(data)
    assert tokens.Encoder(made_ranks()).encode(None) == [] == tokens.Encoder(made_ranks()).encode("")


def test_few_kept_answers_give_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_FITS", 3)
    machine = tokens.Transducer(made_ranks())
    rnd = random.Random(10)
    for _ in range(500):
        data = bytes(rnd.choice(b"abc ") for _ in range(rnd.randint(0, 40)))
        assert machine.encode(data) == machine.merge(data)


@pytest.fixture(scope="module")
def encoder():
    if RANKS is None:
        pytest.skip("no vocabulary file here")
    return tokens.Encoder(RANKS)


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=tokens.SPLIT, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rnd = random.Random(3)
    parts = ["the", " of", "ing", "  ", "\n", "\t", "é", "日本", "กา", "هل", "😀", "12", "3.5", "'s", "<|endoftext|>", "zzzz", "aaaaaaaa", "\x0b", "​", "A", "­"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]


def test_agrees_with_reference(encoder, reference):
    for t in [*texts(), "", " ", "\n\n", "x" * 5000, "ab" * 4000, "<|endoftext|>"]:
        assert encoder.encode(t) == reference.encode_ordinary(t), t


def test_random_bytes_piece(encoder):
    rnd = random.Random(5)
    machine = encoder.machine
    for _ in range(1500):
        data = bytes(rnd.choice(b"abcdeth \xe6\x97\xa5") for _ in range(rnd.randint(1, 24)))
        assert machine.encode(data) == machine.merge(data)


def test_pairs_against_the_definition(encoder):
    rnd = random.Random(6)
    machine = encoder.machine
    tokens_ = [t for t in RANKS.values() if len(machine.token[t]) < 10]
    for _ in range(4000):
        a, b = rnd.choice(tokens_), rnd.choice(tokens_)
        if machine.fits(-1, a):
            assert machine.fits(a, b) == (machine.merge(machine.token[a] + machine.token[b]) == [a, b])


def test_small_state_store_gives_the_same(encoder, monkeypatch):
    want = [encoder.encode(t) for t in texts()[:300]]
    monkeypatch.setattr(tokens, "KEPT_STATES", 40)
    small = tokens.Encoder(RANKS)
    monkeypatch.setattr(tokens, "KEPT_PIECES", 5)
    assert [small.encode(t) for t in texts()[:300]] == want


def test_utf8_stream():
    rnd = random.Random(7)
    for _ in range(4000):
        data = bytes(rnd.choice([rnd.randrange(256), 0xE2, 0x82, 0xAC, 0xF0, 0x9F]) for _ in range(rnd.randint(0, 10)))
        s = tokens.Utf8Stream()
        got, at = "", 0
        while at < len(data):
            n = rnd.randint(1, 3)
            got += s.push(data[at : at + n])
            at += n
        assert got + s.close() == data.decode("utf-8", "replace")


def test_operator_and_round_trip(spark):
    rows = [(1, "Hello, world", "x"), (2, None, None), (3, "", "y"), (None, "กขค 日本 <|endoftext|>", "z"), (1, "Hello, world", "x"), (4, "long " * 40_000, "w")]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    out = tokens.encode_texts(df)
    assert out.columns == ["doc_id", "text", "ids", "_ids"]
    got = out.collect()
    assert len(got) == len(rows) and [r["_ids"] for r in got if not r.text] == [[], []]
    back = tokens.decode_ids(out.select("doc_id", "text", "_ids"), "_ids", "decoded").collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert tokens.decode_ids(spark.createDataFrame([(None,)], "ids array<int>")).first().text is None
    assert tokens.encode_texts(df.limit(0)).count() == 0
