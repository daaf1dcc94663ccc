"""Byte-pair encoding of whole corpora by a finite-state transducer.

The merge list is compiled on demand into a deterministic transducer over bytes. After reading some bytes, the
encoding of the text so far is fixed but for its end: a later byte may still join into a token that started up to
one token length ago. A state therefore holds, for each place where a token may still be open, the bytes since
there and the tokens before it that are not settled yet. Tokens on which all open places agree are emitted; the
rest is the bounded lookahead. States and transitions are made the first time a byte asks for them and kept, so
running text costs one table lookup a byte.

Two facts about byte-pair encoding make this exact: an encoding cut after any of its tokens is the encoding of the
shorter text, and a row of tokens is an encoding if each two neighbours are (Berglund, Martens and van der Merwe,
"Constructing a BPE tokenization DFA", 2024).
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from brightledger.session import free_name, spread

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the published pre-splitting pattern of the 50k byte-level vocabulary.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct pieces whose ids a worker keeps; beyond it the store is emptied. It bounds memory, never the result.
KEPT_PIECES = 200_000
#: Transducer states, and answers on neighbouring tokens, that a worker keeps before it starts over.
KEPT_STATES, KEPT_FITS = 100_000, 500_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 token and id."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


_NEVER = 1 << 62


class Transducer:
    """Byte-pair encoder; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        # Beginnings of tokens as nodes of a tree: node and byte -> node; the root is 0.
        self.child: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        child, nodes = self.child, 1
        for t, i in ranks.items():
            node = 0
            for b in t:
                k = node << 8 | b
                got = child.get(k)
                if got is None:
                    got = child[k] = nodes
                    nodes += 1
                node = got
            self.ends[node] = i
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self._made: dict[int, tuple[int, int]] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the last settled token (-1 at the start) and, for each open place, the node of the bytes since it and the
        # unsettled tokens before it; the place with no bytes since is the end of the text so far.
        start = (-1, (0,), ((),))
        self.number = {start: 0}
        self.states = [start]
        # State and byte -> next state and the tokens that are settled.
        self.step: dict[int, tuple[int, tuple[int, ...]]] = {}

    def merge(self, data: bytes, below: int = 1 << 62) -> list[int]:
        """Encoding by the definition: join the pair of lowest rank until none (of a rank under ``below``) joins. For short inputs."""
        get = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(x + y, _NEVER) for x, y in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < below:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], _NEVER)
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], _NEVER)
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` in an encoding (-1: the start).

        Two tokens stay apart if no join across their border comes before the joins that made them. The joins of either are undone,
        the latest first, and the border is tried between what is left.
        """
        key = (left + 1) << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= KEPT_FITS:
                self._fits.clear()
            known = self._fits[key] = self._apart(left, right)
        return known

    def _parts(self, t: int) -> tuple[int, int]:
        """The two tokens whose join made ``t``; twice ``t`` for a single byte."""
        got = self._made.get(t)
        if got is None:
            parts = self.merge(self.token[t], t)
            got = self._made[t] = (parts[0], parts[1]) if len(parts) == 2 else (t, t)
        return got

    def _whole_token(self, t: int) -> bool:
        got = self._whole.get(t)
        if got is None:
            got = self._whole[t] = self.merge(self.token[t]) == [t]
        return got

    def _apart(self, left: int, right: int) -> bool:
        if not self._whole_token(right):
            return False
        if left < 0:
            return True
        get, token = self.ranks.get, self.token
        most = _NEVER
        while True:
            both = get(token[left] + token[right])
            if both is not None and both < most:
                return False
            if left > right:
                most, left = left, self._parts(left)[1]
                if left == most:
                    most, right = right + 1, self._parts(right)[0]
                    if right + 1 == most:
                        return True
            else:
                most, right = right + 1, self._parts(right)[0]
                if right + 1 == most:
                    most, left = left, self._parts(left)[1]
                    if left == most:
                        return True

    def _follow(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        settled, nodes, befores = self.states[state]
        now, chains, end = [], [], None
        child, ends, fits = self.child.get, self.ends.get, self._fits.get
        for node, before in zip(nodes, befores):  # the longest open piece first
            node = child(node << 8 | byte)
            if node is not None:
                now.append(node)
                chains.append(before)
                if end is None and (t := ends(node)) is not None:
                    left = before[-1] if before else settled
                    ok = fits((left + 1) << 32 | t)
                    if self.fits(left, t) if ok is None else ok:
                        end = before + (t,)
        if end is None:
            raise ValueError("the vocabulary lacks a single byte")
        now.append(0)
        chains.append(end)
        common, size = 0, len(chains)
        for x in zip(*chains):
            if x.count(x[0]) != size:
                break
            common += 1
        out = end[:common]
        if common:
            chains = [x[common:] for x in chains]
        n = self._place((out[-1] if common else settled, tuple(now), tuple(chains)))
        self.step[state << 8 | byte] = (n, out)
        return n, out

    def _place(self, key: tuple) -> int:
        n = self.number.get(key)
        if n is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
        return n

    def encode(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        out: list[int] = []
        state, step = 0, self.step
        for byte in data:
            known = step.get(state << 8 | byte)
            if known is None:
                if len(self.states) > KEPT_STATES:
                    here = self.states[state]
                    self._reset()
                    state, step = self._place(here), self.step
                known = self._follow(state, byte)
            state, emitted = known
            if emitted:
                out.extend(emitted)
        out.extend(self.states[state][2][-1])
        return out


class Encoder:
    """Texts to ids: splits by the pattern, then runs the transducer on each piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = SPLIT):
        self.machine = Transducer(ranks)
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Ids of ``text``; an empty list for null and for the empty text."""
        out: list[int] = []
        if not text:
            return out
        kept = self.kept
        for piece in self.split(text):
            ids = kept.get(piece)
            if ids is None:
                ids = self.machine.encode(piece.encode())
                if len(piece) <= 64:
                    if len(kept) >= KEPT_PIECES:
                        kept.clear()
                    kept[piece] = ids
            out.extend(ids)
        return out


class Utf8Stream:
    """Incremental UTF-8 decoder: a state machine that holds at most three bytes of an unfinished character.

    Bytes that cannot belong to a character give U+FFFD, one for each longest part that could have begun one.
    """

    def __init__(self) -> None:
        self.need, self.code, self.low, self.high = 0, 0, 0x80, 0xBF

    def push(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.need:
                if self.low <= b <= self.high:
                    self.code, self.need, self.low, self.high = self.code << 6 | b & 0x3F, self.need - 1, 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.code))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.need, self.code = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.need, self.code = 2, b & 0x0F
                self.low, self.high = 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
            elif 0xF0 <= b <= 0xF4:
                self.need, self.code = 3, b & 0x07
                self.low, self.high = 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        rest, self.need = ("�" if self.need else ""), 0
        return rest


def decode_stream(ids: Iterable[int], token: dict[int, bytes]) -> Iterator[str]:
    """Text of ``ids``, handed out as soon as characters are whole."""
    machine = Utf8Stream()
    for i in ids:
        if part := machine.push(token[i]):
            yield part
    if rest := machine.close():
        yield rest


_encoders: dict[tuple[str, str], Encoder] = {}


def shared_encoder(data: bytes, pattern: str) -> Encoder:
    """The encoder of this worker process for a vocabulary and pattern; it keeps from task to task what it has learnt. One is kept."""
    key = hashlib.sha256(data).hexdigest(), pattern
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(data), pattern)
    return _encoders[key]


def _load(spark: SparkSession, path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_texts(df: DataFrame, text: str = "text", out: str = "ids", ranks_path: str = DEFAULT_RANKS, pattern: str = SPLIT) -> DataFrame:
    """``df`` with the token ids of column ``text`` in a further column ``out`` (array<int>), no special tokens.

    Null and empty texts give an empty list. Text that looks like a special token is ordinary text. All other
    columns pass unchanged; if one is named like ``out``, the new column gets underscores before its name. Texts
    may be of any length. An empty table gives an empty table. One narrow pass, no shuffle; the vocabulary file
    is read by the driver and broadcast (its size is that of the vocabulary, whatever the data).
    """
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(_load(spark, ranks_path))
    out = free_name(df.columns, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(data.value, pattern)
        collects = gc.isenabled()
        gc.disable()  # hundreds of thousands of states, none in a cycle, would be looked at again and again
        try:
            for batch in batches:
                ids, ends = array("i"), array("i", [0])
                for t in batch.column(at).to_pylist():
                    ids.extend(encoder.encode(t))
                    ends.append(len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, out])
        finally:
            if collects:
                gc.enable()

    return spread(df).mapInArrow(run, schema)


def decode_ids(df: DataFrame, ids: str = "ids", out: str = "text", ranks_path: str = DEFAULT_RANKS) -> DataFrame:
    """``df`` with the text of the id lists in ``ids``; null gives null, an empty list the empty text."""
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(_load(spark, ranks_path))
    out = free_name(df.columns, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: t for t, i in read_ranks(data.value).items()}
        for batch in batches:
            texts = [None if x is None else "".join(decode_stream(x, token)) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)
