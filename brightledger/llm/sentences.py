"""Sentence spans by a semi-Markov model.

A text falls into blocks at blank lines. In a block every place where a unit may end is a candidate: after end marks
with their closing quotes, at line breaks, and at Thai blanks. Dynamic programming then picks the row of whole spans
with the best sum of scores. A span's score has its closing (kind of mark, abbreviation or number as its last word, and how the next span opens: upper case,
list mark, opening word) and what only the whole of it shows: whether its quotes and brackets balance, how long it is, and whether it holds a
letter or digit at all.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brightledger.session import spread

# Abbreviations (casefolded, without the last stop) after which a sentence goes on whatever follows.
GOES_ON = frozenset(
    """dr mr mrs ms messrs atty engr ing prof sr sra srta dra dña hr fr gng bb g inh gov hon gen col capt rev
    st sto sta mt no nos nr núm num blg res sec pp p pág págs pag fig figs vol ch chap art arts arts. par para
    approx ca hal vs i.e e.g cf ver v incl viz d.h z.b u.a bzw evtl ggf fa abs tel ext dept div est al
    jan feb mar apr jun jul aug sept sep oct nov dec ene abr ago set dic enero mrz okt dez
    सं रु डॉ श्री αρ κ κα δρ σελ د أ م رقم ὁ ดร พ.ศ ค.ศ""".split()
)
# Abbreviations that may also close a sentence; what follows decides.
MAY_END = frozenset(
    """etc atbp usw a.m p.m am pm n.u n.h kg g km m cm mm ml l pcs pc lbs ft hrs hr min u.s u.k u.n inc co corp ltd cía
    s.a s.a.s c.v jr b.c a.d ph.d m.d u.s.a π.μ μ.μ κ.λπ κ.ά κτλ p.a o.ä u.ä""".split()
)
# Words (casefolded) that open sentences rather than go on with one; used where letter case says nothing.
OPENERS = frozenset(
    """the this these that at in on why what how who did does was nobody all each offers please notice lot form see as per
    dr mr mrs ms atty engr meanwhile delivery payment work iprocure status total offer any no
    ang mga ayon bakit binuksan ihahatid kasama maaaring nagbayad noong salamat samantala tinanggap umurong hindi
    el la los las se según además ¿quién ¿qué ¡quedó esta este quién
    am das der die hat laut diese im
    η ο οι το ποιος ευχαριστούμε σύμφωνα αυτή""".split()
)
# Of the openers, those that are as common within a sentence.
COMMON = frozenset("the as in on at per all any total no form see work what how who ang mga el la los las se am das der die im η ο οι το".split())
# Words (casefolded) after which a sentence goes on, also over a line break.
CONNECT = frozenset(
    """a an the of in on at to for by from with and or as per that this is was were are be been not no than under over until about
    ang ng sa na mga ni kay si nina at o noong nang mas para ayon ay
    el la los las un una de del al por para con en y o que se si su según
    der die das den dem des ein eine einen von vom zu zum zur bei im in am und oder mit für an auf unter
    του της των τον την το η ο οι τα στο στη στην από για και είναι με ότι
    ने के की का को पर से में और जो लिए
    إلى على من عن في أن هل مبلغ بقيمة السيد شركة""".split()
)
# Of the openers, those that headings begin with as well.
HEADS = frozenset("notice lot form status total work delivery payment acta minutes re no".split())
# Words before a German ordinal number.
BEFORE_ORDINAL = frozenset("am der die das den dem des vom zum zur beim im ab bis seit und jeder jede jedes dieser".split())
# Verbs that tie a closed quotation to its speaker.
SAID = re.compile(r"说|說|称|道|表示|指出|问|答|述べ|言った|言い|語っ|尋ね|話し")

MARKS = ".!?…。！？．।॥؟۔።፧፨;;"
CLOSERS = "\"'”’»“)]}›」』）】〉》＂"
OPEN = {"“": "”", "«": "»", "‹": "›", "(": ")", "[": "]", "{": "}", "「": "」", "『": "』", "（": "）", "【": "】", "〈": "〉", "《": "》", "„": "“"}
SHUT = set(OPEN.values()) - {"“"}

_BLANK = re.compile(r"(?:\r\n?|\n| |\u0085)[^\S\n\r  \u0085]*(?:(?:\r\n?|\n| |\u0085)\s*)+|\s* \s*")
_LINE = re.compile(r"\s*?(?:\r\n?|\n| |\u0085)\s*")
_LIST = re.compile(r"(?:[-–—•*·▪◦‣○●]|\(?\d{1,3}[.)]|\(?[A-Za-z]\)|\(?[ivxIVX]{1,5}\))[^\S\n]+")
_END = re.compile(rf"[{re.escape(MARKS)}]+[{re.escape(CLOSERS)}]*")
_WORD = re.compile(r"[^\W_]+(?:[.'’][^\W_]+)*\.?")
_THAI = re.compile(r"(?<=[ก-๎])[^\S\n]+(?=[ก-๎])")
_QUOTE = re.compile("[" + re.escape("".join(OPEN) + "".join(OPEN.values()) + '"') + "]")
_ALNUM = re.compile(r"[^\W_]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ]")


def _last_word(text: str, lo: int, at: int) -> str:
    """The word (with inner stops) that ends at ``at``, casefolded."""
    i = at
    while i > lo and (text[i - 1].isalnum() or unicodedata.category(text[i - 1])[0] == "M" or (text[i - 1] == "." and i < at)):
        i -= 1
    word = text[i:at].lstrip(".").casefold()
    head, _, tail = word.rpartition(".")
    return tail if len(head.rpartition(".")[2]) > 3 else word  # "page.Dr" is two words


def _greek(text: str, at: int, lo: int) -> bool:
    """Whether the nearest letters before ``at``, of the 200 characters there, are mostly Greek (numbers and blanks are passed over)."""
    seen = greek = 0
    i = at - 1
    lo = max(lo, at - 200)
    while i >= lo and seen < 12:
        if text[i].isalpha():
            seen += 1
            greek += "Ͱ" <= text[i] <= "Ͽ" or "ἀ" <= text[i] <= "῿"
        i -= 1
    return seen > 0 and greek * 2 > seen


def letter_case(text: str, least: int = 1) -> str:
    """``upper`` or ``lower`` if (nearly) all cased letters are so, else ``mixed`` (also for fewer than ``least``)."""
    return _case(sum(map(str.isupper, text)), sum(map(str.islower, text)), least)


def _case(up: int, low: int, least: int) -> str:
    if up + low < least or (up and low and up < 9 * low):
        return "mixed"
    return "upper" if up > low else "lower"


class _Block:
    def __init__(self, text: str, lo: int, hi: int, case: str):
        self.text, self.lo, self.hi, self.whole, self.case = text, lo, hi, case, case
        if case == "mixed":
            part = text[lo:hi]
            self.uppers = [0, *accumulate(map(str.isupper, part))]
            self.lowers = [0, *accumulate(map(str.islower, part))]

    def next_word(self, at: int) -> str:
        m = _WORD.match(self.text, at, self.hi)
        return m[0] if m else ""

    def opens(self, at: int) -> float:
        """How well a sentence may open at ``at`` (after end marks), -3 to 3."""
        text = self.text
        c = text[at]
        if c.isdigit():
            return 1.0 if self.case == "mixed" else 0.5
        k = at
        while k < self.hi and (text[k] in OPEN or text[k] in "\"'‘¿¡“"):
            k += 1
        if k > at and (k >= self.hi or not text[k].islower()):
            return 2.0
        w = self.next_word(k)
        if not w:
            return 2.0 if not (c in ",;:)]}" or c in CLOSERS or c in MARKS) else -3.0
        if self.case != "mixed":
            first = w.rstrip(".").casefold()
            return 2.0 if first in OPENERS or k > at else (-0.5 if w[0].upper() != w[0].lower() else 2.0)
        if w[0].islower():
            return 2.0 if len(w) > 2 and w[1].isupper() else -3.0
        return 2.0

    def close(self, start: int, end: int, nxt: int) -> float:
        """Score of closing after the marks ``text[start:end]`` when the next unit would begin at ``nxt``."""
        text, lo = self.text, self.lo
        if self.whole == "mixed":
            up, low = self.uppers, self.lowers
            a, b, c, d = max(0, start - 80 - lo), start - lo, nxt - lo, min(nxt + 80, self.hi) - lo
            self.case = _case(up[b] - up[a] + up[d] - up[c], low[b] - low[a] + low[d] - low[c], 20)
        else:
            self.case = self.whole
        run = text[start:end]
        marks = run.rstrip(CLOSERS)
        closed = run[len(marks):]
        c, gap = text[nxt], nxt > end
        m = marks[-1]
        cjk = bool(_CJK.match(c))
        opens = self.opens(nxt)
        if m in ";;" and not (len(marks) == 1 and (m == ";" or _greek(text, start, lo))):
            return -9.0
        if set(marks) <= {"…"} or (len(marks) > 1 and set(marks) == {"."}):
            if cjk or not gap:
                return -4.0
            return 1.5 if opens > 0.5 else -4.0
        if m in "。！？।॥۔።፧፨．؟":
            if closed and not gap and c not in OPEN and c not in "\"'":
                # A quotation that opened the sentence has its speaker after it; one that a colon or verb brought in ends it.
                depth_open = self.quote_start(end)
                said = SAID.search(text, nxt, min(self.hi, nxt + 60)) if depth_open == self.sentence_start(depth_open) else None
                tied = c in "とって,，、" or (said and not re.search(r"[。！？]", text[nxt : said.start()]))
                return -5.0 if tied else 3.0
            return 4.0 if c not in ",，、;；" else -4.0
        word = _last_word(text, lo, start)
        if m in "!?":
            if closed and opens < 0:
                return -5.0
            if not gap and not (c.isupper() or cjk or c in OPEN or c in "¿¡\"“" or unicodedata.category(c) == "Lo"):
                return -6.0
            return 4.0 if opens > 0 else (-1.0 if self.case == "mixed" else 3.0 if not closed else -2.0)
        # A full stop.
        before = text[start - 1] if start > lo else " "
        if not gap:
            two = nxt + 1 < self.hi and (text[nxt + 1].islower() or text[nxt + 1 : nxt + 3] == ". ")
            good = (c.isupper() and two and (len(word) > 2 or closed or before.isdigit() or not before.isalnum())) or c in "¿¡«„“" or cjk
            if not good or (word in GOES_ON and before.isalpha()):
                return -9.0
            return 3.0
        if closed:
            return 4.0 if opens > 0 else -4.0
        if before.isdigit() or (before.isalnum() and word[:1].isdigit()):
            if re.fullmatch(r"\d{1,2}", word):
                at = start - len(word)
                while at > lo and text[at - 1].isspace():
                    at -= 1
                earlier = _last_word(text, lo, at)
                if earlier in BEFORE_ORDINAL:
                    return -5.0
            return 4.0 if opens > 0 else -4.0
        if word in GOES_ON:
            return -6.0
        letters = word.replace(".", "")
        if len(letters) == 1 and word not in MAY_END or (len(word) == 1 and before.isupper()):
            if letters == "m" and re.search(r"\b[ap]\.\s?m$", text[max(lo, start - 6) : start], re.IGNORECASE):
                return 1.5 if opens > 1 else -4.0
            return -6.0
        if word in MAY_END or ("." in word and all(len(x) <= 2 for x in word.split("."))):
            if self.case != "mixed" and self.next_word(nxt).rstrip(".").casefold() in COMMON:
                return -4.0
            return 1.5 if opens > 1 else -4.0
        if opens > 0:
            return 4.0
        if self.case == "mixed":  # a stretch in lower case within other text
            after = self.next_word(nxt + (c == "(")).rstrip(".").casefold()
            return 2.0 if len(word) > 3 and after in OPENERS else -4.0
        return 3.0

    def quote_start(self, end: int) -> int:
        """Where the quotation that closes just before ``end`` opened."""
        text, shut = self.text, self.text[end - 1]
        if shut in "\"'":
            i = text.rfind(shut, self.lo, end - 1)
            return i if i >= 0 else self.lo
        begin = [a for a, b in OPEN.items() if b == shut]
        i = max((text.rfind(a, self.lo, end - 1) for a in begin), default=-1)
        return i if i >= 0 else self.lo

    def sentence_start(self, at: int) -> int:
        """``at`` if a sentence begins there: block or line start, or an end mark (with closers) just before."""
        text = self.text
        i = at
        while i > self.lo and text[i - 1].isspace():
            i -= 1
        if i <= self.lo or "\n" in text[i:at]:
            return at
        while i > self.lo and text[i - 1] in CLOSERS:
            i -= 1
        return at if i > self.lo and text[i - 1] in MARKS else -1


def _balance(text: str, lo: int, hi: int, places: list[int]) -> dict[int, tuple[int, int]]:
    """Nesting depth and parity of straight quotes before each of ``places`` (in order) of ``text[lo:hi]``."""
    out = {}
    d = q = low = k = 0
    for m in _QUOTE.finditer(text, lo, hi):
        i = m.start()
        while k < len(places) and places[k] <= i:
            out[places[k]] = (d, q)
            k += 1
        c = text[i]
        if c == "„":
            low += 1
            d += 1
        elif c == "“":
            d += -1 if low else 1
            low -= low > 0
        elif c in OPEN:
            d += 1
        elif c in SHUT:
            d -= 1
            if c == ")" and d < 0:  # a list mark such as "2)" opens nothing
                j = i
                while j > lo and i - j <= 5 and text[j - 1].isalnum():
                    j -= 1
                if i - j <= 5:
                    d += 1
        else:
            q ^= 1
    for p in places[k:]:
        out[p] = (d, q)
    return out


def _letters(text: str, starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """How many stretches between the places of ``starts`` and ``ends`` (in turn) before each hold a letter or digit."""
    a, b, n = [], [], 0
    for s, e in zip(starts, ends):
        a.append(n)
        n += _ALNUM.search(text, s, e) is not None
        b.append(n)
    return a, b


def _wrap(text: str, lines: list[tuple[int, int]]) -> int:
    """Width to which the block's lines were broken; 0 if they were not."""
    if len(lines) < 2:
        return 0
    w = max(b - a for a, b in lines)
    return w if 55 <= w <= 100 else 0


def _runs_on(text: str, a: int, b: int, a2: int, good: list[int]) -> bool:
    """Whether the line ``text[a:b]``, which has no end mark, breaks off within a sentence that the next line goes on with.

    So it is if the line ended other sentences before (a heading has the line for itself), ends in a word that calls for more, or begins like a sentence.
    ``good``: places, in order, where end marks close well.
    """
    thai = lambda c: "ก" <= c <= "๎"
    if thai(text[b - 1]) or thai(text[a2]):
        return False
    k = bisect_right(good, a)
    if k < len(good) and good[k] < b:
        return True
    words = text[a:b].split()
    last = words[-1].strip("(\"'“«„‘¿¡").casefold()
    if last in CONNECT or text[b - 1] in ",،、，":
        return True
    line = text[a:b]
    first = words[0].strip("(\"'“«„‘").rstrip(",").casefold()
    return first in OPENERS and first not in HEADS and len(words) > 1 and not line.isupper() and line[-1] not in ":："


#: A span of fewer characters than this loses, the more the shorter it is, up to ``SHORT_LOSS``.
USUAL, SHORT_LOSS = 40, 0.5
#: What a span loses whose quotes or brackets do not balance, and one without a letter or digit.
UNBALANCED, EMPTY = 9.0, 6.0


def span_loss(width: int, balanced: bool, full: bool) -> float:
    """What a whole span loses for its length, its quotes and brackets, and for having no letter or digit."""
    short = USUAL - width
    return (SHORT_LOSS * (short / USUAL) ** 2 if short > 0 else 0.0) + (0.0 if balanced else UNBALANCED) + (0.0 if full else EMPTY)


def lattice(starts: list[int], ends: list[int], score: list[float], at_start: list, at_end: list, full_start: list[int], full_end: list[int]) -> tuple[list[float], list[int]]:
    """Best value of the spans up to each end, and the span that each best way ends with. Spans may be of any width.

    A span gets the score of closing at its end (which looks at its last word and at how the next one opens), less ``span_loss`` of the whole of it.
    ``full_start`` and ``full_end``: letters and digits before each place. Begins from ``USUAL`` characters back matter only by balance, so the best way to
    a begin is kept for each balance, and overall; the few nearer ones are tried one by one. So the search is exact and linear.
    """
    n = len(ends)
    best = [0.0] + [float("-inf")] * n
    back = [0] * (n + 1)
    # The best far begin for each balance, and (under None) of all: with a letter or digit since, and without.
    full: dict = {}
    empty: dict = {}
    p = seen = 0
    for j in range(1, n + 1):
        e, here, letters, close = ends[j - 1], at_end[j - 1], full_end[j - 1], score[j - 1]
        if letters > seen:  # there is one since all begins so far
            seen = letters
            for k, i in empty.items():
                if k not in full or best[i] >= best[full[k]]:
                    full[k] = i
            empty = {}
        while p < j and e - starts[p] >= USUAL:
            into = full if letters > full_start[p] else empty
            for k in (at_start[p], None):
                if k not in into or best[p] >= best[into[k]]:
                    into[k] = p
            p += 1
        most, by = float("-inf"), 0
        for i in range(j - 1, p - 1, -1):
            value = best[i] - span_loss(e - starts[i], here == at_start[i], letters > full_start[i])
            if value > most:
                most, by = value, i
        for far, loss in ((full, 0.0), (empty, EMPTY)):
            if far:
                i = far.get(here, -1)
                if i >= 0 and best[i] - loss > most:
                    most, by = best[i] - loss, i
                i = far[None]
                if best[i] - loss - UNBALANCED > most:
                    most, by = best[i] - loss - UNBALANCED, i
        best[j], back[j] = most + close, by
    return best, back


def _units(text: str, lo: int, hi: int, case: str) -> Iterator[tuple[int, int]]:
    block = _Block(text, lo, hi, case)
    # Lines of the block.
    lines, at = [], lo
    for m in _LINE.finditer(text, lo, hi):
        if m.start() > at:
            lines.append((at, m.start()))
        at = m.end()
    lines.append((at, hi))
    wrap = _wrap(text, lines)
    marks: dict[int, int] = {}  # start of a line -> end of its list mark
    for a, b in lines:
        if m := _LIST.match(text, a, b):
            marks[a] = m.end()
    listed = sorted(marks)
    low_quote = text.find("„", lo, hi)

    # Candidates: end of a unit -> (begin of the next, score of closing there).
    found: dict[int, tuple[int, float]] = {}
    for m in _END.finditer(text, lo, hi):
        start, end = m.span()
        # A quote mark behind the stop may open the next sentence rather than close this one.
        while end - start > 1 and text[end - 1] in "\"'“" and (end >= hi or not text[end].isspace()) and text[end - 2].isspace():
            end -= 1
        run = text[start:end]
        if run[-1] == "“" and not 0 <= low_quote < start:
            end -= len(run) - len(run.rstrip("“"))
        if end >= hi:
            continue
        if listed and (k := bisect_right(listed, start)) and start < marks[listed[k - 1]]:
            continue
        nxt = end
        while nxt < hi and text[nxt].isspace():
            nxt += 1
        if nxt >= hi:
            continue
        found[end] = (nxt, block.close(start, end, nxt))
    for m in _THAI.finditer(text, lo, hi):
        found[m.start()] = (m.end(), 6.0)
    good = sorted(e for e, (_, g) in found.items() if g > 1)
    for (a, b), (a2, b2) in zip(lines, lines[1:]):
        has_mark = a2 in marks
        word = text[a2:b2].split(None, 1)[0]
        cjk = bool(_CJK.match(text[a2]))
        if wrap:
            broken = (b - a >= wrap - 4) if cjk else (b - a + 1 + min(len(word), 25) > wrap and b - a >= wrap - 26)
        else:
            broken = False
        numbered = has_mark and text[a2].isdigit()
        if b in found and not has_mark:
            # An end mark at the line's end: judged as such, a little more willing when lines are whole.
            nxt, g = found[b]
            if not broken and g > -6 and not text[a2].islower():
                found[b] = (nxt, max(g, 2.0))
            continue
        if has_mark and not (numbered and broken and b not in found):
            g = 8.0
        elif broken:
            g = -5.0
        elif _runs_on(text, a, b, a2, good):
            g = -5.0
        elif case == "mixed" and text[a2].islower() and a not in marks and not (len(word) > 2 and word[1].isupper()):
            g = -5.0
        else:
            g = 5.0
        found[b] = (a2, g)

    if not found:
        yield lo, hi
        return
    ends = sorted(found)
    starts = [lo] + [found[e][0] for e in ends]
    score = [found[e][1] for e in ends] + [0.0]
    ends.append(hi)
    state = _balance(text, lo, hi, sorted({*starts, *ends}))
    at_start, at_end = [state[p] for p in starts], [state[p] for p in ends]
    n = len(ends)
    full_start, full_end = _letters(text, starts, ends)
    best, back = lattice(starts, ends, score, at_start, at_end, full_start, full_end)
    cut, j = [], n
    while j:
        i = back[j]
        cut.append((starts[i], ends[j - 1]))
        j = i
    yield from reversed(cut)


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """Begin and end (exclusive) of each unit of ``text``, in characters; none for null or blank texts."""
    if not text or text.isspace():
        return []
    out = []
    at = 0
    pieces = []
    for m in _BLANK.finditer(text):
        pieces.append((at, m.start()))
        at = m.end()
    pieces.append((at, len(text)))
    for lo, hi in pieces:
        while lo < hi and text[lo].isspace():
            lo += 1
        while hi > lo and text[hi - 1].isspace():
            hi -= 1
        if lo == hi:
            continue
        out.extend(_units(text, lo, hi, letter_case(text[lo:hi])))
    return out


def split_sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (``key``, begin_pos, end_pos) for each sentence unit of each text, positions in code points from 0.

    Null, empty and blank texts have no rows; repeated keys or texts are each split on their own; a null key is
    kept. Texts may be of any length: work is linear in it. Other columns of ``df`` are not read. An empty table
    gives an empty table. One narrow pass, no shuffle.
    """
    src = df.select(key, text)
    schema = T.StructType([src.schema.fields[0], T.StructField("begin_pos", T.IntegerType(), False), T.StructField("end_pos", T.IntegerType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, begin, end = [], [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                for a, b in sentence_spans(t):
                    at.append(k)
                    begin.append(a)
                    end.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(begin, pa.int32()), pa.array(end, pa.int32())], names=[batch.schema.names[0], "begin_pos", "end_pos"])

    return spread(src).mapInArrow(run, schema)
