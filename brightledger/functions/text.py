"""Text folding shared by operators: look-alike letters, accents, letter case."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import regex

# Greek and Cyrillic letters that look like Latin ones, and Latin letters that do not decompose.
CONFUSABLES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ι": "i", "κ": "k", "ν": "v", "ρ": "p", "α": "a",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "І": "I", "Ј": "J", "Ѕ": "S", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
}
EXTRA_LATIN = {"Ø": "O", "ø": "o", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "ı": "i"}
# The HTML entities that are decoded, whatever their letter case.
ENTITIES = {"amp": "&", "nbsp": " ", "gt": ">", "lt": "<", "quot": '"', "#39": "'"}

_ENTITY = re.compile(r"&(" + "|".join(map(re.escape, ENTITIES)) + ");", re.IGNORECASE)
_CONFUSABLE = str.maketrans(CONFUSABLES)
_EXTRA = str.maketrans(EXTRA_LATIN)
_LOOK_ALIKE = re.compile("[" + "".join(CONFUSABLES) + "]")
_MARKS, _LETTERS, _FOREIGN = regex.compile(r"\p{M}+"), regex.compile(r"[\p{L}--\p{ASCII}]", regex.V1), re.compile(r"[^\x00-\x7f]")
# Lower-case forms of capital look-alikes, for text that was lowered after it was typed.
_LOOSE = str.maketrans({**{k.lower(): v.lower() for k, v in CONFUSABLES.items()}, **CONFUSABLES, **EXTRA_LATIN})


def decode_entities(s: str) -> str:
    return _ENTITY.sub(lambda m: ENTITIES[m[1].lower()], s) if "&" in s else s


def fold(name: str | None) -> tuple[str, int, int]:
    """Key of a name (upper-case ASCII, single blanks), how many look-alikes were replaced and how many letters were lost.

    A null name folds like the empty one.
    """
    s = unicodedata.normalize("NFKC", decode_entities(name or ""))
    if s.isascii():
        return " ".join(s.upper().split()), 0, 0
    latin = unicodedata.normalize("NFKD", s.translate(_CONFUSABLE).translate(_EXTRA))
    unmarked = _MARKS.sub("", latin)
    return " ".join(_FOREIGN.sub(" ", unmarked).upper().split()), len(_LOOK_ALIKE.findall(s)), len(_LETTERS.findall(unmarked))


def plain(s: str) -> str:
    """Lower-case text without accents, look-alikes and invisible characters; other characters stay."""
    s = decode_entities(s)
    if s.isascii():
        return s.lower()
    s = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", s).translate(_LOOSE))
    return "".join(c for c in s if unicodedata.category(c) not in ("Mn", "Cf")).lower()


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity; the prefix (4 characters at most) adds only above a Jaro similarity of 0.7."""
    if a == b:
        return 1.0 if a else 0.0
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    reach = max(max(n, m) // 2 - 1, 0)
    taken = [False] * m
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(m, i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                left.append(c)
                break
    k = len(left)
    if not k:
        return 0.0
    right = [b[j] for j in range(m) if taken[j]]
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (k / n + k / m + (k - swaps) / k) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, n, m) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


def jaro_winkler_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler`` of many pairs at once, over arrays of their letters."""
    n = len(a)
    la, lb = (np.array([len(x) for x in y], np.int32) for y in (a, b))
    if not n or not la.max() or not lb.max():
        return np.zeros(n)
    letters = lambda x, w: np.array([[*map(ord, s), *[0] * (w - len(s))] for s in x], np.int32)
    x, y = letters(a, int(la.max())), letters(b, int(lb.max()))
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    place = np.arange(y.shape[1], dtype=np.int32)[None, :]
    real = place < lb[:, None]
    free = real.copy()
    found = np.zeros(x.shape, bool)
    rows = np.arange(n)
    for i in range(x.shape[1]):
        fit = free & (y == x[:, i : i + 1]) & (np.abs(place - i) <= reach) & (i < la)[:, None]
        j = fit.argmax(axis=1)
        hit = fit[rows, j]
        found[:, i] = hit
        free[rows[hit], j[hit]] = False
    k = found.sum(axis=1)
    most = int(k.max())
    first = lambda letters, mask: np.take_along_axis(letters, np.argsort(~mask, axis=1, kind="stable")[:, :most], axis=1)
    left, right = first(x, found), first(y, real & ~free)
    swaps = ((left != right) & (np.arange(most)[None, :] < k[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(k > 0, (k / la + k / lb + (k - swaps) / k) / 3, 0.0)
    w = min(4, x.shape[1], y.shape[1])
    alike = (x[:, :w] == y[:, :w]) & (np.arange(w)[None, :] < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(alike, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
