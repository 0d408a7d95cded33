"""The word split of byte-level BPE, as arrays of code-point classes.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
runs of letters, numbers or other signs take one blank before them, a run of white space gives
its last character up to what follows, and seven endings are cut off after an apostrophe.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

OTHER, LETTER, NUMBER, BLANK, WHITE = range(5)
# The endings of the pattern, by length.
ONE_LETTER = frozenset("stmd")
TWO_LETTERS = frozenset({"re", "ve", "ll"})


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", WHITE)):
        for found in regex.finditer(pattern, everything):
            text = found.group()
            table[np.frombuffer(text.encode("utf-32-le"), np.uint32)] = kind
    table[0x20] = BLANK
    return table


def _cuts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of a text begin, which is not empty, and its code points."""
    n = len(text)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = classes()[points]
    white = kind >= BLANK
    run = np.minimum(kind, BLANK)
    start = np.ones(n, bool)
    start[1:] = run[1:] != run[:-1]
    first = np.flatnonzero(start[1:] & ~white[1:]) + 1
    before = first - 1
    start[before[white[before]]] = True
    start[first[kind[before] == BLANK]] = False
    for i in np.flatnonzero(start & (points == 0x27)).tolist():
        if text[i + 1:i + 2] in ONE_LETTER:
            end = i + 2
        elif text[i + 1:i + 3] in TWO_LETTERS:
            end = i + 3
        else:
            continue
        start[i + 1] = False
        if end < n:
            start[end] = True
    return np.flatnonzero(start), points


def pretokens(text: str) -> list[str]:
    """The pieces of a text, in order; joined they are the text again."""
    if not text:
        return []
    cut = _cuts(text)[0].tolist()
    return [text[a:b] for a, b in zip(cut, [*cut[1:], len(text)])]


def sizes(text: str) -> np.ndarray:
    """The bytes of the pieces of a text in UTF-8."""
    if not text:
        return np.zeros(0, np.int64)
    cut, points = _cuts(text)
    if text.isascii():
        return np.diff(cut, append=len(text))
    width = np.ones(len(text), np.uint8)
    for least in (0x80, 0x800, 0x10000):
        width += points >= least
    return np.add.reduceat(width, cut, dtype=np.int64)
