"""Word hashes of whole texts as numpy arrays, for tasks that read Arrow batches.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``; A-Z count as a-z. Both rules are on
single bytes, so UTF-8 texts need no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18  # texts handled at once; a longer text is handled alone

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection whose every output bit hangs on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BYTE[_SPACE] = 0


def _power(base: int, n: int) -> np.ndarray:
    known = _powers[base]
    while len(known) < n:
        step = np.uint64(pow(base, len(known), 1 << 64))
        known = np.concatenate([known, known * step])
    _powers[base] = known
    return known[:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets into them) for runs of texts; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, raw[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        first = last


def cuts(raw: np.ndarray, after: np.ndarray, before: np.ndarray, most: int = SLICE_BYTES) -> np.ndarray:
    """Offsets that cut a text into pieces of about ``most`` bytes.

    Cuts lie behind a byte of the table ``after`` and ahead of one of ``before``; where a text
    holds no such place its piece is longer.
    """
    found, at = [0], most
    while at < len(raw):
        stop = min(at + most, len(raw))
        free = np.flatnonzero(after[raw[at - 1:stop - 1]] & before[raw[at:stop]])
        if len(free):
            at += int(free[0])
            found.append(at)
        at += most
    return np.array([*found, len(raw)], np.int64)


def word_starts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte of every word, and how many words lie before each row's offset."""
    space = _SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    start[inner] = ~space[inner]
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, offsets)


def _hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, before = word_starts(raw, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    sums = np.add.reduceat(_BYTE[raw] * _power(_BASE, len(raw)), starts)
    return mix(sums * _power(_INVERSE, len(raw))[starts]), before


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and how many words lie before each row's offset.

    A long text is read in pieces that begin with a word; a word's hash does not hang on its place.
    """
    if len(offsets) != 2 or len(raw) <= 2 * SLICE_BYTES:
        return _hashes(raw, offsets)
    ends = cuts(raw, _SPACE, ~_SPACE).tolist()
    found = np.concatenate([_hashes(raw[a:b], np.array([0, b - a]))[0] for a, b in zip(ends[:-1], ends[1:])])
    return found, np.array([0, len(found)])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of one text; fewer words make one shingle."""
    if not len(words):
        return words
    width = min(n, len(words))
    sums = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        sums = mix(sums + words[i:len(words) - width + 1 + i] + np.uint64(i + 1))
    return np.unique(sums)
