"""Fill-in-middle transformation as a pipeline of Arrow kernels.

A text is cut into units, ``[A-Za-z]+|[^A-Za-z]``. The regular expression kernel sets a byte
that UTF-8 never holds behind every unit, so a split gives one list of units a text. The lists
are flattened with the indices of their parents, every unit gets its ordinal, the ordinal
against the text's two cuts gives its role, and for each role the units are filtered, set into
lists again and joined: prefix, middle and suffix of a whole batch come from a handful of
kernels, without a loop over texts or units.

Both cuts and the form hang on the document's key alone (a hash of seed and key), so a document
is transformed alike in every run, partition and cluster; nothing is shuffled.

Cases: a null or empty text gives form ``plain`` and an empty output, 0 units; a text that holds
a mark itself stays plain, so every output can be undone; a null key is hashed as an empty one;
rows that share a key are cut by the same numbers, each over its own units; a text of any length
is cut whole, long ones in pieces that end at unit borders (memory goes with the piece but for
the text itself and one single run of letters); other columns are left out; an empty table stays
empty. Texts are UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10  # of the texts stay as they are
SPM_PERCENT = 20  # of the others put the suffix first
SLICE_BYTES = 2 << 20  # of text whose units stand in memory at once
_BORDER = b"\xff"  # in no UTF-8 text

_INSIDE = np.zeros(256, bool)  # bytes that no unit begins with unless it begins the text: letters may carry a unit on
_INSIDE[ord("A"):ord("Z") + 1] = _INSIDE[ord("a"):ord("z") + 1] = _INSIDE[0x80:0xC0] = True


def _buffers(texts: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets of large strings, and the bytes they lie in."""
    _, offsets, data = texts.buffers()
    return np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1], data if data is not None else pa.py_buffer(b"")


def pieces(texts: pa.Array, most: int = SLICE_BYTES) -> tuple[pa.Array, np.ndarray]:
    """The texts cut at unit borders into pieces of about ``most`` bytes, and the text of each piece."""
    ends, data = _buffers(texts)
    long = np.flatnonzero(np.diff(ends) > most)
    cuts, owner = [ends], [np.arange(len(texts) + 1)]
    raw = np.frombuffer(data, np.uint8) if data.size else np.zeros(0, np.uint8)
    for row in long.tolist():
        at, stop = int(ends[row]) + most, int(ends[row + 1])
        while at < stop:
            free = np.flatnonzero(~_INSIDE[raw[at:min(at + most, stop)]])
            if not len(free):
                at += most
                continue
            at += int(free[0])
            cuts.append(np.array([at]))
            owner.append(np.array([row]))
            at += most
    cut, own = np.concatenate(cuts), np.concatenate(owner)
    order = np.lexsort((own, cut))
    cut, own = cut[order], own[order]
    return pa.LargeStringArray.from_buffers(len(cut) - 1, pa.py_buffer(np.ascontiguousarray(cut)), data), own[:-1]


def _runs(size: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that together hold ``most`` bytes or, alone, more."""
    total = np.concatenate([[0], np.cumsum(size)])
    first = 0
    while first < len(size):
        last = max(int(np.searchsorted(total, total[first] + most, "right")) - 1, first + 1)
        yield first, last
        first = last


def _joined(units: pa.Array, count: np.ndarray) -> pa.Array:
    """The units set into lists of ``count`` each, every list joined to one text."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, units), pa.scalar("", pa.large_string()))


def parts(texts: pa.Array, cut_at: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Units of every text, and its prefix, middle and suffix.

    ``cut_at`` holds two numbers a text; modulo one more than its units they are the cuts.
    """
    cut, row = pieces(texts)
    count = pc.count_substring_regex(cut, UNIT).to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.bincount(row, count, len(texts)).astype(np.int64)
    cuts = np.sort(cut_at % (n + 1)[:, None], axis=1)
    before = np.cumsum(count) - count
    before -= (np.cumsum(n) - n)[row]  # units of the text in earlier pieces
    found = [[], [], []]
    ends, _ = _buffers(cut)
    for a, b in _runs(np.diff(ends)):
        lists = pc.split_pattern(pc.replace_substring_regex(cut.slice(a, b - a), UNIT, b"\\0" + _BORDER), _BORDER)
        units, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        start = pa.array(np.concatenate([[0], np.cumsum(count[a:b] + 1)[:-1]]) - before[a:b])  # a split leaves an empty last unit
        ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(start, parent))
        low, high = (pa.array(cuts[row[a:b], i]) for i in (0, 1))
        role = pc.add(pc.greater_equal(ordinal, pc.take(low, parent)).cast(pa.int8()), pc.greater_equal(ordinal, pc.take(high, parent)).cast(pa.int8()))
        for k in range(3):
            mine = pc.equal(role, k)
            length = np.bincount(pc.filter(parent, mine).to_numpy(), minlength=b - a)
            found[k].append(_joined(pc.filter(units, mine), length))
    each = np.bincount(row, minlength=len(texts))
    return n, [_joined(pa.concat_arrays(f) if f else pa.array([], pa.large_string()), each) for f in found]


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row.

    Four numbers of 32 bits are read from the sha256 of ``seed:key``: two choose the cuts, one
    whether the text stays plain, one whether suffix (spm) or prefix (psm) comes first.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            ends, _ = _buffers(whole)
            for a, b in _runs(np.diff(ends)):
                said = whole.slice(a, b - a)
                h = np.stack([batch.column(i).slice(a, b - a).to_numpy() for i in range(2, 6)], 1)
                n, (prefix, middle, suffix) = parts(said, h[:, :2])
                plain = pc.or_(pc.equal(said, ""), pa.array(h[:, 2] % 100 >= 100 - plain_percent))
                for mark in (PREFIX, SUFFIX, MIDDLE):
                    plain = pc.or_(plain, pc.match_substring(said, mark))
                form = pc.if_else(plain, "plain", pc.if_else(pa.array(h[:, 3] % 100 < spm_percent), "spm", "psm"))
                join = lambda *x: pc.binary_join_element_wise(*(pa.scalar(y, pa.large_string()) if isinstance(y, str) else y for y in x), pa.scalar("", pa.large_string()))
                output = pc.if_else(plain, said, pc.if_else(pc.equal(form, "spm"), join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                                                            join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
                none = pa.scalar(None, pa.int64())
                chars = [pc.if_else(plain, none, pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n), form.cast(pa.string()), *chars, output.cast(pa.string())],
                                                 names=[key, "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(key), F.col(text), *numbers).mapInArrow(
        run, f"`{key}` {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def _undone(form: pa.Array, output: pa.Array) -> pa.Array:
    found, ends = [], None
    output = pc.fill_null(output.cast(pa.large_string()), "")
    ends, _ = _buffers(output)
    for a, b in _runs(np.diff(ends)):
        said, kind = output.slice(a, b - a), form.slice(a, b - a)
        plain = pc.fill_null(pc.equal(kind, "plain"), True)
        marked = pc.if_else(plain, PREFIX + SUFFIX + MIDDLE, said)  # three marks in every row
        split = pc.split_pattern_regex(marked, f"{PREFIX}|{SUFFIX}|{MIDDLE}", max_splits=3)
        one, two, middle = (pc.list_element(split, i) for i in (1, 2, 3))
        spm = pc.fill_null(pc.equal(kind, "spm"), False)
        none = pa.scalar("", pa.large_string())
        found.append(pc.if_else(plain, said, pc.binary_join_element_wise(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two), none)))
    return (pa.concat_arrays(found) if found else output).cast(pa.string())


def restored(form: Column, output: Column) -> Column:
    """The text that an output of the given form was made from; a null output counts as empty."""
    @F.arrow_udf("string")
    def undone(kind: pa.Array, said: pa.Array) -> pa.Array:
        return _undone(kind, said)
    return undone(form, output)
