"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of letters, capitals, marks and repeats in
the line itself and in the lines before and after; two more weights tie neighbouring labels.
Weights are fitted by the chain's likelihood on lines that carry their document's label. A
document's score is the mean of the forward-backward marginals of "good", weighted by length.

Cases: a null or empty text is one empty line; a text of any length or number of lines is
scored whole; equal texts score equal; without labelled rows of both kinds every score is 0.5
(predicted 1: nothing is rejected unlearned); repeated rows are scored each; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamra.llm.order import bounded
from tamra.llm.samples import held_out, labelled
from tamra.llm.words import _SPACE, SLICE_BYTES, cuts, slices, word_hashes, word_starts

STEPS = 200
PENALTY = 1e-3
CLIP = 8.0  # standard deviations

_CLASS = {name: np.zeros(256, bool) for name in ("letter", "upper", "digit", "mark", "odd", "end")}
_CLASS["upper"][ord("A"):ord("Z") + 1] = True
_CLASS["letter"][128:] = _CLASS["letter"][ord("a"):ord("z") + 1] = _CLASS["letter"][ord("A"):ord("Z") + 1] = True
_CLASS["digit"][ord("0"):ord("9") + 1] = True
_CLASS["mark"][[ord(c) for c in ".,;:'\"-()?"]] = True
_CLASS["end"][[ord(c) for c in ".?:"]] = True
_CLASS["odd"][33:127] = True
_CLASS["odd"] &= ~(_CLASS["letter"] | _CLASS["digit"] | _CLASS["mark"])
_LINE_END = np.zeros(256, bool)
_LINE_END[0x0A] = True
N_LINE = 12
LINES_AT_ONCE = 65_536


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # of the features and a constant
    stay: np.ndarray  # gain of keeping the label good, of keeping it bad


@dataclass
class Lines:
    features: np.ndarray
    row: np.ndarray
    length: np.ndarray
    number: np.ndarray  # of the line in its text


def _sums(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[stops] - total[starts]


def lines(raw: np.ndarray, offsets: np.ndarray) -> Lines:
    """Features of all lines of a run of texts; every text has one line at least."""
    n = len(raw)
    breaks = np.flatnonzero(raw == 0x0A)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, row))
    starts, row = starts[order], row[order]
    stops = np.empty_like(starts)
    stops[:-1] = starts[1:]
    last = np.append(row[1:] != row[:-1], True)
    stops[:-1] -= ~last[:-1]
    stops[last] = offsets[row[last] + 1]
    number = np.arange(len(row)) - np.searchsorted(row, row)
    # an empty line says nothing: it is left out, unless its text has no other line
    filled = np.bincount(row, stops > starts, len(offsets) - 1) > 0
    kept = (stops > starts) | (~filled[row] & (number == 0))
    starts, stops, row, number = starts[kept], stops[kept], row[kept], number[kept]
    size = stops - starts
    safe = np.maximum(size, 1)
    count = {name: _sums(table[raw], starts, stops) for name, table in _CLASS.items()}
    begins, _ = word_starts(raw, offsets)
    hashes, _ = word_hashes(raw, offsets)
    first, end = np.searchsorted(begins, starts), np.searchsorted(begins, stops)
    words = np.maximum(end - first, 1)
    bytes_in_words = count["letter"] + count["digit"] + count["mark"] + count["odd"]
    line_of = np.searchsorted(starts, begins, "right") - 1
    again = np.zeros(len(begins), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    # distinct words of a line: sort (line, hash) as one number, a slice has fewer than 2 ** 24 lines
    packed = np.sort((line_of.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    distinct = np.bincount((packed[new] >> np.uint64(40)).astype(np.int64), minlength=len(starts))
    word_last = np.append(begins[1:], n) - 1 if len(begins) else begins
    for _ in range(2):  # step back over one blank or line end
        blank = (word_last > 0) & (raw[word_last] <= 0x20) if len(begins) else np.zeros(0, bool)
        word_last = word_last - blank
    odd_end = _sums(_CLASS["odd"][raw[word_last]] if len(begins) else np.zeros(0), first, end)
    closing = np.zeros(len(starts))
    full = size > 0
    closing[full] = _CLASS["end"][raw[stops[full] - 1]]
    features = np.stack([
        np.log1p(size), count["letter"] / safe, count["digit"] / safe, count["upper"] / np.maximum(count["letter"], 1),
        count["mark"] / safe, count["odd"] / safe, bytes_in_words / words / 10, odd_end / words,
        _sums(again, first, end) / words, distinct / words, closing, (size == 0)], axis=1)
    return Lines(features, row, size, number)


def text_lines(raw: np.ndarray, offsets: np.ndarray) -> Lines:
    """``lines``, a long text being read in pieces that begin with the first word of a line."""
    if len(offsets) != 2 or len(raw) <= 2 * SLICE_BYTES:
        return lines(raw, offsets)
    ends = cuts(raw, _LINE_END, ~_SPACE)
    parts = [lines(raw[a:b], np.array([0, b - a])) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    before = np.cumsum([0] + [int((raw[a:b] == 0x0A).sum()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
    found = Lines(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("features", "row", "length")),
                  np.concatenate([p.number + at for p, at in zip(parts, before.tolist())]))
    kept = found.length > 0
    return Lines(found.features[kept], found.row[kept], found.length[kept], found.number[kept]) if kept.any() else lines(raw[:0], np.array([0, 0]))


def neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Each line's features with those of the line before and after it; zeros beyond the text."""
    same = row[1:] == row[:-1]
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:][same], after[:-1][same] = x[:-1][same], x[1:][same]
    return np.concatenate([x, before, after, np.ones((len(x), 1))], axis=1)


class Chain:
    """Lines laid out by text and place, so that all texts take a step of the recursion together."""

    def __init__(self, row: np.ndarray) -> None:
        self.begin = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        self.count = np.diff(np.append(self.begin, len(row)))
        self.order = np.argsort(-self.count, kind="stable")
        self.begin, self.sorted = self.begin[self.order], self.count[self.order]
        self.steps = int(self.sorted[0]) if len(row) else 0
        self.live = len(self.sorted) - np.searchsorted(self.sorted[::-1], np.arange(self.steps), "right")

    def run(self, u: np.ndarray, good: float, bad: float) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of "good" given the lines up to each (own included), and given those after it."""
        ahead, behind = np.array(u), np.zeros(len(u))
        for t in range(1, self.steps):
            at = self.begin[:self.live[t]] + t
            r = ahead[at - 1]
            ahead[at] += np.logaddexp(r + good, 0) - np.logaddexp(r, bad)
        for t in range(self.steps - 2, -1, -1):
            at = self.begin[:self.live[t + 1]] + t
            s = u[at + 1] + behind[at + 1]
            behind[at] = np.logaddexp(s + good, 0) - np.logaddexp(s, bad)
        return ahead, behind


def _logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _scaled(model: Model, found: Lines) -> np.ndarray:
    return np.clip((found.features - model.mean) / model.spread, -CLIP, CLIP)


def marginals(model: Model, found: Lines) -> np.ndarray:
    """Probability that each line is good."""
    x = _scaled(model, found)
    if len(x) <= LINES_AT_ONCE:
        u = neighbours(x, found.row) @ model.weights
    else:  # some lines at a time, each with the one before and after it
        u = np.empty(len(x))
        for a in range(0, len(x), LINES_AT_ONCE):
            lo, hi = max(a - 1, 0), min(a + LINES_AT_ONCE + 1, len(x))
            u[a:a + LINES_AT_ONCE] = (neighbours(x[lo:hi], found.row[lo:hi]) @ model.weights)[a - lo:a - lo + LINES_AT_ONCE]
    ahead, behind = Chain(found.row).run(u, *model.stay)
    return _logistic(ahead + behind)


def fit(sample: pd.DataFrame) -> Model:
    """Weights by full-batch Adam on the chain's likelihood, both labels of equal weight."""
    model = Model(np.zeros(N_LINE), np.ones(N_LINE), np.zeros(3 * N_LINE + 1), np.zeros(2))
    y = sample["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return model
    parts = []
    for start, raw, offsets in slices(pa.array(sample["text"], pa.large_string())):
        part = lines(raw, offsets)
        parts.append(Lines(part.features, part.row + start, part.length, part.number))
    found = Lines(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("features", "row", "length", "number")))
    model.mean, model.spread = found.features.mean(0), found.features.std(0) + 1e-6
    x, chain, label = neighbours(_scaled(model, found), found.row), Chain(found.row), y[found.row].astype(float)
    lines_in = np.bincount(found.row, minlength=len(y))
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    share = (share / np.maximum(lines_in, 1))[found.row]
    linked = np.flatnonzero(found.row[1:] == found.row[:-1])
    params = np.zeros(x.shape[1] + 2)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        u, (good, bad) = x @ params[:-2], params[-2:]
        ahead, behind = chain.run(u, good, bad)
        node = (_logistic(ahead + behind) - label) * share
        r, s = ahead[linked], (u + behind)[linked + 1]
        both, change, neither = r + s + good, np.logaddexp(r, s), np.full(len(r), bad)
        total = np.logaddexp(np.logaddexp(both, change), neither)
        pair = np.stack([np.exp(both - total) - label[linked], np.exp(neither - total) - (1 - label[linked])])
        gradient = np.concatenate([x.T @ node, pair @ share[linked]]) + PENALTY * params
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient ** 2
        params -= 0.05 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    model.weights, model.stay = params[:-2], params[-2:]
    return model


def _values(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of a run of texts."""
    found, n = text_lines(raw, offsets), len(offsets) - 1
    weight = found.length + 1.0
    value = np.bincount(found.row, marginals(model, found) * weight, n) / np.bincount(found.row, weight, n)
    return np.clip(value, 0, 1)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in slices(batch.column(1)):
                value, n = _values(model, raw, offsets), len(offsets) - 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(value)], names=[key, "score"])

    bounded(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def keep(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text scores ``least`` or more; only texts leave the JVM."""
    bounded(docs.sparkSession)

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        found = np.ones(len(texts), bool)
        for first, raw, offsets in slices(texts):
            found[first:first + len(offsets) - 1] = _values(model, raw, offsets) >= least
        return pa.array(found)

    return docs.where(good(F.col(text)))


def line_labels(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line, n_bytes, good): the marginal of every line that is not empty, lines numbered from 0."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in slices(batch.column(1)):
                found = text_lines(raw, offsets)
                keys = batch.column(0).slice(first).take(pa.array(found.row))
                yield pa.RecordBatch.from_arrays([keys, pa.array(found.number), pa.array(found.length), pa.array(marginals(model, found))],
                                                 names=[key, "line", "n_bytes", "good"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, line bigint, n_bytes bigint, good double")


def predict(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, label: str = "quality", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled sample of ``docs`` and score all of them: (key, held_out, score, predicted)."""
    model = fit(labelled(docs, labels, label, key, text))
    scored = score(docs, model, key, text)
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
