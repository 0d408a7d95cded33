"""Toxicity by multiple-instance learning: sentences are the instances, documents the bags.

A sentence ends at ``.``, ``!``, ``?`` or a line end. Its score is the logistic of a base rate
plus the weights of its words; a word (a run of ASCII letters or non-ASCII bytes, A-Z as a-z)
brings the hashed weights of its prefixes of 3 to 8 bytes and of itself. A document's score is
the noisy-or of its sentences, 1 - prod(1 - p), so one sentence is enough. The weights are
fitted on document labels alone, through the noisy-or, and then locate the sentences.

Cases: a null or empty text is one sentence without words and scores the base rate; a text of
any length is scored whole; equal texts score equal; with no labelled rows, or one label only,
the weights stay 0; repeated rows are scored each; other columns are left out.
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
from tamra.llm.words import SLICE_BYTES, _BASE, _INVERSE, _power, cuts, mix, slices

BITS = 18
PREFIXES = range(3, 9)
BASE_LOGIT = -8.0  # of a sentence that no word speaks against
PENALTY = 0.0004  # on the sum of the weights, which are never negative: no word excuses another
LEAST_DOCS = 5  # a feature seen in fewer fitted documents keeps weight 0
STEPS = 200

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = _LETTER[128:] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True
_ANY = np.ones(256, bool)
_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_CODE[ord("A"):ord("Z") + 1] = _CODE[ord("a"):ord("z") + 1]


@dataclass
class Sentences:
    features: np.ndarray  # of each word, one column a feature; -1 where the word is too short
    word: np.ndarray  # hash of each word
    word_sentence: np.ndarray  # sentence of each word
    starts: np.ndarray  # first byte of each sentence
    row: np.ndarray  # text of each sentence


def sentences(raw: np.ndarray, offsets: np.ndarray) -> Sentences:
    """Words and sentences of a run of texts; every text has one sentence at least."""
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[1:][_END[raw]] = True
    first = first[:n]
    first[offsets[:-1][offsets[:-1] < n]] = True
    # an empty text has no byte of its own: its sentence is added at its offset
    empty = np.flatnonzero(offsets[1:] == offsets[:-1])
    starts = np.concatenate([np.flatnonzero(first), offsets[empty]])
    row = np.concatenate([np.searchsorted(offsets, np.flatnonzero(first), "right") - 1, empty])
    letter = _LETTER[raw]
    begin = letter.copy()
    begin[1:] &= ~letter[:-1] | first[1:]
    stop = letter.copy()
    stop[:-1] &= ~letter[1:] | first[1:]
    begins, stops = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[raw] * _power(_BASE, n), out=sums[1:])
    back = _power(_INVERSE, n)[begins] if n else np.zeros(0, np.uint64)
    length = stops - begins
    mask = np.uint64((1 << BITS) - 1)
    features = np.full((len(begins), len(PREFIXES) + 1), -1, np.int32)
    for i, k in enumerate([*PREFIXES, 0]):
        long = length >= k
        end = stops if not k else begins + k
        hashed = mix((sums[end[long]] - sums[begins[long]]) * back[long] + np.uint64(k))
        features[long, i] = (hashed & mask).astype(np.int32)
        whole = hashed  # the last one is of the whole word
    return Sentences(features, whole, np.searchsorted(np.flatnonzero(first), begins, "right") - 1, starts, row)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _logits(s: Sentences, weights: np.ndarray) -> np.ndarray:
    """A word counts once in a sentence, however often it stands there."""
    word = np.append(weights, 0.0)[s.features].sum(1)
    at = np.flatnonzero(word)
    if len(at):
        order = np.lexsort((s.word[at], s.word_sentence[at]))
        at = at[order]
        new = np.ones(len(at), bool)
        new[1:] = (s.word[at[1:]] != s.word[at[:-1]]) | (s.word_sentence[at[1:]] != s.word_sentence[at[:-1]])
        at = at[new]
    return BASE_LOGIT + np.bincount(s.word_sentence[at], word[at], len(s.starts))


def fit(sample: pd.DataFrame) -> np.ndarray:
    """Weights by full-batch Adam on the likelihood of the document labels."""
    size = 1 << BITS
    weights = np.zeros(size)
    y = sample["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return weights
    # equal words share their features: weights are summed once for each distinct word
    kinds, names, pairs, rows, at, seen = [], [], [], [], 0, 0
    for start, raw, offsets in slices(pa.array(sample["text"], pa.large_string())):
        s = sentences(raw, offsets)
        name, first, word_id = np.unique(s.word, return_index=True, return_inverse=True)
        once = np.unique(s.word_sentence.astype(np.int64) * max(len(name), 1) + word_id)
        kinds.append(s.features[first])
        names.append(name)
        pairs.append(np.stack([once // max(len(name), 1) + at, once % max(len(name), 1) + seen]))
        rows.append(s.row + start)
        at += len(s.starts)
        seen += len(name)
    _, first, merged = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    kinds = np.concatenate(kinds)[first]
    sentence, word_id = np.concatenate(pairs, axis=1)
    word_id, row = merged[word_id], np.concatenate(rows)
    del names, pairs
    pairs = np.unique(word_id * len(y) + row[sentence])
    docs = np.zeros(size, np.int64)
    for column in kinds.T:  # one kind of feature at a time bounds the driver's memory
        feature = column[pairs // len(y)]
        seen = np.unique(feature[feature >= 0].astype(np.int64) * len(y) + (pairs % len(y))[feature >= 0])
        docs += np.bincount(seen // len(y), minlength=size)
    del pairs
    allowed = docs >= LEAST_DOCS
    real = kinds >= 0
    flat, owner = kinds[real], np.nonzero(real)[0]
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
    mean, square = np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        score = np.bincount(owner, weights[flat], len(kinds))
        z = BASE_LOGIT + np.bincount(sentence, score[word_id], at)
        doubt = np.bincount(row, np.logaddexp(0, z), len(y))  # -log(1 - P)
        slope = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(doubt, 500)), 1e-12), 1.0) * share
        by_sentence = np.clip(slope[row] * _logistic(z), -len(y), len(y))
        by_word = np.bincount(word_id, by_sentence[sentence], len(kinds))
        gradient = np.bincount(flat, by_word[owner], size) / len(y) + PENALTY
        gradient[~allowed] = 0
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient ** 2
        step_size = 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        weights = np.maximum(weights - step_size, 0)
    return weights.astype(np.float32)


def _doubts(weights: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """-log(1 - P) of a run of texts: sums over their sentences."""
    s = sentences(raw, offsets)
    return np.bincount(s.row, np.logaddexp(0, _logits(s, weights)), len(offsets) - 1)


def _values(weights: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Scores of a run of texts; a long one is read in pieces that end where a sentence does."""
    if len(offsets) != 2 or len(raw) <= 2 * SLICE_BYTES:
        return -np.expm1(-_doubts(weights, raw, offsets))
    ends = cuts(raw, _END, _ANY)
    doubt = sum(_doubts(weights, raw[a:b], np.array([0, b - a])) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))
    return -np.expm1(-doubt)


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every text."""
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in slices(batch.column(1)):
                value = _values(sent.value, raw, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(value)), pa.array(value)], names=[key, "score"])

    bounded(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def keep(docs: DataFrame, weights: np.ndarray, below: float = 0.7, text: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose text scores less than ``below``; only texts leave the JVM."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    bounded(docs.sparkSession)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        found = np.ones(len(texts), bool)
        for first, raw, offsets in slices(texts):
            found[first:first + len(offsets) - 1] = _values(sent.value, raw, offsets) < below
        return pa.array(found)

    return docs.where(clean(F.col(text)))


def offending(docs: DataFrame, weights: np.ndarray, least: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, first_byte, n_bytes, score, sentence) of every sentence that scores ``least`` or more."""
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, raw, offsets in ((b, *part) for b in batches for part in slices(b.column(1))):
            s = sentences(raw, offsets)
            p = _logistic(_logits(s, sent.value))
            hit = np.flatnonzero(p >= least)
            following = np.append(np.sort(s.starts), len(raw))
            begin = s.starts[hit]
            end = np.minimum(following[np.searchsorted(following, begin, "right")], offsets[s.row[hit] + 1])
            said = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist())]
            keys = batch.column(0).slice(first).take(pa.array(s.row[hit]))
            yield pa.RecordBatch.from_arrays([keys, pa.array(begin - offsets[s.row[hit]]), pa.array(end - begin), pa.array(p[hit]),
                                              pa.array(said, pa.string())], names=[key, "first_byte", "n_bytes", "score", "sentence"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, first_byte bigint, n_bytes bigint, score double, sentence string")


def predict(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, label: str = "toxic", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled sample of ``docs`` and score all of them: (key, held_out, score, predicted)."""
    weights = fit(labelled(docs, labels, label, key, text))
    scored = score(docs, weights, key, text)
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
