"""BPE encoding and decoding by an index of pair occurrences.

The distinct words of a block of texts are laid out as one chain of symbols. Every mergeable
pair is listed with all its positions; the active ranks are applied in ascending order, each
to its whole list at once, and a merge adds its new neighbours to the lists of later ranks.
A merge of rank r makes a symbol that only later ranks use, so one pass over the ranks gives
what merging word by word gives.

Cases: a null or empty text has no ids and decodes to an empty text; repeated rows give equal
rows; other columns are left out of the result. A text of any length is encoded whole, and the
memory of a task is bounded by a block of texts plus the word cache, both parameters. What a
block has freed goes back to the system, so workers that wait hold the vocabulary and the cache.
"""

from __future__ import annotations

import ctypes
import hashlib
import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tamra.llm.order import bounded
from tamra.llm.pretokens import sizes

BLOCK_CHARS = 4_000_000  # texts whose new words share one index
CACHED_WORDS = 100_000  # words whose ids a Python worker keeps
ENTERED = 1 << 18  # positions whose pairs are looked up at once


@cache
def byte_letters() -> list[str]:
    """The printable stand-in of every byte value (fixed by the vocabulary format)."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = (b for b in range(256) if b not in plain)
    moved = {b: chr(256 + i) for i, b in enumerate(others)}
    return [moved.get(b) or chr(b) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    byte_ids: np.ndarray  # id of each byte value
    keys: np.ndarray  # left * size + right of every merge, sorted
    ranks: np.ndarray  # rank of each of the keys
    lefts: list[int]  # by rank
    rights: list[int]
    merged: list[int]
    size: int
    special: dict[str, int]
    pieces: list[bytes]  # bytes of every id


@cache
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    lefts, rights = ([vocab[p[side]] for p in pairs] for side in (0, 1))
    keys = np.array(lefts, np.int64) * size + np.array(rights, np.int64)
    order = np.argsort(keys, kind="stable")
    letters = byte_letters()
    byte_of = {letter: b for b, letter in enumerate(letters)}
    pieces = [b""] * size
    for token, i in vocab.items():
        pieces[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    for token, i in special.items():
        pieces[i] = token.encode()
    return Vocabulary(np.array([vocab[c] for c in letters], np.int64), keys[order], order.astype(np.int64), lefts, rights,
                      [vocab[a + b] for a, b in pairs], size, special, pieces)


def _alternate(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of overlapping pairs of one symbol, every second one, from the left."""
    first = np.ones(len(at), bool)
    first[1:] = after[at[:-1]] != at[1:]
    run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - run_start) % 2 == 0]


def encode_words(words: list[str], v: Vocabulary) -> list[bytes]:
    """Ids of each word as little-endian unsigned 32-bit integers."""
    raw = [w.encode("utf-8") for w in words]
    length = np.array([len(r) for r in raw], np.int64)
    # one dead cell after each word, and one before the first, keep words apart
    start = np.concatenate([[1], 1 + np.cumsum(length + 1)])
    total = int(start[-1])
    place_type = np.int32 if total < 1 << 31 else np.int64
    symbol = np.full(total, -1, np.int32)
    data = np.frombuffer(b"".join(raw), np.uint8)
    inside = np.ones(total, bool)
    inside[0] = False
    inside[start[1:] - 1] = False
    symbol[inside] = v.byte_ids.astype(np.int32)[data]
    before, after = np.arange(-1, total - 1, dtype=place_type), np.arange(1, total + 1, dtype=place_type)
    after[-1] = total - 1
    waiting: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(left: np.ndarray) -> None:
        """List the mergeable pairs that begin at these positions."""
        a, b = symbol[left], symbol[after[left]]
        real = (a >= 0) & (b >= 0)
        left, key = left[real], a[real].astype(np.int64) * v.size + b[real]
        place = np.searchsorted(v.keys, key)
        place[place == len(v.keys)] = 0
        known = v.keys[place] == key
        left, rank = left[known], v.ranks[place[known]]
        if not len(left):
            return
        order = np.argsort(rank, kind="stable")
        left, rank = left[order], rank[order]
        edge = np.flatnonzero(np.diff(rank)) + 1
        for r, at in zip(rank[np.concatenate([[0], edge])].tolist(), np.split(left, edge)):
            if r in waiting:
                waiting[r].append(at)
            else:
                waiting[r] = [at]
                heapq.heappush(active, r)

    if len(v.keys):
        for first in range(0, total, ENTERED):
            enter(np.flatnonzero(inside[first:first + ENTERED]).astype(place_type) + place_type(first))
    while active:
        rank = heapq.heappop(active)
        lists = waiting.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = v.lefts[rank], v.rights[rank]
        at = at[(symbol[at] == left) & (symbol[after[at]] == right)]
        if left == right and len(at) > 1:
            at = _alternate(at, after)
        if not len(at):
            continue
        gone = after[at]
        symbol[at], symbol[gone] = v.merged[rank], -2
        follow = after[gone]
        after[at], before[follow] = follow, at
        enter(np.unique(np.concatenate([at, before[at]])))
    kept = symbol >= 0
    ends = np.concatenate([np.zeros(1, place_type), np.cumsum(kept, dtype=place_type)])
    flat = symbol[kept].astype("<u4").tobytes()
    return [flat[4 * a:4 * b] for a, b in zip(ends[start[:-1]].tolist(), ends[start[1:] - 1].tolist())]


class Encoder:
    """Encodes texts word by word; keeps the ids of the words it met first, up to a bound."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: dict[str, int], cached: int = CACHED_WORDS) -> None:
        self.special = {s: np.array([special[s]], "<u4").tobytes() for s in sorted(special, key=len, reverse=True)}
        self.new_words, self.bound, self.words = encode, cached + len(special), dict(self.special)

    def _sizes(self, text: str) -> np.ndarray:
        """The bytes of the pre-tokens and special tokens of a text in order."""
        for name in self.special:
            if name in text:
                first, *others = map(self._sizes, text.split(name))
                own = np.array([len(name.encode())], np.int64)
                return np.concatenate([first, *(x for other in others for x in (own, other))])
        return sizes(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        parts, known = [self._sizes(t) for t in texts], self.words
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *parts]))
        words = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer("".join(texts).encode())).dictionary_encode()
        at, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in distinct if w not in known]
        room = max(self.bound - len(known), 0)
        if new:
            known.update(zip(new, self.new_words(new)))
        ids = [known[w] for w in distinct]
        for w in new[room:]:
            del known[w]
        # the ids of the distinct words lie side by side; every word takes its own from there
        count = np.array([len(i) // 4 for i in ids], np.int64)
        first = np.cumsum(count) - count
        taken = count[at]
        stop = np.cumsum(taken)
        total = int(stop[-1]) if len(stop) else 0
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(first[at] - stop + taken, taken) + np.arange(total)].tobytes()
        last = np.concatenate([np.zeros(1, np.int64), 4 * stop])[np.cumsum([0, *map(len, parts)])].tolist()
        return [flat[a:b] for a, b in zip(last, last[1:])]


def decode(ids: bytes, v: Vocabulary) -> str:
    """The text of ids; bytes that are no UTF-8 become replacement characters."""
    pieces = v.pieces
    return b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's call that gives freed pages back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Hand memory that is free, but kept for later use, to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, with freed memory given back first, after each batch that it makes, and last.

    Spark keeps the Python workers of a task for later ones; an executor has more of them than cores.
    """
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for made in run(batches):
            yield made
            del made
            give_back()
        give_back()

    return tidy


@cache
def _encoder(path: str) -> Encoder:
    v = load(path)
    return Encoder(lambda words: encode_words(words, v), v.special)


def blocks(batches: Iterable[pa.RecordBatch], chars: int = BLOCK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches of (id, text) in parts of about ``chars`` characters, null texts as empty ones."""
    for batch in batches:
        texts, first, held = [], 0, 0
        for i, value in enumerate(batch.column(1)):
            texts.append(value.as_py() or "")
            held += len(texts[-1])
            if held >= chars or i == batch.num_rows - 1:
                yield batch.slice(first, i + 1 - first), texts
                texts, first, held = [], i + 1, 0


def encode_text(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): each text's ids as little-endian unsigned 32-bit integers, in the rows' order."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for held, texts in blocks(batches):
            ids = pa.array(encoder.encode(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([held.column(0), ids], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(tidied(run), f"`{key}` {kind}, ids binary")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass; return counts and digests instead of the ids."""
    kind = docs.schema[key].dataType.simpleString()
    bounded(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for held, texts in blocks(batches):
            ids = encoder.encode(texts)
            back = (decode(i, load(path)).encode("utf-8") for i in ids)
            columns = [held.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                       pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                       pa.array([hashlib.sha256(b).hexdigest() for b in back])]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(tidied(run), f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode_ids(ids: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) from the result of ``encode_text``; null ids give an empty text."""
    kind = ids.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = load(path)
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "text": [decode(i or b"", v) for i in frame["ids"]]})

    return ids.select(key, "ids").mapInPandas(run, f"`{key}` {kind}, text string")
