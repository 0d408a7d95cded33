"""Token ids in files of fixed-width packed bits, with offsets for random access.

A file is a Parquet part; a row is a block: whole documents in ascending key order, about
``BLOCK_TOKENS`` ids. Every id takes the least number of bits that holds the vocabulary, id j
of a block begins at bit ``j * width`` (little-endian), so numpy unpacks any slice of a block
without the ids before it. ``first_token`` is the block's offset among the ids of its part.

Spark writes and commits the files, so a lost executor's blocks are written again, and any
store that Spark reaches can hold them. A null or empty text has only the end id. Rows of one
key are kept, in the order of their texts' crc32; a null key sorts first. Other columns are
left out. A document longer than a block is a block of its own; no text is cut.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamra.llm.bpe import Encoder, blocks

BLOCK_TOKENS = 65_536
BLOCK_CHARS = 2_000_000
CACHED_WORDS = 600_000  # words whose ids a Python worker keeps: about 110 MB


def bits_for(size: int) -> int:
    """Least width that holds ids 0 to size - 1."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    ids = np.ascontiguousarray(ids, "<u8")
    if width % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 8)[:, :width // 8].tobytes()
    bits = (ids[:, None] >> np.arange(width, dtype=np.uint64)).astype(np.uint8) & 1
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, first: int, n: int) -> np.ndarray:
    """Ids ``first`` to ``first + n - 1`` of a block."""
    raw = np.frombuffer(data, np.uint8)
    start, stop = first * width, (first + n) * width
    raw = raw[start // 8:(stop + 7) // 8]
    if width % 8 == 0:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width // 8] = raw.reshape(n, width // 8)
        return wide.view("<u8").ravel().astype("<u4")
    bits = np.unpackbits(raw, bitorder="little")[start % 8:start % 8 + n * width].reshape(n, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(1).astype("<u4")


@cache
def _library(path: str) -> tuple[Encoder, int]:
    """The tokenizers library behind a cache of words, and the vocabulary's size."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)

    def words(new: list[str]) -> list[bytes]:
        """The library splits each piece for itself; a piece of the pattern stays whole."""
        found = tokenizer.encode(new, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(new)), "right").tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    return Encoder(words, special, CACHED_WORDS), tokenizer.get_vocab_size(with_added_tokens=True)


def vocabulary_size(path: str) -> int:
    return _library(path)[1]


def write(docs: DataFrame, out: str, path: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append ``end_id``, and write blocks in ascending key order below ``out``."""
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"part int, block int, first_token bigint, n_tokens int, width int, keys array<{kind}>, "
              "key_tokens array<int>, payload binary")
    ordered = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.crc32(F.coalesce(text, F.lit(""))).alias("tie"))
               .repartitionByRange("key", "tie").sortWithinPartitions("key", "tie", "text").select("key", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = _library(path)
        part, width = TaskContext.get().partitionId(), bits_for(size)
        keys, counts, held = [], [], []
        waiting = block = first = 0
        names = ["part", "block", "first_token", "n_tokens", "width", "keys", "key_tokens", "payload"]

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            joined = pa.concat_arrays(keys)
            columns = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                       pa.array([len(ids)], pa.int32()), pa.array([width], pa.int32()),
                       pa.ListArray.from_arrays(pa.array([0, len(joined)], pa.int32()), joined),
                       pa.array([counts], pa.list_(pa.int32())), pa.array([pack(ids, width)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch, texts in blocks(batches, BLOCK_CHARS):
            column = batch.column(0)
            for i, ids in enumerate(encoder.encode(texts)):
                held.append(ids + end)
                counts.append(len(ids) // 4 + 1)
                keys.append(column.slice(i, 1))
                waiting += counts[-1]
                if waiting >= BLOCK_TOKENS:
                    yield flush()
                    block, first = block + 1, first + waiting
                    keys, counts, held, waiting = [], [], [], 0
        if held:
            yield flush()

    ordered.mapInArrow(run, schema).write.mode("overwrite").parquet(out)


def read_blocks(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


def part_starts(stored: DataFrame) -> DataFrame:
    """(part, base): ids in all parts before; one row per written file part."""
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_range(spark: SparkSession, out: str, start: int, stop: int) -> DataFrame:
    """(start, ids) of the blocks' slices that hold ids start to stop - 1 of the whole corpus."""
    stored = read_blocks(spark, out)
    placed = stored.join(part_starts(stored), "part").withColumn("at", F.col("base") + F.col("first_token"))
    placed = placed.where((F.col("at") < stop) & (F.col("at") + F.col("n_tokens") > start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            spans = [(max(start - r["at"], 0), min(stop - r["at"], r["n_tokens"])) for r in rows]
            ids = [unpack(r["payload"], r["width"], a, b - a).tolist() for r, (a, b) in zip(rows, spans)]
            yield pa.RecordBatch.from_arrays([pa.array([r["at"] + a for r, (a, _) in zip(rows, spans)], pa.int64()),
                                              pa.array(ids, pa.list_(pa.int64()))], names=["start", "ids"])

    return placed.select("at", "n_tokens", "width", "payload").mapInArrow(run, "start bigint, ids array<bigint>")


def documents(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files alone."""
    stored = read_blocks(spark, out)
    kind = stored.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                part, first, n, width = (row.column(c)[0].as_py() for c in range(4))
                counts = row.column(5).flatten().to_numpy().astype(np.int64)
                ids = unpack(row.column(6)[0].as_py(), width, 0, n)
                ends = np.cumsum(counts)
                begins = ends - counts
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(crc), part, np.int32)), row.column(4).flatten(),
                                                  pa.array(first + begins), pa.array(counts), pa.array(crc, pa.int64())],
                                                 names=["part", key, "at", "n_tokens", "ids_crc32"])

    found = stored.select("part", "first_token", "n_tokens", "width", "keys", "key_tokens", "payload").mapInArrow(
        run, f"part int, `{key}` {kind}, at bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(part_starts(stored), "part").select(key, (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
