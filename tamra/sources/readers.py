"""Readers: Markdown trees, JSON lines, Parquet globs and mixed Parquet schemas."""

from __future__ import annotations

import fnmatch
import os
import re
import zlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamra.functions.text import non_blank
from tamra.operators.shape import cap, concat, normalise

# Text column names tried in this order, first one present wins.
TEXT_CANDIDATES = ("text", "txt", "body", "content", "document", "article", "raw_content")


def _drop_invalid(raw: Column) -> Column:
    """Decode UTF-8, leaving invalid bytes out."""
    return F.translate(F.make_valid_utf8(raw.cast("string")), "�", "")


def _lenient(spark: SparkSession):
    return (spark.read.option("recursiveFileLookup", True)
            .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True))


def path_id(path: Column, ordinal: Column | int = 0) -> Column:
    """Document id that does not depend on how files were split into tasks."""
    number = F.lit(ordinal) if isinstance(ordinal, int) else ordinal
    return F.sha1(F.concat_ws("\u0001", path, number.cast("string")))


def read_markdown(spark: SparkSession, folder: str, source: str, pattern: str = "*.md") -> DataFrame:
    """One row per file of a tree; blank files are left out."""
    files = mounted_files(spark, folder, pattern)
    if files is None:
        files = _lenient(spark).format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return (
        files.select(_drop_invalid(F.col("content")).alias("text"), F.col("path").alias("original_path"))
        .filter(non_blank(F.col("text")))
        .select("text", F.lit(source).alias("source"), "original_path", path_id(F.col("original_path")).alias("doc_key"))
    )


LISTERS = 32  # tasks that walk a tree; each takes its share of the entries of the top folder
BATCH_BYTES = 4_000_000  # of contents that a task hands on at once, or one file
PATHS = 10_000  # that a task hands on at once


def mounted_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    """``path, content`` of the files that Spark's reader of binary files would find, listed and read by the tasks.

    Spark's reader keeps a record of every file on the driver. Here tasks walk the tree, paths are
    dealt by hash, and tasks read them. None if that reader is needed: for another store than a
    mounted folder, a folder that is none or is named by a glob, or a pattern of more than ``*`` and ``?``.
    """
    place = urlsplit(folder)
    root = os.path.abspath(place.path)
    if place.scheme not in ("", "file") or place.netloc or place.query or place.fragment or re.search(r"[][{}\\^]", pattern) or re.search(r"[][{}*?\\%]", folder):
        return None
    if not os.path.isdir(root):
        return None
    wanted = re.compile(fnmatch.translate(pattern))

    def hidden(name: str) -> bool:
        return name.startswith(".") or (name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))) or name.endswith("._COPYING_")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries(at: str) -> Iterator[os.DirEntry]:
            try:
                with os.scandir(at) as found:
                    yield from (e for e in found if not hidden(e.name))
            except OSError:  # gone or closed meanwhile
                return

        for batch in batches:
            for share in batch.column(0).to_pylist():
                below, paths = [], []
                for top in (True, False):
                    while top or below:
                        for e in entries(root if top else below.pop()):
                            if top and zlib.crc32(e.name.encode("utf-8", "surrogateescape")) % LISTERS != share:
                                continue
                            if e.is_dir():
                                below.append(e.path)
                            elif wanted.match(e.name):
                                paths.append(os.fsencode(e.path))
                            if len(paths) >= PATHS:
                                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary())], names=["name"])
                                paths = []
                        if top:
                            break
                if paths:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary())], names=["name"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, contents, size = [], [], 0

        def made() -> pa.RecordBatch:
            paths = pa.array([f"file:{os.fsdecode(n)}".encode("utf-8", "replace") for n in names], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([paths, pa.array(contents, pa.binary())], names=["path", "content"])

        for batch in batches:
            for name in batch.column(0).to_pylist():
                try:
                    with open(name, "rb") as file:
                        content = file.read()
                except OSError:
                    continue
                names.append(name)
                contents.append(content)
                size += len(content)
                if size >= BATCH_BYTES:
                    yield made()
                    names, contents, size = [], [], 0
        if names:
            yield made()

    shares = spark.range(0, LISTERS, 1, LISTERS).mapInArrow(listed, "name binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shares.repartition(parts, "name").mapInArrow(read, "path string, content binary")


def _social_lines(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    lines = _lenient(spark).option("pathGlobFilter", pattern).text(folder)
    valid = lines.select(_drop_invalid(F.col("value")).alias("value")).filter(non_blank(F.col("value")))
    return valid.withColumn("keys", F.json_object_keys("value"))


def read_social_jsonl(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """Title and body of each JSON line; a line that is no JSON object is left out.

    The body is ``body_text`` if that key is present, whatever its value, and
    ``text`` otherwise.
    """
    rows = _social_lines(spark, folder, pattern).filter(F.col("keys").isNotNull())
    title = F.coalesce(F.get_json_object("value", "$.title"), F.lit(""))
    body = F.coalesce(
        F.when(F.array_contains("keys", "body_text"), F.get_json_object("value", "$.body_text"))
        .otherwise(F.get_json_object("value", "$.text")),
        F.lit(""),
    )
    text = (F.when((title != "") & (body != ""), F.concat_ws("\n", title, body))
            .when(body != "", body).otherwise(title))
    return rows.select(text.alias("text"), F.lit("social").alias("source")).filter(non_blank(F.col("text")))


def social_rejects(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """Count of the non-blank lines that are no JSON object."""
    return _social_lines(spark, folder, pattern).agg(
        F.count_if(F.col("keys").isNull()).alias("rejected"), F.count(F.lit(1)).alias("lines"))


def read_jsonl(spark: SparkSession, path: str, source: str = "nation_data") -> DataFrame:
    """The ``text`` field of each JSON line; the other fields are never parsed into columns."""
    return spark.read.schema("text STRING").json(path).withColumn("source", F.lit(source))


def list_files(spark: SparkSession, globs: Iterable[str]) -> list[str]:
    """Paths that match, each once, sorted. Only paths are read, not contents."""
    found = spark.read.format("binaryFile").load(list(globs)).select("path").distinct()
    return sorted(row.path for row in found.collect())


def read_parquet_globs(spark: SparkSession, globs: Sequence[str]) -> DataFrame:
    """One table from several globs; a file matched twice is read once."""
    return spark.read.parquet(*list_files(spark, globs))


def footer_columns(spark: SparkSession, folder: str, candidates: Sequence[str] = TEXT_CANDIDATES) -> DataFrame:
    """``path, chosen, is_text, error`` per Parquet file. Footers are read in the tasks."""
    names = list(candidates)

    def inspect(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch["path"]:
                # a store that the footers' reader doesn't know is an error of the call, not of a file
                store, inner = pafs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))
                try:
                    schema = pq.read_schema(inner, filesystem=store)
                    chosen = next((c for c in names if c in schema.names), None)
                    kind = schema.field(chosen).type if chosen else None
                    textual = kind is not None and (pa.types.is_string(kind) or pa.types.is_large_string(kind))
                    rows.append((path, chosen, textual, None))
                except Exception as error:  # noqa: BLE001 - an unreadable file is reported, not fatal
                    rows.append((path, None, False, type(error).__name__))
            yield pd.DataFrame(rows, columns=["path", "chosen", "is_text", "error"])

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(folder).select("path"))
    return files.mapInPandas(inspect, "path string, chosen string, is_text boolean, error string")


def read_mixed_parquet(spark: SparkSession, folder: str,
                       candidates: Sequence[str] = TEXT_CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """Text from files with different text columns, and the files that were skipped.

    Per file the first candidate *present* is read, and no other column. One scan
    per chosen column, however many files share it.
    """
    footers = footer_columns(spark, folder, candidates).collect()  # one short row per file, like a file listing
    groups: dict[str, list[str]] = {}
    for row in footers:
        if row.is_text:
            groups.setdefault(row.chosen, []).append(row.path)
    skipped = spark.createDataFrame(
        [(r.path, r.error or ("no text column" if r.chosen is None else "not a string column"))
         for r in footers if not r.is_text], "path string, reason string")
    parts = [
        spark.read.schema(f"`{name}` STRING").option("ignoreCorruptFiles", True).parquet(*sorted(paths))
        .select(F.col(name).alias("text")).filter(non_blank(F.col("text")))
        for name, paths in sorted(groups.items())
    ]
    if not parts:
        return spark.createDataFrame([], "text string"), skipped
    return reduce(DataFrame.unionByName, parts), skipped


def load_sources(spark: SparkSession, specs: Sequence[Mapping], text_field: str = "text",
                 max_docs: int | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Read every named source into one corpus, in the order of ``specs``.

    A spec is ``{id, path, format, split, text_field}``; ``split`` (default
    ``train``) picks a partition of the source where it has one.
    """
    parts = []
    for spec in specs:
        frame = spark.read.format(spec.get("format", "parquet")).load(spec["path"])
        if "split" in frame.columns:
            frame = frame.filter(F.col("split") == spec.get("split", "train"))
        parts.append(normalise(frame, spec.get("text_field", text_field), keep).withColumn("source", F.lit(spec["id"])))
    if not parts:
        raise ValueError("no data sources: the list of sources is empty")
    return cap(concat(parts), max_docs)


def license_gate(df: DataFrame, allow: Sequence[str]) -> DataFrame:
    """Keep documents without a licence line or with one that names an allowed licence.

    ``allow`` is a short list of licence names, matched as whole words of the licence line ("mit"
    is not in "not permitted"). A text without a licence line is kept: nothing forbids it.
    """
    line = F.regexp_extract(F.col("text"), r"(?im)^([^\n]*licen[cs]e[^\n]*)", 1)
    pattern = "(?i)(?<![A-Za-z0-9])(?:" + "|".join(re.escape(name) for name in allow) + ")(?![A-Za-z0-9])"
    marked = df.withColumn("license_line", line)
    allowed = F.regexp_like("license_line", F.lit(pattern)) if allow else F.lit(False)
    return marked.filter((F.col("license_line") == "") | allowed)
