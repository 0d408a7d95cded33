"""A bounded, reproducible sample of labelled texts to fit a classifier on."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamra.llm.order import stored

PER_CLASS = 2_500  # labelled rows drawn for each of the two labels
CLASS_BYTES = 3 << 20  # of the texts drawn for each label, which bounds the driver's memory
MOST_BYTES = 65_536  # of one text; a longer one is scored whole but never drawn


def held_out(key: Column) -> Column:
    """The fold whose labels are never seen: crc32 of the key as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", per_class: int = PER_CLASS,
             class_bytes: int = CLASS_BYTES, most_bytes: int = MOST_BYTES) -> pd.DataFrame:
    """(text, label) of labelled rows outside the held-out fold, drawn by hash order of the key.

    Of each label the first ``per_class`` texts are drawn, or as many as fit ``class_bytes``
    together; texts over ``most_bytes`` are passed over before the draw. ``attrs`` says how many
    labelled keys there were (``labelled``) and how many of them were too long (``too_long``).
    A key labelled more than once counts once, as 1 if any row says so; null labels don't count;
    of rows that share a key the one of the smallest crc32 is taken.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(key).agg(F.max(F.col(label)).alias("_label"))
    said = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(F.col(key), F.struct(F.crc32(said).alias("tie"), F.octet_length(said).alias("bytes")).alias("_text"))
    rows = known.join(sized, key).groupBy(key, "_label").agg(F.min("_text").alias("_text"))
    rows = stored(rows.select(key, "_label", "_text.tie", "_text.bytes", F.xxhash64(key).alias("_order")), "labelled")
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("bytes") > most_bytes, 1))).first()
    drawn = [rows.where((F.col("_label") == y) & (F.col("bytes") <= most_bytes)).orderBy("_order", key).limit(per_class).toPandas() for y in (0, 1)]
    drawn = pd.concat([d[d["bytes"].cumsum() <= class_bytes] for d in drawn], ignore_index=True)
    if len(drawn):
        chosen = docs.sparkSession.createDataFrame(drawn[[key, "tie"]])  # at most 2 * per_class keys
        texts = docs.select(F.col(key), F.crc32(said).alias("tie"), said.alias("_said")).join(F.broadcast(chosen), [key, "tie"]).toPandas()
        drawn = drawn.merge(texts.drop_duplicates([key, "tie"]), on=[key, "tie"])
    found = pd.DataFrame({"text": drawn["_said"].to_numpy(object) if len(drawn) else [], "label": drawn["_label"].astype(int).to_numpy()})
    found.attrs = {"labelled": counts[0], "too_long": counts[1]}
    return found
