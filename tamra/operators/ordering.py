"""Row numbers, running sums and neighbours without a one-task window.

A window that is ordered over a whole corpus, or over a group that may hold a
third of it, runs in a single task. Every function here first cuts the order
into buckets that are monotone in the order, works inside (group, bucket), and
adds what the earlier buckets of the same group contribute. The table of buckets
is small: a row for each bucket and group. Null keys and null order values are kept: a null key
is a group, a null value comes first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BUCKET = "_bucket"
HASH_DIGITS = 3  # 16 ** 3 buckets per group for an order by hash


ROWS_PER_BUCKET = 50_000
MOST_BUCKETS = 10_000


def with_value_bucket(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``, non-decreasing in the numeric ``column``; nulls have a bucket of their own, before all others.

    The cut points are approximate quantiles (as many as the rows call for, at most ``MOST_BUCKETS``
    numbers) and are written into the plan, so a recomputed task puts each row into the same
    bucket again. Any cut points give exact results.
    """
    value = F.col(column).cast("double")
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(8, df.count() // ROWS_PER_BUCKET))
    marks = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(value, marks, 4 * buckets)).first() if marks else [None]
    cuts = sorted(set(row[0] or []))
    if not cuts:
        return df.withColumn(BUCKET, F.when(value.isNull(), -1.0).otherwise(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    numeric = df.withColumn("_order", value)
    placed = Bucketizer(splits=splits, inputCol="_order", outputCol=BUCKET, handleInvalid="keep").transform(numeric)
    return placed.withColumn(BUCKET, F.when(F.col("_order").isNull(), -1.0).otherwise(F.col(BUCKET))).drop("_order")


def with_hash_bucket(df: DataFrame, hashed: str, digits: int = HASH_DIGITS) -> DataFrame:
    """Add ``_bucket``, the leading hex digits of a hash: even by construction; "" for a null."""
    return df.withColumn(BUCKET, F.coalesce(F.substring(F.col(hashed), 1, digits), F.lit("")))


def _attach(df: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys that may be null; the bucket itself never is."""
    both = df.alias("_d").join(table.alias("_t"), [F.col(f"_d.{k}").eqNullSafe(F.col(f"_t.{k}")) for k in keys])
    return both.select("_d.*", *[f"_t.{c}" for c in table.columns if c not in keys])


def row_numbers(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), out: str = "rn") -> DataFrame:
    """1-based row number in ``order`` within ``by``; ``df`` carries ``_bucket``."""
    keys = [*by, BUCKET]
    local = W.partitionBy(*keys).orderBy(*order)
    before = W.partitionBy(*by).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    numbered = df.withColumn("_local", F.row_number().over(local))
    return (
        _attach(numbered, offsets, keys)
        .withColumn(out, (F.col("_local") + F.col("_off")).cast("bigint"))
        .drop("_local", "_off", BUCKET)
    )


def rank_by_value(df: DataFrame, column: str, by: Sequence[str] = (), out: str = "rn",
                  buckets: int | None = None) -> DataFrame:
    """Row number by a unique numeric column."""
    return row_numbers(with_value_bucket(df, column, buckets), [column], by, out)


def rank_by_hash(df: DataFrame, key: Column, tie: str, by: Sequence[str] = (), out: str = "rn") -> DataFrame:
    """Row number by the md5 of ``key`` (ties by ``tie``)."""
    hashed = df.withColumn("_md5", F.md5(key))
    return row_numbers(with_hash_bucket(hashed, "_md5"), ["_md5", tie], by, out).drop("_md5")


def running(df: DataFrame, value: Column, column: str, by: Sequence[str] = (), out: str = "before",
            how: str = "sum", buckets: int | None = None) -> DataFrame:
    """Sum (or max) of ``value`` over the earlier rows of the group, the row itself left out.

    The first row of a group gets 0 for ``sum`` and null for ``max``.
    """
    combine = {"sum": F.sum, "max": F.max}[how]
    marked = with_value_bucket(df.withColumn("_v", value), column, buckets)
    keys = [*by, BUCKET]
    inside = W.partitionBy(*keys).orderBy(column).rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*by).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = marked.groupBy(*keys).agg(combine("_v").alias("_t")).select(
        *keys, combine("_t").over(earlier).alias("_off"))
    local = marked.withColumn("_local", combine("_v").over(inside))
    joined = _attach(local, offsets, keys)
    if how == "sum":
        total = F.coalesce(F.col("_local"), F.lit(0)) + F.coalesce(F.col("_off"), F.lit(0))
    else:
        total = F.greatest(F.col("_local"), F.col("_off"))
    return joined.withColumn(out, total).drop("_local", "_off", "_v", BUCKET)


def following(df: DataFrame, column: str, order: Sequence[str], by: Sequence[str], out: str = "next_value",
              buckets: int | None = None) -> DataFrame:
    """Value of ``column`` (numeric or time, first in ``order``) in the next row of the group."""
    timed = df.schema[column].dataType.typeName().startswith("timestamp")
    seconds = df.withColumn("_key", (F.col(column).cast("timestamp") if timed else F.col(column)).cast("double"))
    marked = with_value_bucket(seconds, "_key", buckets)
    keys = [*by, BUCKET]
    inside = W.partitionBy(*keys).orderBy(*order)
    later = W.partitionBy(*by).orderBy(BUCKET)
    heads = marked.groupBy(*keys).agg(F.min(column).alias("_head")).select(
        *keys, F.lead("_head").over(later).alias("_next_head"))
    local = marked.withColumn("_local", F.lead(column).over(inside))
    return (
        _attach(local, heads, keys)
        .withColumn(out, F.coalesce("_local", "_next_head"))
        .drop("_local", "_next_head", "_key", BUCKET)
    )
