"""Row numbers and running sums over a whole table, without a window in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamra.session import bounded, scratch  # noqa: F401 - operators take both from here


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it: what follows never runs it again."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def running(df: DataFrame, order: list[str], value: str | Column | None = None) -> DataFrame:
    """``df`` with ``row_number`` (from 0) and, given ``value``, ``before``: its sum over all earlier rows.

    ``df`` must be narrow (it is shuffled and stored once). Rows are dealt by ranges of
    ``order``, numbered inside a range, and shifted by the ranges before it; there are as many
    ranges as shuffle partitions. Rows equal in ``order`` share a range.
    """
    value = F.lit(0) if value is None else (F.col(value) if isinstance(value, str) else value)
    dealt = df.withColumn("_value", value).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "ranges")
    sums = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_range", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(to)
                                    for c, to in (("_n", "_rows"), ("_sum", "_words"))))
    inside = Window.partitionBy("_range").orderBy(*order)
    up_to = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.select("*", (F.row_number().over(inside) - 1).alias("_at"), F.coalesce(F.sum("_value").over(up_to), F.lit(0)).alias("_here"))
    return (numbered.join(bases, "_range")
            .withColumn("row_number", (F.col("_rows") + F.col("_at")).cast("long"))
            .withColumn("before", F.col("_words") + F.col("_here"))
            .drop("_range", "_value", "_rows", "_words", "_at", "_here"))
