"""Running sums and maxima over long orders, in blocks of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)


def running_total(rows: DataFrame, keys: list[str], block: Column, order: list, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` before the row, in order of ``block``, then of ``order``, per ``keys``.

    Blocks hold a bounded part of the rows; only their totals meet per key.
    """
    rows = rows.withColumn("_block", block)
    totals = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    # Block totals in two levels, so that a task never has more than a thousandth of them.
    super_key = F.floor(F.col("_block") / 1000)
    upper = totals.groupBy(*keys, super_key.alias("_super")).agg(F.sum("_sum").alias("_total"))
    per_key = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_super").rowsBetween(*BEFORE)
    upper = upper.select(*keys, "_super", F.coalesce(F.sum("_total").over(per_key), F.lit(0)).alias("_above"))
    totals = totals.withColumn("_super", super_key).join(upper, [*keys, "_super"])
    per_super = Window.partitionBy(*keys, "_super").orderBy("_block").rowsBetween(*BEFORE)
    offsets = totals.select(*keys, "_block", (F.col("_above") + F.coalesce(F.sum("_sum").over(per_super), F.lit(0))).alias("_offset"))
    in_block = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(*BEFORE)
    inside = rows.withColumn("_inside", F.coalesce(F.sum(value).over(in_block), F.lit(0)))
    return inside.join(offsets, [*keys, "_block"]).withColumn(name, F.col("_offset") + F.col("_inside")).drop("_block", "_offset", "_inside")


def latest_before(rows: DataFrame, keys: list[str], at: str, value: str, name: str, width: int = 256) -> DataFrame:
    """Add ``name``: the largest non-null ``value`` of the rows of the key with a smaller ``at``.

    ``value`` grows with ``at``. Stretches of ``width`` of ``at`` are looked at separately and only
    hand on their largest value, so a key with many rows is spread over many tasks.
    """
    rows = rows.withColumn("_block", F.floor(F.col(at) / width))
    tops = rows.groupBy(*keys, "_block").agg(F.max(value).alias("_top"))
    carried = F.max("_top").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(*BEFORE))
    tops = tops.select(*keys, "_block", carried.alias("_carried"))
    smaller = Window.partitionBy(*keys, "_block").orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_inside", F.max(value).over(smaller))
    return inside.join(tops, [*keys, "_block"]).withColumn(name, F.coalesce("_inside", "_carried")).drop("_block", "_inside", "_carried")
