"""Order-dependent operators that do not pull a table into one task.

A window without PARTITION BY moves every row into a single partition. The two
building blocks here avoid it: ``exact_quantiles`` counts rows by the leading bits of
their values, ``running_totals`` splits the order into ranges and adds the totals of the
earlier ranges.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.sources.staging import stage

DIGIT = 16  # bits that a pass settles
GATHERED = 200_000  # rows of a column that a task gathers before it sums them up
_NAN = (1 << 63) - 1


def ordered_image(value: Column) -> Column:
    """A long that orders like the double: its bits, negated for negative values; NaN is the largest.

    There is no built-in for the bits, so they are taken apart: scaling by a power of two is exact.
    """
    size = F.abs(value)
    guess = F.least(F.floor(F.log2(size)), F.lit(1023))
    scaled = size / F.pow(F.lit(2.0), guess.cast("double"))
    # The logarithm may be off by a rounding at a power of two.
    power = guess + F.when(scaled >= 2.0, F.lit(1)).when(scaled < 1.0, F.lit(-1)).otherwise(F.lit(0))
    part = F.when(scaled >= 2.0, scaled / 2.0).when(scaled < 1.0, scaled * 2.0).otherwise(scaled)
    normal = (power + F.lit(1023)).cast("long") * F.lit(1 << 52) + ((part - F.lit(1.0)) * F.lit(float(1 << 52))).cast("long")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    infinite = F.lit(2047 << 52).cast("long")
    bits = F.when(size == float("inf"), infinite).when(size < 2.0**-1022, tiny).otherwise(normal)
    return F.when(value.isNotNull(), F.when(F.isnan(value), F.lit(_NAN).cast("long")).when(value < 0, -bits).otherwise(bits))


def image_value(image: int) -> float:
    """The double of an image."""
    if image == _NAN:
        return math.nan
    size = struct.unpack("<d", struct.pack("<q", abs(image)))[0]
    return -size if image < 0 else size


def exact_quantiles(df: DataFrame, columns, probs) -> dict[str, list]:
    """Exact linearly interpolated quantiles of each column, NULLs skipped.

    Radix selection: rows are counted by the leading 16 bits of their values, then, among those that
    share the leading bits of a wanted rank, by the next 16, four times at most. All columns and ranks
    share a pass; a pass ends a rank whose rows have one value. Counts are summed up in Arrow batches where the rows are read and
    at most 65,536 of them per open rank reach the driver, whatever the number of rows. ``df`` is read
    once a pass and should be staged.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    found: dict[tuple[int, int], int] = {}
    # Open ranks: (column, leading digits) to the ranks there and the rows before.
    open_ranks: dict[tuple[int, int | None], list[int]] = {}
    before: dict[tuple[int, int | None], int] = {}
    positions: dict[int, list[float]] = {}
    for shift in range(64 - DIGIT, -1, -DIGIT):
        wanted: dict[int, list[int] | None] = {} if open_ranks else dict.fromkeys(range(len(columns)))
        for c, lead in open_ranks:
            wanted.setdefault(c, []).append(lead)
        # Only columns that have open ranks are read.
        asked = df.select(*[F.col(columns[c]).cast("double").alias(f"v{c}") for c in wanted])
        counted = (
            asked.mapInArrow(_count_digits(wanted, shift), "c int, lead long, n long, low long, high long")
            .groupBy("c", "lead")
            .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
            .collect()
        )
        groups: dict[tuple[int, int | None], list] = {}
        for r in sorted(counted, key=lambda r: (r["c"], r["lead"])):
            lead = r["lead"] >> DIGIT if shift < 64 - DIGIT else None
            groups.setdefault((r["c"], lead), []).append(r)
        if shift == 64 - DIGIT:
            for (c, _), digits in groups.items():
                n = sum(r["n"] for r in digits)
                positions[c] = [p * (n - 1) for p in probs]
                open_ranks[c, None] = sorted({r for p in positions[c] for r in (math.floor(p), math.ceil(p))})
                before[c, None] = 0
        still: dict[tuple[int, int | None], list[int]] = {}
        for key, ranks in open_ranks.items():
            upto, at = before[key], 0
            digits = groups[key]
            for rank in ranks:
                while upto + digits[at]["n"] <= rank:
                    upto += digits[at]["n"]
                    at += 1
                digit = digits[at]
                if digit["low"] == digit["high"]:
                    found[key[0], rank] = digit["low"]
                else:
                    still.setdefault((key[0], digit["lead"]), []).append(rank)
                    before[key[0], digit["lead"]] = upto
        open_ranks = still
        if not open_ranks:
            break
    return {
        name: [_interpolate(found, i, p) for p in positions[i]] if i in positions else [None] * len(probs)
        for i, name in enumerate(columns)
    }


def _images(values: pa.Array) -> np.ndarray:
    """``ordered_image`` of the values that are not NULL: the bits of the double, negated for negative values."""
    doubles = values.drop_null().to_numpy(zero_copy_only=False)
    bits = doubles.view(np.int64)
    images = np.where(bits < 0, -(bits & _NAN), bits)
    images[np.isnan(doubles)] = _NAN
    return images


def _count_digits(wanted: dict, shift: int):
    """Rows by leading digits, with smallest and largest image, per column: summed up while a partition is read."""

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts, axis=1)
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        first = np.flatnonzero(np.diff(rows[0], prepend=rows[0, :1] - 1))
        return np.stack([rows[0, first], np.add.reduceat(rows[1], first), np.minimum.reduceat(rows[2], first), np.maximum.reduceat(rows[3], first)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # At most as many counts as there are digits behind the wanted leads.
        kept: dict[int, list[np.ndarray]] = {c: [] for c in wanted}
        waiting = dict.fromkeys(wanted, 0)
        for batch in batches:
            for at, (c, leads) in enumerate(wanted.items()):
                images = _images(batch.column(at))
                if leads is not None:
                    images = images[np.isin(images >> (shift + DIGIT), leads)]
                if len(images):
                    kept[c].append(np.stack([images >> shift, np.ones_like(images), images, images]))
                    waiting[c] += len(images)
                if waiting[c] > GATHERED:
                    kept[c], waiting[c] = [merged(kept[c])], 0
        for c, parts in kept.items():
            if parts:
                lead, n, low, high = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), c, np.int32)), *map(pa.array, (lead, n, low, high))], names=["c", "lead", "n", "low", "high"])

    return run


def _interpolate(found, column, position):
    low, high = math.floor(position), math.ceil(position)
    below, above = image_value(found[column, low]), image_value(found[column, high])
    return below if below == above else (high - position) * below + (position - low) * above


def order_ranges(df: DataFrame, order, buckets: int | None = None) -> DataFrame:
    """``df`` with ``_range``, the number of a range of the ascending ``order`` columns.

    Spark's range partitioning deals the rows out; they are written with their number, so that a
    recomputed task can't deal them anew. ``order`` should be unique per row; then equal
    leading values cannot pile up in one range.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(buckets, *order).withColumn("_range", F.spark_partition_id()))


def running_totals(df: DataFrame, order, sums: dict, buckets: int | None = None) -> DataFrame:
    """Running sums over the whole table in ascending ``order``.

    ``sums`` maps an output name to the column to sum. Rows are summed up inside ranges of the
    order; a table with one row per range carries the totals of all earlier ranges. There are as
    many ranges as shuffle partitions, so ranges get more, not larger, with the table.
    """
    ranged = order_ranges(df, order, buckets)
    totals = ranged.groupBy("_range").agg(*[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()])
    # One row per shuffle partition.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_range"),
        *[F.coalesce(F.sum(f"_t_{out}").over(earlier), F.lit(0)).alias(f"_o_{out}") for out in sums],
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranged.withColumns({f"_w_{out}": F.sum(src).over(inside) for out, src in sums.items()})
    joined = ranked.join(F.broadcast(offsets), "_range")
    return joined.select(*df.columns, *[(F.col(f"_w_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums])
