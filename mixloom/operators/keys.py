"""Keys: duplicates, orphans, first rows and skew-safe joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dedupe_on_key(df: DataFrame, keys, tiebreak) -> DataFrame:
    """One row per key: the first in ``tiebreak`` order.

    Written as an aggregate, not as a window: the minimum is combined on the map
    side, so a key that holds a large share of the rows never lands whole in one
    task. Ties beyond ``tiebreak`` are settled by the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in tiebreak if c in rest] + [c for c in rest if c not in tiebreak]
    if not order:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    return picked.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in df.columns])


def first_row_per_key(df: DataFrame, keys, order, columns) -> DataFrame:
    """``columns`` of the first row of each key, by ``order``."""
    return dedupe_on_key(df.select(*dict.fromkeys([*keys, *order, *columns])), keys, order).select(*keys, *columns)


def check_pk(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Set difference of key values."""
    return wanted.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def salts_of(df: DataFrame, keys, share: float = 0.0005, min_rows: int = 1_000_000, tracked: int = 10_000, parts: int | None = None) -> DataFrame:
    """Hot keys of ``df`` as a table: ``_hash`` of the key and ``_salts``, the parts that it is spread over.

    A key is hot with at least ``share`` of the rows and ``min_rows`` rows; its parts are as large as one of
    ``parts`` even ones. One column-pruned scan with a mergeable frequent-items sketch of bounded size, whose
    result becomes the table in the same job: at most 1/share rows, and nothing comes to the driver. The
    estimate only steers how rows are spread and cannot change a result.
    """
    top = min(int(1.0 / share) + 1, tracked)
    parts = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if parts is None else parts
    counted = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {top}, {tracked})").alias("top")
    )
    each = counted.select("n", F.explode("top").alias("x")).filter(F.col("x.count") >= F.greatest(F.lit(2), F.lit(min_rows), share * F.col("n")))
    salts = F.greatest(F.lit(2), F.ceil(F.col("x.count") / F.col("n") * parts))
    return each.select(F.col("x.item").alias("_hash"), salts.cast("int").alias("_salts"))


def _with_salts(df: DataFrame, keys, salts: DataFrame) -> DataFrame:
    """``df`` with the ``_salts`` of its key, 1 for keys that are not hot."""
    joined = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(salts), "_hash", "left")
    return joined.withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_hash")


def add_salt(left: DataFrame, keys, salts: DataFrame) -> DataFrame:
    """Add ``_salt``, by the row and by its input partition.

    The partition number spreads identical rows, which hash alike; both stay the same
    when a task is run again.
    """
    row = F.xxhash64(*left.columns, F.spark_partition_id())
    salted = _with_salts(left.withColumn("_row", row), keys, salts)
    return salted.withColumn("_salt", F.pmod("_row", F.col("_salts")).cast("int")).drop("_row", "_salts")


def parts_of(n_rows: int, task_rows: int, spark: SparkSession) -> int:
    """Partitions of at most about ``task_rows`` rows, as many as the session has cores at least."""
    return max(spark.sparkContext.defaultParallelism, -(-n_rows // task_rows))


def skew_join(
    left: DataFrame, right: DataFrame, keys, how: str = "inner", salts: DataFrame | None = None, parts: int | None = None
) -> DataFrame:
    """Equi-join of a large skewed ``left`` with a ``right`` that has few rows per key.

    Adaptive execution does not split a skewed join when an aggregation on the same
    key follows it, so hot keys are salted here: their left rows are spread over many
    partitions and their right rows are repeated once per salt. All other keys have one
    salt. ``how`` is inner or left; ``salts`` are those of ``salts_of`` if not given.

    Adaptive execution makes tasks as large as its advisory size of compressed bytes, which can be
    millions of rows. With ``parts`` both sides are put into that many partitions, which it leaves
    as they are, also where ``right`` is broadcast: for joins followed by work that holds its rows.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    if salts is None:
        salts = salts_of(left, keys, parts=None if parts is None else max(64, parts))
    copies = F.explode(F.sequence(F.lit(0), F.col("_salts") - F.lit(1)))
    salted_left = add_salt(left, keys, salts)
    salted_right = _with_salts(right, keys, salts).withColumn("_salt", copies).drop("_salts")
    if parts is not None:
        salted_left, salted_right = (side.repartition(parts, *keys, "_salt") for side in (salted_left, salted_right))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
