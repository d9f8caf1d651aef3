import pytest
from pyspark.sql import functions as F

from mixloom.operators import keys


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_keeps_the_first_by_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "z"), (1, 4, "a"), (2, 9, None)], "k int, o int, v string")
    assert rows(keys.dedupe_on_key(df, ["k"], ["o"])) == [(1, 4, "a"), (2, 9, None)]
    assert rows(keys.dedupe_on_key(df.select("k"), ["k"], ["k"])) == [(1,), (2,)]
    assert rows(keys.first_row_per_key(df, ["k"], ["o"], ["v"])) == [(1, "a"), (2, None)]


def test_key_checks(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None)], "id int, parent string")
    parent = spark.createDataFrame([("a",), ("b",)], "name string")
    assert rows(keys.check_pk(child, ["id"])) == [(1, 2)]
    assert [r["id"] for r in keys.check_fk(child, parent, "parent", "name").collect()] == [2]
    wanted = spark.createDataFrame([("a",), ("x",)], "name string")
    assert rows(keys.missing_keys(wanted, parent, "name")) == [("x",)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows, many of them copies, on one key; some keys without a match."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    left = spark.range(6000).select(key.alias("k"), (F.col("id") % 11).alias("v"))
    right = spark.range(450).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return left, right


def hash_of(spark, value):
    return spark.range(1).select(F.xxhash64(F.lit(value).cast("long"))).first()[0]


def table(salts):
    return {r["_hash"]: r["_salts"] for r in salts.collect()}


def test_hot_keys_are_found(spark, skewed):
    left, _ = skewed
    found = table(keys.salts_of(left, ["k"], share=0.05, min_rows=0, parts=300))
    assert list(found) == [hash_of(spark, 7)] and found[hash_of(spark, 7)] == pytest.approx(100, abs=3)
    assert table(keys.salts_of(spark.range(1000).withColumnRenamed("id", "k"), ["k"], share=0.05, min_rows=0)) == {}
    # A key of two thousand rows is no burden for one task.
    assert table(keys.salts_of(left, ["k"])) == {}
    assert table(keys.salts_of(left.limit(0), ["k"])) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(skewed, how):
    left, right = skewed
    joined = keys.skew_join(left, right, ["k"], how, keys.salts_of(left, ["k"], share=0.05, min_rows=0))
    assert rows(joined.select("k", "v", "w").fillna(-1)) == rows(
        left.join(right, "k", how).select("k", "v", "w").fillna(-1)
    )
    assert rows(keys.skew_join(left, right, ["k"], how).select("k", "v", "w").fillna(-1)) == rows(
        left.join(right, "k", how).select("k", "v", "w").fillna(-1)
    )
    with pytest.raises(ValueError):
        keys.skew_join(left, right, ["k"], "full")


def test_salts_spread_hot_rows_and_their_copies(spark, skewed):
    left, _ = skewed
    salts = keys.salts_of(left, ["k"], share=0.05, min_rows=0)
    spread = keys.add_salt(left.repartition(8), ["k"], salts).groupBy("k").agg(F.count_distinct("_salt").alias("n"))
    counts = {r["k"]: r["n"] for r in spread.collect()}
    assert counts.pop(7) > 8 and set(counts.values()) == {1}
    copies = spark.range(800, numPartitions=8).select(F.lit(7).cast("long").alias("k"))
    given = spark.createDataFrame([(hash_of(spark, 7), 64)], "_hash long, _salts int")
    # Hashes of eight partition numbers; two may meet.
    assert keys.add_salt(copies, ["k"], given).select("_salt").distinct().count() >= 6


def test_a_key_with_half_the_rows_is_spread_at_the_default_settings(spark):
    n = 2_400_000
    key = F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id"))
    left = spark.range(n).select(key.alias("k"), F.col("id").alias("v"))
    right = spark.range(0, n, 3).select(F.col("id").alias("k"), F.lit(1).alias("w")).union(spark.createDataFrame([(5, 1)], "k long, w int"))
    salted = keys.add_salt(left, ["k"], keys.salts_of(left, ["k"])).filter("k = 5").groupBy("_salt").count().collect()
    assert len(salted) >= 32 and max(r["count"] for r in salted) < n / 2 / 16
    got, want = (
        j.agg(F.count(F.lit(1)), F.sum("v"), F.sum("w")).first() for j in (keys.skew_join(left, right, ["k"]), left.join(right, "k"))
    )
    assert got == want and got[0] > n / 2


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_parts_bound_the_rows_of_a_task(spark, broadcast):
    left = spark.range(40_000).select((F.col("id") % 20_000).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert keys.parts_of(40_000, 1000, spark) == 40 and keys.parts_of(0, 1000, spark) == spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for how in ("inner", "left"):
            joined = keys.skew_join(left, right, ["k"], how, parts=keys.parts_of(40_000, 1000, spark))
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert max(sizes) < 2000 and sum(sizes) == (20_000 if how == "inner" else 40_000)
            assert rows(joined.select("k", "v", "w").fillna(-1)) == rows(left.join(right, "k", how).select("k", "v", "w").fillna(-1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
