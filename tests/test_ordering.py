import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mixloom.operators import ordering

PROBS = [0.0, 0.2, 0.25, 0.5, 0.8, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) if v is not None else (None,) for v in values], "v double")


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    columns = {
        "spread": rng.normal(0, 1e4, 3000),
        # A third of the rows on one value, which is also a quantile edge.
        "hot": np.where(rng.random(3000) < 0.34, 7.0, np.round(rng.gamma(1.0, 10.0, 3000), 1)),
        "constant": np.full(3000, 4.0),
    }
    names = list(columns)
    df = spark.createDataFrame([tuple(float(x) for x in r) for r in zip(*columns.values())], names)
    got = ordering.exact_quantiles(df, names, PROBS)
    for name in names:
        assert np.allclose(got[name], np.quantile(columns[name], PROBS), rtol=1e-14, atol=1e-12), name


ODD = [0.0, -0.0, 5e-324, 2.0**-1074 * 7, 2.0**-1022, 1.5 * 2.0**-1022, 1.7976931348623157e308, float("inf"), 1.0, 2.0, 0.1, 0.3, 3.0, 1e300, 2.0**52 + 1, 123456789.125]


def test_image_orders_like_the_double(spark):
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    values = np.concatenate([bits.view(np.float64), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1021, 1023), 0), ODD])
    values = values[~np.isnan(values)]
    values = np.concatenate([values, -values])
    rows = frame(spark, values).select("v", ordering.ordered_image(F.col("v")).alias("i")).collect()
    assert [r for r in rows if ordering.image_value(r["i"]) != r["v"]] == []
    assert [r["v"] for r in sorted(rows, key=lambda r: r["i"])] == sorted(r["v"] for r in rows)
    nan = frame(spark, [float("nan")]).select(ordering.ordered_image(F.col("v"))).first()[0]
    assert np.isnan(ordering.image_value(nan)) and nan > max(r["i"] for r in rows)


def test_quantiles_of_values_that_share_their_leading_bits(spark):
    """All four passes are needed; half of the rows have one value."""
    rng = np.random.default_rng(2)
    values = np.concatenate([1.0 + rng.integers(0, 1 << 20, 900) * 2.0**-52, np.full(900, 1.0 + 2.0**-40), -rng.exponential(5.0, 300)])
    got = ordering.exact_quantiles(frame(spark, values), ["v"], PROBS)["v"]
    assert np.allclose(got, np.quantile(values, PROBS), rtol=5e-16, atol=0)


def test_quantiles_take_four_small_jobs(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(0, 1, (500, 6))], [f"c{i}" for i in range(6)])
    tracker, group = spark.sparkContext.statusTracker(), "quantile-jobs"
    spark.sparkContext.setJobGroup(group, "")
    ordering.exact_quantiles(df, df.columns, PROBS)
    # Adaptive execution runs the map side of an aggregate as a job of its own.
    assert len(tracker.getJobIdsForGroup(group)) <= 8
    spark.sparkContext.setJobGroup("", "")


def test_quantiles_skip_nulls_and_allow_empty(spark):
    assert ordering.exact_quantiles(frame(spark, [None, 1.0, 3.0]), ["v"], [0.5])["v"] == [2.0]
    assert ordering.exact_quantiles(frame(spark, [None]), ["v"], [0.5])["v"] == [None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=12, max_size=60))
def test_quantile_property(spark, values):
    got = ordering.exact_quantiles(frame(spark, values), ["v"], [0.2, 0.5, 0.8])["v"]
    assert np.allclose(got, np.quantile(np.array(values, dtype=float), [0.2, 0.5, 0.8]))


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_running_totals_match_a_plain_cumulative_sum(spark, buckets):
    rng = np.random.default_rng(3)
    # A third of the rows tie on the leading column.
    lead = np.where(rng.random(2000) < 0.34, 0.0, rng.integers(-50, 50, 2000)).astype(float)
    rows = [(float(a), i, int(i % 7)) for i, a in enumerate(lead)]
    df = spark.createDataFrame(rows, "a double, k long, w long")
    out = ordering.running_totals(df, ["a", "k"], {"total": "w"}, buckets).orderBy("a", "k").collect()
    want = np.cumsum([r[2] for r in sorted(rows)])
    assert [r["total"] for r in out] == want.tolist()


def test_ranges_follow_the_order_and_split_ties(spark):
    df = spark.range(4000).select(F.lit(1.0).alias("a"), F.col("id").alias("k"))
    ranged = ordering.order_ranges(df, ["a", "k"], 8)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 3
    bounds = ranged.groupBy("_range").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("_range").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(bounds, bounds[1:]))


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "a double, w long")
    assert ordering.running_totals(df, ["a"], {"total": "w"}).count() == 0


def test_digits_are_summed_up_where_the_rows_are_read(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ordering, "GATHERED", 50)
    values = [None, -0.0, 0.0, float("nan"), float("inf"), -float("inf"), -5e-324, *(float(i % 40) for i in range(1000))]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + 30], pa.float64())], names=["v0"]) for i in range(0, len(values), 30)]
    found = pa.Table.from_batches(list(ordering._count_digits({0: None}, 48)(iter(batches)))).to_pylist()
    images = [r["i"] for r in frame(spark, values).select(ordering.ordered_image(F.col("v")).alias("i")).collect() if r["i"] is not None]
    wanted = {}
    for i in images:
        wanted.setdefault(i >> 48, []).append(i)
    assert {r["lead"]: (r["n"], r["low"], r["high"]) for r in found} == {k: (len(v), min(v), max(v)) for k, v in wanted.items()}
    # One row per digit of the partition, not one per value.
    assert len(found) == len(wanted)
