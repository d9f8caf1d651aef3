import numpy as np
import pytest
from pyspark.sql import functions as F

from mixloom.operators import descriptive, quality


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(10, 3, 500)
    data = {"a": a, "b": 0.5 * a + rng.normal(0, 1, 500), "c": rng.gamma(1.0, 4.0, 500), "d": rng.normal(0, 1, 500)}
    rows = [(i, f"g{i % 3}", *[float(v[i]) for v in data.values()]) for i in range(500)]
    return spark.createDataFrame(rows, "i int, g string, a double, b double, c double, d double"), data


def test_describe_uses_sample_deviation_and_linear_quartiles(sample):
    df, data = sample
    for r in quality.describe(df, ["a", "c"]).collect():
        x = data[r["column_name"]]
        assert r["n"] == 500 and r["std"] == pytest.approx(np.std(x, ddof=1))
        assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.75]))


def test_missing_reports(spark):
    df = spark.createDataFrame([("x", 1.0, None), ("x", None, None), ("y", 2.0, 3.0)], "g string, p double, q double")
    report = {r["column_name"]: (r["n_missing"], r["pct_missing"]) for r in quality.missing_report(df).collect()}
    assert report == {"p": (1, 33.33), "q": (2, 66.67)}
    shares = {(r["g"], r["column_name"]): r["missing_share"] for r in quality.missing_share_by_group(df, "g", ["p", "q"]).collect()}
    assert shares[("x", "q")] == 1.0 and shares[("y", "q")] == 0.0
    with pytest.raises(ValueError):
        quality.require_columns(df, ["absent"])


def test_boxplot_matches_numpy(sample):
    df, data = sample
    row = descriptive.boxplot_stats(df, ["c"]).first()
    q1, q2, q3 = np.quantile(data["c"], [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = data["c"][(data["c"] >= low) & (data["c"] <= high)]
    assert row["n_outliers"] == 500 - len(inside)
    assert row["whisker_high"] == pytest.approx(inside.max()) and row["median"] == pytest.approx(q2)


def test_histogram_counts_every_row(sample):
    df, data = sample
    rows = descriptive.histogram(df, "c", 50).orderBy("bin").collect()
    want, _ = np.histogram(data["c"], 50)
    assert [r["n_rows"] for r in rows] == want.tolist()
    flat = descriptive.histogram(df.withColumn("k", F.lit(2.0)), "k", 4).collect()
    assert sum(r["n_rows"] for r in flat) == 500


def test_lorenz_ends_at_hundred_and_is_concave(sample):
    df, data = sample
    rows = descriptive.lorenz(df, "i", "c", 5).orderBy("customer_rank").collect()
    values = [r["cum_value_pct"] for r in rows]
    assert values[-1] == pytest.approx(100) and rows[-1]["cum_customer_pct"] == 100.0
    assert np.allclose(values, 100 * np.cumsum(np.sort(data["c"])[::-1]) / data["c"].sum())


def test_shares_sum_to_hundred(sample):
    df, _ = sample
    pairs = df.withColumn("h", (F.col("i") % 4).cast("string"))
    sums = descriptive.row_share(pairs, "g", "h").groupBy("g").agg(F.sum("pct").alias("s")).collect()
    assert all(r["s"] == pytest.approx(100) for r in sums)
    assert sum(r["pct"] for r in descriptive.value_counts(df, "g").collect()) == pytest.approx(100)
    table = descriptive.crosstab(pairs, "g", "h", ["0", "1", "2", "3", "9"]).collect()
    assert all(r["9"] == 0 for r in table)


def test_anova_and_its_tail(sample, spark):
    df, data = sample
    row = descriptive.anova_test(df, F.col("g"), "a").first()
    groups = [data["a"][k::3] for k in range(3)]
    grand = data["a"].mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 497
    assert row["f_statistic"] == pytest.approx(between / within, rel=1e-8) and row["df_within"] == 497
    # Closed form of the tail for two numerator degrees of freedom.
    assert row["p_value"] == pytest.approx((1 + 2 * row["f_statistic"] / 497) ** (-497 / 2), rel=1e-9)
    assert descriptive.f_survival(3.0, 2, 10) == pytest.approx((1 + 0.6) ** -5.0, rel=1e-9)
    assert descriptive.f_survival(0.01, 2, 10) == pytest.approx(1.002**-5.0, rel=1e-9)


def test_correlations(sample):
    df, data = sample
    names = ["a", "b", "c", "d"]
    got = {(r["col_a"], r["col_b"]): r["r"] for r in descriptive.corr_matrix(df, names).collect()}
    want = np.corrcoef([data[n] for n in names])
    assert all(got[(x, y)] == pytest.approx(want[i, j]) for i, x in enumerate(names) for j, y in enumerate(names))
    partial = {(r["col_a"], r["col_b"]): r["partial_r"] for r in descriptive.partial_corr_matrix(df, names).collect()}
    controls = np.column_stack([np.ones(500), data["c"], data["d"]])

    def residual(y):
        return y - controls @ np.linalg.lstsq(controls, y, rcond=None)[0]

    assert partial[("a", "b")] == pytest.approx(np.corrcoef(residual(data["a"]), residual(data["b"]))[0, 1], rel=1e-6)
    assert partial[("c", "c")] == 1.0


def test_correlation_uses_complete_pairs_only(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "p double, q double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in descriptive.corr_matrix(df, ["p", "q"]).collect()}
    assert got[("p", "q")] == pytest.approx(1.0)


def test_trim_and_top(sample):
    df, data = sample
    kept = descriptive.quantile_trim(df, "c", 0.99).count()
    assert kept == (data["c"] <= np.quantile(data["c"], 0.99)).sum()
    top = descriptive.top_n_per_group(df.withColumn("h", F.col("i") % 10), "g", "h", 3)
    assert top.groupBy("g").count().filter("count != 3").count() == 0


def test_lorenz_takes_totals_that_differ_by_the_order_of_addition_as_ties(spark):
    totals = [(1, 0.3 + 0.2 + 0.1), (2, 0.1 + 0.2 + 0.3), (3, 9.0)]
    assert totals[0][1] < totals[1][1]
    rows = descriptive.lorenz(spark.createDataFrame(totals, "k int, v double"), "k", "v", 2, digits=6)
    assert [r["k"] for r in rows.orderBy("customer_rank").collect()] == [3, 1, 2]
