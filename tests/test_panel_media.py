import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixloom.operators import media as media_ops
from mixloom.operators import panel as panel_ops

D = dt.date
DAY = [D(2024, 1, d) for d in range(1, 9)]


def raw(spark, rows):
    """geo, day, price, discount, clicks, spend"""
    schema = (
        "TERRITORY_NAME string, DATE_DAY date, ALL_PURCHASES_ORIGINAL_PRICE double, ALL_PURCHASES_GROSS_DISCOUNT double, "
        "AD_CLICKS double, AD_SPEND double"
    )
    return spark.createDataFrame(rows, schema)


def test_channel_roles_and_pairs(spark):
    df = spark.createDataFrame([(1.0,) * 5], "A_SPEND double, A_CLICKS double, B_SPEND double, C_CLICKS double, B_IMPRESSIONS double")
    roles = panel_ops.media_channels(df)
    assert roles["channels"] == ["A", "B"] and roles["clicks_cols"] == ["A_CLICKS", "C_CLICKS"]
    assert panel_ops.paired_channels(df) == ["A"]


def test_sparse_channel_goes_without_its_namesakes(spark):
    """META is sparse in one territory only; META2 shares the prefix and stays."""
    rows = [("x", 1.0, 5.0, 1.0, None), ("x", 1.0, 5.0, 1.0, 2.0), ("y", None, None, 1.0, 3.0), ("y", None, 4.0, 1.0, None)]
    df = spark.createDataFrame(rows, "TERRITORY_NAME string, META_SPEND double, META_CLICKS double, META2_CLICKS double, META2_SPEND double")
    kept = panel_ops.drop_sparse_channels(df)
    assert kept.columns == ["TERRITORY_NAME", "META2_CLICKS", "META2_SPEND"]
    assert kept.filter("META2_SPEND IS NULL").count() == 0


def test_organisation_ranking(spark):
    rows = [
        ("o1", "t", D(2024, 1, 1), 1.0, None),
        ("o1", "t", D(2024, 1, 9), 1.0, None),
        ("o2", "t", D(2024, 1, 1), 1.0, 1.0),
        ("o2", "All Territories", D(2024, 6, 1), 1.0, 1.0),
        ("o3", "t", D(2024, 1, 1), 1.0, 1.0),
        ("o3", "t", D(2024, 1, 2), None, 1.0),
    ]
    df = spark.createDataFrame(rows, "ORGANISATION_ID string, TERRITORY_NAME string, DATE_DAY date, A_SPEND double, B_SPEND double")
    ranking = {r["ORGANISATION_ID"]: (r["active_channels"], r["date_range_days"]) for r in panel_ops.org_ranking(df).collect()}
    assert ranking == {"o1": (1, 8), "o2": (2, 0), "o3": (2, 1)}
    assert panel_ops.best_organisation(df).first()["ORGANISATION_ID"] == "o3"
    assert panel_ops.select_firm(df, "o2").count() == 1


def test_prepared_panel(spark):
    rows = [("b", DAY[1], 10.0, 2.0, None, None), ("a", DAY[0], 0.0, 0.0, 3.0, 1.0), ("a", DAY[1], 0.0, 4.0, 1.0, 1.0)]
    out = {(r["GEO"], r["DATE_DAY"]): r for r in panel_ops.prepare_panel(raw(spark, rows)).collect()}
    assert out[("b", DAY[1])]["DISCOUNT_RATE"] == 0.2 and out[("b", DAY[1])]["AD_SPEND"] == 0.0
    # Neither 0/0 nor x/0 leaves a number that is not finite.
    assert out[("a", DAY[0])]["DISCOUNT_RATE"] == 0.0 and out[("a", DAY[1])]["DISCOUNT_RATE"] == 0.0
    assert [out[k]["TREND"] for k in sorted(out)] == [0, 1, 1]
    assert out[("a", DAY[0])]["DAY_OF_WEEK"] == 1


def random_panel(spark, seed=6):
    rng = np.random.default_rng(seed)
    rows = []
    for geo in "abc":
        for day in DAY:
            if rng.random() < 0.85:
                price = 0.0 if rng.random() < 0.1 else float(rng.integers(1, 50))
                rows.append((geo, day, price, 0.0, float(rng.integers(0, 9)), 1.0))
    return panel_ops.prepare_panel(raw(spark, rows))


def test_alignment_equals_the_having_form(spark):
    panel = random_panel(spark)
    left = {tuple(r) for r in panel_ops.align_geo_dates(panel).select("GEO", "DATE_DAY", "NET_REVENUE", "TREND").collect()}
    right = {tuple(r) for r in panel_ops.complete_days(panel).select("GEO", "DATE_DAY", "NET_REVENUE", "TREND").collect()}
    assert left == right and 0 < len(left) < 24
    counts = {r["n_rows"] for r in panel_ops.rows_per_geo(panel_ops.align_geo_dates(panel)).collect()}
    assert len(counts) == 1
    assert panel_ops.densify(panel).count() == 24


def test_split_by_day_keeps_days_whole(spark):
    panel = random_panel(spark)
    split = panel_ops.temporal_split(panel)
    assert split.groupBy("DATE_DAY").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert split.filter("split = 'train'").select("DATE_DAY").distinct().count() == 6
    by_rows = panel_ops.temporal_split_rows(panel)
    assert by_rows.filter("split = 'train'").count() == math.floor(0.75 * panel.count())
    mask = panel_ops.holdout_mask(panel)
    assert mask.count() == 24 and mask.filter("is_holdout").count() == 6
    index = [r["TREND"] for r in panel_ops.trend_row_index(panel.drop("TREND")).orderBy("DATE_DAY", "GEO").collect()]
    assert index == list(range(panel.count()))


def test_empirical_roi_and_prior(spark):
    rows = [("a", DAY[0], 10.0, 2.0, 1.0, 4.0), ("b", DAY[0], 6.0, 0.0, 1.0, 1.0), ("c", DAY[0], 6.0, 0.0, 1.0, None)]
    roi = panel_ops.empirical_roi(panel_ops.prepare_panel(raw(spark, rows)))
    got = {r["geo"]: r["roi"] for r in roi.collect()}
    assert got == {"a": 2.0, "b": 6.0, "c": None, "ALL": 4.0}
    prior = panel_ops.roi_prior(roi).first()
    assert prior["mu"] == pytest.approx(math.log(4.0)) and prior["sigma"] == 0.5


# ---------------------------------------------------------------- media response


@pytest.fixture(scope="module")
def media(spark):
    rng = np.random.default_rng(9)
    rows = [
        (g, D(2024, 1, 1) + dt.timedelta(days=i), c, float(rng.integers(0, 20)), float(rng.random() * 5))
        for g in ("a", "b")
        for c in ("X", "Y")
        for i in range(30)
    ]
    df = spark.createDataFrame(rows, "geo string, day date, channel string, media double, spend double")
    return media_ops.scale_media(df, ["X", "Y"]).cache()


@pytest.fixture(scope="module")
def draws(spark):
    rng = np.random.default_rng(10)
    rows = [
        (d, g, c, float(rng.gamma(5.0)), 0.3 + 0.2 * (d % 3), 1.0, 1.0) for d in range(12) for g in ("a", "b") for c in ("X", "Y")
    ]
    return spark.createDataFrame(rows, "draw int, geo string, channel string, beta double, alpha double, ec double, slope double")


def brute(media, draws):
    """draw, geo, day, channel -> contribution, by loops."""
    series = {}
    for r in media.orderBy("day").collect():
        series.setdefault((r["geo"], r["channel"]), []).append((r["day"], r["scaled"]))
    out = {}
    for d in draws.collect():
        points = series[(d["geo"], d["channel"])]
        for i, (day, _) in enumerate(points):
            w = [d["alpha"] ** k for k in range(9)]
            level = sum(w[k] * (points[i - k][1] if i >= k else 0.0) for k in range(9)) / sum(w)
            out[(d["draw"], d["geo"], day, d["channel"])] = d["beta"] * level / (level + d["ec"])
    return out


def test_scaling_by_the_median_of_active_days(media):
    for c in ("X", "Y"):
        rows = media.filter(F.col("channel") == c).collect()
        unit = np.median([r["media"] for r in rows if r["media"] > 0])
        assert all(r["scaled"] == pytest.approx(r["media"] / unit) for r in rows)


def test_adstock_of_a_constant_is_the_constant(spark):
    df = spark.range(30).select(
        F.lit("a").alias("geo"), F.lit("X").alias("channel"), F.col("id").alias("day"), F.lit(3.0).alias("scaled")
    )
    setting = spark.createDataFrame([("X", 0.6, 1.0, 1.0)], "channel string, alpha double, ec double, slope double")
    out = media_ops.carry_over(df, setting).filter("day >= 8").select("adstocked").distinct().collect()
    assert all(r[0] == pytest.approx(3.0) for r in out)


def lags_by_loop(points, max_lag):
    """Sum per day of the days before; points are (day, value)."""
    at = {}
    for day, x in points:
        at[day] = at.get(day, 0.0) + x
    return sorted((day, [x, *[at.get(day - k, 0.0) for k in range(1, max_lag + 1)]]) for day, x in points)


@pytest.mark.parametrize("stretch", [1, 3, 8, 1024])
def test_stretches_do_not_change_the_lags(spark, stretch):
    # With gaps, a repeated day, days before zero and an empty series end.
    points = [(d, float(d * d % 7)) for d in range(-20, 40) if d % 11 not in (3, 4)] + [(5, 0.5)]
    df = spark.createDataFrame([("a", "X", d, x) for d, x in points] + [("b", "X", 1, None), ("b", "X", None, 2.0)], "geo string, channel string, day int, scaled double")
    out = media_ops.with_lags(df, max_lag=5, stretch=stretch).collect()
    assert sorted((r["day"], r["_lags"]) for r in out if r["geo"] == "a") == lags_by_loop(points, 5)
    assert sorted(r["_lags"][0] for r in out if r["geo"] == "b") == [0.0, 2.0]
    assert all(r["_lags"][1:] == [0.0] * 5 for r in out if r["geo"] == "b")


def test_lags_by_date_and_in_steps(spark):
    dates = spark.sql("select 'a' geo, 'X' channel, date_add(date'2024-01-01', cast(id * 7 as int)) day, cast(id as double) scaled from range(20)")
    for df in (dates, dates.withColumn("day", F.col("day").cast("timestamp"))):
        out = {r["scaled"]: r["_lags"] for r in media_ops.with_lags(df, max_lag=2, step=7, stretch=4).collect()}
        assert out == {float(i): [float(i), float(max(i - 1, 0)), float(max(i - 2, 0))] for i in range(20)}


def test_one_long_series_runs_in_many_tasks(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("a").alias("geo"), F.lit("X").alias("channel"), F.col("id").alias("day"), F.col("id").cast("double").alias("scaled"))
    out = media_ops.with_lags(df).select("day", "_lags", F.spark_partition_id().alias("task"))
    wrong = F.exists(F.transform("_lags", lambda x, k: x != F.greatest(F.col("day") - k, F.lit(0))), lambda w: w)
    row = out.agg(F.count(F.lit(1)).alias("n"), F.sum(wrong.cast("int")).alias("wrong"), F.count_distinct("task").alias("tasks")).first()
    assert (row["n"], row["wrong"]) == (n, 0) and row["tasks"] > 1


def test_contributions_match_loops(media, draws):
    want = brute(media, draws)
    got = media_ops.contributions(draws, media).collect()
    assert len(got) == len(want)
    assert all(r["contribution"] == pytest.approx(want[(r["draw"], r["geo"], r["day"], r["channel"])]) for r in got)


def test_returns_and_intervals(media, draws):
    want = brute(media, draws)
    spend = {r["channel"]: r["spend_total"] for r in media_ops.channel_spend(media).collect()}
    for r in media_ops.return_table(draws, media, "roi").collect():
        totals = [sum(v for k, v in want.items() if k[0] == d and k[3] == r["channel"]) / spend[r["channel"]] for d in range(12)]
        assert [r["roi_low"], r["roi_median"], r["roi_high"]] == pytest.approx(np.quantile(totals, [0.025, 0.5, 0.975]))
    roi = {r["channel"]: r["roi_median"] for r in media_ops.return_table(draws, media, "roi").collect()}
    mroi = {r["channel"]: r["mroi_median"] for r in media_ops.return_table(draws, media, "mroi").collect()}
    # Saturation makes the next unit worth less than the average one.
    assert all(0 < mroi[c] < roi[c] for c in roi)
    with pytest.raises(ValueError):
        media_ops.return_table(draws, media, "cost")


def test_outcome_parts_add_up(spark, media, draws):
    intercepts = draws.select("draw", "geo").distinct().withColumn("intercept", F.lit(5.0))
    expected = media_ops.expected_outcome(media_ops.contributions(draws, media), intercepts)
    assert expected.filter(F.abs(F.col("expected") - F.col("media_total") - 5.0) > 1e-9).count() == 0
    medians = media_ops.outcome_medians(expected)
    assert medians.filter(F.abs(F.col("baseline_median") - 5.0) > 1e-9).count() == 0


def test_dependence_is_scaled_to_unit_range(media, draws):
    medians = media_ops.contribution_intervals(media_ops.contributions(draws, media))
    row = media_ops.dependence(medians, media).agg(F.min("scaled_contribution"), F.max("scaled_contribution")).first()
    assert row[0] == 0.0 and row[1] == pytest.approx(1.0)
    table = media_ops.credible_interval_table(medians).collect()
    assert all(r["ci_low"] <= r["median"] <= r["ci_high"] and r["ci_width"] >= 0 for r in table)


def test_scenarios(media, draws):
    same = media_ops.what_if(draws, media, {}, "same", ["X", "Y"]).first()
    assert same["delta_abs"] == 0.0 and same["mult_X"] == 1.0
    more = media_ops.what_if(draws, media, {"X": 2.0}, "more", ["X", "Y"]).first()
    assert more["delta_abs"] > 0 and (more["mult_X"], more["mult_Y"]) == (2.0, 1.0)
    scaled = media_ops.apply_multipliers(media, {"X": 2.0})
    rebuilt = media_ops.what_if(draws, scaled, {}, "rebuilt", ["X", "Y"]).first()
    assert rebuilt["scenario_median"] == pytest.approx(more["scenario_median"])
    with pytest.raises(ValueError):
        media_ops.what_if(draws, media, {"Z": 2.0}, "bad", ["X", "Y"])


def test_response_curve_is_concave_and_passes_through_today(media, draws):
    grid = [0.5, 1.0, 1.5, 2.0]
    rows = media_ops.response_curve(draws, media, grid).orderBy("channel", "multiplier").collect()
    for c in ("X", "Y"):
        means = [r["mean"] for r in rows if r["channel"] == c]
        steps = np.diff(means)
        assert all(steps > 0) and all(np.diff(steps) < 0)
    base = media_ops.what_if(draws, media, {}, "same", ["X", "Y"]).first()["baseline_median"]
    at_one = [r for r in rows if r["multiplier"] == 1.0]
    assert sum(r["low"] for r in at_one) <= base <= sum(r["high"] for r in at_one)
