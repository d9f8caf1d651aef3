import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mixloom.functions import dates, scalars


def column(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_lgamma_matches_the_library(spark):
    values = [1e-3, 0.05, 0.5, 1.0, 1.34, 2.0, 7.7, 30.0, 500.0, 1e6]
    got = column(spark, values, scalars.lgamma("x"))
    assert np.allclose(got, [math.lgamma(v) for v in values], rtol=1e-12, atol=1e-10)


def test_gauss_series_on_closed_forms(spark):
    z = [0.0, 0.1, 0.5, 0.8]
    # 2F1(a, b; b; z) = (1 - z)^-a and 2F1(1, 1; 2; z) = -ln(1 - z) / z
    power = column(spark, z, scalars.gauss_2f1(F.lit(0.7), F.lit(1.9), F.lit(1.9), F.col("x")))
    assert np.allclose(power, [(1 - v) ** -0.7 for v in z], rtol=1e-12)
    log = column(spark, z[1:], scalars.gauss_2f1(F.lit(1.0), F.lit(1.0), F.lit(2.0), F.col("x")))
    assert np.allclose(log, [-math.log(1 - v) / v for v in z[1:]], rtol=1e-12)


def test_hill_is_half_at_its_scale_and_grows(spark):
    got = column(spark, [0.0, 1.0, 2.0, 4.0], scalars.hill("x", 2.0, 1.0))
    assert got[2] == 0.5 and got == sorted(got) and got[0] == 0.0


def test_clip_keeps_null_and_ratio_avoids_zero(spark):
    assert column(spark, [-1.0, None, 2.0], scalars.clip_lower("x")) == [0.0, None, 2.0]
    assert column(spark, [0.0, 2.0, None], scalars.safe_ratio(F.lit(4.0), F.col("x"))) == [None, 2.0, None]
    assert column(spark, [0.0, 2.0, None], scalars.safe_ratio(F.lit(4.0), F.col("x"), 0.0)) == [0.0, 2.0, 0.0]


def test_quantile_score_is_right_closed_and_shares_ties(spark):
    values = [1.0, 1.0, 2.0, 3.0, 3.0, 9.0, None]
    assert column(spark, values, scalars.quantile_score("x", [1.0, 2.0, 3.0, 9.0])) == [1, 1, 1, 2, 2, 3, None]
    assert column(spark, values, scalars.quantile_score("x", [1.0, 2.0, 3.0, 9.0], True)) == [3, 3, 3, 2, 2, 1, None]


def test_equal_width_score_matches_cut(spark):
    rng = np.random.default_rng(5)
    values = [float(v) for v in np.round(rng.gamma(2.0, 3.0, 200), 1)]
    want = pd.cut(pd.Series(values), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert column(spark, values, scalars.equal_width_score("x", min(values), max(values), 5)) == want
    assert column(spark, [4.0, 4.0], scalars.equal_width_score("x", 4.0, 4.0, 5)) == [3, 3]


def test_histogram_bin_closes_the_last_bin(spark):
    got = column(spark, [0.0, 0.9, 1.0, 9.99, 10.0], scalars.histogram_bin("x", F.lit(0.0), F.lit(10.0), 10))
    assert got == [0, 0, 1, 9, 9]


def test_dates_in_both_layouts(spark):
    values = ["2025-03-09", "09-03-2025", "3/9/2025", None]
    got = column(spark, values, dates.parse_date("x").cast("string"), "string")
    assert got == ["2025-03-09", "2025-03-09", None, None]


def test_day_of_week_and_week_index(spark):
    days = ["2024-01-01", "2024-01-07", "2024-01-08"]
    day = F.col("x").cast("date")
    assert column(spark, days, dates.day_of_week(day), "string") == [1, 7, 1]
    first, same, following = column(spark, days, dates.period_index(day), "string")
    assert first == same and following == first + 1
    with pytest.raises(ValueError):
        dates.period_index(day, "fortnight")
