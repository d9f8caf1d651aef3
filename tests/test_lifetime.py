import datetime as dt
import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixloom.operators import lifetime as life

D = dt.date
MODEL = life.BgNbd(r=0.9, alpha=8.0, a=0.7, b=2.4)
SPEND = life.GammaGamma(p=3.0, q=4.0, v=20.0)


@pytest.fixture(scope="module")
def population():
    """Customers drawn from the model: buying at a gamma rate, leaving after each purchase with a beta chance."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(4000):
        rate, leave, age = rng.gamma(MODEL.r, 1 / MODEL.alpha), rng.beta(MODEL.a, MODEL.b), int(rng.integers(30, 90))
        t, x, last, later, alive = 0.0, 0, 0.0, 0, True
        while alive:
            t += rng.exponential(1 / rate)
            if t > age + 26:
                break
            if t <= age:
                x, last = x + 1, t
            else:
                later += 1
            alive = rng.random() >= leave
        mean = rng.gamma(SPEND.p * x, 1.0) / x * SPEND.v / rng.gamma(SPEND.q, 1.0) if x else 0.0
        rows.append((i, x, float(last), float(age), float(mean), later))
    return rows


@pytest.fixture(scope="module")
def summary(spark, population):
    return spark.createDataFrame(
        population, "customer_id int, frequency long, recency double, T double, monetary_value double, later long"
    )


def test_summary_counts_a_week_once(spark):
    rows = [
        (1, D(2024, 1, 1), 10.0),
        (1, D(2024, 1, 3), 5.0),
        (1, D(2024, 1, 15), 20.0),
        (1, D(2024, 1, 29), 40.0),
        (2, D(2024, 1, 9), 7.0),
    ]
    tx = spark.createDataFrame(rows, "c int, d date, v double")
    got = {r["c"]: r for r in life.btyd_summary(tx, "c", "d", "v", F.lit(D(2024, 2, 6))).collect()}
    assert (got[1]["frequency"], got[1]["recency"], got[1]["T"], got[1]["monetary_value"]) == (2, 4, 5, 30.0)
    assert (got[2]["frequency"], got[2]["recency"], got[2]["T"], got[2]["monetary_value"]) == (0, 0, 4, 0.0)


def test_holdout_counts_weeks_after_the_calibration(spark):
    rows = [(1, D(2024, 1, 1), 1.0), (1, D(2024, 2, 5), 1.0), (1, D(2024, 2, 6), 1.0), (1, D(2024, 2, 20), 1.0)]
    rows += [(2, D(2024, 1, 2), 1.0), (3, D(2024, 2, 7), 1.0)]
    tx = spark.createDataFrame(rows, "c int, d date, v double")
    got = life.calibration_holdout(tx, "c", "d", "v", "2024-01-31", F.lit(D(2024, 2, 26)))
    out = {r["c"]: (r["frequency_cal"], r["frequency_holdout"], r["duration_holdout"]) for r in got.collect()}
    # Customer 3 buys only in the holdout and is left out.
    assert out == {1: (0, 2, 4), 2: (0, 0, 4)}


def loglik(m, x, tx, age):
    a1 = math.lgamma(m.r + x) - math.lgamma(m.r) + m.r * math.log(m.alpha)
    beta = math.lgamma(m.a + m.b) - math.lgamma(m.b) + math.lgamma(m.b + x) - math.lgamma(m.a + m.b + x)
    alive = (m.alpha + age) ** -(m.r + x)
    gone = m.a / (m.b + x - 1) * (m.alpha + tx) ** -(m.r + x) if x > 0 else 0.0
    return a1 + beta + math.log(alive + gone)


def test_log_likelihood(summary, population):
    want = sum(loglik(MODEL, x, tx, age) for _, x, tx, age, _, _ in population)
    assert life.bgnbd_loglik(summary, MODEL).first()[0] == pytest.approx(want, rel=1e-10)


def test_fit_recovers_the_model(summary):
    fitted = life.bgnbd_fit(summary, penalty=0.0)
    best = life.bgnbd_loglik(summary, fitted).first()[0]
    assert best >= life.bgnbd_loglik(summary, MODEL).first()[0]
    assert fitted.r == pytest.approx(MODEL.r, rel=0.2) and fitted.alpha == pytest.approx(MODEL.alpha, rel=0.2)
    assert fitted.a / (fitted.a + fitted.b) == pytest.approx(MODEL.a / (MODEL.a + MODEL.b), rel=0.2)
    for change in (0.97, 1.03):
        for name in ("r", "alpha", "a", "b"):
            values = {n: getattr(fitted, n) * (change if n == name else 1.0) for n in ("r", "alpha", "a", "b")}
            assert life.bgnbd_loglik(summary, life.BgNbd(**values)).first()[0] < best + 1e-3


def test_gamma_gamma_fit_recovers_the_mean(summary):
    fitted = life.gamma_gamma_fit(summary, penalty=0.0)
    mean = fitted.p * fitted.v / (fitted.q - 1)
    assert mean == pytest.approx(SPEND.p * SPEND.v / (SPEND.q - 1), rel=0.1)
    assert life.gamma_gamma_loglik(summary, fitted).first()[0] >= life.gamma_gamma_loglik(summary, SPEND).first()[0]


def test_expected_purchases_agree_with_the_simulation(summary, population):
    predicted = life.bgnbd_expected_purchases(summary, MODEL, 26.0)
    got = predicted.groupBy((F.col("frequency") > 1).alias("g")).agg(
        F.avg("expected_purchases").alias("e"), F.avg("later").alias("y")
    )
    for r in got.collect():
        assert r["e"] == pytest.approx(r["y"], rel=0.12)
    zero = life.bgnbd_expected_purchases(summary, MODEL, 0.0).agg(F.max(F.abs("expected_purchases"))).first()[0]
    assert zero == pytest.approx(0.0, abs=1e-12)
    assert life.holdout_evaluation(
        summary.withColumnsRenamed({"frequency": "frequency_cal", "recency": "recency_cal", "T": "T_cal"})
        .withColumn("frequency_holdout", F.col("later"))
        .withColumn("duration_holdout", F.lit(26.0)),
        MODEL,
    ).first()["r2"] > 0.2


def test_expected_purchases_match_the_published_form(summary, population):
    """The un-transformed series, summed term by term."""

    def published(x, tx, age, t, m=MODEL):
        z, term, total = t / (m.alpha + age + t), 1.0, 1.0
        p, q, c = m.r + x, m.b + x, m.a + m.b + x - 1
        for n in range(4000):
            term *= (p + n) * (q + n) / ((c + n) * (n + 1)) * z
            total += term
        top = c / (m.a - 1) * (1 - ((m.alpha + age) / (m.alpha + age + t)) ** p * total)
        odds = m.a / (m.b + x - 1) * ((m.alpha + age) / (m.alpha + tx)) ** p if x > 0 else 0.0
        return top / (1 + odds)

    got = {r["customer_id"]: r["expected_purchases"] for r in life.bgnbd_expected_purchases(summary, MODEL, 40.0).collect()}
    for i, x, tx, age, _, _ in population[:60]:
        assert got[i] == pytest.approx(published(x, tx, age, 40.0), rel=1e-9)


def test_alive_probability(summary):
    row = life.bgnbd_p_alive(summary, MODEL).agg(F.min("p_alive"), F.max("p_alive")).first()
    assert 0 < row[0] <= row[1] <= 1
    fresh = life.bgnbd_p_alive(summary.filter("frequency = 0"), MODEL).select("p_alive").distinct().collect()
    assert [r[0] for r in fresh] == [1.0]


def test_value_discounts_period_by_period(summary):
    few = summary.limit(25)
    got = {r["customer_id"]: r["predicted_clv"] for r in life.predicted_clv(few, MODEL, SPEND, 3, 4.0, 0.02).collect()}
    want, before = {}, None
    for k in range(0, 4):
        step = life.bgnbd_expected_purchases(few, MODEL, 4.0 * k)
        now = {r["customer_id"]: r["expected_purchases"] for r in step.collect()}
        for c, v in now.items():
            want[c] = want.get(c, 0.0) + ((v - before[c]) / 1.02**k if before else 0.0)
        before = now
    worth = {r["customer_id"]: r["expected_value"] for r in life.gg_expected_value(few, SPEND).collect()}
    assert all(got[c] == pytest.approx(worth[c] * want[c], rel=1e-9) for c in got)


def test_shrunken_value_lies_between_customer_and_population(summary):
    population_mean = SPEND.v * SPEND.p / (SPEND.q - 1)
    for r in life.gg_expected_value(summary.limit(200), SPEND).collect():
        low, high = sorted((population_mean, r["monetary_value"])) if r["frequency"] else (population_mean,) * 2
        assert low - 1e-9 <= r["expected_value"] <= high + 1e-9


def test_regression_metrics_exclude_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, None), (None, 1.0)], "y double, p double")
    row = life.regression_metrics(df, "y", "p").first()
    assert (row["n"], row["n_excluded"]) == (2, 2)
    assert row["rmse"] == pytest.approx(math.sqrt(0.5)) and row["mae"] == 0.5 and row["r2"] == pytest.approx(0.5)


def test_gamma_derivatives(spark):
    xs = [0.01, 0.3, 1.0, 2.5, 17.0, 400.0]
    from mixloom.functions.scalars import digamma, trigamma

    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", digamma("x").alias("d"), trigamma("x").alias("t"))
    for r in df.collect():
        # By the recurrence up to 10^6, where log(y) - 1/2y and 1/y + 1/2y^2 are exact to the last digits.
        n = 1_000_000
        k = np.arange(n) + r["x"]
        y = r["x"] + n
        assert r["d"] == pytest.approx(math.log(y) - 0.5 / y - (1 / k).sum(), abs=1e-9)
        assert r["t"] == pytest.approx(1 / y + 0.5 / y**2 + (1 / k**2).sum(), rel=1e-10)
        assert life.psi(r["x"]) == pytest.approx(r["d"], rel=1e-12, abs=1e-12) and life.psi_prime(r["x"]) == pytest.approx(r["t"], rel=1e-12)


def sums(rows, terms, theta):
    data = rows.crossJoin(rows.sparkSession.createDataFrame([tuple(theta)], ", ".join(f"_p{i} double" for i in range(len(theta)))))
    stages = terms([F.col(f"_p{i}") for i in range(len(theta))])
    for helpers in stages[:-1]:
        data = data.select("*", *helpers)
    return np.array(data.agg(*[F.sum(F.col("w") * c) for c in stages[-1]]).first())


@pytest.mark.parametrize(
    ("terms", "constant", "theta", "columns"),
    [
        (life._bgnbd_terms, life._bgnbd_constant_terms, (0.9, 8.0, 0.7, 2.4), ("frequency as x", "recency as tx", "T as age", "1.0 as w")),
        (life._gg_terms, life._gg_constant_terms, (3.0, 4.0, 20.0), ("frequency as x", "monetary_value as m", "2.0 as w")),
    ],
)
def test_derivatives_are_those_of_the_likelihood(summary, terms, constant, theta, columns):
    """Value, gradient and Hessian in one row against differences of the row above them."""
    rows = life.repeat_buyers(summary).limit(200).unionByName(summary.filter("frequency = 0").limit(50 if "tx" in str(columns) else 0))
    rows = rows.selectExpr(*columns)
    k = len(theta)
    here = sums(rows, terms, theta)
    value, gradient, hessian = constant(*theta)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    for i in range(k):
        h = 1e-5 * theta[i]
        up, down = ([t + s * h * (n == i) for n, t in enumerate(theta)] for s in (1, -1))
        high, low = sums(rows, terms, up), sums(rows, terms, down)
        slopes = (high - low) / (2 * h)
        assert here[1 + i] == pytest.approx(slopes[0], rel=1e-5, abs=1e-4)
        cu, cd = constant(*up), constant(*down)
        assert gradient[i] == pytest.approx((cu[0] - cd[0]) / (2 * h), rel=1e-5, abs=1e-7)
        for j in range(i, k):
            assert here[1 + k + pairs.index((i, j))] == pytest.approx(slopes[1 + j], rel=1e-5, abs=1e-4)
            assert hessian.get((i, j), 0.0) == pytest.approx((cu[1][j] - cd[1][j]) / (2 * h), rel=1e-5, abs=1e-7)


def test_fits_take_few_passes(summary):
    for fitted in (life.bgnbd_fit(summary), life.gamma_gamma_fit(summary)):
        assert fitted.report.converged and fitted.report.passes <= 25 and fitted.report.gradient < 1e-4


def test_the_fits_run_side_by_side(summary, monkeypatch):
    meet = threading.Barrier(2, timeout=20)
    for name in ("bgnbd_fit", "gamma_gamma_fit"):
        # Breaks if one fit waits for the other.
        monkeypatch.setattr(life, name, lambda rows, penalty, name=name: (meet.wait(), (name, rows, penalty))[1])
    assert life.clv_fits(summary, 0.5) == (("bgnbd_fit", summary, 0.5), ("gamma_gamma_fit", summary, 0.5))


def test_fits_side_by_side_are_those_one_after_the_other(summary):
    model, spend = life.clv_fits(summary)
    alone = life.bgnbd_fit(summary), life.gamma_gamma_fit(summary)
    for got, want, names in ((model, alone[0], ("r", "alpha", "a", "b")), (spend, alone[1], ("p", "q", "v"))):
        assert [getattr(got, n) for n in names] == pytest.approx([getattr(want, n) for n in names], rel=1e-6)
