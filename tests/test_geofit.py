import numpy as np
import pytest
from pyspark.sql import functions as F

from mixloom.operators import geofit
from mixloom.operators import media as media_ops
from mixloom.operators import panel as panel_ops
from mixloom.sources.staging import stage

SIZE = 4  # two media, an intercept, one control


def world(seed, geos=30, days=80, spread=(0.15, 0.05), common=(0.8, 0.4), noise=0.3):
    rng = np.random.default_rng(seed)
    effects = {f"g{g}": np.maximum(rng.normal(common, spread), 0.0) for g in range(geos)}
    rows = []
    for geo, b in effects.items():
        x = rng.gamma(2.0, 0.3, (days, 2))
        control = rng.normal(0, 1, days)
        y = x @ b + 0.3 + 0.1 * control + rng.normal(0, noise, days)
        rows += [(0.5, 1.0, geo, d, *map(float, x[d]), 1.0, float(control[d]), float(y[d]), d >= 60) for d in range(days)]
    return effects, rows


SCHEMA = "alpha double, ec double, geo string, day int, x0 double, x1 double, x2 double, x3 double, y double, is_holdout boolean"
FLAT = (np.zeros(SIZE), np.zeros(SIZE))


@pytest.fixture(scope="module")
def fitted(spark):
    effects, rows = world(1)
    grams = stage(geofit.geo_gram(spark.createDataFrame(rows, SCHEMA), SIZE))
    fits = geofit.fit_settings(grams, {(0.5, 1.0): FLAT}, SIZE)
    draws = geofit.effect_draws(grams, fits, 400, SIZE, 2).collect()
    return effects, rows, fits[0], draws, grams


def test_fit_converges_to_the_maximum(spark, fitted):
    _, _, fit, _, grams = fitted
    assert fit.converged and fit.weight == 1.0 and fit.passes < geofit.MAX_PASSES
    assert np.sqrt(fit.state.sigma2) == pytest.approx(0.3, rel=0.05)
    assert fit.state.mu[:2] == pytest.approx([0.8, 0.4], abs=0.1)
    # No neighbour of the end is better.
    at = fit.state.vector()
    for i in range(len(at)):
        for step in (-0.02, 0.02):
            state = geofit.State.of(at + step * np.eye(len(at))[i])
            sums = geofit._totals(grams, {(0.5, 1.0): state}, SIZE)[0.5, 1.0]
            assert geofit._penalised(sums[3], state, *FLAT) < fit.log_likelihood + 0.02


def test_likelihood_is_that_of_the_whole_covariance(spark, fitted):
    _, rows, fit, _, grams = fitted
    total = 0.0
    for geo in {r[2] for r in rows}:
        train = [r for r in rows if r[2] == geo and not r[-1]]
        x, y = np.array([r[4:8] for r in train]), np.array([r[8] for r in train])
        cov = fit.state.sigma2 * np.eye(len(y)) + x @ np.diag(fit.state.tau2) @ x.T
        rest = y - x @ fit.state.mu
        total += -0.5 * (len(y) * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + rest @ np.linalg.solve(cov, rest))
    sums = geofit._totals(grams, {(0.5, 1.0): fit.state}, SIZE)[0.5, 1.0]
    assert sums[3] == pytest.approx(total)


def test_intervals_cover_the_true_geo_effects(fitted):
    effects, rows, _, draws, _ = fitted
    covered, errors, alone = 0, [], []
    for geo, b in effects.items():
        sampled = np.array([r["coefficients"] for r in draws if r["geo"] == geo])
        assert sampled.shape == (400, SIZE) and (sampled[:, :2] >= 0).all()
        low, high = np.quantile(sampled[:, :2], [0.025, 0.975], axis=0)
        covered += int(((low <= b) & (b <= high)).sum())
        train = [r for r in rows if r[2] == geo and not r[-1]]
        own, *_ = np.linalg.lstsq(np.array([r[4:8] for r in train]), np.array([r[8] for r in train]))
        errors.append(((sampled[:, :2].mean(0) - b) ** 2).sum())
        alone.append(((own[:2] - b) ** 2).sum())
    assert covered >= 0.88 * 2 * len(effects)
    # Leaning on the other geos beats every geo on its own.
    assert sum(errors) < sum(alone)


def test_draws_are_repeatable_and_common_to_all_partitions(spark, fitted):
    _, _, fit, draws, grams = fitted
    again = geofit.effect_draws(grams.repartition(5), [fit], 400, SIZE, 2).collect()
    assert sorted((r["draw"], r["geo"], tuple(r["coefficients"])) for r in again) == sorted((r["draw"], r["geo"], tuple(r["coefficients"])) for r in draws)


def test_prior_is_centre_and_precision(spark):
    _, rows = world(2, geos=3, days=12, noise=2.0)
    grams = stage(geofit.geo_gram(spark.createDataFrame(rows, SCHEMA), SIZE))
    key = (0.5, 1.0)
    tight = (np.array([2.5, 0.0, 0, 0]), np.array([1e6, 0, 0, 0]))
    loose = (np.array([2.5, 0.0, 0, 0]), np.array([1e-6, 0, 0, 0]))
    (a,), (b,), (c,) = (geofit.fit_settings(grams, {key: p}, SIZE) for p in (tight, loose, FLAT))
    assert a.mean[0] == pytest.approx(2.5, abs=0.01)
    assert b.mean[0] == pytest.approx(c.mean[0], abs=0.01)


def test_better_settings_get_the_weight(spark):
    _, rows = world(3)
    rng = np.random.default_rng(0)
    wrong = [(0.8, 1.0, r[2], r[3], float(rng.gamma(2.0, 0.3)), float(rng.gamma(2.0, 0.3)), *r[6:]) for r in rows]
    grams = stage(geofit.geo_gram(spark.createDataFrame(rows + wrong, SCHEMA), SIZE))
    fits = {f.alpha: f for f in geofit.fit_settings(grams, {(0.5, 1.0): FLAT, (0.8, 1.0): FLAT}, SIZE)}
    assert fits[0.5].weight > 0.99 and sum(f.weight for f in fits.values()) == pytest.approx(1.0)
    assert all(f.converged for f in fits.values())


def test_truncated_draws():
    rng = np.random.default_rng(5)
    precision = np.array([[4.0, 1.0], [1.0, 2.0]])
    draws = geofit.positive_normal(np.tile([-0.2, 0.3], (20_000, 1)), precision, 1, rng)
    free = np.array([-0.2, 0.3]) + rng.multivariate_normal([0, 0], np.linalg.inv(precision), 200_000)
    kept = free[free[:, 0] >= 0]
    assert (draws[:, 0] >= 0).all()
    assert draws.mean(0) == pytest.approx(kept.mean(0), abs=0.02)
    assert draws.std(0) == pytest.approx(kept.std(0), abs=0.02)


def test_draws_are_dealt_whole():
    assert geofit.deal_draws([0.5, 0.3, 0.2], 10) == [5, 3, 2]
    assert geofit.deal_draws([1 / 3] * 3, 100) == [34, 33, 33]
    assert geofit.deal_draws([0.999, 0.001], 10) == [10, 0]


@pytest.fixture(scope="module")
def market(spark):
    """Two channels, six geos, 60 days; a known return of channel A."""
    rng = np.random.default_rng(4)
    rows = []
    for g in range(6):
        for d in range(60):
            a, b = rng.integers(5, 40), rng.integers(5, 40)
            level = 100 * (g + 1)
            revenue = level * (1 + 0.8 * a / (a + 20) + 0.3 * b / (b + 20) + rng.normal(0, 0.02))
            rows.append((f"g{g}", d, float(revenue), 0.1, d, d % 7 + 1, int(a), int(b), float(a * level / 100), float(b * level / 100)))
    names = "GEO string, d int, NET_REVENUE double, DISCOUNT_RATE double, TREND int, DAY_OF_WEEK int, A_CLICKS int, B_CLICKS int, A_SPEND double, B_SPEND double"
    panel = spark.createDataFrame(rows, names).withColumn("DATE_DAY", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d"))).drop("d")
    panel = stage(panel)
    return panel, stage(media_ops.scale_media(panel_ops.media_input(panel), ["A", "B"]))


def test_prior_moments_follow_the_return(market):
    panel, media = market
    prior = panel_ops.roi_prior(panel_ops.empirical_roi(panel))
    rows = stage(geofit.design(panel, media, ["A", "B"], (0.2,), (1.0,)))
    ((centre, precision),) = geofit.effect_prior(prior, rows, panel, media, ["A", "B"], 11).values()
    p = prior.first()
    means = {r["GEO"]: r["m"] for r in panel.groupBy("GEO").agg(F.avg("NET_REVENUE").alias("m")).collect()}
    for i, c in enumerate("AB"):
        response = sum(r[f"x{i}"] * means[r["geo"]] for r in rows.collect())
        spent = panel.agg(F.sum(f"{c}_SPEND")).first()[0]
        draws = np.random.default_rng(1).lognormal(p["mu"], p["sigma"], 400_000) * spent / response
        assert centre[i] == pytest.approx(draws.mean(), rel=0.02)
        assert precision[i] == pytest.approx(1 / draws.var(), rel=0.05)
    assert (precision[2:] == 0).all()


def test_chain_from_prior_to_accuracy(market):
    panel, media = market
    prior = panel_ops.roi_prior(panel_ops.empirical_roi(panel))
    fit, settings = geofit.geo_fit(panel, media, ["A", "B"], prior, 40, (0.0, 0.6), (0.5, 1.0))
    assert all(s.converged for s in settings)
    # No carry-over was in the data.
    assert sum(s.weight for s in settings if s.alpha == 0.0) > 0.99
    draws = stage(geofit.media_draws(fit, panel, ["A", "B"]))
    assert draws.count() == 40 * 6 * 2
    roi = {r["channel"]: r for r in media_ops.return_table(draws, media, "roi").collect()}
    assert roi["A"]["roi_low"] > roi["B"]["roi_high"]
    fitted = geofit.fitted_outcome(fit, panel, media, ["A", "B"], (0.0, 0.6), (0.5, 1.0)).collect()
    assert {r["split"] for r in fitted} == {"train", "test"} and len(fitted) == 360
    test = [r for r in fitted if r["split"] == "test"]
    assert sum(abs(r["actual"] - r["expected"]) for r in test) < 0.05 * sum(r["actual"] for r in test)
    assert all(r["expected_low"] <= r["expected"] <= r["expected_high"] for r in fitted)


def test_geos_that_are_alike_converge_in_few_passes(spark):
    """Many variances between geos near 0 have a flat likelihood; the EM algorithm ran out of passes there."""
    rng = np.random.default_rng(6)
    size, rows = 12, []
    for g in range(20):
        media = 0.8 + 0.02 * rng.normal(size=(22, 3))
        for d, x in enumerate(media):
            columns = [*map(float, x), 1.0, 0.1 + 0.01 * float(rng.normal()), d / 30, *[float(d % 7 == k) for k in range(6)]]
            y = 1.0 + 0.5 * float(x.sum() - 2.4) + 0.03 * float(rng.normal())
            rows.append((0.5, 1.0, f"g{g}", d, *columns, y, False))
    schema = "alpha double, ec double, geo string, day int, " + ", ".join(f"x{i} double" for i in range(size)) + ", y double, is_holdout boolean"
    grams = stage(geofit.geo_gram(spark.createDataFrame(rows, schema), size))
    (fit,) = geofit.fit_settings(grams, {(0.5, 1.0): (np.zeros(size), np.zeros(size))}, size, 40)
    assert fit.converged and np.sqrt(fit.state.sigma2) == pytest.approx(0.03, rel=0.1)
