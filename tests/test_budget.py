import itertools

import pytest
from pyspark.sql import functions as F

from mixloom.operators import budget

# The published result tables (medians per channel).
ROI = {"GOOGLE_DISPLAY": 2.5373178720474243, "META_FACEBOOK": 3.3174381256103516, "META_INSTAGRAM": 2.084299087524414, "META_OTHER": 4.97102427482605}
MROI = {"GOOGLE_DISPLAY": 0.8745281100273132, "META_FACEBOOK": 2.3229756355285645, "META_INSTAGRAM": 1.5705127120018005, "META_OTHER": 2.594647765159607}
BEFORE = {"GOOGLE_DISPLAY": (90000.0, 233731.21875), "META_FACEBOOK": (7460000.0, 24745710.0), "META_INSTAGRAM": (2530000.0, 5275156.0), "META_OTHER": (20000.0, 106338.859375)}
AFTER = {"GOOGLE_DISPLAY": (50000.0, 184773.78125), "META_FACEBOOK": (8160000.0, 26335322.0), "META_INSTAGRAM": (1850000.0, 4131028.0), "META_OTHER": (30000.0, 129127.578125)}
DELTA_PCT = {"GOOGLE_DISPLAY": -44.4, "META_FACEBOOK": 9.4, "META_INSTAGRAM": -26.9, "META_OTHER": 50.0}


def table(spark, values, name):
    return spark.createDataFrame(list(values.items()), f"channel string, {name} double")


def allocation(spark, values):
    rows = [(c, s, r) for c, (s, r) in values.items()]
    return spark.createDataFrame(rows, "channel string, spend double, incremental_outcome double")


def test_published_investment_status(spark):
    out = budget.investment_status(table(spark, ROI, "roi_median"), table(spark, MROI, "mroi_median"))
    status = {r["channel"]: r["status"] for r in out.collect()}
    assert status == {c: "Over-invested" if c == "GOOGLE_DISPLAY" else "Under-invested" for c in ROI}


def test_published_allocation(spark):
    comparison = budget.compare_allocation(allocation(spark, AFTER), allocation(spark, BEFORE)).cache()
    assert {r["channel"]: r["spend_delta_pct"] for r in comparison.collect()} == DELTA_PCT
    totals = budget.optimization_totals(comparison).first()
    assert totals["revenue_gain"] == pytest.approx(419315.28, abs=0.01)
    assert totals["revenue_gain_pct"] == pytest.approx(1.38, abs=0.005)
    # Each side over its own spend; the optimised plan leaves 10,000 unspent.
    assert totals["spend_optimized"] == 10090000.0 and totals["roi_optimized"] == pytest.approx(3.0506, abs=1e-4)
    report = {r["channel"]: r["direction"] for r in budget.reallocation_report(comparison).collect()}
    assert report["META_OTHER"] == "Increase" and report["GOOGLE_DISPLAY"] == "Decrease"


def metrics(spark, rows):
    return spark.createDataFrame(rows, "channel string, spend_total double, roi_median double, mroi_median double")


@pytest.fixture(scope="module")
def three(spark):
    return metrics(spark, [("A", 100.0, 3.0, 0.5), ("B", 50.0, 2.0, 1.0), ("C", 50.0, 4.0, 3.0)])


def spends(df):
    return {r["channel"]: (r["new_spend"], r["multiplier"]) for r in df.collect()}


def test_strategies_spend_the_extra_budget(three):
    equal = spends(budget.strategy_equal(three, 0.3))
    assert equal["A"] == (pytest.approx(120.0), pytest.approx(1.2)) and equal["B"][0] == pytest.approx(70.0)
    best = spends(budget.strategy_best_mroi(three, 0.2))
    assert best["C"][0] == pytest.approx(90.0) and best["A"][1] == 1.0
    aware = spends(budget.strategy_saturation_aware(three, 0.2))
    # 30 freed and 40 extra, shared 1 : 3 by marginal return; a return of exactly 1 is not saturated.
    assert aware["A"][0] == pytest.approx(70.0)
    assert aware["B"][0] == pytest.approx(67.5) and aware["C"][0] == pytest.approx(102.5)
    assert sum(v[0] for v in aware.values()) == pytest.approx(240.0)
    top = spends(budget.strategy_top_channel(three))
    assert top["C"][0] == 75.0 and top["A"][0] == 100.0
    half = spends(budget.strategy_random_half(three))
    assert sorted(round(v[1], 6) for v in half.values()) == [1.0, 1.0, 1.1]
    assert half == spends(budget.strategy_random_half(three))


def test_status_at_exactly_one(spark, three):
    roi, mroi = three.select("channel", "roi_median"), three.select("channel", "mroi_median")
    status = {r["channel"]: r["status"] for r in budget.investment_status(roi, mroi).collect()}
    assert status["B"] == "Over-invested"


def test_all_saturated_is_an_error(spark):
    with pytest.raises(ValueError):
        budget.strategy_saturation_aware(metrics(spark, [("A", 1.0, 0.5, 0.5)]))


def curve(spark, shapes, lower=0.5, upper=2.0, steps=6):
    rows = [
        (c, m, spend * m, f(spend * m)) for c, (spend, f) in shapes.items() for m in budget.spend_grid(lower, upper, steps)
    ]
    return spark.createDataFrame(rows, "channel string, multiplier double, spend double, median double")


def test_allocation_is_the_best_of_all_plans(spark):
    shapes = {
        "A": (8.0, lambda s: 30 * s / (s + 10)),
        "B": (8.0, lambda s: 50 * s / (s + 20)),
        "C": (8.0, lambda s: 10 * s / (s + 5)),
    }
    df = curve(spark, shapes)
    out = budget.optimize_budget(df).collect()
    grid = [8.0 * m for m in budget.spend_grid(0.5, 2.0, 6)]
    best = max(
        sum(f(s) for s, (_, f) in zip(plan, shapes.values()))
        for plan in itertools.product(grid, repeat=3)
        if sum(plan) <= 24.0 + 1e-9
    )
    assert sum(r["incremental_outcome"] for r in out) == pytest.approx(best)
    assert sum(r["spend"] for r in out) <= 24.0 + 1e-9
    assert all(4.0 <= r["spend"] <= 16.0 for r in out)
    less = budget.optimize_budget(df, budget=14.0).agg(F.sum("spend")).first()[0]
    assert 12.0 <= less <= 14.0


def best_by_force(shapes, grids, limit):
    plans = itertools.product(*grids)
    return max(sum(f(s) for s, (_, f) in zip(plan, shapes.values())) for plan in plans if sum(plan) <= limit + 1e-9)


def hill4(top, half):
    return lambda s: top * s**4 / (s**4 + half**4)


def test_s_shaped_curves(spark):
    """Awkward budgets, which no row of whole stretches meets; outcomes are on the curve."""
    shapes = {"A": (100.0, hill4(300.0, 90.0)), "B": (100.0, hill4(900.0, 80.0))}
    df = curve(spark, shapes, 0.0, 2.0, 20)
    grids = [[100.0 * m for m in budget.spend_grid(0.0, 2.0, 20)]] * 2
    for limit in (1.0, 89.9, 150.0, 171.3, 260.0, 333.3, 400.0, 1000.0):
        out = {r["channel"]: r for r in budget.optimize_budget(df, budget=limit).collect()}
        for c, (_, f) in shapes.items():
            assert out[c]["incremental_outcome"] == pytest.approx(f(out[c]["spend"]))
        spent = sum(r["spend"] for r in out.values())
        assert spent <= limit + 1e-9 and all(r["unspent"] == pytest.approx(limit - spent) for r in out.values())
        assert sum(r["incremental_outcome"] for r in out.values()) == pytest.approx(best_by_force(shapes, grids, limit))


def test_curves_of_any_shape(spark):
    """Jagged curves on grids that share no step: the best of all plans, and nothing affordable is left."""
    import random

    rng = random.Random(3)
    for _ in range(3):
        rows, grids, tops = [], [], {}
        for c, spend in (("A", 7.3), ("B", 11.9), ("C", 2.17), ("D", 5.01)):
            points = [(m, spend * m, rng.choice([0.0, rng.random() * 9, m])) for m in budget.spend_grid(0.2, 2.0, 9)]
            rows += [(c, *p) for p in points]
            grids.append(points)
            tops[c] = {p[1]: p[2] for p in points}
        df = spark.createDataFrame(rows, "channel string, multiplier double, spend double, median double")
        limits = [4.0, 9.7, 20.0, 26.38, 33.3]
        wanted = spark.createDataFrame([(x,) for x in limits], "budget double")
        for limit, plan in _by_budget(budget.optimize_budgets(df, wanted)).items():
            plans = [p for p in itertools.product(*grids) if sum(x[1] for x in p) <= limit + 1e-9]
            if not plans:
                assert all(r["spend"] == min(tops[r["channel"]]) for r in plan) and plan[0]["unspent"] < 0
                continue
            assert sum(r["incremental_outcome"] for r in plan) == pytest.approx(max(sum(x[2] for x in p) for p in plans))
            for r in plan:
                more = [g for s, g in tops[r["channel"]].items() if r["spend"] < s <= r["spend"] + r["unspent"]]
                assert all(g <= r["incremental_outcome"] for g in more)


def _by_budget(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["budget"], []).append(r)
    return out


def test_kpis(spark, three):
    result = spark.createDataFrame([("s", 20.0)], "scenario_name string, delta_abs double")
    price = spark.createDataFrame([(4.0,)], "avg_price double")
    row = budget.strategy_kpis(result, three, price).first()
    assert row["incremental_purchases"] == 5.0 and row["incremental_roi"] == pytest.approx(0.5)
