"""Queries over media response, returns, scenarios and budget allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import budget, evaluation, mixfit
from mixloom.operators import media as media_ops
from mixloom.operators import panel as panel_ops
from mixloom.plans import views
from mixloom.plans.registry import Tables, as_text, query, rounded
from mixloom.plans.views import CHANNELS, with_views
from mixloom.sources.staging import stage

_keys = "geo, CAST(day AS VARCHAR) AS day, channel"


@query(
    "m6_scale_media",
    with_views("media", f"SELECT {_keys}, media, round(scaled, 6) AS scaled FROM media"),
)
def scale_media(t: Tables) -> DataFrame:
    return rounded(as_text(views.media(t).select("geo", "day", "channel", "media", "scaled"), "day"), 6, "scaled")


@query("m4_adstock", with_views("carried", f"SELECT {_keys}, round(adstocked, 6) AS adstocked FROM carried"))
def adstock(t: Tables) -> DataFrame:
    carried = media_ops.carry_over(views.media(t), media_ops.settings_of(views.draws(t)))
    return rounded(as_text(carried.select("geo", "day", "channel", "adstocked"), "day"), 6, "adstocked")


@query(
    "m5_hill",
    with_views("carried", f"SELECT {_keys}, round(adstocked / (adstocked + 1.0::DOUBLE), 6) AS response FROM carried"),
)
def hill(t: Tables) -> DataFrame:
    carried = media_ops.carry_over(views.media(t), media_ops.settings_of(views.draws(t)))
    response = media_ops.saturate(carried).select("geo", "day", "channel", "response")
    return rounded(as_text(response, "day"), 6, "response")


@query(
    "m9_contributions",
    with_views("contributions", f"SELECT draw, {_keys}, round(contribution, 6) AS contribution FROM contributions"),
)
def contributions(t: Tables) -> DataFrame:
    parts = media_ops.contributions(views.draws(t), views.media(t))
    return rounded(as_text(parts, "day"), 6, "contribution")


def _medians(t: Tables) -> DataFrame:
    return media_ops.contribution_intervals(media_ops.contributions(views.draws(t), views.media(t)))


@query(
    "m10_contribution_intervals",
    with_views(
        "contribution_medians",
        f"SELECT {_keys}, round(low, 6) AS low, round(median, 6) AS median, round(high, 6) AS high FROM contribution_medians",
    ),
)
def contribution_intervals(t: Tables) -> DataFrame:
    return rounded(as_text(_medians(t), "day"), 6, "low", "median", "high")


@query(
    "m11_expected_outcome",
    with_views(
        "expected",
        """SELECT draw, geo, CAST(day AS VARCHAR) AS day, round(media_total, 6) AS media_total,
                  round(expected, 6) AS expected, round(baseline, 6) AS baseline FROM expected""",
    ),
)
def expected_outcome(t: Tables) -> DataFrame:
    parts = media_ops.contributions(views.draws(t), views.media(t))
    outcome = media_ops.expected_outcome(parts, views.intercepts(t))
    return rounded(as_text(outcome, "day"), 6, "media_total", "expected", "baseline")


@query(
    "m11_outcome_medians",
    with_views(
        "expected",
        """SELECT geo, CAST(day AS VARCHAR) AS day, round(quantile_cont(expected, 0.5), 6) AS expected_median,
                  round(quantile_cont(media_total, 0.5), 6) AS media_total_median,
                  round(quantile_cont(expected - media_total, 0.5), 6) AS baseline_median FROM expected GROUP BY ALL""",
    ),
)
def outcome_medians(t: Tables) -> DataFrame:
    parts = media_ops.contributions(views.draws(t), views.media(t))
    medians = media_ops.outcome_medians(media_ops.expected_outcome(parts, views.intercepts(t)))
    return rounded(as_text(medians, "day"), 6, "expected_median", "media_total_median", "baseline_median")


@query(
    "m12_geo_slice",
    with_views(
        "contribution_medians",
        f"SELECT {_keys}, round(median, 6) AS median FROM contribution_medians WHERE geo = 'G07'",
    ),
)
def geo_slice(t: Tables) -> DataFrame:
    part = media_ops.geo_slice(_medians(t), "G07").select("geo", "day", "channel", "median")
    return rounded(as_text(part, "day"), 6, "median")


@query(
    "a34_mean_abs_contribution",
    with_views(
        "contribution_medians",
        "SELECT geo, channel, round(avg(abs(median)), 6) AS importance FROM contribution_medians GROUP BY ALL",
    ),
)
def mean_abs_contribution(t: Tables) -> DataFrame:
    return rounded(media_ops.mean_abs_contribution(_medians(t)), 6, "importance")


@query(
    "a35_credible_interval_table",
    with_views(
        "contribution_medians",
        """SELECT geo, channel, round(avg(median), 6) AS median, round(avg(low), 6) AS ci_low,
                  round(avg(high), 6) AS ci_high, round(avg(high) - avg(low), 6) AS ci_width
           FROM contribution_medians GROUP BY ALL""",
    ),
)
def credible_interval_table(t: Tables) -> DataFrame:
    return rounded(media_ops.credible_interval_table(_medians(t)), 6, "median", "ci_low", "ci_high", "ci_width")


@query(
    "m13_dependence",
    with_views(
        "contribution_medians media",
        """SELECT m.geo, CAST(m.day AS VARCHAR) AS day, m.channel, x.media, round(m.median, 6) AS contribution,
                  round((median - min(median) OVER s) / (max(median) OVER s - min(median) OVER s + 1e-9), 5)
                    AS scaled_contribution
           FROM contribution_medians m JOIN media x USING (geo, day, channel)
           WINDOW s AS (PARTITION BY m.geo, m.channel)""",
    ),
)
def dependence(t: Tables) -> DataFrame:
    table = media_ops.dependence(stage(_medians(t)), views.media(t))
    return rounded(rounded(as_text(table, "day"), 6, "contribution"), 5, "scaled_contribution")


@query(
    "a32_posterior_interval",
    with_views(
        "draws",
        """SELECT geo, channel, round(q[1], 6) AS low, round(q[2], 6) AS median, round(q[3], 6) AS high
           FROM (SELECT geo, channel, quantile_cont(beta, [0.025, 0.5, 0.975]) AS q FROM draws GROUP BY ALL)""",
    ),
)
def posterior_interval(t: Tables) -> DataFrame:
    return rounded(media_ops.posterior_interval(views.draws(t), ["geo", "channel"], "beta"), 6, "low", "median", "high")


def _returns(t: Tables, kind: str) -> DataFrame:
    return media_ops.return_table(views.draws(t), views.media(t), kind)


@query(
    "a33_roi_table",
    with_views(
        "roi",
        "SELECT channel, round(roi_low, 6) AS roi_low, round(roi_median, 6) AS roi_median, round(roi_high, 6) AS roi_high FROM roi",
    ),
)
def roi_table(t: Tables) -> DataFrame:
    return rounded(_returns(t, "roi"), 6, "roi_low", "roi_median", "roi_high")


@query(
    "a33_mroi_table",
    with_views(
        "mroi",
        "SELECT channel, round(mroi_low, 6) AS mroi_low, round(mroi_median, 6) AS mroi_median, round(mroi_high, 6) AS mroi_high FROM mroi",
    ),
)
def mroi_table(t: Tables) -> DataFrame:
    return rounded(_returns(t, "mroi"), 6, "mroi_low", "mroi_median", "mroi_high")


@query(
    "p19_investment_status",
    with_views(
        "roi mroi",
        """SELECT channel, round(roi_median, 6) AS roi_median, round(mroi_median, 6) AS mroi_median,
                  CASE WHEN mroi_median > 1 THEN 'Under-invested' ELSE 'Over-invested' END AS status
           FROM roi JOIN mroi USING (channel)""",
    ),
)
def investment_status(t: Tables) -> DataFrame:
    status = budget.investment_status(_returns(t, "roi"), _returns(t, "mroi"))
    return rounded(status, 6, "roi_median", "mroi_median")


@query(
    "j15_roi_with_mroi",
    with_views(
        "roi mroi",
        """SELECT channel, round(roi_low, 6) AS roi_low, round(roi_high, 6) AS roi_high, round(mroi_low, 6) AS mroi_low,
                  round(mroi_high, 6) AS mroi_high FROM roi JOIN mroi USING (channel)""",
    ),
)
def roi_with_mroi(t: Tables) -> DataFrame:
    merged = _returns(t, "roi").join(_returns(t, "mroi"), "channel").drop("roi_median", "mroi_median")
    return rounded(merged, 6, "roi_low", "roi_high", "mroi_low", "mroi_high")


# ---------------------------------------------------------------- strategies


def _metrics(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Draws, media and channel metrics, staged for the scenario that follows."""
    draws, media = views.draws(t), views.media(t)
    roi, mroi = media_ops.return_table(draws, media, "roi"), media_ops.return_table(draws, media, "mroi")
    return draws, media, stage(budget.channel_metrics(media, roi, mroi))


@query(
    "m15_channel_metrics",
    with_views(
        "metrics",
        """SELECT channel, round(spend_total, 4) AS spend_total, round(roi_median, 6) AS roi_median,
                  round(mroi_median, 6) AS mroi_median, is_saturated FROM metrics""",
    ),
)
def channel_metrics(t: Tables) -> DataFrame:
    return rounded(rounded(_metrics(t)[2], 4, "spend_total"), 6, "roi_median", "mroi_median")


@query(
    "k6_best_channel",
    with_views(
        "metrics",
        "SELECT channel, round(mroi_median, 6) AS mroi_median FROM metrics ORDER BY metrics.mroi_median DESC, channel LIMIT 1",
    ),
)
def best_channel(t: Tables) -> DataFrame:
    return rounded(budget.best_channel(_metrics(t)[2]), 6, "mroi_median")


_extra = "(SELECT sum(spend_total) * 0.2 FROM metrics)"
_level = "(SELECT median(mroi_median) FROM metrics)"
_STRATEGIES = {
    "equal": f"spend_total + {_extra} / (SELECT count(*) FROM metrics)",
    "best_mroi": f"""spend_total + CASE WHEN channel = (SELECT channel FROM metrics ORDER BY mroi_median DESC, channel LIMIT 1)
                                        THEN {_extra} ELSE 0 END""",
    "saturation_aware": f"""CASE WHEN mroi_median < {_level} THEN spend_total * 0.7
        ELSE spend_total + ((SELECT coalesce(sum(spend_total) * 0.3, 0) FROM metrics WHERE mroi_median < {_level}) + {_extra})
             * mroi_median / (SELECT sum(mroi_median) FROM metrics WHERE mroi_median >= {_level}) END""",
    "top_channel": """spend_total * CASE WHEN channel = (SELECT channel FROM metrics ORDER BY roi_median DESC, channel LIMIT 1)
                                         THEN 1.5 ELSE 1 END""",
    "random_half": """spend_total * CASE WHEN row_number() OVER (ORDER BY md5(channel || '#42'))
                                         <= (SELECT count(*) // 2 FROM metrics) THEN 1.1 ELSE 1 END""",
}


def _multiplier_sql(name: str) -> str:
    return f"mult AS (SELECT channel, {_STRATEGIES[name]} AS new_spend, ({_STRATEGIES[name]}) / spend_total AS multiplier FROM metrics)"


def _strategy(metrics: DataFrame, name: str) -> DataFrame:
    if name == "saturation_aware":
        # These stand-in returns are all below 1; a level from the data leaves channels to move the budget to.
        level = metrics.agg(F.median("mroi_median")).first()[0]
        return budget.strategy_saturation_aware(metrics, level=level)
    return {
        "equal": budget.strategy_equal,
        "best_mroi": budget.strategy_best_mroi,
        "top_channel": budget.strategy_top_channel,
        "random_half": budget.strategy_random_half,
    }[name](metrics)


SCENARIO = (
    "baseline_low",
    "baseline_median",
    "baseline_high",
    "scenario_low",
    "scenario_median",
    "scenario_high",
    "delta_abs",
    "delta_pct",
)


def _scenario_sql(name: str) -> str:
    """Scenario body behind an expression ``mult``; result named ``res``."""
    return f"""
    tot AS (SELECT draw, sum(beta * (adstocked / (adstocked + ec))) AS base,
                   sum(beta * (adstocked * multiplier / (adstocked * multiplier + ec))) AS scen
            FROM draws JOIN carried USING (geo, channel) JOIN mult USING (channel) GROUP BY draw),
    qs AS (SELECT quantile_cont(base, [0.025, 0.5, 0.975]) AS b, quantile_cont(scen, [0.025, 0.5, 0.975]) AS s FROM tot),
    res AS (SELECT '{name}' AS scenario_name, b[1] AS baseline_low, b[2] AS baseline_median, b[3] AS baseline_high,
                   s[1] AS scenario_low, s[2] AS scenario_median, s[3] AS scenario_high, s[2] - b[2] AS delta_abs,
                   (s[2] - b[2]) * 100 / b[2] AS delta_pct,
                   {", ".join(f"(SELECT max(multiplier) FROM mult WHERE channel = '{c}') AS mult_{c}" for c in CHANNELS)}
            FROM qs)"""


_mults = [f"mult_{c}" for c in CHANNELS]
_scenario_out = "scenario_name, " + ", ".join(
    [f"round({c}, 4) AS {c}" for c in SCENARIO] + [f"round({c}, 6) AS {c}" for c in _mults]
)


def _round_scenario(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 4, *SCENARIO), 6, *_mults)


GIVEN = {"CLICK": 1.3, "VIEW": 0.8}
_given = "mult AS (SELECT channel, CASE channel WHEN 'CLICK' THEN 1.3 WHEN 'VIEW' THEN 0.8 ELSE 1.0 END::DOUBLE AS multiplier FROM channel_spend)"


@query(
    "m19_apply_multipliers",
    with_views(
        "media",
        f"""SELECT {_keys}, round(media * m, 6) AS media, round(spend * m, 6) AS spend
            FROM (SELECT *, CASE channel WHEN 'CLICK' THEN 1.3 WHEN 'VIEW' THEN 0.8 ELSE 1.0 END::DOUBLE AS m FROM media)""",
    ),
)
def apply_multipliers(t: Tables) -> DataFrame:
    scaled = media_ops.apply_multipliers(views.media(t), GIVEN).select("geo", "day", "channel", "media", "spend")
    return rounded(as_text(scaled, "day"), 6, "media", "spend")


@query(
    "m20_what_if",
    with_views("draws carried channel_spend", f"WITH {_given}, {_scenario_sql('given')} SELECT {_scenario_out} FROM res"),
)
def what_if(t: Tables) -> DataFrame:
    return _round_scenario(media_ops.what_if(views.draws(t), views.media(t), GIVEN, "given", CHANNELS))


def _run_strategy(t: Tables, name: str) -> DataFrame:
    draws, media, metrics = _metrics(t)
    return media_ops.what_if(draws, media, _strategy(metrics, name), name, CHANNELS)


def _strategy_query(query_name: str, name: str):
    sql = with_views(
        "draws carried metrics",
        f"WITH {_multiplier_sql(name)}, {_scenario_sql(name)} SELECT {_scenario_out} FROM res",
    )

    @query(query_name, sql)
    def run(t: Tables) -> DataFrame:
        return _round_scenario(_run_strategy(t, name))

    return run


for _query_name, _strategy_name in (
    ("m21_strategy_equal", "equal"),
    ("m22_strategy_best_mroi", "best_mroi"),
    ("m23_strategy_saturation_aware", "saturation_aware"),
    ("m25_strategy_top_channel", "top_channel"),
    ("m25_strategy_random_half", "random_half"),
):
    _strategy_query(_query_name, _strategy_name)


@query(
    "m24_strategy_kpis",
    with_views(
        "draws carried metrics raw_panel",
        f"""WITH {_multiplier_sql('equal')}, {_scenario_sql('equal')}
            SELECT scenario_name, round(delta_abs, 4) AS delta_abs,
                   round(delta_abs / (SELECT sum(ALL_PURCHASES_ORIGINAL_PRICE - ALL_PURCHASES_GROSS_DISCOUNT)
                                             / sum(ALL_PURCHASES) FROM raw_panel), 6) AS incremental_purchases,
                   round(delta_abs / {_extra}, 8) AS incremental_roi FROM res""",
    ),
)
def strategy_kpis(t: Tables) -> DataFrame:
    draws, media, metrics = _metrics(t)
    result = media_ops.what_if(draws, media, budget.strategy_equal(metrics), "equal", CHANNELS)
    kpis = budget.strategy_kpis(result, metrics, panel_ops.avg_price(views.raw_panel(t)))
    kpis = kpis.select("scenario_name", "delta_abs", "incremental_purchases", "incremental_roi")
    return rounded(rounded(rounded(kpis, 4, "delta_abs"), 6, "incremental_purchases"), 8, "incremental_roi")


def _scenario_block(i: int, name: str) -> str:
    text = f"{_multiplier_sql(name)}, {_scenario_sql(name)}"
    for word in ("mult", "tot", "qs", "res"):
        text = text.replace(f"{word} AS (", f"{word}{i} AS (").replace(f"FROM {word} ", f"FROM {word}{i} ")
        text = text.replace(f"FROM {word})", f"FROM {word}{i})").replace(f"JOIN {word} ", f"JOIN {word}{i} ")
    return text


COMPARED = ("equal", "best_mroi", "saturation_aware")


@query(
    "m26_scenario_comparison",
    with_views(
        "draws carried metrics",
        "WITH "
        + ", ".join(_scenario_block(i, n) for i, n in enumerate(COMPARED))
        + " UNION ALL ".join(f" SELECT {_scenario_out} FROM res{i}" for i in range(len(COMPARED))),
    ),
)
def scenario_comparison(t: Tables) -> DataFrame:
    """The three strategies under each other."""
    draws, media, metrics = _metrics(t)
    results = [media_ops.what_if(draws, media, _strategy(metrics, n), n, CHANNELS) for n in COMPARED]
    return _round_scenario(results[0].unionByName(results[1]).unionByName(results[2]))


@query(
    "u2_union_scenarios",
    with_views(
        "metrics",
        f"""WITH a AS (SELECT channel, {_STRATEGIES['equal']} AS new_spend FROM metrics),
                 b AS (SELECT channel, {_STRATEGIES['top_channel']} AS new_spend FROM metrics)
            SELECT 'equal' AS scenario, channel, round(new_spend, 4) AS new_spend, 'extra budget' AS remark FROM a
            UNION ALL SELECT 'top_channel', channel, round(new_spend, 4), NULL FROM b""",
    ),
)
def union_scenarios(t: Tables) -> DataFrame:
    metrics = _metrics(t)[2]
    first = budget.strategy_equal(metrics).withColumns({"scenario": F.lit("equal"), "remark": F.lit("extra budget")})
    second = budget.strategy_top_channel(metrics).withColumn("scenario", F.lit("top_channel"))
    both = first.unionByName(second, allowMissingColumns=True)
    return rounded(both.select("scenario", "channel", "new_spend", "remark"), 4, "new_spend")


# ---------------------------------------------------------------- curves and budget

GRID = budget.spend_grid()
_grid_sql = f"(SELECT unnest([{', '.join(f'{m!r}::DOUBLE' for m in GRID)}]) AS multiplier)"


def _digits(column: str) -> int:
    """Steps of the grid are fractions of cents: four digits would cut spend at exact halves."""
    return 6 if column.startswith("spend") else 4


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, _digits(c)) for c in columns})


def _curves_sql(hill: str) -> str:
    return f"""
    per_draw AS (SELECT draw, channel, multiplier, sum(beta * {hill}) AS outcome
                 FROM draws JOIN carried USING (geo, channel), {_grid_sql} GROUP BY ALL),
    curve AS (SELECT channel, multiplier, mean, q[1] AS low, q[2] AS median, q[3] AS high, spend_total * multiplier AS spend
              FROM (SELECT channel, multiplier, avg(outcome) AS mean, quantile_cont(outcome, [0.025, 0.5, 0.975]) AS q
                    FROM per_draw GROUP BY ALL) JOIN channel_spend USING (channel))"""


_curve_sql = _curves_sql("(adstocked * multiplier / (adstocked * multiplier + ec))")
# A slope above one gives S-shaped curves.
SLOPE = 3.0
_s_curve_sql = _curves_sql(
    f"(power(adstocked * multiplier, {SLOPE}::DOUBLE) / (power(adstocked * multiplier, {SLOPE}::DOUBLE) + power(ec, {SLOPE}::DOUBLE)))"
)


def _curve(t: Tables) -> DataFrame:
    return media_ops.response_curve(views.draws(t), views.media(t), GRID)


@query(
    "m14_response_curve",
    with_views(
        "draws carried channel_spend",
        f"""WITH {_curve_sql} SELECT channel, multiplier, round(spend, 6) AS spend, round(mean, 4) AS mean,
                   round(low, 4) AS low, round(median, 4) AS median, round(high, 4) AS high FROM curve""",
    ),
)
def response_curve(t: Tables) -> DataFrame:
    return _money(_curve(t), "spend", "mean", "low", "median", "high")


# Every plan of one point per channel.
_points = [f"p{i}" for i in range(len(CHANNELS))]
_optimal_sql = f"""
    plan AS (SELECT {", ".join(f"{p}.spend AS {p}_spend, {p}.median AS {p}_median" for p in _points)},
                    {" + ".join(f"{p}.spend" for p in _points)} AS spent, {" + ".join(f"{p}.median" for p in _points)} AS gained
             FROM {", ".join(f"(SELECT spend, median FROM curve WHERE channel = '{c}') {p}" for p, c in zip(_points, CHANNELS))}),
    best AS (SELECT * FROM plan WHERE spent <= (SELECT sum(spend_total) FROM channel_spend) * (1 + 1e-12)
             ORDER BY gained DESC, spent LIMIT 1),
    opt AS (SELECT channel, spend_total AS spend_historical, spend, incremental_outcome FROM channel_spend JOIN (
              {" UNION ALL ".join(f"SELECT '{c}' AS channel, {p}_spend AS spend, {p}_median AS incremental_outcome FROM best" for p, c in zip(_points, CHANNELS))}
            ) USING (channel)),
    hist AS (SELECT channel, spend, median AS incremental_outcome FROM curve WHERE multiplier = 1.0)"""


def _with_optimal(body: str, curve: str = _curve_sql) -> str:
    return with_views("draws carried channel_spend", f"WITH {curve}, {_optimal_sql} {body}")


_allocation_sql = """SELECT channel, round(spend_historical, 6) AS spend_historical, round(spend, 6) AS spend,
       round(incremental_outcome, 4) AS incremental_outcome,
       round((SELECT sum(spend_historical) - sum(spend) FROM opt), 2) AS unspent FROM opt"""


def _allocation(curve: DataFrame) -> DataFrame:
    optimised = budget.optimize_budget(stage(curve))
    return _money(rounded(optimised, 2, "unspent"), "spend_historical", "spend", "incremental_outcome")


@query("m16_optimize_budget", _with_optimal(_allocation_sql))
def optimize_budget(t: Tables) -> DataFrame:
    return _allocation(_curve(t))


@query("m16_optimize_budget_s_shaped", _with_optimal(_allocation_sql, _s_curve_sql))
def optimize_budget_s_shaped(t: Tables) -> DataFrame:
    """The same budget on curves that bend upwards first."""
    draws = views.draws(t).withColumn("slope", F.lit(SLOPE))
    return _allocation(media_ops.response_curve(draws, views.media(t), GRID))


def _comparison(t: Tables) -> DataFrame:
    curve = stage(_curve(t))
    historical = curve.filter(F.col("multiplier") == 1.0).select(
        "channel", "spend", F.col("median").alias("incremental_outcome")
    )
    return budget.compare_allocation(budget.optimize_budget(curve), historical)


_comparison_sql = """cmp AS (SELECT channel, h.spend AS spend_historical, h.incremental_outcome AS revenue_historical,
        o.spend AS spend_optimized, o.incremental_outcome AS revenue_optimized, o.spend - h.spend AS spend_delta,
        round((o.spend - h.spend) * 100 / h.spend, 1) AS spend_delta_pct,
        o.incremental_outcome - h.incremental_outcome AS revenue_delta FROM hist h JOIN opt o USING (channel))"""
MONEY = ("spend_historical", "revenue_historical", "spend_optimized", "revenue_optimized", "spend_delta", "revenue_delta")


@query(
    "m17_compare_allocation",
    _with_optimal(
        f", {_comparison_sql} SELECT channel, spend_delta_pct, {', '.join(f'round({c}, {_digits(c)}) AS {c}' for c in MONEY)} FROM cmp"
    ),
)
def compare_allocation(t: Tables) -> DataFrame:
    return _money(_comparison(t), *MONEY)


@query(
    "m18_reallocation_report",
    _with_optimal(
        f""", {_comparison_sql} SELECT channel, CASE WHEN spend_delta > 0 THEN 'Increase' ELSE 'Decrease' END AS direction,
              round(spend_delta, 6) AS spend_delta, round(spend_historical, 6) AS spend_from,
              round(spend_optimized, 6) AS spend_to FROM cmp"""
    ),
)
def reallocation_report(t: Tables) -> DataFrame:
    return _money(budget.reallocation_report(_comparison(t)), "spend_delta", "spend_from", "spend_to")


@query(
    "a37_optimization_totals",
    _with_optimal(
        f""", {_comparison_sql}, s AS (SELECT sum(spend_historical) AS sh, sum(spend_optimized) AS so,
                sum(revenue_historical) AS rh, sum(revenue_optimized) AS ro FROM cmp)
            SELECT round(sh, 6) AS spend_historical, round(so, 6) AS spend_optimized, round(rh, 4) AS revenue_historical,
                   round(ro, 4) AS revenue_optimized, round(ro - rh, 4) AS revenue_gain,
                   round((ro - rh) * 100 / rh, 6) AS revenue_gain_pct, round(rh / sh, 6) AS roi_historical,
                   round(ro / so, 6) AS roi_optimized FROM s"""
    ),
)
def optimization_totals(t: Tables) -> DataFrame:
    totals = budget.optimization_totals(_comparison(t))
    money = ["spend_historical", "spend_optimized", "revenue_historical", "revenue_optimized", "revenue_gain"]
    return rounded(_money(totals, *money), 6, "revenue_gain_pct", "roi_historical", "roi_optimized")


# ---------------------------------------------------------------- accuracy and fit

_accuracy = """
    e AS (SELECT x.geo, x.day, p.NET_REVENUE AS actual, x.expected, CASE WHEN dense_rank() OVER (ORDER BY x.day) - 1
                   < floor(0.75 * (SELECT count(DISTINCT DATE_DAY) FROM dense_panel)) THEN 'train' ELSE 'test' END AS split
          FROM (SELECT geo, day, quantile_cont(expected, 0.5) AS expected FROM expected GROUP BY ALL) x
          JOIN dense_panel p ON p.GEO = x.geo AND p.DATE_DAY = x.day),
    both_sets AS (SELECT geo, day, actual, expected, unnest([split, 'all']) AS evaluation_set FROM e)"""
_measures = """count(*) AS n, round(1 - sum((actual - expected) ** 2) / nullif(var_pop(actual) * count(*), 0), 6) AS r2,
    round(avg(abs((actual - expected) / nullif(actual, 0))), 4) AS mape,
    round(sum(abs(actual - expected)) / nullif(sum(actual), 0), 6) AS wmape"""


def _actual_expected(t: Tables) -> DataFrame:
    panel = panel_ops.temporal_split(views.dense_panel(t).select("GEO", "DATE_DAY", "NET_REVENUE"))
    parts = media_ops.contributions(views.draws(t), views.media(t))
    medians = media_ops.outcome_medians(media_ops.expected_outcome(parts, views.intercepts(t)))
    actual = panel.withColumnsRenamed({"GEO": "geo", "DATE_DAY": "day", "NET_REVENUE": "actual"})
    return stage(actual.join(medians, ["geo", "day"]).withColumnRenamed("expected_median", "expected"))


def _round_accuracy(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 6, "r2", "wmape"), 4, "mape")


@query(
    "a31_mmm_accuracy_geo",
    with_views("expected dense_panel", f"WITH {_accuracy} SELECT geo, evaluation_set, {_measures} FROM both_sets GROUP BY ALL"),
)
def mmm_accuracy_geo(t: Tables) -> DataFrame:
    return _round_accuracy(evaluation.mmm_accuracy(_actual_expected(t), "geo", "split", "actual", "expected"))


@query(
    "a31_mmm_accuracy_national",
    with_views(
        "expected dense_panel",
        f"""WITH {_accuracy}, nat AS (SELECT day, evaluation_set, sum(actual) AS actual, sum(expected) AS expected
                                      FROM both_sets GROUP BY ALL)
            SELECT 'national' AS geo, evaluation_set, {_measures} FROM nat GROUP BY ALL""",
    ),
)
def mmm_accuracy_national(t: Tables) -> DataFrame:
    return _round_accuracy(
        evaluation.mmm_accuracy_national(_actual_expected(t), "day", "split", "actual", "expected")
    )


REPLICATES = 100


@query("m7_mmm_ensemble_draws")
def mmm_ensemble_draws(t: Tables) -> DataFrame:
    """Draws of the pooled bootstrap ensemble, the fit without geo effects."""
    panel = views.dense_panel(t)
    media = stage(media_ops.scale_media(panel_ops.media_input(panel), CHANNELS))
    return mixfit.fit_draws(stage(mixfit.mmm_fit(panel, media, CHANNELS, REPLICATES)), panel, CHANNELS)
