"""Queries over the marketing panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import descriptive
from mixloom.operators import panel as panel_ops
from mixloom.plans import views
from mixloom.plans.registry import Tables, as_text, query, rounded
from mixloom.plans.sales import BOX, _boxplot_sql
from mixloom.plans.views import PANEL_SPENDS, with_views
from mixloom.sources.staging import stage

_day = "CAST(DATE_DAY AS VARCHAR) AS DATE_DAY"


@query(
    "j5_geo_day_grid",
    with_views("grid", f"SELECT GEO, {_day} FROM grid"),
)
def geo_day_grid(t: Tables) -> DataFrame:
    return as_text(panel_ops.geo_day_grid(stage(views.panel(t))), "DATE_DAY")


_dense = [*PANEL_SPENDS, "NET_REVENUE", "DISCOUNT_RATE"]
_dense_sql = ", ".join(f"round({c}, 6) AS {c}" for c in _dense)


@query(
    "j6_densify",
    with_views(
        "dense_panel",
        f"SELECT GEO, {_day}, {_dense_sql}, CLICK_CLICKS, SIGNUP_CLICKS, VIEW_CLICKS FROM dense_panel",
    ),
)
def densify(t: Tables) -> DataFrame:
    columns = ["GEO", "DATE_DAY", *_dense, "CLICK_CLICKS", "SIGNUP_CLICKS", "VIEW_CLICKS"]
    return rounded(as_text(views.dense_panel(t).select(*columns), "DATE_DAY"), 6, *_dense)


@query(
    "j7_day_controls",
    with_views("dense_panel", f"SELECT GEO, {_day}, TREND, DAY_OF_WEEK, MONTH FROM dense_panel"),
)
def day_controls(t: Tables) -> DataFrame:
    return as_text(views.dense_panel(t).select("GEO", "DATE_DAY", "TREND", "DAY_OF_WEEK", "MONTH"), "DATE_DAY")


@query(
    "j10_anti_filter",
    with_views(
        "dense_panel",
        f"""SELECT GEO, {_day} FROM dense_panel
            WHERE DATE_DAY NOT IN (SELECT DATE_DAY FROM dense_panel WHERE NET_REVENUE = 0)""",
    ),
)
def anti_filter(t: Tables) -> DataFrame:
    panel = views.dense_panel(t)
    zero = panel.filter(F.col("NET_REVENUE") == 0).select("DATE_DAY").distinct()
    return as_text(panel.join(zero, "DATE_DAY", "left_anti").select("GEO", "DATE_DAY"), "DATE_DAY")


@query(
    "a12_daily_sum",
    with_views(
        "raw_panel",
        f"""SELECT {_day}, {", ".join(f"round(coalesce(sum({c}), 0), 4) AS {c}" for c in PANEL_SPENDS)},
                   round({" + ".join(f"coalesce(sum({c}), 0)" for c in PANEL_SPENDS)}, 4) AS TOTAL_SPEND
            FROM raw_panel GROUP BY DATE_DAY""",
    ),
)
def daily_sum(t: Tables) -> DataFrame:
    daily = descriptive.daily_sum(views.raw_panel(t), "DATE_DAY", PANEL_SPENDS, "TOTAL_SPEND")
    return rounded(as_text(daily, "DATE_DAY"), 4, *PANEL_SPENDS, "TOTAL_SPEND")


_totals = " UNION ALL ".join(
    f"SELECT '{c.removesuffix('_SPEND')}' AS channel, coalesce(sum({c}), 0) AS total_spend FROM raw_panel"
    for c in PANEL_SPENDS
)


@query("a13_spend_totals", with_views("raw_panel", f"SELECT channel, round(total_spend, 2) AS total_spend FROM ({_totals})"))
def spend_totals(t: Tables) -> DataFrame:
    totals = descriptive.column_totals(views.raw_panel(t), PANEL_SPENDS, "channel", "total_spend", "_SPEND")
    return rounded(totals.orderBy(F.desc("total_spend")), 2, "total_spend")


@query(
    "a14_spend_by_geo",
    with_views(
        "raw_panel",
        "SELECT TERRITORY_NAME, "
        + ", ".join(f"round(coalesce(sum({c}), 0), 4) AS {c.removesuffix('_SPEND')}" for c in PANEL_SPENDS)
        + " FROM raw_panel GROUP BY 1",
    ),
)
def spend_by_geo(t: Tables) -> DataFrame:
    table = descriptive.totals_by_group(views.raw_panel(t), "TERRITORY_NAME", PANEL_SPENDS, "_SPEND")
    names = [c.removesuffix("_SPEND") for c in PANEL_SPENDS]
    return rounded(table.orderBy(*[F.desc(c) for c in names]), 4, *names)


@query(
    "a15_spend_concentration",
    with_views(
        "raw_panel",
        f"""SELECT channel, round(total_spend, 2) AS total_spend,
                   round(total_spend * 100.0 / sum(total_spend) OVER (), 6) AS pct_of_total FROM ({_totals})""",
    ),
)
def spend_concentration(t: Tables) -> DataFrame:
    shares = descriptive.concentration(views.raw_panel(t), PANEL_SPENDS, "_SPEND")
    return rounded(rounded(shares, 6, "pct_of_total"), 2, "total_spend").orderBy(F.desc("pct_of_total"))


_active = " + ".join(
    f"CAST(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) < 0.8 AS BIGINT)" for c in PANEL_SPENDS
)
_ranking = f"""
    SELECT ORGANISATION_ID, CAST(max(DATE_DAY) - min(DATE_DAY) AS INTEGER) AS date_range_days,
           {_active} AS active_channels, count(*) AS n_rows
    FROM org_panel WHERE TERRITORY_NAME <> 'All Territories' GROUP BY 1"""


@query("a16_org_ranking", with_views("org_panel", _ranking))
def org_ranking(t: Tables) -> DataFrame:
    return panel_ops.org_ranking(views.org_panel(t))


@query(
    "a16_best_organisation",
    with_views("org_panel", f"{_ranking} ORDER BY active_channels DESC, date_range_days DESC, ORGANISATION_ID LIMIT 1"),
)
def best_organisation(t: Tables) -> DataFrame:
    return panel_ops.best_organisation(views.org_panel(t))


@query(
    "v9_rows_per_organisation",
    with_views(
        "org_panel",
        """SELECT ORGANISATION_ID, count(*) AS n_rows FROM org_panel GROUP BY 1
           ORDER BY n_rows DESC, ORGANISATION_ID LIMIT 10""",
    ),
)
def rows_per_organisation(t: Tables) -> DataFrame:
    return descriptive.top_values(views.org_panel(t), "ORGANISATION_ID", 10)


@query(
    "a17_seasonality_weekday",
    with_views(
        "raw_panel",
        """SELECT CAST(isodow(DATE_DAY) AS INTEGER) AS unit_no, dayname(DATE_DAY) AS unit_name,
                  round(avg(ALL_PURCHASES), 6) AS mean_value FROM raw_panel GROUP BY 1, 2""",
    ),
)
def seasonality_weekday(t: Tables) -> DataFrame:
    season = descriptive.seasonality(
        views.raw_panel(t), (F.weekday("DATE_DAY") + 1).cast("int"), F.date_format("DATE_DAY", "EEEE"), "ALL_PURCHASES"
    )
    return rounded(season.orderBy("unit_no"), 6, "mean_value")


@query(
    "a17_seasonality_month",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS unit_no, monthname(o_orderdate) AS unit_name,
              round(avg(o_totalprice), 2) AS mean_value FROM orders GROUP BY 1, 2""",
)
def seasonality_month(t: Tables) -> DataFrame:
    season = descriptive.seasonality(
        t.orders, F.month("o_orderdate"), F.date_format("o_orderdate", "MMMM"), "o_totalprice"
    )
    return rounded(season.orderBy("unit_no"), 2, "mean_value")


@query(
    "a18_anova_oneway",
    with_views(
        "raw_panel",
        """WITH g AS (SELECT isodow(DATE_DAY) AS d, count(*) AS n, avg(ALL_PURCHASES) AS m,
                             var_pop(ALL_PURCHASES) * count(*) AS w FROM raw_panel GROUP BY 1),
                o AS (SELECT avg(ALL_PURCHASES) AS gm FROM raw_panel)
           SELECT count(*) - 1 AS df_between, CAST(sum(n) AS BIGINT) - count(*) AS df_within,
                  round((sum(n * (m - gm) ** 2) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))), 6) AS f_statistic
           FROM g, o""",
    ),
)
def anova_oneway(t: Tables) -> DataFrame:
    anova = descriptive.anova_oneway(views.raw_panel(t), F.weekday("DATE_DAY"), "ALL_PURCHASES")
    return rounded(anova, 6, "f_statistic")


@query("a18_anova_p_value")
def anova_p_value(t: Tables) -> DataFrame:
    return descriptive.anova_test(views.raw_panel(t), F.weekday("DATE_DAY"), "ALL_PURCHASES")


CORR_COLUMNS = (*PANEL_SPENDS, "ALL_PURCHASES", "FIRST_PURCHASES", "ALL_PURCHASES_ORIGINAL_PRICE")
_corr = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM raw_panel"
    for a in CORR_COLUMNS
    for b in CORR_COLUMNS
)


@query("a19_corr_matrix", with_views("raw_panel", _corr))
def corr_matrix(t: Tables) -> DataFrame:
    return rounded(descriptive.corr_matrix(views.raw_panel(t), CORR_COLUMNS), 6, "r")


def _partial_sql(a: str, b: str, c: str) -> str:
    return f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
                      round((corr({a}, {b}) - corr({a}, {c}) * corr({b}, {c}))
                            / sqrt((1 - corr({a}, {c}) ** 2) * (1 - corr({b}, {c}) ** 2)), 6) AS partial_r FROM p"""


_three = ("CLICK_SPEND", "VIEW_SPEND", "ALL_PURCHASES_ORIGINAL_PRICE")
_partial = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, 1.0::DOUBLE AS partial_r"
    if a == b
    else _partial_sql(a, b, next(c for c in _three if c not in (a, b)))
    for a in _three
    for b in _three
)


@query(
    "a20_partial_corr_matrix",
    with_views(
        "raw_panel",
        f"WITH p AS (SELECT {', '.join(f'coalesce({c}, 0) AS {c}' for c in _three)} FROM raw_panel) {_partial}",
    ),
)
def partial_corr_matrix(t: Tables) -> DataFrame:
    return rounded(descriptive.partial_corr_matrix(views.raw_panel(t), _three), 6, "partial_r")


@query("a20_partial_corr_all")
def partial_corr_all(t: Tables) -> DataFrame:
    return descriptive.partial_corr_matrix(views.raw_panel(t), CORR_COLUMNS)


_filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in PANEL_SPENDS)


@query(
    "a21_outliers_by_channel",
    with_views("raw_panel", f"WITH f AS (SELECT {_filled} FROM raw_panel) {_boxplot_sql('f', PANEL_SPENDS)}"),
)
def outliers_by_channel(t: Tables) -> DataFrame:
    panel = stage(views.raw_panel(t).select(*PANEL_SPENDS).fillna(0))
    return rounded(descriptive.boxplot_stats(panel, list(PANEL_SPENDS)), 4, *BOX)


@query(
    "a24_empirical_roi",
    with_views(
        "panel",
        f"""SELECT coalesce(GEO, 'ALL') AS geo, round(sum(NET_REVENUE), 6) AS revenue, round(sum(s), 4) AS spend,
                   round(sum(NET_REVENUE) / sum(s), 6) AS roi
            FROM (SELECT GEO, NET_REVENUE, {" + ".join(PANEL_SPENDS)} AS s FROM panel) GROUP BY ROLLUP (GEO)""",
    ),
)
def empirical_roi(t: Tables) -> DataFrame:
    return rounded(rounded(panel_ops.empirical_roi(views.panel(t)), 4, "spend"), 6, "revenue", "roi")


@query(
    "m8_roi_prior",
    with_views(
        "panel",
        f"""SELECT round(ln(r), 6) AS mu, 0.5::DOUBLE AS sigma, round(r, 6) AS prior_median
            FROM (SELECT sum(NET_REVENUE) / sum({" + ".join(PANEL_SPENDS)}) AS r FROM panel)""",
    ),
)
def roi_prior(t: Tables) -> DataFrame:
    return rounded(panel_ops.roi_prior(panel_ops.empirical_roi(views.panel(t))), 6, "mu", "prior_median")


@query(
    "m1_prepare_panel",
    with_views(
        "panel",
        f"""SELECT GEO, {_day}, {", ".join(f"round({c}, 6) AS {c}" for c in _dense)}, CLICK_CLICKS, SIGNUP_CLICKS,
                   VIEW_CLICKS, TREND, DAY_OF_WEEK, MONTH FROM panel""",
    ),
)
def prepare_panel(t: Tables) -> DataFrame:
    columns = ["GEO", "DATE_DAY", *_dense, "CLICK_CLICKS", "SIGNUP_CLICKS", "VIEW_CLICKS", *panel_ops.TIME_CONTROLS]
    return rounded(as_text(views.panel(t).select(*columns), "DATE_DAY"), 6, *_dense)


_alive = """
    (SELECT DATE_DAY FROM panel GROUP BY DATE_DAY
     HAVING count(*) FILTER (NET_REVENUE <> 0) = (SELECT count(DISTINCT GEO) FROM panel))"""


@query(
    "m2_align_geo_dates",
    with_views(
        "dense_panel",
        f"""SELECT GEO, {_day}, {_dense_sql}, TREND, DAY_OF_WEEK, MONTH FROM dense_panel
            WHERE DATE_DAY NOT IN (SELECT DATE_DAY FROM dense_panel WHERE NET_REVENUE = 0)""",
    ),
)
def align_geo_dates(t: Tables) -> DataFrame:
    columns = ["GEO", "DATE_DAY", *_dense, *panel_ops.TIME_CONTROLS]
    aligned = panel_ops.align_geo_dates(views.panel(t)).select(*columns)
    return rounded(as_text(aligned, "DATE_DAY"), 6, *_dense)


@query(
    "m2_complete_days",
    with_views("panel", f"SELECT GEO, {_day}, {_dense_sql} FROM panel WHERE DATE_DAY IN {_alive}"),
)
def complete_days(t: Tables) -> DataFrame:
    kept = panel_ops.complete_days(views.panel(t)).select("GEO", "DATE_DAY", *_dense)
    return rounded(as_text(kept, "DATE_DAY"), 6, *_dense)


@query(
    "m2_rows_per_geo",
    with_views("panel", f"SELECT GEO, count(*) AS n_rows FROM panel WHERE DATE_DAY IN {_alive} GROUP BY 1"),
)
def rows_per_geo(t: Tables) -> DataFrame:
    return panel_ops.rows_per_geo(panel_ops.align_geo_dates(views.panel(t)))


@query(
    "m3_media_input",
    with_views(
        "media_long",
        """SELECT geo, CAST(day AS VARCHAR) AS day, channel, media, round(spend, 4) AS spend FROM media_long""",
    ),
)
def media_input(t: Tables) -> DataFrame:
    return rounded(as_text(panel_ops.media_input(views.dense_panel(t)), "day"), 4, "spend")


@query(
    "w5_trend_index",
    with_views("raw_panel", f"SELECT TERRITORY_NAME, {_day}, dense_rank() OVER (ORDER BY raw_panel.DATE_DAY) - 1 AS TREND FROM raw_panel"),
)
def trend_index(t: Tables) -> DataFrame:
    panel = stage(views.raw_panel(t).select("TERRITORY_NAME", "DATE_DAY"))
    return as_text(panel_ops.trend_index(panel), "DATE_DAY")


@query(
    "w5_trend_row_index",
    with_views(
        "raw_panel",
        f"""SELECT TERRITORY_NAME, {_day},
                   row_number() OVER (ORDER BY raw_panel.DATE_DAY, TERRITORY_NAME) - 1 AS TREND FROM raw_panel""",
    ),
)
def trend_row_index(t: Tables) -> DataFrame:
    panel = stage(views.raw_panel(t).select("TERRITORY_NAME", "DATE_DAY"))
    return as_text(panel_ops.trend_row_index(panel, "TERRITORY_NAME"), "DATE_DAY")


_split = """
    CASE WHEN dense_rank() OVER (ORDER BY p.DATE_DAY) - 1
              < floor(0.75 * (SELECT count(DISTINCT DATE_DAY) FROM panel)) THEN 'train' ELSE 'test' END"""


@query("w6_temporal_split", with_views("panel", f"SELECT GEO, {_day}, {_split} AS split FROM panel p"))
def temporal_split(t: Tables) -> DataFrame:
    panel = stage(views.panel(t).select("GEO", "DATE_DAY"))
    return as_text(panel_ops.temporal_split(panel), "DATE_DAY")


@query(
    "w6_temporal_split_rows",
    with_views(
        "panel",
        f"""SELECT GEO, {_day}, CASE WHEN row_number() OVER (ORDER BY p.DATE_DAY, GEO) - 1
                   < floor(0.75 * (SELECT count(*) FROM panel)) THEN 'train' ELSE 'test' END AS split FROM panel p""",
    ),
)
def temporal_split_rows(t: Tables) -> DataFrame:
    panel = stage(views.panel(t).select("GEO", "DATE_DAY"))
    return as_text(panel_ops.temporal_split_rows(panel), "DATE_DAY")


@query(
    "w7_holdout_mask",
    with_views(
        "grid",
        f"""SELECT GEO, {_day}, dense_rank() OVER (ORDER BY p.DATE_DAY) - 1
                   >= floor(0.75 * (SELECT count(DISTINCT DATE_DAY) FROM grid)) AS is_holdout FROM grid p""",
    ),
)
def holdout_mask(t: Tables) -> DataFrame:
    panel = stage(views.panel(t).select("GEO", "DATE_DAY"))
    return as_text(panel_ops.holdout_mask(panel), "DATE_DAY")


@query(
    "a36_avg_price",
    with_views(
        "raw_panel",
        """SELECT round(sum(ALL_PURCHASES_ORIGINAL_PRICE - ALL_PURCHASES_GROSS_DISCOUNT) / sum(ALL_PURCHASES), 6)
                  AS avg_price FROM raw_panel""",
    ),
)
def avg_price(t: Tables) -> DataFrame:
    return rounded(panel_ops.avg_price(views.raw_panel(t)), 6, "avg_price")
