"""Queries over data-quality reports and scalar operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.functions import dates, scalars
from mixloom.operators import descriptive, keys, quality
from mixloom.operators import panel as panel_ops
from mixloom.plans import views
from mixloom.plans.registry import Tables, as_text, query, rounded
from mixloom.plans.views import PANEL_SPENDS, with_views
from mixloom.sources.staging import stage


@query("v1_check_pk", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_pk(t: Tables) -> DataFrame:
    return keys.check_pk(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "v2_check_fk",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def check_fk(t: Tables) -> DataFrame:
    return keys.check_fk(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey", "o_custkey")


@query("v3_check_columns", "SELECT DISTINCT 'TIKTOK_SPEND' AS missing_column FROM events")
def check_columns(t: Tables) -> DataFrame:
    expected = ["ORGANISATION_ID", "TERRITORY_NAME", "DATE_DAY", "ALL_PURCHASES", "TIKTOK_SPEND"]
    panel = views.org_panel(t)
    missing = quality.check_columns(panel, expected)
    return panel.select(F.explode(F.array(*[F.lit(c) for c in missing])).alias("missing_column")).distinct()


@query("v4_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape(t: Tables) -> DataFrame:
    return quality.shape(t.lineitem)


_missing = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, count(*) AS n FROM raw_panel"
    for c in [*PANEL_SPENDS, "CLICK_CLICKS", "SIGNUP_CLICKS", "VIEW_CLICKS", "VIEW_IMPRESSIONS", "ALL_PURCHASES"]
)


@query(
    "v5_missing_report",
    with_views(
        "raw_panel",
        f"""SELECT column_name, n_missing, round(n_missing * 100.0::DOUBLE / n, 2) AS pct_missing
            FROM ({_missing}) WHERE n_missing > 0""",
    ),
)
def missing_report(t: Tables) -> DataFrame:
    return quality.missing_report(views.raw_panel(t))


_shares = " UNION ALL ".join(
    f"SELECT TERRITORY_NAME, '{c}' AS column_name, "
    f"round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS missing_share FROM raw_panel GROUP BY 1"
    for c in PANEL_SPENDS
)


@query("v6_missing_share_by_group", with_views("raw_panel", _shares))
def missing_share_by_group(t: Tables) -> DataFrame:
    report = quality.missing_share_by_group(views.raw_panel(t), "TERRITORY_NAME", PANEL_SPENDS)
    return rounded(report, 6, "missing_share")


_flags = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in PANEL_SPENDS)


@query(
    "v7_missing_matrix",
    with_views("raw_panel", f"SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY, {_flags} FROM raw_panel"),
)
def missing_matrix(t: Tables) -> DataFrame:
    matrix = quality.missing_matrix(views.raw_panel(t), ["DATE_DAY", "TERRITORY_NAME"], PANEL_SPENDS)
    return as_text(matrix.orderBy("DATE_DAY", "TERRITORY_NAME"), "DATE_DAY")


def _describe_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,
               round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
               round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
               round(quantile_cont({c}, 0.75), 4) AS q75, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {source}"""
        for c in columns
    )


STATS = ("mean", "std", "min", "q25", "q50", "q75", "max")
RFM_METRICS = ("recency", "frequency", "monetary")


@query("v8_describe_rfm", with_views("rfm_raw", _describe_sql("rfm_raw", RFM_METRICS)))
def describe_rfm(t: Tables) -> DataFrame:
    return rounded(quality.describe(views.rfm_raw(t), RFM_METRICS), 4, *STATS)


LINE_METRICS = ("l_quantity", "l_extendedprice", "l_discount")


@query("v8_describe_lines", _describe_sql("lineitem", LINE_METRICS))
def describe_lines(t: Tables) -> DataFrame:
    return rounded(quality.describe(t.lineitem.select(*LINE_METRICS), LINE_METRICS), 4, *STATS)


@query(
    "v9_profile_keys",
    with_views(
        "org_panel",
        """SELECT count(DISTINCT ORGANISATION_ID) AS n_organisations, count(DISTINCT TERRITORY_NAME) AS n_territories,
                  CAST(min(DATE_DAY) AS VARCHAR) AS first_day, CAST(max(DATE_DAY) AS VARCHAR) AS last_day
           FROM org_panel""",
    ),
)
def profile_keys(t: Tables) -> DataFrame:
    profile = quality.profile_keys(views.org_panel(t), "ORGANISATION_ID", "TERRITORY_NAME", "DATE_DAY")
    return as_text(profile, "first_day", "last_day")


@query(
    "v10_temporal_range",
    with_views(
        "order_",
        """SELECT min(year) AS min_year, max(year) AS max_year, min(week) AS min_week, max(week) AS max_week
           FROM order_""",
    ),
)
def temporal_range(t: Tables) -> DataFrame:
    return quality.temporal_range(views.order(t), ["year", "week"])


_active = " + ".join(f"CAST(coalesce(sum({c}), 0) > 0 AS INTEGER)" for c in PANEL_SPENDS)


@query(
    "v11_train_readiness",
    with_views(
        "panel",
        f"""WITH s AS (SELECT (max(DATE_DAY) - min(DATE_DAY)) / 7.0::DOUBLE AS w, CAST({_active} AS DOUBLE) AS a FROM panel)
            SELECT 'train_weeks' AS check_name, round(w, 6) AS value, w >= 104 AS passed FROM s
            UNION ALL SELECT 'active_channels', a, a >= 3 FROM s
            UNION ALL SELECT 'target_present', 1.0, TRUE FROM s
            UNION ALL SELECT 'missing_time_controls', 0.0, TRUE FROM s""",
    ),
)
def train_readiness(t: Tables) -> DataFrame:
    panel = views.panel(t)
    checks = quality.train_readiness(
        panel, "DATE_DAY", panel_ops.spend_columns(panel), "NET_REVENUE", panel_ops.TIME_CONTROLS
    )
    return rounded(checks, 6, "value")


# ---------------------------------------------------------------- scalar operators


@query(
    "p1_split_features_target",
    """SELECT c_mktsegment, count(*) AS n_rows, round(sum(c_acctbal), 2) AS target_sum FROM customer GROUP BY 1""",
)
def split_features_target(t: Tables) -> DataFrame:
    base = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    features, _ = quality.split_features_target(base, "c_acctbal")
    target = base.select("c_custkey", "c_acctbal")
    return features.join(target, "c_custkey").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("c_acctbal"), 2).alias("target_sum")
    )


_order_roles = [
    ("categorical", "o_orderstatus"),
    ("categorical", "o_orderpriority"),
    ("numeric", "o_totalprice"),
    ("date", "o_orderdate"),
]


@query(
    "p2_column_types",
    " UNION ALL ".join(
        f"SELECT '{k}' AS role, '{c}' AS column_name, count({c}) AS n_values FROM orders" for k, c in _order_roles
    ),
)
def column_types(t: Tables) -> DataFrame:
    df = t.orders
    roles = quality.column_types(df, exclude=["o_orderkey", "o_custkey"])
    return _column_counts(df, [(role, c) for role, columns in roles.items() for c in columns])


def _column_counts(df: DataFrame, labelled) -> DataFrame:
    """Non-NULL values of the columns a metadata operator picked."""
    counts = df.agg(*[F.count(c).alias(c) for _, c in labelled])
    cells = F.array(
        *[F.struct(F.lit(k).alias("role"), F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for k, c in labelled]
    )
    return counts.select(F.explode(cells).alias("x")).select("x.*")


_media_roles = [("spend", c) for c in PANEL_SPENDS] + [
    ("clicks", "CLICK_CLICKS"),
    ("clicks", "SIGNUP_CLICKS"),
    ("clicks", "VIEW_CLICKS"),
    ("impressions", "VIEW_IMPRESSIONS"),
]


def _roles_sql(roles) -> str:
    return " UNION ALL ".join(
        f"SELECT '{k}' AS role, '{c}' AS column_name, count({c}) AS n_values FROM raw_panel" for k, c in roles
    )


@query("p3_media_channels", with_views("raw_panel", _roles_sql(_media_roles)))
def media_channels(t: Tables) -> DataFrame:
    panel = views.raw_panel(t)
    found = panel_ops.media_channels(panel)
    roles = [(k, c) for k in ("spend", "clicks", "impressions") for c in found[f"{k}_cols"]]
    return _column_counts(panel, roles)


@query("p4_paired_channels", with_views("raw_panel", _roles_sql([("paired", f"{c}_SPEND") for c in views.CHANNELS])))
def paired_channels(t: Tables) -> DataFrame:
    panel = views.raw_panel(t)
    return _column_counts(panel, [("paired", f"{c}_SPEND") for c in panel_ops.paired_channels(panel)])


@query(
    "p5_select_firm",
    with_views(
        "org_panel",
        """SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY, ALL_PURCHASES FROM org_panel
           WHERE ORGANISATION_ID = 'ORG3' AND TERRITORY_NAME <> 'All Territories'""",
    ),
)
def select_firm(t: Tables) -> DataFrame:
    firm = panel_ops.select_firm(views.org_panel(t), "ORG3")
    return as_text(firm.select("TERRITORY_NAME", "DATE_DAY", "ALL_PURCHASES"), "DATE_DAY")


@query(
    "p6_line_revenue",
    with_views(
        "items",
        """SELECT order_id, product_id, quantity, round(unit_price_usd, 4) AS unit_price_usd,
                  round(item_discount_usd, 4) AS item_discount_usd, round(gross_revenue_usd, 4) AS gross_revenue_usd,
                  round(net_revenue_usd, 4) AS net_revenue_usd FROM items""",
    ),
)
def line_revenue(t: Tables) -> DataFrame:
    money = ["unit_price_usd", "item_discount_usd", "gross_revenue_usd", "net_revenue_usd"]
    return rounded(views.items(t).select("order_id", "product_id", "quantity", *money), 4, *money)


@query(
    "p7_clip_lower",
    "SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 1000 ELSE c_acctbal END AS clipped FROM customer",
)
def clip_lower(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", scalars.clip_lower("c_acctbal", 1000.0).alias("clipped"))


@query(
    "p8_safe_ratio",
    with_views(
        "raw_panel",
        """SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY,
                  round(coalesce(ALL_PURCHASES_GROSS_DISCOUNT / nullif(ALL_PURCHASES_ORIGINAL_PRICE, 0), 0), 6)
                    AS discount_rate FROM raw_panel""",
    ),
)
def safe_ratio(t: Tables) -> DataFrame:
    rate = scalars.safe_ratio("ALL_PURCHASES_GROSS_DISCOUNT", "ALL_PURCHASES_ORIGINAL_PRICE", 0.0)
    panel = views.raw_panel(t).select("TERRITORY_NAME", "DATE_DAY", rate.alias("discount_rate"))
    return rounded(as_text(panel, "DATE_DAY"), 6, "discount_rate")


# The published limit.
SPARSE_SHARE = 0.70


_sparse = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(sum(total), 2) AS total_spend FROM (
          SELECT avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS missing, coalesce(sum({c}), 0) AS total
          FROM raw_panel GROUP BY TERRITORY_NAME) HAVING max(missing) <= {SPARSE_SHARE}"""
    for c in PANEL_SPENDS
)


@query("p9_drop_sparse_channels", with_views("raw_panel", _sparse))
def drop_sparse_channels(t: Tables) -> DataFrame:
    kept = panel_ops.drop_sparse_channels(views.raw_panel(t), "TERRITORY_NAME", SPARSE_SHARE)
    totals = descriptive.column_totals(kept, panel_ops.spend_columns(kept), "column_name", "total_spend")
    return rounded(totals, 2, "total_spend")


_filled = ", ".join(f"round(coalesce({c}, 0), 4) AS {c}" for c in PANEL_SPENDS)


@query(
    "p10_fill_zero",
    with_views("raw_panel", f"SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY, {_filled} FROM raw_panel"),
)
def fill_zero(t: Tables) -> DataFrame:
    panel = views.raw_panel(t).select("TERRITORY_NAME", "DATE_DAY", *PANEL_SPENDS).fillna(0, subset=list(PANEL_SPENDS))
    return rounded(as_text(panel, "DATE_DAY"), 4, *PANEL_SPENDS)


@query(
    "p12_drop_columns",
    with_views(
        "org_panel",
        """SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY, count(*) AS n_rows FROM org_panel
           GROUP BY 1, 2""",
    ),
)
def drop_columns(t: Tables) -> DataFrame:
    kept = views.org_panel(t).drop(*panel_ops.UNUSED_COLUMNS)
    return as_text(kept.groupBy("TERRITORY_NAME", "DATE_DAY").agg(F.count(F.lit(1)).alias("n_rows")), "DATE_DAY")


@query(
    "p13_time_features",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, dayname(o_orderdate) AS day_name,
              CAST(month(o_orderdate) AS INTEGER) AS month, monthname(o_orderdate) AS month_name,
              strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""",
)
def time_features(t: Tables) -> DataFrame:
    return dates.add_calendar(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query(
    "p14_net_revenue",
    with_views(
        "raw_panel",
        """SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY,
                  round(ALL_PURCHASES_ORIGINAL_PRICE - ALL_PURCHASES_GROSS_DISCOUNT, 6) AS NET_REVENUE
           FROM raw_panel""",
    ),
)
def net_revenue(t: Tables) -> DataFrame:
    net = F.col("ALL_PURCHASES_ORIGINAL_PRICE") - F.col("ALL_PURCHASES_GROSS_DISCOUNT")
    panel = views.raw_panel(t).select("TERRITORY_NAME", "DATE_DAY", net.alias("NET_REVENUE"))
    return rounded(as_text(panel, "DATE_DAY"), 6, "NET_REVENUE")


@query(
    "p15_date_arithmetic",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 1 AS VARCHAR) AS next_day,
              CAST((SELECT max(CAST(o_orderdate AS DATE)) + 1 FROM orders) - CAST(o_orderdate AS DATE) AS INTEGER)
                AS days_ago,
              CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start,
              CAST((CAST(date_trunc('week', o_orderdate) AS DATE) - DATE '1969-12-29') / 7 AS INTEGER) AS week_no
       FROM orders""",
)
def date_arithmetic(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    last = t.orders.agg(F.date_add(F.max(day), 1).alias("snapshot"))
    return t.orders.crossJoin(F.broadcast(last)).select(
        "o_orderkey",
        F.date_add(day, 1).cast("string").alias("next_day"),
        F.datediff("snapshot", day).alias("days_ago"),
        F.date_trunc("week", day).cast("date").cast("string").alias("week_start"),
        dates.period_index(day).alias("week_no"),
    )


@query(
    "p16_string_ops",
    """SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, replace(c_name, 'Customer#', '') AS without_prefix,
              substr(c_mktsegment, 1, 4) AS short_segment,
              CAST(c_nationkey AS VARCHAR) || CAST(c_custkey % 10 AS VARCHAR) AS joined_digits,
              starts_with(c_mktsegment, 'M') AS starts_m, ends_with(c_mktsegment, 'Y') AS ends_y FROM customer""",
)
def string_ops(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
        F.regexp_replace("c_name", "^Customer#", "").alias("without_prefix"),
        F.substring("c_mktsegment", 1, 4).alias("short_segment"),
        F.concat(F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 10).cast("string")).alias("joined_digits"),
        F.col("c_mktsegment").startswith("M").alias("starts_m"),
        F.col("c_mktsegment").endswith("Y").alias("ends_y"),
    )


@query(
    "p17_math_ops",
    """SELECT c_custkey, round(ln(abs(c_acctbal) + 1), 6) AS log_balance, round(sqrt(abs(c_acctbal)), 6) AS root_balance,
              round(power(c_nationkey, 1.5), 6) AS power_nation, round(c_acctbal / 7, 2) AS rounded
       FROM customer""",
)
def math_ops(t: Tables) -> DataFrame:
    balance = F.abs("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.round(F.log(balance + 1), 6).alias("log_balance"),
        F.round(F.sqrt(balance), 6).alias("root_balance"),
        F.round(F.pow(F.col("c_nationkey"), F.lit(1.5)), 6).alias("power_nation"),
        F.round(F.col("c_acctbal") / 7, 2).alias("rounded"),
    )


@query(
    "p22_not_null_pairs",
    with_views(
        "raw_panel",
        """SELECT count(*) FILTER (CLICK_SPEND IS NOT NULL AND VIEW_SPEND IS NOT NULL) AS n_kept,
                  count(*) FILTER (CLICK_SPEND IS NULL OR VIEW_SPEND IS NULL) AS n_excluded FROM raw_panel""",
    ),
)
def not_null_pairs(t: Tables) -> DataFrame:
    return quality.excluded_pairs(views.raw_panel(t), "CLICK_SPEND", "VIEW_SPEND")


@query("u3_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query(
    "u4_set_difference",
    "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def set_difference(t: Tables) -> DataFrame:
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return keys.missing_keys(t.customer, urgent, "c_custkey")


@query(
    "u5_pivot",
    with_views(
        "raw_panel",
        """SELECT TERRITORY_NAME, round(sum(CLICK_SPEND) FILTER (month(DATE_DAY) = 1 AND day(DATE_DAY) <= 15), 2) AS first_half,
                  round(sum(CLICK_SPEND) FILTER (day(DATE_DAY) > 15), 2) AS second_half FROM raw_panel GROUP BY 1""",
    ),
)
def pivot(t: Tables) -> DataFrame:
    half = F.when(F.dayofmonth("DATE_DAY") <= 15, "first_half").otherwise("second_half")
    wide = (
        views.raw_panel(t)
        .withColumn("half", half)
        .groupBy("TERRITORY_NAME")
        .pivot("half", ["first_half", "second_half"])
        .agg(F.sum("CLICK_SPEND"))
    )
    return rounded(wide, 2, "first_half", "second_half")


_long = " UNION ALL ".join(
    f"SELECT TERRITORY_NAME, CAST(DATE_DAY AS VARCHAR) AS DATE_DAY, '{c}' AS column_name, round({c}, 4) AS value FROM raw_panel"
    for c in PANEL_SPENDS
)


@query("u6_unpivot", with_views("raw_panel", _long))
def unpivot(t: Tables) -> DataFrame:
    long = views.raw_panel(t).unpivot(["TERRITORY_NAME", "DATE_DAY"], list(PANEL_SPENDS), "column_name", "value")
    return rounded(as_text(long, "DATE_DAY"), 4, "value")


@query(
    "u7_transpose_report",
    """SELECT unnest(['customers', 'balance_mean', 'balance_max']) AS metric,
              unnest([CAST(count(*) AS DOUBLE), round(avg(c_acctbal), 4), max(c_acctbal)]) AS value FROM customer""",
)
def transpose_report(t: Tables) -> DataFrame:
    report = t.customer.agg(
        F.count(F.lit(1)).cast("double").alias("customers"),
        F.round(F.avg("c_acctbal"), 4).alias("balance_mean"),
        F.max("c_acctbal").alias("balance_max"),
    )
    return report.unpivot([], report.columns, "metric", "value")
