"""The retail and media domain, derived from the provided tables.

Every view has a Spark builder and the text of the same SQL common table expression.
``with_views`` puts together the expressions a query needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions.scalars import safe_ratio
from mixloom.operators import media as media_ops
from mixloom.operators import panel as panel_ops
from mixloom.operators import revenue, scoring
from mixloom.plans.registry import Tables
from mixloom.sources.staging import stage

# ---------------------------------------------------------------- retail


def order(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day.alias("order_date"),
        F.col("o_orderpriority").alias("channel_id"),
        F.col("o_orderstatus").alias("payment_type"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week"),
    )


def order_item(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        # Prices and discounts are whole rupees.
        F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("double").alias("item_discount"),
    )


def product(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category_id"), F.col("p_brand").alias("brand")
    )


def category(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_type").alias("category_id")).distinct().withColumn(
        "category_name", F.initcap("category_id")
    )


def customer(t: Tables) -> DataFrame:
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_order")
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"), F.col("r_name").alias("state")
    )
    return (
        t.customer.join(first, "c_custkey", "left")
        .join(places, "c_nationkey")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.date_sub("first_order", (F.col("c_custkey") % 60 + 1).cast("int")).alias("signup_date"),
            "city",
            "state",
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def price_change(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Weekly price list: the highest unit price among the lines of the week."""
    lines = (t.lineitem if lines is None else lines).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price"),
    )
    weeks = order(t).select("order_id", "year", "week")
    return lines.join(weeks, "order_id").groupBy("product_id", "year", "week").agg(
        F.max("price").alias("unit_price")
    )


def fulfilled_price(t: Tables) -> DataFrame:
    """Price list of fulfilled lines only; it lacks prices, as a look-up must be able to meet."""
    return price_change(t, t.lineitem.filter(F.col("l_linestatus") == "F"))


def main_items(t: Tables) -> DataFrame:
    return revenue.main_dataset(order(t), customer(t), order_item(t), product(t), category(t), price_change(t))


def items(t: Tables) -> DataFrame:
    return revenue.line_revenue(main_items(t))


def order_sales(t: Tables) -> DataFrame:
    return revenue.order_rollup(items(t))


def rfm_raw(t: Tables) -> DataFrame:
    return scoring.rfm_raw(order_sales(t))


def rfm(t: Tables) -> DataFrame:
    return scoring.rfm(rfm_raw(t))


def clv(t: Tables) -> DataFrame:
    return scoring.clv_descriptive(rfm_raw(t))


def tiers(t: Tables) -> DataFrame:
    return scoring.value_tiers(clv(t))


# Segments below this size are merged: the published size.
MIN_SEGMENT = 100

SQL: dict[str, str] = {
    "order_": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               o_orderpriority AS channel_id, o_orderstatus AS payment_type,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week
        FROM orders""",
    "order_item": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, l_quantity AS quantity,
               floor(l_extendedprice * l_discount) AS item_discount
        FROM lineitem""",
    "customer_": """
        SELECT c_custkey AS customer_id, first_order - CAST(c_custkey % 60 + 1 AS INTEGER) AS signup_date,
               n_name AS city, r_name AS state, c_mktsegment AS segment, c_acctbal AS balance
        FROM customer
        LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_order FROM orders GROUP BY 1)
               ON o_custkey = c_custkey
        JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey""",
    "price_change": """
        SELECT l_partkey AS product_id, year, week, max(floor(l_extendedprice / l_quantity)) AS unit_price
        FROM lineitem JOIN order_ ON order_id = l_orderkey GROUP BY ALL""",
    "fulfilled_price": """
        SELECT l_partkey AS product_id, year, week, max(floor(l_extendedprice / l_quantity)) AS unit_price
        FROM lineitem JOIN order_ ON order_id = l_orderkey
        WHERE l_linestatus = 'F' GROUP BY ALL""",
    "main_items": """
        SELECT i.order_id, o.customer_id, o.order_date, o.year, o.week, c.signup_date, c.city, c.state, c.segment,
               i.quantity, i.item_discount, i.product_id, p.p_brand AS brand,
               upper(p.p_type[1]) || lower(p.p_type[2:]) AS category_name, pc.unit_price
        FROM order_ o
        JOIN customer_ c ON c.customer_id = o.customer_id
        JOIN order_item i ON i.order_id = o.order_id
        JOIN part p ON p.p_partkey = i.product_id
        JOIN price_change pc ON pc.product_id = i.product_id AND pc.year = o.year AND pc.week = o.week""",
    "items": """
        SELECT *, unit_price / 83.0::DOUBLE AS unit_price_usd, item_discount / 83.0::DOUBLE AS item_discount_usd,
               quantity * (unit_price / 83.0::DOUBLE) AS gross_revenue_usd,
               quantity * (unit_price / 83.0::DOUBLE) - item_discount / 83.0::DOUBLE AS net_revenue_usd
        FROM main_items""",
    "order_sales": """
        SELECT order_id, min(customer_id) AS customer_id, min(order_date) AS order_date,
               min(signup_date) AS signup_date, min(year) AS year, min(week) AS week,
               sum(gross_revenue_usd) AS gross_revenue_usd, max(item_discount_usd) AS item_discount_usd,
               greatest(sum(gross_revenue_usd) - max(item_discount_usd), 0) AS net_revenue_usd
        FROM items GROUP BY order_id""",
    "rfm_raw": """
        SELECT customer_id,
               CAST((SELECT max(order_date) + 1 FROM order_sales) - max(order_date) AS INTEGER) AS recency,
               count(order_id) AS frequency, sum(net_revenue_usd) AS monetary, min(signup_date) AS signup_date,
               (SELECT max(order_date) + 1 FROM order_sales) AS snapshot_date
        FROM order_sales GROUP BY customer_id""",
    "rfm_edges": """
        SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS r, quantile_cont(frequency, [0.2, 0.4, 0.6, 0.8]) AS f,
               quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS m, min(recency) AS r0, max(recency) AS r5,
               min(frequency) AS f0, max(frequency) AS f5, min(monetary) AS m0, max(monetary) AS m5
        FROM rfm_raw""",
    "rfm_digits": """
        SELECT rfm_raw.*,
          CASE WHEN len(list_distinct([r0] || r || [r5])) = 6
               THEN 5 - len(list_filter(r, lambda e: recency > e))
               ELSE 6 - least(5, greatest(1, ceil((recency - r0) / ((r5 - r0) / 5.0::DOUBLE)))) END AS r_score,
          CASE WHEN len(list_distinct([f0] || f || [f5])) = 6
               THEN 1 + len(list_filter(f, lambda e: frequency > e))
               ELSE least(5, greatest(1, ceil((frequency - f0) / ((f5 - f0) / 5.0::DOUBLE)))) END AS f_score,
          CASE WHEN len(list_distinct([m0] || m || [m5])) = 6
               THEN 1 + len(list_filter(m, lambda e: monetary > e))
               ELSE least(5, greatest(1, ceil((monetary - m0) / ((m5 - m0) / 5.0::DOUBLE)))) END AS m_score
        FROM rfm_raw, rfm_edges""",
    "rfm": """
        SELECT * EXCLUDE (r_score, f_score, m_score), CAST(r_score AS INTEGER) AS r_score,
               CAST(f_score AS INTEGER) AS f_score, CAST(m_score AS INTEGER) AS m_score,
               CAST(CAST(r_score AS INTEGER) AS VARCHAR) || CAST(CAST(f_score AS INTEGER) AS VARCHAR)
                 || CAST(CAST(m_score AS INTEGER) AS VARCHAR) AS rfm_segment,
               round((r_score + f_score + m_score) / 3.0::DOUBLE, 2) AS rfm_score,
               CAST(r_score * 100 + f_score * 10 + m_score AS INTEGER) AS rfm_number
        FROM rfm_digits""",
    "segment_counts": """
        SELECT rfm_segment, r_score, f_score, m_score, count(*) AS n FROM rfm GROUP BY ALL""",
    "segment_pairs": f"""
        SELECT s.rfm_segment, s.n AS n_customers, l.rfm_segment AS target_segment,
               sqrt((s.r_score - l.r_score) ** 2 + (s.f_score - l.f_score) ** 2 + (s.m_score - l.m_score) ** 2)
                 AS distance,
               row_number() OVER (PARTITION BY s.rfm_segment ORDER BY (s.r_score = l.r_score) DESC,
                 sqrt((s.r_score - l.r_score) ** 2 + (s.f_score - l.f_score) ** 2 + (s.m_score - l.m_score) ** 2),
                 l.n DESC, l.rfm_segment) AS place
        FROM segment_counts s CROSS JOIN segment_counts l WHERE s.n < {MIN_SEGMENT} AND l.n >= {MIN_SEGMENT}""",
    "pruned": """
        SELECT rfm.*, coalesce(target_segment, rfm.rfm_segment) AS pruned_segment
        FROM rfm LEFT JOIN (SELECT rfm_segment AS small, target_segment FROM segment_pairs WHERE place = 1)
               ON small = rfm.rfm_segment""",
    "clv": """
        SELECT customer_id, recency, frequency, monetary, signup_date,
               (snapshot_date - signup_date) / 30.0::DOUBLE AS active_months, monetary / frequency AS apv,
               frequency / ((snapshot_date - signup_date) / 30.0::DOUBLE) AS pf,
               (monetary / frequency) * (frequency / ((snapshot_date - signup_date) / 30.0::DOUBLE))
                 / nullif((SELECT avg(CASE WHEN recency > 90 THEN 1.0::DOUBLE ELSE 0 END) FROM rfm_raw), 0) AS clv
        FROM rfm_raw""",
    "tiers": """
        SELECT clv.*, CASE WHEN clv > e[3] THEN 'Platinum' WHEN clv > e[2] THEN 'Gold' WHEN clv > e[1] THEN 'Silver'
                           ELSE 'Bronze' END AS tier,
               CASE WHEN clv > e[3] THEN 1 WHEN clv > e[2] THEN 2 WHEN clv > e[1] THEN 3 ELSE 4 END AS tier_rank
        FROM clv, (SELECT quantile_cont(clv, [0.2, 0.5, 0.8]) AS e FROM clv)""",
}

# ---------------------------------------------------------------- media panel

# Event types that act as media channels; ERROR is recorded without clicks.
CHANNELS = ("CLICK", "SIGNUP", "VIEW")
SPEND_ONLY = "ERROR"
PANEL_SPENDS = ("CLICK_SPEND", "SIGNUP_SPEND", "VIEW_SPEND", "ERROR_SPEND")


def _panel_aggregates():
    kind, value = F.col("event_type"), F.col("value")
    grade = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    bought = kind == "purchase"
    out = []
    for c in CHANNELS:
        is_channel = kind == c.lower()
        out.append(F.sum(F.when(is_channel, value)).alias(f"{c}_SPEND"))
        out.append(F.sum(F.when(is_channel, F.lit(1))).alias(f"{c}_CLICKS"))
    out += [
        F.sum(F.when(kind == SPEND_ONLY.lower(), value)).alias(f"{SPEND_ONLY}_SPEND"),
        F.sum(F.when(kind == "view", F.lit(2))).alias("VIEW_IMPRESSIONS"),
        F.count_if(bought).alias("ALL_PURCHASES"),
        F.count_if(bought & (grade < 50)).alias("FIRST_PURCHASES"),
        F.coalesce(F.sum(F.when(bought, value)), F.lit(0.0)).alias("ALL_PURCHASES_ORIGINAL_PRICE"),
        F.coalesce(F.sum(F.when(bought, value * grade / F.lit(1000.0))), F.lit(0.0)).alias(
            "ALL_PURCHASES_GROSS_DISCOUNT"
        ),
    ]
    return out


def geo_of() -> Column:
    return F.concat(F.lit("G"), F.lpad((F.col("user_id") % 20).cast("string"), 2, "0"))


def raw_panel(t: Tables) -> DataFrame:
    """Twenty territories by day."""
    return t.events.groupBy(geo_of().alias("TERRITORY_NAME"), F.col("ts").cast("date").alias("DATE_DAY")).agg(
        *_panel_aggregates()
    )


def org_panel(t: Tables) -> DataFrame:
    """Organisations by territory and day."""
    territory = F.when(F.col("user_id") % 3 == 0, panel_ops.ALL_TERRITORIES).otherwise(
        F.concat(F.lit("T"), (F.col("user_id") % 3).cast("string"))
    )
    org = F.concat(F.lit("ORG"), (F.col("user_id") % 7).cast("string"))
    return t.events.groupBy(
        org.alias("ORGANISATION_ID"), territory.alias("TERRITORY_NAME"), F.col("ts").cast("date").alias("DATE_DAY")
    ).agg(*_panel_aggregates())


def panel(t: Tables) -> DataFrame:
    """Prepared panel. Staged: calendar, grid and media all read it."""
    return panel_ops.prepare_panel(stage(raw_panel(t)))


def dense_panel(t: Tables) -> DataFrame:
    return stage(panel_ops.densify(panel(t)))


def media(t: Tables) -> DataFrame:
    """Long media table on the dense grid, scaled per channel."""
    return stage(media_ops.scale_media(panel_ops.media_input(dense_panel(t)), CHANNELS))


# Carry-over per channel of the response draws.
ALPHA = {"CLICK": 0.6, "SIGNUP": 0.3, "VIEW": 0.45}
DRAWS = 20


def _draw_inputs(t: Tables) -> DataFrame:
    """Revenue and clicks per draw and geo; draw d leaves out block d of the events (delete-a-group jackknife)."""
    kind = F.col("event_type")
    cells = t.events.groupBy(geo_of().alias("geo"), (F.col("event_id") % DRAWS).cast("int").alias("draw")).agg(
        F.coalesce(F.sum(F.when(kind == "purchase", F.col("value"))), F.lit(0.0)).alias("r"),
        *[F.count_if(kind == c.lower()).alias(f"n_{c}") for c in CHANNELS],
    )
    cells = stage(cells)
    names = ["r", *[f"n_{c}" for c in CHANNELS]]
    totals = cells.groupBy("geo").agg(*[F.sum(c).alias(f"all_{c}") for c in names])
    grid = totals.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(DRAWS - 1))))
    return grid.join(cells, ["geo", "draw"], "left").select(
        "geo", "draw", *[(F.col(f"all_{c}") - F.coalesce(F.col(c), F.lit(0))).alias(c) for c in names]
    )


def _day_count(t: Tables) -> DataFrame:
    return t.events.select(F.col("ts").cast("date").alias("d")).distinct().agg(F.count("d").alias("n_days"))


def draws(t: Tables) -> DataFrame:
    """Response draws: half of the left-in revenue per day, split over channels by clicks."""
    base = _draw_inputs(t).crossJoin(F.broadcast(_day_count(t)))
    total = sum([F.col(f"n_{c}") for c in CHANNELS], F.lit(0))
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("channel"), F.col(f"n_{c}").alias("n"), F.lit(ALPHA[c]).alias("alpha"))
            for c in CHANNELS
        ]
    )
    long = base.select("draw", "geo", "r", "n_days", total.alias("n_all"), F.explode(cells).alias("c"))
    beta = F.lit(0.5) * F.col("r") * safe_ratio("c.n", "n_all", 0.0) / F.col("n_days")
    return long.select(
        "draw",
        "geo",
        "c.channel",
        beta.alias("beta"),
        "c.alpha",
        F.lit(1.0).alias("ec"),
        F.lit(1.0).alias("slope"),
    )


def intercepts(t: Tables) -> DataFrame:
    base = _draw_inputs(t).crossJoin(F.broadcast(_day_count(t)))
    return base.select("draw", "geo", (F.lit(0.5) * F.col("r") / F.col("n_days")).alias("intercept"))


def _panel_sql(keys: str) -> str:
    grade = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"
    channels = ",\n".join(
        f"sum(value) FILTER (event_type = '{c.lower()}') AS {c}_SPEND, "
        f"CAST(nullif(count(*) FILTER (event_type = '{c.lower()}'), 0) AS BIGINT) AS {c}_CLICKS"
        for c in CHANNELS
    )
    return f"""
        SELECT {keys}, CAST(ts AS DATE) AS DATE_DAY, {channels},
               sum(value) FILTER (event_type = 'error') AS ERROR_SPEND,
               CAST(nullif(2 * count(*) FILTER (event_type = 'view'), 0) AS BIGINT) AS VIEW_IMPRESSIONS,
               count(*) FILTER (event_type = 'purchase') AS ALL_PURCHASES,
               count(*) FILTER (event_type = 'purchase' AND {grade} < 50) AS FIRST_PURCHASES,
               coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS ALL_PURCHASES_ORIGINAL_PRICE,
               coalesce(sum(value * {grade} / 1000.0::DOUBLE) FILTER (event_type = 'purchase'), 0)
                 AS ALL_PURCHASES_GROSS_DISCOUNT
        FROM events GROUP BY ALL"""


GEO_SQL = "'G' || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0')"
_lags = range(1, media_ops.MAX_LAG + 1)
_carried = " + ".join(
    ["scaled", *[f"power(alpha, {k}) * coalesce(lag(scaled, {k}) OVER series, 0)" for k in _lags]]
)
_weights = " + ".join(["1.0", *[f"power(alpha, {k})" for k in _lags]])
_alpha_case = "CASE channel " + " ".join(f"WHEN '{c}' THEN {a}" for c, a in ALPHA.items()) + " END"
_n_all = " + ".join(f"n_{c}" for c in CHANNELS)

SQL.update(
    {
        "raw_panel": _panel_sql(f"{GEO_SQL} AS TERRITORY_NAME"),
        "org_panel": _panel_sql(
            "'ORG' || (user_id % 7) AS ORGANISATION_ID, "
            "CASE WHEN user_id % 3 = 0 THEN 'All Territories' ELSE 'T' || (user_id % 3) END AS TERRITORY_NAME"
        ),
        "panel": """
            SELECT TERRITORY_NAME AS GEO, DATE_DAY, coalesce(CLICK_SPEND, 0) AS CLICK_SPEND,
                   coalesce(CLICK_CLICKS, 0) AS CLICK_CLICKS, coalesce(SIGNUP_SPEND, 0) AS SIGNUP_SPEND,
                   coalesce(SIGNUP_CLICKS, 0) AS SIGNUP_CLICKS, coalesce(VIEW_SPEND, 0) AS VIEW_SPEND,
                   coalesce(VIEW_CLICKS, 0) AS VIEW_CLICKS, coalesce(ERROR_SPEND, 0) AS ERROR_SPEND,
                   VIEW_IMPRESSIONS, ALL_PURCHASES, FIRST_PURCHASES, ALL_PURCHASES_ORIGINAL_PRICE,
                   ALL_PURCHASES_GROSS_DISCOUNT,
                   ALL_PURCHASES_ORIGINAL_PRICE - ALL_PURCHASES_GROSS_DISCOUNT AS NET_REVENUE,
                   coalesce(ALL_PURCHASES_GROSS_DISCOUNT / nullif(ALL_PURCHASES_ORIGINAL_PRICE, 0), 0)
                     AS DISCOUNT_RATE,
                   dense_rank() OVER (ORDER BY DATE_DAY) - 1 AS TREND,
                   CAST(isodow(DATE_DAY) AS INTEGER) AS DAY_OF_WEEK, CAST(month(DATE_DAY) AS INTEGER) AS MONTH
            FROM raw_panel""",
        "grid": """
            SELECT GEO, DATE_DAY FROM (SELECT DISTINCT GEO FROM panel)
            CROSS JOIN (SELECT DISTINCT DATE_DAY FROM panel)""",
        "dense_panel": """
            SELECT GEO, DATE_DAY, coalesce(CLICK_SPEND, 0) AS CLICK_SPEND, coalesce(CLICK_CLICKS, 0) AS CLICK_CLICKS,
                   coalesce(SIGNUP_SPEND, 0) AS SIGNUP_SPEND, coalesce(SIGNUP_CLICKS, 0) AS SIGNUP_CLICKS,
                   coalesce(VIEW_SPEND, 0) AS VIEW_SPEND, coalesce(VIEW_CLICKS, 0) AS VIEW_CLICKS,
                   coalesce(ERROR_SPEND, 0) AS ERROR_SPEND, coalesce(VIEW_IMPRESSIONS, 0) AS VIEW_IMPRESSIONS,
                   coalesce(ALL_PURCHASES, 0) AS ALL_PURCHASES, coalesce(NET_REVENUE, 0) AS NET_REVENUE,
                   coalesce(DISCOUNT_RATE, 0) AS DISCOUNT_RATE, day_trend AS TREND, day_dow AS DAY_OF_WEEK,
                   day_month AS MONTH
            FROM grid
            JOIN (SELECT DATE_DAY, min(TREND) AS day_trend, min(DAY_OF_WEEK) AS day_dow, min(MONTH) AS day_month
                  FROM panel GROUP BY 1) USING (DATE_DAY)
            LEFT JOIN panel USING (GEO, DATE_DAY)""",
        "media_long": "\n UNION ALL ".join(
            f"SELECT GEO AS geo, DATE_DAY AS day, '{c}' AS channel, CAST({c}_CLICKS AS DOUBLE) AS media, "
            f"CAST({c}_SPEND AS DOUBLE) AS spend FROM dense_panel"
            for c in CHANNELS
        ),
        "media": """
            SELECT m.*, coalesce(media / unit, 0) AS scaled FROM media_long m
            JOIN (SELECT channel, quantile_cont(media, 0.5) FILTER (media > 0) AS unit FROM media_long GROUP BY 1)
              USING (channel)""",
        "draw_cells": f"""
            SELECT {GEO_SQL} AS geo, CAST(event_id % {DRAWS} AS INTEGER) AS draw,
                   coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS r,
                   {", ".join(f"count(*) FILTER (event_type = '{c.lower()}') AS n_{c}" for c in CHANNELS)}
            FROM events GROUP BY ALL""",
        "draw_inputs": f"""
            SELECT t.geo, CAST(d AS INTEGER) AS draw, t.r - coalesce(c.r, 0) AS r,
                   {", ".join(f"t.n_{c} - coalesce(c.n_{c}, 0) AS n_{c}" for c in CHANNELS)},
                   (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS n_days
            FROM (SELECT geo, sum(r) AS r, {", ".join(f"CAST(sum(n_{c}) AS BIGINT) AS n_{c}" for c in CHANNELS)}
                  FROM draw_cells GROUP BY geo) t
            CROSS JOIN (SELECT unnest(range({DRAWS})) AS d)
            LEFT JOIN draw_cells c ON c.geo = t.geo AND c.draw = d""",
        "draws": "\n UNION ALL ".join(
            f"SELECT draw, geo, '{c}' AS channel, "
            f"0.5::DOUBLE * r * coalesce(CAST(n_{c} AS DOUBLE) / nullif({_n_all}, 0), 0) / n_days AS beta, "
            f"{ALPHA[c]}::DOUBLE AS alpha, 1.0::DOUBLE AS ec, 1.0::DOUBLE AS slope FROM draw_inputs"
            for c in CHANNELS
        ),
        "intercepts": "SELECT draw, geo, 0.5::DOUBLE * r / n_days AS intercept FROM draw_inputs",
        "carried": f"""
            SELECT geo, day, channel, media, spend, scaled, ({_carried}) / ({_weights}) AS adstocked
            FROM (SELECT *, CAST({_alpha_case} AS DOUBLE) AS alpha FROM media)
            WINDOW series AS (PARTITION BY geo, channel ORDER BY day)""",
        "contributions": """
            SELECT draw, geo, day, channel, beta * (adstocked / (adstocked + ec)) AS contribution
            FROM draws JOIN carried USING (geo, channel)""",
        "contribution_medians": """
            SELECT geo, day, channel, q[1] AS low, q[2] AS median, q[3] AS high
            FROM (SELECT geo, day, channel, quantile_cont(contribution, [0.025, 0.5, 0.975]) AS q
                  FROM contributions GROUP BY ALL)""",
        "expected": """
            SELECT draw, geo, day, media_total, intercept + media_total AS expected, intercept AS baseline
            FROM (SELECT draw, geo, day, sum(contribution) AS media_total FROM contributions GROUP BY ALL)
            JOIN intercepts USING (draw, geo)""",
        "channel_spend": "SELECT channel, sum(spend) AS spend_total FROM media GROUP BY channel",
        "roi_draws": """
            SELECT draw, channel, sum(beta * (adstocked / (adstocked + ec))) AS base,
                   sum(beta * (adstocked * 1.01 / (adstocked * 1.01 + ec))) AS bumped
            FROM draws JOIN carried USING (geo, channel) GROUP BY ALL""",
        "roi": """
            SELECT channel, q[1] AS roi_low, q[2] AS roi_median, q[3] AS roi_high
            FROM (SELECT channel, quantile_cont(base / nullif(spend_total, 0), [0.025, 0.5, 0.975]) AS q
                  FROM roi_draws JOIN channel_spend USING (channel) GROUP BY channel)""",
        "mroi": """
            SELECT channel, q[1] AS mroi_low, q[2] AS mroi_median, q[3] AS mroi_high
            FROM (SELECT channel,
                         quantile_cont((bumped - base) / nullif(spend_total * 0.01, 0), [0.025, 0.5, 0.975]) AS q
                  FROM roi_draws JOIN channel_spend USING (channel) GROUP BY channel)""",
        "metrics": """
            SELECT channel, spend_total, roi_median, mroi_median, mroi_median < 1 AS is_saturated
            FROM channel_spend JOIN roi USING (channel) JOIN mroi USING (channel)""",
    }
)
_order = list(SQL)


def with_views(names: str, body: str) -> str:
    """``body`` behind the common table expressions ``names`` and everything they use."""
    needed: set[str] = set()

    def visit(name):
        if name in needed:
            return
        needed.add(name)
        words = set(SQL[name].replace(",", " ").replace("(", " ").replace(")", " ").replace(".", " ").split())
        for other in _order:
            if other != name and other in words:
                visit(other)

    for name in names.split():
        visit(name)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in _order if n in needed)
    body = body.strip()
    own = f",\n{body.removeprefix('WITH ')}" if body.startswith("WITH ") else f"\n{body}"
    return f"WITH {parts}{own}"
