"""Queries over sales: joins, roll-ups and customer distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import descriptive, keys, quality, revenue
from mixloom.plans import views
from mixloom.plans.registry import Tables, as_text, query, rounded
from mixloom.plans.views import with_views
from mixloom.sources.staging import stage


@query(
    "j1_star_join",
    with_views(
        "main_items",
        """SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, year, week,
                  CAST(signup_date AS VARCHAR) AS signup_date, city, state, segment, quantity,
                  round(item_discount, 6) AS item_discount, product_id, brand, category_name,
                  round(unit_price, 8) AS unit_price FROM main_items""",
    ),
)
def star_join(t: Tables) -> DataFrame:
    joined = as_text(views.main_items(t), "order_date", "signup_date")
    return rounded(rounded(joined, 6, "item_discount"), 8, "unit_price")


@query(
    "j2_price_lookup",
    with_views(
        "order_ order_item fulfilled_price",
        """SELECT i.order_id, i.product_id, o.year, o.week, i.quantity, round(p.unit_price, 8) AS unit_price
           FROM order_item i JOIN order_ o USING (order_id)
           JOIN fulfilled_price p ON p.product_id = i.product_id AND p.year = o.year AND p.week = o.week""",
    ),
)
def price_lookup(t: Tables) -> DataFrame:
    items = views.order_item(t).join(views.order(t).select("order_id", "year", "week"), "order_id")
    priced = items.join(views.fulfilled_price(t), ["product_id", "year", "week"])
    return rounded(priced.select("order_id", "product_id", "year", "week", "quantity", "unit_price"), 8, "unit_price")


@query(
    "j2_price_as_of",
    with_views(
        "order_ order_item fulfilled_price",
        """SELECT i.order_id, i.product_id, o.year, o.week, i.quantity, round(p.unit_price, 8) AS unit_price
           FROM order_item i JOIN order_ o USING (order_id)
           ASOF JOIN (SELECT product_id, year * 100 + week AS at, unit_price FROM fulfilled_price) p
             ON p.product_id = i.product_id AND o.year * 100 + o.week >= p.at""",
    ),
)
def price_as_of(t: Tables) -> DataFrame:
    items = views.order_item(t).join(views.order(t).select("order_id", "year", "week"), "order_id")
    priced = revenue.price_as_of(items, stage(views.fulfilled_price(t)))
    return rounded(priced.select("order_id", "product_id", "year", "week", "quantity", "unit_price"), 8, "unit_price")


@query(
    "j3_left_attribute",
    with_views(
        "customer_",
        """SELECT c_custkey AS customer_id, CAST(signup_date AS VARCHAR) AS signup_date, state
           FROM customer LEFT JOIN customer_ ON customer_id = c_custkey""",
    ),
)
def left_attribute(t: Tables) -> DataFrame:
    attribute = keys.first_row_per_key(views.customer(t), ["customer_id"], ["signup_date"], ["signup_date", "state"])
    base = t.customer.select(F.col("c_custkey").alias("customer_id"))
    return as_text(base.join(attribute, "customer_id", "left"), "signup_date")


@query("j11_semi_filter", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def semi_filter(t: Tables) -> DataFrame:
    pending = t.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(pending, "c_custkey", "left_semi")


@query(
    "a1_order_rollup",
    with_views(
        "order_sales",
        """SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date,
                  CAST(signup_date AS VARCHAR) AS signup_date, year, week,
                  round(gross_revenue_usd, 4) AS gross_revenue_usd, round(item_discount_usd, 4) AS item_discount_usd,
                  round(net_revenue_usd, 4) AS net_revenue_usd FROM order_sales""",
    ),
)
def order_rollup(t: Tables) -> DataFrame:
    money = ["gross_revenue_usd", "item_discount_usd", "net_revenue_usd"]
    return rounded(as_text(views.order_sales(t), "order_date", "signup_date"), 4, *money)


@query(
    "a2_customer_metrics",
    with_views(
        "order_sales",
        """SELECT customer_id, round(sum(net_revenue_usd), 4) AS total_spending,
                  count(order_id) AS purchase_frequency FROM order_sales GROUP BY 1""",
    ),
)
def customer_metrics(t: Tables) -> DataFrame:
    return rounded(revenue.customer_metrics(views.order_sales(t)), 4, "total_spending")


@query(
    "a3_revenue_by_category",
    with_views(
        "items", "SELECT category_name, round(sum(net_revenue_usd), 2) AS net_revenue FROM items GROUP BY 1"
    ),
)
def revenue_by_category(t: Tables) -> DataFrame:
    by = descriptive.sum_by(views.items(t), "category_name", "net_revenue_usd", "net_revenue")
    return rounded(by, 2, "net_revenue").orderBy("net_revenue")


@query(
    "a4_first_per_customer",
    with_views(
        "main_items",
        """SELECT customer_id, segment, state, city FROM (
             SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY segment, state, city) AS rn
             FROM main_items) WHERE rn = 1""",
    ),
)
def first_per_customer(t: Tables) -> DataFrame:
    return keys.first_row_per_key(
        views.main_items(t), ["customer_id"], ["segment", "state", "city"], ["segment", "state", "city"]
    )


@query(
    "a5_value_counts",
    """SELECT c_mktsegment, count(*) AS n_rows, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM customer), 4) AS pct
       FROM customer GROUP BY 1""",
)
def value_counts(t: Tables) -> DataFrame:
    return rounded(descriptive.value_counts(t.customer, "c_mktsegment"), 4, "pct")


@query(
    "a6_monthly_revenue",
    with_views(
        "order_sales",
        """SELECT strftime(order_date, '%Y-%m') AS year_month, round(sum(net_revenue_usd), 2) AS net_revenue
           FROM order_sales GROUP BY 1""",
    ),
)
def monthly_revenue(t: Tables) -> DataFrame:
    return rounded(revenue.monthly_revenue(views.order_sales(t)), 2, "net_revenue")


@query(
    "k4_top_places",
    with_views(
        "customer_",
        """SELECT city, count(*) AS n_rows FROM customer_ GROUP BY 1 ORDER BY n_rows DESC, city LIMIT 10""",
    ),
)
def top_places(t: Tables) -> DataFrame:
    return descriptive.top_values(views.customer(t), "city", 10)


@query(
    "k8_head",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def head(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


_metrics_cte = """
    m AS (SELECT customer_id, sum(net_revenue_usd) AS total_spending, count(order_id) AS purchase_frequency
          FROM order_sales GROUP BY 1)"""


def _boxplot_sql(source: str, columns, digits: int = 4) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(q1, {digits}) AS q1, round(q2, {digits}) AS median,
                   round(q3, {digits}) AS q3,
                   round(CAST(min(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), {digits})
                     AS whisker_low,
                   round(CAST(max(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE), {digits})
                     AS whisker_high,
                   count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
            FROM (SELECT {c} AS x FROM {source}),
                 (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3
                  FROM {source}) GROUP BY q1, q2, q3"""
        for c in columns
    )


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "a21_boxplot_customers",
    with_views("order_sales", f"WITH {_metrics_cte} {_boxplot_sql('m', ('total_spending', 'purchase_frequency'))}"),
)
def boxplot_customers(t: Tables) -> DataFrame:
    metrics = stage(revenue.customer_metrics(views.order_sales(t)))
    return rounded(descriptive.boxplot_stats(metrics, ["total_spending", "purchase_frequency"]), 4, *BOX)


@query("a21_boxplot_lines", _boxplot_sql("lineitem", ("l_quantity", "l_extendedprice"), 6))
def boxplot_lines(t: Tables) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice"]
    return rounded(descriptive.boxplot_stats(t.lineitem.select(*columns), columns), 6, *BOX)


def histogram_sql(source: str, column: str, bins: int, digits: int = 4) -> str:
    return f"""SELECT bin, round(lo + (hi - lo) / {bins}.0::DOUBLE * bin, {digits}) AS bin_low,
                      round(lo + (hi - lo) / {bins}.0::DOUBLE * (bin + 1), {digits}) AS bin_high,
                      coalesce(n, 0) AS n_rows
               FROM (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin),
                    (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source})
               LEFT JOIN (SELECT CAST(least({bins - 1}, floor(({column} - lo2) * {bins}.0::DOUBLE / (hi2 - lo2))) AS INTEGER) AS b,
                                 count(*) AS n
                          FROM {source}, (SELECT CAST(min({column}) AS DOUBLE) AS lo2, CAST(max({column}) AS DOUBLE) AS hi2
                                          FROM {source}) WHERE {column} IS NOT NULL GROUP BY 1) ON b = bin"""


@query(
    "a22_histogram_spending",
    with_views("order_sales", f"WITH {_metrics_cte} {histogram_sql('m', 'total_spending', 50)}"),
)
def histogram_spending(t: Tables) -> DataFrame:
    metrics = stage(revenue.customer_metrics(views.order_sales(t)))
    return rounded(descriptive.histogram(metrics, "total_spending", 50), 4, "bin_low", "bin_high")


@query(
    "a22_frequency_counts",
    with_views(
        "order_sales",
        f"WITH {_metrics_cte} SELECT purchase_frequency, count(*) AS n_rows FROM m GROUP BY 1",
    ),
)
def frequency_counts(t: Tables) -> DataFrame:
    metrics = revenue.customer_metrics(views.order_sales(t))
    return metrics.groupBy("purchase_frequency").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "a23_quantile_trim",
    with_views(
        "order_sales",
        f"""WITH {_metrics_cte} SELECT customer_id, round(total_spending, 4) AS total_spending FROM m
            WHERE total_spending <= (SELECT quantile_cont(total_spending, 0.99) FROM m)""",
    ),
)
def quantile_trim(t: Tables) -> DataFrame:
    metrics = stage(revenue.customer_metrics(views.order_sales(t))).select("customer_id", "total_spending")
    return rounded(descriptive.quantile_trim(metrics, "total_spending", 0.99), 4, "total_spending")


@query(
    "w1_lorenz",
    with_views(
        "order_sales",
        f"""WITH {_metrics_cte}
            SELECT customer_id, row_number() OVER w AS customer_rank,
                   round(sum(total_spending) OVER (w ROWS UNBOUNDED PRECEDING) * 100.0 / sum(total_spending) OVER (), 6)
                     AS cum_value_pct,
                   round(row_number() OVER w * 100.0::DOUBLE / count(*) OVER (), 6) AS cum_customer_pct
            FROM m WINDOW w AS (ORDER BY total_spending DESC, customer_id)""",
    ),
)
def lorenz(t: Tables) -> DataFrame:
    metrics = revenue.customer_metrics(views.order_sales(t))
    # Totals are whole rupees over the exchange rate: different ones are further apart, equal ones nearer, than 1e-6.
    curve = descriptive.lorenz(metrics, "customer_id", "total_spending", digits=6)
    return rounded(curve, 6, "cum_value_pct", "cum_customer_pct")


@query(
    "w8_first_row_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def first_row_per_key(t: Tables) -> DataFrame:
    return keys.first_row_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    "w9_running_total",
    """SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2)
              AS running_total FROM orders""",
)
def running_total(t: Tables) -> DataFrame:
    from mixloom.operators.ordering import running_totals

    base = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    totals = running_totals(base, ["o_orderdate", "o_orderkey"], {"running_total": "o_totalprice"})
    return rounded(totals.select("o_orderkey", "running_total"), 2, "running_total")


@query(
    "j12_scalar_broadcast",
    """SELECT c_custkey, round(c_acctbal * 100.0 / (SELECT sum(c_acctbal) FROM customer), 8) AS pct_of_total
       FROM customer""",
)
def scalar_broadcast(t: Tables) -> DataFrame:
    shares = quality.value_share(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "pct_of_total")
    return rounded(shares.select("c_custkey", "pct_of_total"), 8, "pct_of_total")
