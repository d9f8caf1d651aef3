"""Queries over customer scores, descriptive value and value tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import descriptive, quality, revenue, scoring
from mixloom.operators.keys import parts_of, skew_join
from mixloom.plans import views
from mixloom.plans.quality import STATS, _describe_sql
from mixloom.plans.registry import Tables, as_text, query, rounded
from mixloom.plans.sales import histogram_sql
from mixloom.plans.views import MIN_SEGMENT, with_views
from mixloom.sources.staging import stage


@query(
    "a7_rfm_raw",
    with_views(
        "rfm_raw",
        """SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary,
                  CAST(signup_date AS VARCHAR) AS signup_date, CAST(snapshot_date AS VARCHAR) AS snapshot_date
           FROM rfm_raw""",
    ),
)
def rfm_raw(t: Tables) -> DataFrame:
    return rounded(as_text(views.rfm_raw(t), "signup_date", "snapshot_date"), 4, "monetary")


@query(
    "a8_churn_rate",
    with_views(
        "rfm_raw",
        """SELECT count(*) AS n_customers, count(*) FILTER (recency > 90) AS n_churned,
                  round(count(*) FILTER (recency > 90) / CAST(count(*) AS DOUBLE), 6) AS churn_rate FROM rfm_raw""",
    ),
)
def churn_rate(t: Tables) -> DataFrame:
    return rounded(scoring.churn_rate(views.rfm_raw(t)), 6, "churn_rate")


@query(
    "b1_quantile_bins",
    """SELECT c_custkey, CAST(1 + len(list_filter(e, lambda x: c_acctbal > x)) AS INTEGER) AS balance_bin
       FROM customer, (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS e FROM customer)""",
)
def quantile_bins(t: Tables) -> DataFrame:
    base = t.customer.select("c_custkey", "c_acctbal")
    return scoring.quantile_bins(base, "c_acctbal", 5, "balance_bin").drop("c_acctbal")


@query(
    "b2_equal_width_bins",
    """SELECT c_custkey, CAST(least(5, greatest(1, ceil((c_acctbal - lo) / ((hi - lo) / 5.0::DOUBLE)))) AS INTEGER)
              AS balance_bin
       FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)""",
)
def equal_width_bins(t: Tables) -> DataFrame:
    base = t.customer.select("c_custkey", "c_acctbal")
    return scoring.equal_width_bins(base, "c_acctbal", 5, "balance_bin").drop("c_acctbal")


@query(
    "b3_assign_score_fallback",
    """WITH c AS (SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS n FROM orders GROUP BY 1),
            e AS (SELECT min(n) AS lo, max(n) AS hi, quantile_cont(n, [0.2, 0.4, 0.6, 0.8]) AS q FROM c)
       SELECT o_custkey, n,
              CAST(CASE WHEN len(list_distinct([lo] || q || [hi])) = 6 THEN 1 + len(list_filter(q, lambda x: n > x))
                        ELSE least(5, greatest(1, ceil((n - lo) / ((hi - lo) / 5.0::DOUBLE)))) END AS INTEGER) AS score,
              CASE WHEN len(list_distinct([lo] || q || [hi])) = 6 THEN 'quantile' ELSE 'equal_width' END AS score_path
       FROM c, e""",
)
def assign_score_fallback(t: Tables) -> DataFrame:
    """Few distinct counts repeat a quantile edge, so equal-width bins are used."""
    counts = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n"))
    return scoring.assign_score(stage(counts), "n", 5, "score")


RFM_COLUMNS = "customer_id, recency, frequency, round(monetary, 4) AS monetary, r_score, f_score, m_score, rfm_segment, rfm_score"


@query("b4_rfm", with_views("rfm", f"SELECT {RFM_COLUMNS} FROM rfm"))
def rfm(t: Tables) -> DataFrame:
    return rounded(views.rfm(t).drop("signup_date", "snapshot_date", "rfm_number"), 4, "monetary")


@query("b9_rfm_score_numeric", with_views("rfm", "SELECT customer_id, rfm_segment, rfm_number FROM rfm"))
def rfm_score_numeric(t: Tables) -> DataFrame:
    return views.rfm(t).select("customer_id", "rfm_segment", "rfm_number")


@query(
    "j9_nearest_segment",
    with_views(
        "segment_pairs",
        """SELECT rfm_segment, n_customers, target_segment, round(distance, 6) AS distance
           FROM segment_pairs WHERE place = 1""",
    ),
)
def nearest_segment(t: Tables) -> DataFrame:
    return rounded(scoring.segment_mapping(views.rfm(t), MIN_SEGMENT), 6, "distance")


@query(
    "j8_mapping_replace",
    with_views("pruned", "SELECT customer_id, rfm_segment, pruned_segment FROM pruned"),
)
def mapping_replace(t: Tables) -> DataFrame:
    pruned = scoring.prune_segments(views.rfm(t), MIN_SEGMENT)
    return pruned.select("customer_id", "rfm_segment", "pruned_segment")


@query(
    "b5_prune_segments",
    with_views(
        "pruned",
        """SELECT count(DISTINCT rfm_segment) AS segments_before, count(DISTINCT pruned_segment) AS segments_after,
                  count(*) FILTER (rfm_segment <> pruned_segment) AS customers_moved, count(*) AS n_customers
           FROM pruned""",
    ),
)
def prune_segments(t: Tables) -> DataFrame:
    return scoring.pruning_summary(scoring.prune_segments(views.rfm(t), MIN_SEGMENT))


@query(
    "b6_rfm_score_levels",
    with_views("rfm", "SELECT rfm_score, count(*) AS n_rows, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM rfm), 4) AS pct FROM rfm GROUP BY 1"),
)
def rfm_score_levels(t: Tables) -> DataFrame:
    return rounded(descriptive.value_counts(views.rfm(t), "rfm_score"), 4, "pct")


@query("b6_rfm_score_describe", with_views("rfm", _describe_sql("rfm", ["rfm_score"])))
def rfm_score_describe(t: Tables) -> DataFrame:
    return rounded(quality.describe(views.rfm(t), ["rfm_score"]), 4, *STATS)


@query(
    "k1_top_customers_rfm",
    with_views(
        "rfm",
        """SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary, rfm_segment, rfm_score FROM rfm
           ORDER BY rfm_score DESC, rfm_segment DESC, customer_id LIMIT 10""",
    ),
)
def top_customers_rfm(t: Tables) -> DataFrame:
    columns = ["customer_id", "recency", "frequency", "monetary", "rfm_segment", "rfm_score"]
    order = [F.desc("rfm_score"), F.desc("rfm_segment"), F.col("customer_id")]
    return rounded(scoring.top_k(views.rfm(t).select(*columns), order, 10), 4, "monetary")


@query(
    "b7_clv_descriptive",
    with_views(
        "clv",
        """SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary,
                  CAST(signup_date AS VARCHAR) AS signup_date, round(active_months, 6) AS active_months,
                  round(apv, 4) AS apv, round(pf, 6) AS pf, round(clv, 4) AS clv FROM clv""",
    ),
)
def clv_descriptive(t: Tables) -> DataFrame:
    values = rounded(as_text(views.clv(t), "signup_date"), 4, "monetary", "apv", "clv")
    return rounded(values, 6, "active_months", "pf")


@query(
    "b7_clv_by_customers",
    with_views(
        "rfm_raw",
        """SELECT customer_id, round(frequency / (SELECT CAST(count(*) AS DOUBLE) FROM rfm_raw), 8) AS pf FROM rfm_raw""",
    ),
)
def clv_by_customers(t: Tables) -> DataFrame:
    values = scoring.clv_descriptive(views.rfm_raw(t), frequency_basis="customers")
    return rounded(values.select("customer_id", "pf"), 8, "pf")


@query(
    "p20_active_customers",
    with_views("clv", "SELECT customer_id, recency, round(clv, 4) AS clv FROM clv WHERE recency <= 90"),
)
def active_customers(t: Tables) -> DataFrame:
    return rounded(scoring.active_customers(views.clv(t)).select("customer_id", "recency", "clv"), 4, "clv")


@query(
    "k2_top_customers_clv",
    with_views(
        "clv",
        """SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary, round(clv, 4) AS clv FROM clv
           ORDER BY clv.clv DESC, customer_id LIMIT 20""",
    ),
)
def top_customers_clv(t: Tables) -> DataFrame:
    columns = ["customer_id", "recency", "frequency", "monetary", "clv"]
    top = scoring.top_k(views.clv(t).select(*columns), [F.desc("clv"), F.col("customer_id")], 20)
    return rounded(top, 4, "monetary", "clv")


@query("a22_histogram_clv", with_views("clv", histogram_sql("clv", "clv", 40)))
def histogram_clv(t: Tables) -> DataFrame:
    return rounded(descriptive.histogram(views.clv(t), "clv", 40), 4, "bin_low", "bin_high")


@query(
    "b8_value_tiers",
    with_views("tiers", "SELECT customer_id, round(clv, 4) AS clv, tier, CAST(tier_rank AS INTEGER) AS tier_rank FROM tiers"),
)
def value_tiers(t: Tables) -> DataFrame:
    return rounded(views.tiers(t).select("customer_id", "clv", "tier", "tier_rank"), 4, "clv")


TIER_METRICS = ("recency", "frequency", "monetary", "apv", "pf", "clv")
_tier_means = ", ".join(f"round(avg({m}), 2) AS avg_{m}" for m in TIER_METRICS)


@query(
    "a9_segment_summary",
    with_views(
        "tiers",
        f"""SELECT tier, CAST(tier_rank AS INTEGER) AS tier_rank, count(customer_id) AS customers, {_tier_means}
            FROM tiers GROUP BY 1, 2""",
    ),
)
def segment_summary(t: Tables) -> DataFrame:
    return scoring.tier_summary(views.tiers(t))


@query(
    "k7_ordered_tiers",
    with_views(
        "tiers",
        """SELECT tier, CAST(tier_rank AS INTEGER) AS tier_rank, count(*) AS n FROM tiers GROUP BY ALL
           ORDER BY tier_rank""",
    ),
)
def ordered_tiers(t: Tables) -> DataFrame:
    return views.tiers(t).groupBy("tier", "tier_rank").agg(F.count(F.lit(1)).alias("n")).orderBy("tier_rank")


# Items of one task where they are counted on wide, nearly unique keys, which takes some 350 bytes each.
TASK_ITEMS = 500_000


def _tier_items(t: Tables, task_items: int | None = None) -> DataFrame:
    """Tiers on every item row; a customer with very many items is salted.

    The joined items are needed three times (tiers, hot keys, fan-out), so they are staged. With
    ``task_items`` no task gets many more items than that, however many there are.
    """
    items = stage(
        views.items(t).select(
            *["order_id", "customer_id", "order_date", "signup_date", "year", "week"],
            *["gross_revenue_usd", "item_discount_usd", "city", "state", "category_name", "brand"],
            F.col("segment").alias("customer_type"),
        )
    )
    raw = scoring.rfm_raw(revenue.order_rollup(items))
    tiers = scoring.value_tiers(scoring.clv_descriptive(raw)).select("customer_id", "tier", "clv")
    wanted = items.select("customer_id", "customer_type", "city", "state", "category_name", "brand")
    # Every item's customer has a tier, so the inner join from the item side equals the left join from the tiers.
    parts = None if task_items is None else parts_of(items.count(), task_items, t.spark)
    return skew_join(wanted, tiers, ["customer_id"], parts=parts)


TIER_ITEMS_SQL = """
    ti AS (SELECT t.customer_id, t.tier, t.clv, i.segment AS customer_type, i.city, i.state, i.category_name, i.brand
           FROM tiers t LEFT JOIN main_items i USING (customer_id))"""
TYPES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "j4_tier_items",
    with_views(
        "tiers main_items",
        f"""WITH {TIER_ITEMS_SQL} SELECT tier, category_name, brand, state, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers
            FROM ti GROUP BY ALL""",
    ),
)
def tier_items(t: Tables) -> DataFrame:
    per_customer = _tier_items(t, TASK_ITEMS).groupBy("tier", "category_name", "brand", "state", "customer_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_customer.groupBy("tier", "category_name", "brand", "state").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_customers")
    )


_wide = ", ".join(f"count(*) FILTER (customer_type = '{c}') AS {c}" for c in TYPES)


@query(
    "a10_crosstab_items",
    with_views("tiers main_items", f"WITH {TIER_ITEMS_SQL} SELECT tier, {_wide} FROM ti GROUP BY 1"),
)
def crosstab_items(t: Tables) -> DataFrame:
    return descriptive.crosstab(_tier_items(t), "tier", "customer_type", TYPES)


@query(
    "a10_crosstab_customers",
    with_views(
        "tiers customer_",
        f"""SELECT tier, {_wide} FROM (SELECT tier, segment AS customer_type FROM tiers JOIN customer_ USING (customer_id))
            GROUP BY 1""",
    ),
)
def crosstab_customers(t: Tables) -> DataFrame:
    joined = views.tiers(t).join(views.customer(t).select("customer_id", "segment"), "customer_id")
    return descriptive.crosstab(joined.withColumnRenamed("segment", "customer_type"), "tier", "customer_type", TYPES)


@query(
    "a11_row_share",
    with_views(
        "tiers main_items",
        f"""WITH {TIER_ITEMS_SQL} SELECT tier, category_name, count(*) AS n_rows,
                   round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY tier), 4) AS pct
            FROM ti GROUP BY 1, 2""",
    ),
)
def row_share(t: Tables) -> DataFrame:
    return rounded(descriptive.row_share(_tier_items(t), "tier", "category_name"), 4, "pct")


@query(
    "w4_top_categories_per_tier",
    with_views(
        "tiers main_items",
        f"""WITH {TIER_ITEMS_SQL} SELECT tier, category_name, n_rows, CAST(rank AS INTEGER) AS rank FROM (
              SELECT tier, category_name, count(*) AS n_rows,
                     row_number() OVER (PARTITION BY tier ORDER BY count(*) DESC, category_name) AS rank
              FROM ti GROUP BY 1, 2) WHERE rank <= 3""",
    ),
)
def top_categories_per_tier(t: Tables) -> DataFrame:
    return descriptive.top_n_per_group(_tier_items(t), "tier", "category_name", 3)


@query(
    "a9_clv_by_tier_item_weighted",
    with_views("tiers main_items", f"WITH {TIER_ITEMS_SQL} SELECT tier, round(avg(clv), 4) AS mean_clv FROM ti GROUP BY 1"),
)
def clv_by_tier_item_weighted(t: Tables) -> DataFrame:
    """Mean value per tier over item rows, so customers weigh by their items."""
    return rounded(_tier_items(t).groupBy("tier").agg(F.avg("clv").alias("mean_clv")), 4, "mean_clv")
