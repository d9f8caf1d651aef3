import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mixloom.operators import revenue, scoring

D = dt.date


def items(spark, rows):
    schema = (
        "order_id int, customer_id int, order_date date, signup_date date, year int, week int, "
        "quantity double, item_discount double, unit_price double"
    )
    return revenue.line_revenue(spark.createDataFrame(rows, schema))


def test_order_takes_the_largest_discount_and_floors_net(spark):
    rows = [
        (1, 7, D(2025, 1, 2), D(2024, 1, 1), 2025, 1, 2.0, 83.0, 830.0),
        (1, 7, D(2025, 1, 2), D(2024, 1, 1), 2025, 1, 1.0, 166.0, 83.0),
        (2, 7, D(2025, 1, 9), D(2024, 1, 1), 2025, 2, 1.0, 830.0, 83.0),
    ]
    lines = items(spark, rows)
    nets = [r["net_revenue_usd"] for r in lines.orderBy("order_id", "quantity").collect()]
    assert np.allclose(nets, [-1.0, 19.0, -9.0])
    orders = {r["order_id"]: r for r in revenue.order_rollup(lines).collect()}
    assert orders[1]["gross_revenue_usd"] == pytest.approx(21.0)
    assert orders[1]["item_discount_usd"] == pytest.approx(2.0)
    assert orders[1]["net_revenue_usd"] == pytest.approx(19.0)
    assert orders[2]["net_revenue_usd"] == 0.0


def test_main_dataset_drops_items_without_a_price(spark):
    order = spark.createDataFrame([(1, 7, D(2025, 1, 2), 2025, 1)], "order_id int, customer_id int, order_date date, year int, week int")
    item = spark.createDataFrame([(1, 5, 2.0, 0.0), (1, 6, 1.0, 0.0)], "order_id int, product_id int, quantity double, item_discount double")
    product = spark.createDataFrame([(5, "c", "b"), (6, "c", "b")], "product_id int, category_id string, brand string")
    category = spark.createDataFrame([("c", "Coffee")], "category_id string, category_name string")
    customer = spark.createDataFrame([(7, D(2024, 1, 1), "x", "y", "z")], "customer_id int, signup_date date, city string, state string, segment string")
    price = spark.createDataFrame([(5, 2025, 1, 10.0), (6, 2024, 50, 4.0)], "product_id int, year int, week int, unit_price double")
    out = revenue.main_dataset(order, customer, item, product, category, price)
    assert out.columns == list(revenue.MAIN_COLUMNS)
    assert [r["product_id"] for r in out.collect()] == [5]
    timed = item.join(order.select("order_id", "year", "week"), "order_id")
    as_of = {r["product_id"]: r["unit_price"] for r in revenue.price_as_of(timed, price).collect()}
    assert as_of == {5: 10.0, 6: 4.0}


def orders(spark, rows):
    return spark.createDataFrame(
        rows, "order_id int, customer_id int, order_date date, signup_date date, net_revenue_usd double"
    )


def test_rfm_raw_counts_from_the_day_after_the_last_order(spark):
    rows = [
        (1, 1, D(2025, 1, 1), D(2024, 12, 1), 10.0),
        (2, 1, D(2025, 1, 31), D(2024, 12, 1), 5.0),
        (3, 2, D(2025, 1, 11), D(2025, 1, 1), 7.0),
    ]
    raw = {r["customer_id"]: r for r in scoring.rfm_raw(orders(spark, rows)).collect()}
    assert (raw[1]["recency"], raw[1]["frequency"], raw[1]["monetary"]) == (1, 2, 15.0)
    assert raw[2]["recency"] == 21 and raw[2]["snapshot_date"] == D(2025, 2, 1)


def pandas_score(series, bins, ascending):
    labels = list(range(1, bins + 1)) if ascending else list(range(bins, 0, -1))
    edges = np.quantile(series, np.linspace(0, 1, bins + 1))
    if len(set(edges)) == len(edges):
        return pd.qcut(series, bins, labels=labels).astype(int)
    return pd.cut(series, bins, labels=labels).astype(int)


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("kind", ["spread", "few_values"])
def test_scores_match_pandas_on_both_paths(spark, ascending, kind):
    rng = np.random.default_rng(4)
    values = rng.gamma(2.0, 50.0, 400) if kind == "spread" else rng.poisson(0.7, 400).astype(float)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, x double")
    score, path = scoring.score_columns(df, {"x": not ascending}, 5)["x"]
    got = [r[0] for r in df.withColumn("s", score).orderBy("i").select("s").collect()]
    assert path == ("quantile" if kind == "spread" else "equal_width")
    assert got == pandas_score(pd.Series(values), 5, ascending).tolist()


def scored(spark, counts):
    rows, customer = [], 0
    for segment, n in counts.items():
        for _ in range(n):
            rows.append((customer, int(segment[0]), int(segment[1]), int(segment[2]), segment))
            customer += 1
    return spark.createDataFrame(rows, "customer_id int, r_score int, f_score int, m_score int, rfm_segment string")


def test_small_segments_move_to_the_nearest_large_one_of_the_same_recency(spark):
    df = scored(spark, {"111": 1, "112": 6, "155": 5, "211": 9, "533": 2, "544": 1, "422": 5})
    mapping = {r["rfm_segment"]: r["target_segment"] for r in scoring.segment_mapping(df, 5).collect()}
    # 111 has 112 with the same R; 533 and 544 have no large segment with R = 5.
    assert mapping == {"111": "112", "533": "422", "544": "422"}
    pruned = scoring.prune_segments(df, 5)
    summary = scoring.pruning_summary(pruned).first()
    assert (summary["segments_before"], summary["segments_after"], summary["customers_moved"]) == (7, 4, 4)
    assert pruned.count() == df.count()


def test_equal_distance_goes_to_the_larger_segment(spark):
    df = scored(spark, {"333": 1, "332": 5, "334": 7})
    assert scoring.segment_mapping(df, 5).first()["target_segment"] == "334"


def test_without_a_large_segment_all_keep_theirs(spark):
    df = scored(spark, {"111": 1, "222": 2})
    pruned = scoring.prune_segments(df, 100).collect()
    assert all(r["pruned_segment"] == r["rfm_segment"] for r in pruned)


def test_value_is_null_when_nobody_churned(spark):
    rows = [(1, 1, D(2025, 1, 1), D(2024, 12, 1), 10.0), (2, 2, D(2025, 1, 2), D(2024, 12, 1), 10.0)]
    values = scoring.clv_descriptive(scoring.rfm_raw(orders(spark, rows))).collect()
    assert [r["clv"] for r in values] == [None, None] and values[0]["apv"] == 10.0


def test_value_per_month(spark):
    rows = [(1, 1, D(2025, 12, 31), D(2025, 10, 3), 12.0), (2, 2, D(2025, 1, 1), D(2024, 1, 6), 30.0)]
    values = {r["customer_id"]: r for r in scoring.clv_descriptive(scoring.rfm_raw(orders(spark, rows))).collect()}
    # Snapshot 2026-01-01; customer 1 is 90 days = 3 months old; one of two churned.
    assert values[1]["active_months"] == 3.0 and values[1]["clv"] == pytest.approx(12.0 * (1 / 3) / 0.5)
    with pytest.raises(ValueError):
        scoring.clv_descriptive(scoring.rfm_raw(orders(spark, rows)), frequency_basis="weeks")


def test_tiers_cut_at_the_quantiles(spark):
    df = spark.range(100).select(F.col("id").alias("customer_id"), F.pow(F.col("id"), F.lit(2.0)).alias("clv"))
    sizes = {r["tier"]: r["count"] for r in scoring.value_tiers(df).groupBy("tier").count().collect()}
    assert sizes == {"Bronze": 20, "Silver": 30, "Gold": 30, "Platinum": 20}
    with pytest.raises(ValueError):
        scoring.value_tiers(df.withColumn("clv", F.lit(1.0)))
