from pathlib import Path

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from mixloom.plans import scoring as scoring_plans
from mixloom.plans import views
from mixloom.plans.registry import Tables, load_all
from tools.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SMOKE = [
    "s6_dedupe_on_key",
    "j1_star_join",
    "a1_order_rollup",
    "b4_rfm",
    "b8_value_tiers",
    "w1_lorenz",
    "a29_roc_auc",
    "c5_bgnbd_expected_purchases",
    "m1_prepare_panel",
    "a33_roi_table",
    "m20_what_if",
]


def test_every_query_has_a_builder_and_known_sql():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) == set(load_all()) | set(entry.TEXT_QUERIES)
    assert len(queries) > 150


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
@pytest.mark.parametrize("name", SMOKE)
def test_query_equals_its_sql(spark, name):
    verdict = compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
def test_every_line_keeps_its_price_and_a_lookup_can_miss(spark):
    tables = Tables(spark, FOLDER)
    lines = tables.lineitem.count()
    assert views.main_items(tables).count() == lines
    found = load_all()["j2_price_lookup"].build(tables)
    missed = tables.lineitem.join(found, (F.col("l_orderkey") == F.col("order_id")) & (F.col("l_partkey") == F.col("product_id")), "left_anti")
    assert 0 < found.count() < lines and missed.count() > 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
def test_tier_items_are_counted_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(scoring_plans, "TASK_ITEMS", 100)
    given = []
    join = scoring_plans.skew_join

    def spied(*args, **kwargs):
        given.append(join(*args, **kwargs))
        return given[-1]

    monkeypatch.setattr(scoring_plans, "skew_join", spied)
    verdict = compare(entry.queries()["j4_tier_items"](spark, FOLDER), connect(FOLDER), entry.oracle_sql()["j4_tier_items"])
    assert verdict.startswith("ok"), verdict
    # 6,000 items of 150 customers.
    sizes = [r["count"] for r in given[0].groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 40 and max(sizes) < 500


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
def test_flagship(spark):
    assert entry.entry(spark).count() == 10
