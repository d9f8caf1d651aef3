import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.operators import churn, evaluation, mixfit
from mixloom.operators import panel as panel_ops
from mixloom.sources import readers, schemas, staging, writers


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_contract_marks_malformed_cells(spark, tmp_path):
    path = write(tmp_path / "churn.csv", "age,gender\n31,F\nold,M\n,F\n")
    contract = T.StructType.fromDDL("age int, gender string")
    df = readers.read_csv(spark, path, contract, keep_corrupt=True)
    row = readers.corrupt_count(df).first()
    assert (row["n_rows"], row["n_corrupt"], row["n_age"], row["n_gender"]) == (3, 1, 1, 3)
    assert readers.read_csv_inferred(spark, path).count() == 3
    with pytest.raises(Exception):
        readers.read_csv(spark, path, T.StructType.fromDDL("years int, gender string")).collect()


def test_schema_contract_round_trip(spark, tmp_path):
    df = spark.createDataFrame([], schemas.CHURN_SCHEMA)
    readers.freeze_schema(df, str(tmp_path / "contract"))
    assert readers.load_schema(spark, str(tmp_path / "contract")) == schemas.CHURN_SCHEMA
    pretty = write(tmp_path / "pretty.json", '{"type": "struct",\n "fields": [{"name": "a", "type": "integer", "nullable": true, "metadata": {}}]}')
    assert readers.load_schema(spark, pretty).names == ["a"]


def test_ingest_dedupes_and_reads_both_date_layouts(spark, tmp_path):
    write(
        tmp_path / "PROMOTION.csv",
        "promo_id,promo_type,start_date,end_date,discount_value\n"
        "P1,PCT_OFF,2025-01-01,29-01-2025,10.0\nP2,BOGO,bad,2025-02-01,\nP1,PCT_OFF,2025-01-01,29-01-2025,10.0\n",
    )
    tables = readers.ingest(spark, str(tmp_path), str(tmp_path / "out"), ["promotion"])
    rows = {r["promo_id"]: r for r in tables["promotion"].collect()}
    assert len(rows) == 2 and str(rows["P1"]["end_date"]) == "2025-01-29"
    assert rows["P2"]["start_date"] is None and rows["P2"]["discount_value"] is None


def test_catalogue_is_in_dependency_order():
    seen = set()
    for name, spec in schemas.TABLES.items():
        assert set(spec.parents.values()) <= seen and set(spec.key) <= set(spec.schema.names)
        seen.add(name)
    assert len(seen) == 14


def test_tables_and_predictions_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 1.0, 0.75)], "k string, x double, predicted_class double, predicted_probability double")
    writers.save_predictions(df, str(tmp_path / "p"), ["k"])
    back = writers.load_table(spark, str(tmp_path / "p"), T.StructType.fromDDL("k string, predicted_class double, predicted_probability double"))
    assert tuple(back.first()) == ("a", 1.0, 0.75)
    writers.save_predictions(df, str(tmp_path / "q"), ["k", "x"], "parquet")
    assert spark.read.parquet(str(tmp_path / "q")).columns == ["k", "x", "predicted_class", "predicted_probability"]


def test_sql_text_as_a_source(spark):
    df = spark.range(5)
    assert readers.sql_source(spark, "SELECT max(id) AS m FROM {t}", t=df).first()[0] == 4


def test_stage_writes_below_the_configured_folder(spark):
    staged = staging.stage(spark.range(3))
    assert staged.count() == 3
    assert f"{staging.staging_root(spark).removeprefix('file:')}/mixloom-" in staged.inputFiles()[0]


# ---------------------------------------------------------------- churn


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(12)
    rows = []
    for i in range(800):
        spend, visits, region = rng.gamma(2.0, 40.0), int(rng.integers(0, 20)), str(rng.choice(["n", "s", "e"]))
        risk = 1 / (1 + np.exp(0.03 * spend + 0.1 * visits - 3.0))
        missing = rng.random() < 0.05
        rows.append((i, None if missing else float(spend), float(visits), None if missing else region, int(rng.random() < risk)))
    return spark.createDataFrame(rows, "id int, spend double, visits double, region string, churn int")


def test_models_beat_chance_and_keep_every_row(spark, customers):
    marked = churn.hash_split(customers, "id")
    train, test = marked.filter("split = 'train'"), marked.filter("split = 'test'")
    modes = churn.fill_modes(train, ["region"])
    train = churn.fill_map(train, modes)
    # A category never seen in training must not fail.
    test = churn.fill_map(test, modes).withColumn("region", F.when(F.col("id") % 50 == 0, "moon").otherwise(F.col("region")))
    models = {
        "tree": churn.train(train, "churn", ["spend", "visits"], ["region"], churn.gradient_boosting("churn", 5, 3)),
        "forest": churn.train(train, "churn", ["spend", "visits"], ["region"], churn.random_forest("churn", 10, 4)),
        "line": churn.train(train, "churn", ["spend", "visits"], ["region"], churn.logistic_regression("churn")),
    }
    best, scores = churn.select_best(models, test, "churn")
    assert scores[best] == max(scores.values()) > 0.65
    predictions = churn.predict(models["line"], test)
    assert predictions.count() == test.count()
    scan = evaluation.threshold_scan(predictions, "churn", "predicted_probability")
    assert evaluation.roc_auc(scan).first()[0] == pytest.approx(scores["line"], abs=1e-9)
    for name in ("forest", "line"):
        ranked = churn.feature_importance(models[name], train, ["spend", "visits"], ["region"]).orderBy("rank").collect()
        assert sum(r["importance"] for r in ranked) == pytest.approx(1.0)
        assert ranked[0]["feature"] == "spend" and {"region_n", "visits"} <= {r["feature"] for r in ranked}


def test_splits(customers):
    marked = churn.hash_split(customers, "id")
    share = marked.filter("split = 'train'").count() / 800
    assert 0.74 < share < 0.86
    again = churn.hash_split(customers.repartition(5), "id")
    assert sorted(map(tuple, again.select("id", "split").collect())) == sorted(map(tuple, marked.select("id", "split").collect()))
    train = marked.filter("split = 'train'")
    assert churn.complement(customers, train, "id").count() == 800 - train.count()
    a, b = churn.random_split(customers)
    assert a.count() + b.count() == 800


def test_imputation_uses_train_rows_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (10.0,)], "x double")
    test = spark.createDataFrame([(None,), (4.0,)], "x double")
    assert sorted(r[0] for r in churn.impute_median(train, test, ["x"]).collect()) == [3.0, 4.0]
    scaled = churn.standardize(train, test, ["x"]).collect()
    assert [r[0] for r in scaled if r[0]] == [pytest.approx((4.0 - 14 / 3) / np.std([1, 3, 10], ddof=1))]
    hot = churn.one_hot(spark.createDataFrame([("a",), ("z",), (None,)], "c string"), "c", ["a", "b"]).collect()
    assert [(r["c_a"], r["c_b"]) for r in hot] == [(1, 0), (0, 0), (0, 0)]


# ---------------------------------------------------------------- marketing-mix fit


def test_fit_finds_the_effects(spark):
    rng = np.random.default_rng(13)
    days = [f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}" for i in range(224)]
    rows = []
    for g in range(4):
        media = rng.gamma(2.0, 10.0, (224, 2))
        unit = 20.0
        carried = np.zeros_like(media)
        weights = 0.5 ** np.arange(9)
        for i in range(224):
            for k in range(min(i + 1, 9)):
                carried[i] += weights[k] * media[i - k] / unit
        carried /= weights.sum()
        y = 100 * (1.0 + 0.8 * carried[:, 0] / (carried[:, 0] + 1.0)) + rng.normal(0, 2.0, 224)
        for i, day in enumerate(days):
            rows.append((f"g{g}", day, float(y[i]), 0.0, float(media[i, 0]), 1.0, float(media[i, 1]), 1.0))
    schema = (
        "TERRITORY_NAME string, DATE_DAY string, ALL_PURCHASES_ORIGINAL_PRICE double, ALL_PURCHASES_GROSS_DISCOUNT double, "
        "A_CLICKS double, A_SPEND double, B_CLICKS double, B_SPEND double"
    )
    raw = spark.createDataFrame(rows, schema).withColumn("DATE_DAY", F.col("DATE_DAY").cast("date"))
    panel = staging.stage(panel_ops.prepare_panel(raw))
    media = staging.stage(panel_ops.media_input(panel).withColumn("scaled", F.col("media") / 20.0))
    fit = staging.stage(mixfit.mmm_fit(panel, media, ["A", "B"], 12, ridge=1e-4))
    assert fit.count() == 12
    draws = mixfit.fit_draws(fit, panel, ["A", "B"])
    betas = {r["channel"]: r["b"] for r in draws.groupBy("channel").agg(F.avg("beta").alias("b")).collect()}
    assert betas["A"] == pytest.approx(80.0, rel=0.35) and betas["B"] < 0.2 * betas["A"]
    assert draws.filter("beta < 0").count() == 0
    fitted = mixfit.fitted_values(fit, panel, media, ["A", "B"])
    accuracy = evaluation.mmm_accuracy_national(fitted, "day", "split", "actual", "expected").collect()
    assert {r["evaluation_set"]: r["wmape"] for r in accuracy}["test"] < 0.05


def test_bootstrap_weights_have_mean_one(spark):
    weeks = spark.range(200).withColumnRenamed("id", "week")
    row = mixfit.bootstrap_weights(weeks, 50, 1).agg(F.avg("w"), F.var_pop("w")).first()
    assert row[0] == pytest.approx(1.0, abs=0.05) and row[1] == pytest.approx(1.0, abs=0.08)


def test_staged_tables_go_on_request(spark):
    from pathlib import Path

    from mixloom.sources import staging

    table = staging.stage(spark.range(3))
    folder = Path(table.inputFiles()[0].removeprefix("file:")).parent
    assert table.count() == 3 and folder.exists()
    assert staging.drop_staged(spark) >= 1 and not folder.exists()


def test_index_of_many_categories(spark):
    """200,000 categories, one of them with half of the rows; unseen and NULL ones share the next index."""
    hot = spark.range(200_000).select(F.lit("hot").alias("c"))
    train = spark.range(200_000).select(F.concat(F.lit("c"), F.col("id")).alias("c")).union(hot).union(spark.createDataFrame([("c7",), (None,)], "c string"))
    table = staging.stage(churn.index_table(train, "c"))
    first = {r["c"]: r["index"] for r in table.filter("index < 4").collect()}
    assert first == {"hot": 0, "c7": 1, "c0": 2, "c1": 3}
    assert table.agg(F.countDistinct("index"), F.max("index")).first() == (200_001, 200_000)
    rows = spark.createDataFrame([("c1", 1), (None, 2), ("new", 3), ("hot", 4)], "c string, k int")
    got = {r["k"]: r["i"] for r in churn.index_strings(table, rows, "c", "i").collect()}
    assert got == {1: 3, 2: 200_001, 3: 200_001, 4: 0}


def test_forest_keeps_the_nodes_of_its_rows_with_the_same_result(spark):
    rows = [(i, float(i * 37 % 101), f"s{i % 3}", int(i * 37 % 101 + i % 7 > 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, x double, s string, y int")
    kept = churn.random_forest("y", 5, 6)
    assert kept.getCacheNodeIds()
    found = [churn.predict(churn.train(df, "y", ["x"], ["s"], c), df).orderBy("k").collect() for c in (kept, churn.random_forest("y", 5, 6).setCacheNodeIds(False))]
    assert found[0] == found[1]
