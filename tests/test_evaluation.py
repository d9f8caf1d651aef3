import numpy as np
import pytest
from pyspark.sql import functions as F

from mixloom.operators import evaluation


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    score = np.round(rng.random(600), 2)
    label = (rng.random(600) < 0.2 + 0.5 * score).astype(int)
    df = spark.createDataFrame([(int(y), float(s)) for y, s in zip(label, score)], "y int, s double")
    return df, label, score


def test_auc_counts_ties_half(scored):
    df, label, score = scored
    pos, neg = score[label == 1], score[label == 0]
    want = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    scan = evaluation.threshold_scan(df, "y", "s", 4)
    assert evaluation.roc_auc(scan).first()[0] == pytest.approx(want)
    moved = df.withColumn("s", F.exp(F.col("s") * 3))
    assert evaluation.roc_auc(evaluation.threshold_scan(moved, "y", "s")).first()[0] == pytest.approx(want)


def test_curves_end_where_everything_is_positive(scored):
    df, label, _ = scored
    scan = evaluation.threshold_scan(df, "y", "s")
    roc = evaluation.roc_curve(scan).orderBy("threshold").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (1.0, 1.0)
    pr = evaluation.pr_curve(scan).orderBy("threshold").collect()
    assert pr[0]["precision"] == pytest.approx(label.mean()) and pr[0]["recall"] == 1.0


def test_confusion_and_metrics(scored, spark):
    df, label, score = scored
    marked = df.withColumn("p", (F.col("s") >= 0.5).cast("int"))
    c = evaluation.confusion_matrix(marked, "y", "p").first()
    assert (c["tp"], c["fp"]) == (int(((score >= 0.5) & (label == 1)).sum()), int(((score >= 0.5) & (label == 0)).sum()))
    m = evaluation.classification_metrics(marked, "y", "p").first()
    assert m["f1"] == pytest.approx(2 * m["precision"] * m["recall"] / (m["precision"] + m["recall"]))
    nothing = spark.createDataFrame([(0, 0)], "y int, p int")
    assert tuple(evaluation.classification_metrics(nothing, "y", "p").first()) == (1.0, 0.0, 0.0, 0.0)


def test_cost_threshold_is_the_cheapest(scored):
    df, label, score = scored
    scan = evaluation.threshold_scan(df, "y", "s")
    costs = {t: 3.0 * ((score >= t) & (label == 0)).sum() + 2.0 * ((score < t) & (label == 1)).sum() for t in set(score)}
    best = evaluation.cost_threshold(scan, 3.0, 2.0).first()
    assert best["cost"] == min(costs.values())
    assert best["threshold"] == max(t for t, c in costs.items() if c == best["cost"])


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    weights = {r["y"]: r["class_weight"] for r in evaluation.class_weights(df, "y").collect()}
    assert weights == {0: pytest.approx(8 / 12), 1: 2.0}
    assert evaluation.class_weights(df, "y").agg(F.sum("class_weight")).first()[0] == pytest.approx(8.0)


def test_mode_takes_the_lowest_of_equals_and_skips_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, "x"), (None, None)], "p string, q string")
    got = {r["column_name"]: r["mode_value"] for r in evaluation.mode_per_column(df, ["p", "q"]).collect()}
    assert got == {"p": "a", "q": "x"}


def test_accuracy_levels(spark):
    rows = [("a", 1, "train", 10.0, 8.0), ("b", 1, "train", 20.0, 22.0), ("a", 2, "test", 0.0, 1.0), ("b", 2, "test", 5.0, 5.0)]
    df = spark.createDataFrame(rows, "geo string, day int, split string, y double, e double")
    geo = {(r["geo"], r["evaluation_set"]): r for r in evaluation.mmm_accuracy(df, "geo", "split", "y", "e").collect()}
    assert geo[("a", "all")]["wmape"] == pytest.approx(0.3) and geo[("a", "test")]["mape"] is None
    nation = evaluation.mmm_accuracy_national(df, "day", "split", "y", "e").collect()
    assert {r["evaluation_set"]: r["wmape"] for r in nation}["train"] == pytest.approx(0.0)


def test_top_share(spark):
    df = spark.createDataFrame([(f"f{i}", float(v)) for i, v in enumerate([5, 4, 3, 2, 1, 5])], "f string, v double")
    assert evaluation.share_of_top_n(df, "f", "v", 2).first()[0] == pytest.approx(50.0)


def test_a_missing_label_fails(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "label int, x int")
    with pytest.raises(Exception, match="label is NULL"):
        evaluation.class_weights(df, "label").collect()


def test_auc_of_many_groups_in_one_order(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    rows = [(f"m{g}", int(y), float(np.round(rng.normal(y * g / 4, 1), 1))) for g in range(6) for y in rng.integers(0, 2, 400)]
    rows += [("one-sided", 1, 0.5), ("one-sided", 1, 0.7)]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    got = {r["model"]: r["auc"] for r in evaluation.roc_auc_by(df, "model", "y", "s").collect()}
    for model in {r[0] for r in rows}:
        pos = [s for m, y, s in rows if m == model and y == 1]
        neg = [s for m, y, s in rows if m == model and y == 0]
        want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) if neg else None
        assert got[model] == (pytest.approx(want) if want is not None else None)
