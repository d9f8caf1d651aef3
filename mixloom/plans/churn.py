"""Queries over churn features, models and their evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import churn as churn_ops
from mixloom.operators import evaluation
from mixloom.operators.scoring import CHURN_DAYS
from mixloom.plans import views
from mixloom.plans.registry import Tables, query, rounded
from mixloom.plans.views import with_views
from mixloom.sources import writers
from mixloom.sources.staging import stage, staging_root

NUMERIC = ("n_orders", "spend", "balance", "tenure", "urgent_orders")
CATEGORICAL = ("segment", "nation")
LABEL = "churn"


def features(t: Tables) -> DataFrame:
    """Churn records: one row per customer with orders; recency makes the label and is left out.

    Segments of customers in debt and spend of customers with few orders are unknown (NULL).
    """
    day = F.col("o_orderdate").cast("date")
    last = t.orders.agg(F.date_add(F.max(day), 1).alias("snapshot"))
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("total"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent_orders"),
    )
    return (
        per_customer.crossJoin(F.broadcast(last))
        .join(t.customer, "c_custkey")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("n_orders").cast("double").alias("n_orders"),
            F.when(F.col("n_orders") > 5, F.col("total")).alias("spend"),
            F.col("c_acctbal").alias("balance"),
            F.datediff("snapshot", "first_day").cast("double").alias("tenure"),
            F.col("urgent_orders").cast("double").alias("urgent_orders"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"),
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation"),
            (F.datediff("snapshot", "last_day") > CHURN_DAYS).cast("int").alias(LABEL),
            ((F.col("c_custkey") * 37 % 101) / F.lit(100.0)).alias("score"),
        )
    )


FEATURES_SQL = """
    f AS (SELECT c_custkey AS customer_id, CAST(n AS DOUBLE) AS n_orders, CASE WHEN n > 5 THEN total END AS spend,
                 c_acctbal AS balance, CAST(s - first_day AS DOUBLE) AS tenure, CAST(urgent AS DOUBLE) AS urgent_orders,
                 CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment, 'N' || c_nationkey AS nation,
                 CAST(s - last_day > 90 AS INTEGER) AS churn, (c_custkey * 37 % 101) / 100.0::DOUBLE AS score,
                 CASE WHEN CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '#420'), 1, 8) AS BIGINT)
                           / 4294967296.0::DOUBLE < 0.8 THEN 'train' ELSE 'test' END AS split
          FROM (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total, min(CAST(o_orderdate AS DATE)) AS first_day,
                       max(CAST(o_orderdate AS DATE)) AS last_day,
                       count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1)
          JOIN customer ON c_custkey = o_custkey, (SELECT max(CAST(o_orderdate AS DATE)) + 1 AS s FROM orders))"""


def _sql(body: str) -> str:
    """``body`` after the feature rows; a body that starts with a comma adds expressions."""
    return f"WITH {FEATURES_SQL} {body}"


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    marked = stage(churn_ops.hash_split(features(t), "customer_id"))
    return marked.filter("split = 'train'").drop("split"), marked.filter("split = 'test'").drop("split")


def _predicted(df: DataFrame) -> DataFrame:
    return df.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query(
    "l0_churn_features",
    _sql(
        """SELECT customer_id, n_orders, round(spend, 2) AS spend, balance, tenure, urgent_orders, segment, nation, churn
           FROM f"""
    ),
)
def churn_features(t: Tables) -> DataFrame:
    return rounded(features(t).drop("score"), 2, "spend")


@query(
    "a25_class_counts",
    _sql(
        """SELECT churn, count(*) AS n_rows, round((SELECT count(*) FROM f) / (2.0::DOUBLE * count(*)), 6) AS weight
           FROM f GROUP BY 1"""
    ),
)
def class_counts(t: Tables) -> DataFrame:
    return rounded(evaluation.class_counts(features(t), LABEL), 6, "weight")


@query(
    "a25_class_weights",
    _sql(
        """SELECT customer_id, churn, round((SELECT count(*) FROM f) / (2.0::DOUBLE * n), 6) AS class_weight
           FROM f JOIN (SELECT churn, count(*) AS n FROM f GROUP BY 1) USING (churn)"""
    ),
)
def class_weights(t: Tables) -> DataFrame:
    weighted = evaluation.class_weights(stage(features(t).select("customer_id", LABEL)), LABEL)
    return rounded(weighted.select("customer_id", LABEL, "class_weight"), 6, "class_weight")


_modes = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS column_name, {c} AS mode_value, count(*) AS n_rows FROM f
                       WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY n_rows DESC, {c} LIMIT 1)"""
    for c in CATEGORICAL
)


@query("a26_mode_per_column", _sql(_modes))
def mode_per_column(t: Tables) -> DataFrame:
    return evaluation.mode_per_column(_split(t)[0], CATEGORICAL)


@query(
    "p11_fill_map",
    _sql(f""", m AS (SELECT mode_value FROM ({_modes}) WHERE column_name = 'segment')
        SELECT customer_id, coalesce(segment, mode_value) AS segment FROM f, m"""),
)
def fill_map(t: Tables) -> DataFrame:
    train, test = _split(t)
    modes = churn_ops.fill_modes(train, ["segment"])
    return churn_ops.fill_map(train.unionByName(test), modes).select("customer_id", "segment")


@query(
    "l2_impute_mode",
    _sql(f""", m AS (SELECT mode_value FROM ({_modes}) WHERE column_name = 'segment')
        SELECT coalesce(segment, mode_value) AS segment, count(*) AS n_rows FROM f, m WHERE split = 'test' GROUP BY 1"""),
)
def impute_mode(t: Tables) -> DataFrame:
    train, test = _split(t)
    filled = churn_ops.fill_map(test, churn_ops.fill_modes(train, ["segment"]))
    return filled.groupBy("segment").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "l1_impute_median",
    _sql(
        """, m AS (SELECT quantile_cont(spend, 0.5) AS v FROM f WHERE split = 'train')
           SELECT customer_id, round(coalesce(spend, v), 4) AS spend FROM f, m WHERE split = 'test'"""
    ),
)
def impute_median(t: Tables) -> DataFrame:
    train, test = _split(t)
    return rounded(churn_ops.impute_median(train, test, ["spend"]).select("customer_id", "spend"), 4, "spend")


@query(
    "l3_standardize",
    _sql(
        """, m AS (SELECT avg(balance) AS bm, stddev_samp(balance) AS bs, avg(tenure) AS tm, stddev_samp(tenure) AS ts
                   FROM f WHERE split = 'train')
           SELECT customer_id, round((balance - bm) / bs, 6) AS balance, round((tenure - tm) / ts, 6) AS tenure
           FROM f, m WHERE split = 'test'"""
    ),
)
def standardize(t: Tables) -> DataFrame:
    train, test = _split(t)
    columns = ["balance", "tenure"]
    return rounded(churn_ops.standardize(train, test, columns).select("customer_id", *columns), 6, *columns)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")


@query(
    "l5_one_hot",
    _sql(
        "SELECT customer_id, "
        + ", ".join(f"CAST(coalesce(segment = '{c}', FALSE) AS INTEGER) AS segment_{c}" for c in SEGMENTS)
        + " FROM f"
    ),
)
def one_hot(t: Tables) -> DataFrame:
    """Segments outside the known list act as unseen categories: all zeros."""
    return churn_ops.one_hot(features(t).select("customer_id", "segment"), "segment", SEGMENTS).drop("segment")


@query(
    "l4_index_strings",
    _sql(
        """, idx AS (SELECT segment, row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS i FROM f
                     WHERE split = 'train' AND segment IS NOT NULL GROUP BY segment)
           SELECT f.segment, coalesce(i, (SELECT count(*) FROM idx)) AS segment_indexed, count(*) AS n_rows
           FROM f LEFT JOIN idx USING (segment) WHERE split = 'test' GROUP BY ALL"""
    ),
)
def index_strings(t: Tables) -> DataFrame:
    train, test = _split(t)
    indexed = churn_ops.index_strings(stage(churn_ops.index_table(train, "segment")), test, "segment", "segment_indexed")
    return indexed.groupBy("segment", "segment_indexed").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "l4_index_table",
    _sql(
        """SELECT nation, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, nation) - 1 AS index
           FROM f WHERE split = 'train' AND nation IS NOT NULL GROUP BY nation"""
    ),
)
def index_table(t: Tables) -> DataFrame:
    return churn_ops.index_table(_split(t)[0], "nation")


def _filled(train: DataFrame, df: DataFrame) -> DataFrame:
    return churn_ops.fill_map(df, churn_ops.fill_modes(train, CATEGORICAL))


def _vectors(t: Tables) -> tuple[DataFrame, list[str]]:
    """Test rows with their feature vectors, gaps filled by exact train medians and modes, and the names along it."""
    train, test = _split(t)
    filled = [_filled(train, churn_ops.impute_median(train, df, list(NUMERIC))) for df in (train, test)]
    model = churn_ops.preprocessor(NUMERIC, CATEGORICAL).fit(filled[0])
    return model.transform(filled[1]), churn_ops.feature_names(model, filled[0], NUMERIC, CATEGORICAL)


_VECTOR_SQL = f""",
    med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUMERIC)} FROM f WHERE split = 'train'),
    modes AS ({_modes}),
    g AS (SELECT customer_id, churn, split, {", ".join(f"coalesce(f.{c}, med.{c}) AS {c}" for c in NUMERIC)},
                 {", ".join(f"coalesce({c}, (SELECT mode_value FROM modes WHERE column_name = '{c}')) AS {c}" for c in CATEGORICAL)}
          FROM f, med),
    mom AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMERIC)} FROM g WHERE split = 'train'),
    vec AS ({" UNION ALL ".join(f"SELECT customer_id, churn, '{c}' AS feature, ({c} - m_{c}) / s_{c} AS value FROM g, mom WHERE split = 'test'" for c in NUMERIC)}
      UNION ALL {" UNION ALL ".join(f"SELECT customer_id, churn, '{c}_' || k, CASE WHEN {c} = k THEN 1.0 ELSE 0.0 END FROM g, (SELECT DISTINCT {c} AS k FROM g WHERE split = 'train') WHERE split = 'test'" for c in CATEGORICAL)})"""


@query("l6_assemble_features", _sql(f"{_VECTOR_SQL} SELECT customer_id, feature, round(value, 6) AS value FROM vec"))
def assemble_features(t: Tables) -> DataFrame:
    """Every element of every feature vector, by name."""
    vectors, names = _vectors(t)
    return rounded(churn_ops.vector_rows(vectors, "customer_id", "features", names).drop("position"), 6, "value")


@query(
    "a27_confusion_matrix",
    _sql(
        """SELECT count(*) FILTER (churn = 0 AND score < 0.5) AS tn, count(*) FILTER (churn = 0 AND score >= 0.5) AS fp,
                  count(*) FILTER (churn = 1 AND score < 0.5) AS fn, count(*) FILTER (churn = 1 AND score >= 0.5) AS tp
           FROM f"""
    ),
)
def confusion_matrix(t: Tables) -> DataFrame:
    return evaluation.confusion_matrix(_predicted(features(t)), LABEL, "predicted")


@query(
    "a28_classification_metrics",
    _sql(
        """, c AS (SELECT count(*) FILTER (churn = 0 AND score < 0.5) AS tn, count(*) FILTER (churn = 0 AND score >= 0.5) AS fp,
                  count(*) FILTER (churn = 1 AND score < 0.5) AS fn, count(*) FILTER (churn = 1 AND score >= 0.5) AS tp FROM f)
           SELECT round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 6) AS accuracy,
                  round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
                  round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
                  round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1 FROM c"""
    ),
)
def classification_metrics(t: Tables) -> DataFrame:
    metrics = evaluation.classification_metrics(_predicted(features(t)), LABEL, "predicted")
    return rounded(metrics, 6, "accuracy", "precision", "recall", "f1")


_scan = """, g AS (SELECT score, count(*) FILTER (churn = 1) AS pos, count(*) FILTER (churn = 0) AS neg FROM f GROUP BY 1),
    scan AS (SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
                    CAST(sum(pos) OVER () AS BIGINT) AS n_pos, CAST(sum(neg) OVER () AS BIGINT) AS n_neg
             FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _threshold_scan(t: Tables) -> DataFrame:
    return evaluation.threshold_scan(features(t), LABEL, "score")


@query(
    "a29_roc_auc",
    _sql(f"{_scan} SELECT round(sum(pos * (n_neg - fp + neg / 2.0::DOUBLE)) / max(CAST(n_pos AS DOUBLE) * n_neg), 6) AS auc FROM scan"),
)
def roc_auc(t: Tables) -> DataFrame:
    return rounded(evaluation.roc_auc(_threshold_scan(t)), 6, "auc")


@query(
    "w2_roc_curve",
    _sql(
        f"""{_scan} SELECT score AS threshold, round(fp / CAST(n_neg AS DOUBLE), 6) AS fpr,
                           round(tp / CAST(n_pos AS DOUBLE), 6) AS tpr FROM scan"""
    ),
)
def roc_curve(t: Tables) -> DataFrame:
    return rounded(evaluation.roc_curve(_threshold_scan(t)), 6, "fpr", "tpr")


@query(
    "w3_pr_curve",
    _sql(
        f"""{_scan} SELECT score AS threshold, round(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 6) AS precision,
                           round(tp / CAST(n_pos AS DOUBLE), 6) AS recall FROM scan"""
    ),
)
def pr_curve(t: Tables) -> DataFrame:
    return rounded(evaluation.pr_curve(_threshold_scan(t)), 6, "precision", "recall")


COST_FP, COST_FN = 2.0, 1.0


@query(
    "l16_cost_threshold",
    _sql(
        f"""{_scan} SELECT score AS threshold, fp * {COST_FP}::DOUBLE + (n_pos - tp) * {COST_FN}::DOUBLE AS cost FROM scan
            ORDER BY cost, threshold DESC LIMIT 1"""
    ),
)
def cost_threshold(t: Tables) -> DataFrame:
    return evaluation.cost_threshold(_threshold_scan(t), COST_FP, COST_FN)


@query(
    "l16_cost_curve",
    _sql(
        f"""{_scan} SELECT score AS threshold, tp, fp, fp * {COST_FP}::DOUBLE + (n_pos - tp) * {COST_FN}::DOUBLE AS cost
            FROM scan"""
    ),
)
def cost_curve(t: Tables) -> DataFrame:
    return evaluation.cost_curve(_threshold_scan(t), COST_FP, COST_FN)


@query(
    "l14_evaluate",
    _sql(
        f"""{_scan}, c AS (SELECT count(*) FILTER (churn = 0 AND score < 0.5) AS tn,
                  count(*) FILTER (churn = 0 AND score >= 0.5) AS fp, count(*) FILTER (churn = 1 AND score < 0.5) AS fn,
                  count(*) FILTER (churn = 1 AND score >= 0.5) AS tp FROM f)
            SELECT tn, fp, fn, tp, round((tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), 6) AS accuracy,
                   round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
                   round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
                   round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1,
                   (SELECT round(sum(pos * (n_neg - fp + neg / 2.0::DOUBLE)) / max(CAST(n_pos AS DOUBLE) * n_neg), 6) FROM scan) AS auc
            FROM c"""
    ),
)
def evaluate(t: Tables) -> DataFrame:
    scored = stage(_predicted(features(t)).select(LABEL, "score", "predicted"))
    auc = evaluation.roc_auc(evaluation.threshold_scan(scored, LABEL, "score"))
    matrix = evaluation.confusion_matrix(scored, LABEL, "predicted")
    metrics = evaluation.classification_metrics(scored, LABEL, "predicted")
    report = matrix.crossJoin(metrics).crossJoin(auc)
    return rounded(report, 6, "accuracy", "precision", "recall", "f1", "auc")


# ---------------------------------------------------------------- trained models


def _fitted(t: Tables, classifier):
    train, test = _split(t)
    train, test = _filled(train, train), _filled(train, test)
    return churn_ops.train(train, LABEL, NUMERIC, CATEGORICAL, classifier), train, test


def _scored(t: Tables, classifier) -> DataFrame:
    model, _, test = _fitted(t, classifier)
    return churn_ops.predict(model, test).select("customer_id", LABEL, "predicted_class", "predicted_probability")


@query("p18_vector_element")
def vector_element(t: Tables) -> DataFrame:
    model, _, test = _fitted(t, churn_ops.logistic_regression(LABEL))
    positive = churn_ops.vector_element("probability", 1)
    return model.transform(test).select("customer_id", positive.alias("positive_probability"))


@query("l11_train")
def train(t: Tables) -> DataFrame:
    """The coefficients of a fitted pipeline by feature name."""
    model, rows, _ = _fitted(t, churn_ops.logistic_regression(LABEL))
    names = churn_ops.feature_names(model, rows, NUMERIC, CATEGORICAL)
    values = model.stages[-1].coefficients.toArray()
    return t.spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, coefficient double")


@query(
    "l7_preprocessor",
    _sql(f"{_VECTOR_SQL} SELECT churn, feature, count(*) AS n_rows, round(avg(value), 6) AS mean FROM vec GROUP BY ALL"),
)
def preprocessor(t: Tables) -> DataFrame:
    """Mean of every feature per class."""
    vectors, names = _vectors(t)
    rows = churn_ops.vector_rows(vectors.withColumn("_row", F.struct("customer_id", LABEL)), "_row", "features", names)
    means = rows.groupBy(F.col(f"_row.{LABEL}").alias(LABEL), "feature").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean"))
    return rounded(means, 6, "mean")


@query("l8_random_forest")
def random_forest(t: Tables) -> DataFrame:
    return _scored(t, churn_ops.random_forest(LABEL))


@query("l9_logistic_regression")
def logistic_regression(t: Tables) -> DataFrame:
    return _scored(t, churn_ops.logistic_regression(LABEL))


@query("l10_gradient_boosting")
def gradient_boosting(t: Tables) -> DataFrame:
    return _scored(t, churn_ops.gradient_boosting(LABEL))


@query("l12_predict_all_rows")
def predict_all_rows(t: Tables) -> DataFrame:
    """Train, predict, and put train and test rows together again."""
    model, train, test = _fitted(t, churn_ops.logistic_regression(LABEL))
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return churn_ops.predict(model, both).select("customer_id", "split", "predicted_class", "predicted_probability")


@query("j14_attach_predictions")
def attach_predictions(t: Tables) -> DataFrame:
    """Predictions beside the columns they were made from; no join, the model keeps its input columns."""
    model, train, _ = _fitted(t, churn_ops.logistic_regression(LABEL))
    return churn_ops.predict(model, train).select("customer_id", *NUMERIC, *CATEGORICAL, "predicted_class")


def _candidates(t: Tables):
    """Three fitted models by name, with their train and test rows."""
    train, test = _split(t)
    train, test = stage(_filled(train, train)), stage(_filled(train, test))
    candidates = {
        "random_forest": churn_ops.random_forest(LABEL),
        "logistic_regression": churn_ops.logistic_regression(LABEL),
        "gradient_boosting": churn_ops.gradient_boosting(LABEL),
    }
    return {n: churn_ops.train(train, LABEL, NUMERIC, CATEGORICAL, c) for n, c in candidates.items()}, train, test


@query("s8_best_model_predictions")
def best_model_predictions(t: Tables) -> DataFrame:
    """Predictions of the model with the highest AUC for train and test rows, written and read back."""
    models, train, test = _candidates(t)
    best, _ = churn_ops.select_best(models, test, LABEL)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    predicted = churn_ops.predict(models[best], both).withColumn("model", F.lit(best))
    path = f"{staging_root(t.spark).rstrip('/')}/mixloom-{uuid.uuid4().hex}"
    columns = ["customer_id", "split", "model", LABEL]
    writers.save_predictions(predicted, path, columns, "parquet")
    return t.spark.read.parquet(path)


@query("l13_select_best")
def select_best(t: Tables) -> DataFrame:
    models, _, test = _candidates(t)
    best, scores = churn_ops.select_best(models, test, LABEL)
    rows = [(name, float(auc), name == best) for name, auc in scores.items()]
    return t.spark.createDataFrame(rows, "model string, auc double, is_best boolean")


@query("l15_feature_importance")
def feature_importance(t: Tables) -> DataFrame:
    model, train, _ = _fitted(t, churn_ops.random_forest(LABEL))
    return churn_ops.feature_importance(model, train, NUMERIC, CATEGORICAL)


@query("k5_top_features")
def top_features(t: Tables) -> DataFrame:
    model, train, _ = _fitted(t, churn_ops.logistic_regression(LABEL))
    importance = churn_ops.feature_importance(model, train, NUMERIC, CATEGORICAL)
    return importance.orderBy(F.desc("importance"), "feature").limit(5)


@query(
    "w10_share_of_top_n",
    with_views(
        "main_items",
        """WITH b AS (SELECT brand, count(*) AS n FROM main_items GROUP BY 1)
           SELECT round((SELECT sum(n) FROM (SELECT n FROM b ORDER BY n DESC, brand LIMIT 5)) * 100.0::DOUBLE / sum(n), 6)
                  AS top_share_pct FROM b""",
    ),
)
def share_of_top_n(t: Tables) -> DataFrame:
    brands = views.main_items(t).groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    return rounded(evaluation.share_of_top_n(stage(brands), "brand", "n", 5), 6, "top_share_pct")


# ---------------------------------------------------------------- what must hold for any fitted model

_TESTED = _sql("SELECT count(*) AS n_rows, TRUE AS class_by_half, TRUE AS in_range, TRUE AS auc_is_rank FROM f WHERE split = 'test'")


def _checked(t: Tables, classifier) -> DataFrame:
    """Every test row is scored once, the class follows the probability, and two ways to the AUC agree."""
    scored = stage(_scored(t, classifier))
    p = F.col("predicted_probability")
    by_rank = evaluation.roc_auc(evaluation.threshold_scan(scored, LABEL, "predicted_probability")).first()[0]
    agree = abs(churn_ops.auc(scored, LABEL) - by_rank) < 1e-9
    return scored.agg(
        F.countDistinct("customer_id").alias("n_rows"),
        F.every((p == 0.5) | (F.col("predicted_class") == (p > 0.5).cast("double"))).alias("class_by_half"),
        F.every((p >= 0) & (p <= 1)).alias("in_range"),
        F.lit(agree).alias("auc_is_rank"),
    )


@query("l8_random_forest_checks", _TESTED)
def random_forest_checks(t: Tables) -> DataFrame:
    return _checked(t, churn_ops.random_forest(LABEL))


@query("l9_logistic_regression_checks", _TESTED)
def logistic_regression_checks(t: Tables) -> DataFrame:
    return _checked(t, churn_ops.logistic_regression(LABEL))


@query("l10_gradient_boosting_checks", _TESTED)
def gradient_boosting_checks(t: Tables) -> DataFrame:
    return _checked(t, churn_ops.gradient_boosting(LABEL))


_NAMES_SQL = " UNION ALL ".join([*(f"SELECT '{c}' AS feature" for c in NUMERIC), *(f"SELECT DISTINCT '{c}_' || {c} FROM f WHERE split = 'train' AND {c} IS NOT NULL" for c in CATEGORICAL)])


@query("l11_train_checks", _sql(f"SELECT feature, TRUE AS finite FROM ({_NAMES_SQL})"))
def train_checks(t: Tables) -> DataFrame:
    """One finite coefficient for every numeric column and every category of the train rows."""
    finite = ~F.isnan("coefficient") & (F.abs("coefficient") < float("inf"))
    return train(t).select("feature", finite.alias("finite"))


@query("l12_predict_checks", _sql("SELECT split, count(*) AS n_rows, TRUE AS complete FROM f GROUP BY split"))
def predict_checks(t: Tables) -> DataFrame:
    complete = F.every(F.col("predicted_class").isin(0.0, 1.0) & F.col("predicted_probability").between(0.0, 1.0))
    return predict_all_rows(t).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), complete.alias("complete"))


@query(
    "l13_auc_by_group",
    _sql(
        """, p AS (SELECT nation, score FROM f WHERE churn = 1), q AS (SELECT nation, score FROM f WHERE churn <> 1)
           SELECT k.nation, round(avg(CASE WHEN p.score > q.score THEN 1.0 WHEN p.score = q.score THEN 0.5 ELSE 0 END), 9) AS auc
           FROM (SELECT DISTINCT nation FROM f) k LEFT JOIN p ON p.nation = k.nation LEFT JOIN q ON q.nation = k.nation
           GROUP BY k.nation HAVING count(p.score) > 0 AND count(q.score) > 0"""
    ),
)
def auc_by_group(t: Tables) -> DataFrame:
    """AUC of one score in every nation that has both classes, from one order over all of them."""
    return rounded(evaluation.roc_auc_by(features(t), "nation", LABEL, "score"), 9, "auc").filter("auc is not null")


@query("l13_select_best_checks", "SELECT unnest(['gradient_boosting', 'logistic_regression', 'random_forest']) AS model, TRUE AS same_auc, 1 AS n_best")
def select_best_checks(t: Tables) -> DataFrame:
    """The AUC of each model from the one long table is that of the model alone; one model is the best."""
    models, _, test = _candidates(t)
    best, scores = churn_ops.select_best(models, test, LABEL)
    rows = [(n, abs(scores[n] - churn_ops.auc(churn_ops.predict(m, test), LABEL)) < 1e-9, int(scores[best] == max(scores.values()))) for n, m in models.items()]
    return t.spark.createDataFrame(rows, "model string, same_auc boolean, n_best int")


_RANKED_SQL = f"SELECT count(*) AS n_features, count(*) AS n_ranks, 1.0::DOUBLE AS total, TRUE AS falling FROM ({_NAMES_SQL})"


@query("l15_importance_checks", _sql(_RANKED_SQL))
def importance_checks(t: Tables) -> DataFrame:
    """As many features as columns and categories, ranks without a gap, shares that add up and fall with the rank."""
    ranked = stage(feature_importance(t))
    after = ranked.select((F.col("rank") - 1).alias("rank"), F.col("importance").alias("_next"))
    falling = ranked.join(after, "rank").agg(F.every(F.col("importance") >= F.col("_next")).alias("falling"))
    sums = ranked.agg(F.count(F.lit(1)).alias("n_features"), F.max("rank").cast("long").alias("n_ranks"), F.round(F.sum("importance"), 9).alias("total"))
    return sums.crossJoin(F.broadcast(falling))


@query("k5_top_features_checks", "SELECT unnest(range(1, 6))::INTEGER AS rank, TRUE AS is_top")
def top_features_checks(t: Tables) -> DataFrame:
    """The five rows are those of rank 1 to 5, and none is below a feature left out."""
    model, rows, _ = _fitted(t, churn_ops.logistic_regression(LABEL))
    importance = stage(churn_ops.feature_importance(model, rows, NUMERIC, CATEGORICAL))
    rest = importance.filter("rank > 5").agg(F.max("importance").alias("_rest"))
    top = importance.orderBy(F.desc("importance"), "feature").limit(5)
    return top.crossJoin(F.broadcast(rest)).select("rank", (F.col("importance") >= F.col("_rest")).alias("is_top"))


@query("p18_vector_element_checks", _sql("SELECT customer_id, 1.0::DOUBLE AS total FROM f WHERE split = 'test'"))
def vector_element_checks(t: Tables) -> DataFrame:
    """The probabilities of a row are elements 0 and 1, and add up to 1."""
    model, _, test = _fitted(t, churn_ops.logistic_regression(LABEL))
    both = churn_ops.vector_element("probability", 0) + churn_ops.vector_element("probability", 1)
    return model.transform(test).select("customer_id", F.round(both, 9).alias("total"))


@query(
    "j14_attach_checks",
    _sql("SELECT customer_id, n_orders, round(spend, 2) AS spend, round(balance, 2) AS balance, tenure, urgent_orders, nation, TRUE AS predicted FROM f WHERE split = 'train'"),
)
def attach_checks(t: Tables) -> DataFrame:
    """The columns beside a prediction are those of its own row."""
    attached = attach_predictions(t).withColumn("predicted", F.col("predicted_class").isin(0.0, 1.0))
    return rounded(attached.select("customer_id", *NUMERIC, "nation", "predicted"), 2, "spend", "balance")
