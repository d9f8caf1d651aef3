"""Churn classification with MLlib: imputation, encoding, class weights, models, importances."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions.scalars import safe_ratio
from mixloom.operators.evaluation import class_weights, mode_per_column, roc_auc_by
from mixloom.operators.ordering import exact_quantiles, running_totals
from mixloom.sources.staging import stage

# Seed and iteration limit of the published models.
SEED = 420
MAX_ITERATIONS = 1000


def vector_element(column: str, i: int) -> Column:
    """One element of a vector column."""
    return vector_to_array(F.col(column))[i]


def vector_rows(df: DataFrame, key: str, column: str, names) -> DataFrame:
    """All elements of a vector column as rows: key, position, feature name and value."""
    elements = df.select(key, F.posexplode(vector_to_array(F.col(column))).alias("position", "value"))
    return elements.select(key, "position", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("position") + 1).alias("feature"), "value")


def index_table(train: DataFrame, column: str) -> DataFrame:
    """``column``, ``n`` and ``index`` of every category of the train rows: by falling count, then by value.

    The ranks are running totals over ranges, so no task and no driver holds all categories.
    """
    counted = train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.withColumns({"_less": -F.col("n"), "_one": F.lit(1).cast("long")})
    ranked = running_totals(ordered, ["_less", column], {"index": "_one"})
    return ranked.select(column, "n", (F.col("index") - 1).alias("index"))


def index_strings(table: DataFrame, df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the index of its category; unseen and NULL categories get the next free index.

    A join to one row per category; a category with a large share of the rows is split by adaptive execution.
    """
    size = table.agg(F.count(F.lit(1)).alias("_size"))
    known = table.select(column, F.col("index").alias(out))
    joined = df.join(known, column, "left").crossJoin(F.broadcast(size))
    return joined.select(*df.columns, F.coalesce(out, "_size").alias(out))


def random_split(df: DataFrame, ratio: float = 0.8, seed: int = SEED) -> list[DataFrame]:
    """Seeded random split."""
    return df.randomSplit([ratio, 1.0 - ratio], seed=seed)


def hash_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = SEED, out: str = "split") -> DataFrame:
    """Repeatable split by a hash of the key; a row keeps its side whatever the partitioning."""
    token = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}"))), 1, 8)
    position = F.conv(token, 16, 10).cast("long") / F.lit(float(16**8))
    return df.withColumn(out, F.when(position < ratio, "train").otherwise("test"))


def complement(df: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``part``."""
    return df.join(part.select(key), key, "left_anti")


def fill_modes(train: DataFrame, columns) -> dict[str, str]:
    """Mode per categorical column, from the train rows only; one row per column is collected."""
    return {r["column_name"]: r["mode_value"] for r in mode_per_column(train, columns).collect()}


def fill_map(df: DataFrame, values: dict) -> DataFrame:
    """NULL to a constant per column."""
    return df.fillna(values) if values else df


def impute_median(train: DataFrame, df: DataFrame, columns) -> DataFrame:
    """NULL to the exact train median; the pipeline uses the approximate MLlib imputer."""
    medians = exact_quantiles(train, columns, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0])) for c in columns})


def standardize(train: DataFrame, df: DataFrame, columns) -> DataFrame:
    """(x - mean) / sample deviation, both from the train rows."""
    moments = train.agg(
        *[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"_s_{c}") for c in columns]
    )
    scaled = {c: safe_ratio(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}"), 0.0) for c in columns}
    return df.crossJoin(F.broadcast(moments)).withColumns(scaled).select(*df.columns)


def one_hot(df: DataFrame, column: str, categories) -> DataFrame:
    """0/1 column per known category; an unseen category gives all zeros."""
    return df.withColumns(
        {f"{column}_{c}": F.coalesce((F.col(column) == c).cast("int"), F.lit(0)) for c in categories}
    )


def preprocessor(numeric, categorical) -> Pipeline:
    """Unfitted stages from raw columns to ``features``."""
    imputed = [f"{c}_imputed" for c in numeric]
    indexed = [f"{c}_indexed" for c in categorical]
    encoded = [f"{c}_encoded" for c in categorical]
    stages = [
        Imputer(strategy="median", inputCols=list(numeric), outputCols=imputed),
        VectorAssembler(inputCols=imputed, outputCol="numeric_raw"),
        StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True),
    ]
    if categorical:
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
    stages.append(VectorAssembler(inputCols=["numeric_scaled", *encoded], outputCol="features"))
    return Pipeline(stages=stages)


def random_forest(label: str, trees: int = 100, depth: int = 12) -> RandomForestClassifier:
    # A row's node in every tree is kept from level to level; without that, each pass walks all trees from the root.
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="class_weight", seed=SEED, numTrees=trees, maxDepth=depth, cacheNodeIds=True
    )


def logistic_regression(label: str, reg_param: float = 0.0) -> LogisticRegression:
    return LogisticRegression(
        labelCol=label, featuresCol="features", weightCol="class_weight", maxIter=MAX_ITERATIONS, regParam=reg_param
    )


def gradient_boosting(label: str, rounds: int = 20, depth: int = 5) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label, featuresCol="features", weightCol="class_weight", seed=SEED, maxIter=rounds, maxDepth=depth
    )


def train(df: DataFrame, label: str, numeric, categorical, classifier) -> PipelineModel:
    """Fit preprocessing and classifier on class-weighted rows."""
    stages = preprocessor(numeric, categorical).getStages()
    return Pipeline(stages=[*stages, classifier]).fit(class_weights(df, label))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns with predicted class and positive-class probability; stays distributed."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        F.col("prediction").alias("predicted_class"),
        vector_element("probability", 1).alias("predicted_probability"),
    )


def auc(predictions: DataFrame, label: str) -> float:
    """Tie-correct area under the ROC curve."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="predicted_probability", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(predictions)


def select_best(models: dict[str, PipelineModel], test: DataFrame, label: str) -> tuple[str, dict[str, float]]:
    """Name of the model with the highest AUC on ``test``, the first on a tie, and all AUCs.

    The scores of all models form one long table, which is ordered once for all of them.
    """
    scored = [predict(m, test).select(F.lit(name).alias("model"), label, "predicted_probability") for name, m in models.items()]
    long = scored[0]
    for more in scored[1:]:
        long = long.unionByName(more)
    found = {r["model"]: r["auc"] for r in roc_auc_by(stage(long), "model", label, "predicted_probability").collect()}
    scores = {name: found[name] for name in models}
    return max(scores, key=lambda n: scores[n] or 0.0), scores


def feature_names(model: PipelineModel, df: DataFrame, numeric, categorical) -> list[str]:
    """Names along the feature vector; encoded columns carry theirs in the schema."""
    schema = model.transform(df.limit(0)).schema
    names = list(numeric)
    for c in categorical:
        attributes = schema[f"{c}_encoded"].metadata["ml_attr"]["attrs"]
        flat = sorted((a for kind in attributes.values() for a in kind), key=lambda a: a["idx"])
        names += [f"{c}_{a['name']}" for a in flat]
    return names


def feature_importance(model: PipelineModel, df: DataFrame, numeric, categorical) -> DataFrame:
    """Tree importance or absolute coefficient per feature, scaled to sum 1, with its rank."""
    classifier = model.stages[-1]
    if hasattr(classifier, "featureImportances"):
        raw = classifier.featureImportances.toArray()
    else:
        raw = abs(classifier.coefficients.toArray())
    total = float(raw.sum()) or 1.0
    names = feature_names(model, df, numeric, categorical)
    ranked = sorted(zip(names, raw), key=lambda p: (-p[1], p[0]))
    rows = [(i + 1, n, float(v) / total) for i, (n, v) in enumerate(ranked)]
    return df.sparkSession.createDataFrame(rows, "rank int, feature string, importance double")
