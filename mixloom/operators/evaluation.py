"""Evaluation of classifier scores and of marketing-mix predictions, as aggregates.

Label, score and prediction stay in one DataFrame; nothing is aligned by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions.scalars import safe_ratio
from mixloom.operators.ordering import running_totals
from mixloom.sources.staging import stage


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """The four cells in one row."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def classification_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Accuracy, precision, recall and F1; an undefined ratio counts as 0."""
    c = confusion_matrix(df, label, predicted)
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return c.select(
        safe_ratio(tp + tn, tp + tn + fp + fn, 0.0).alias("accuracy"),
        safe_ratio(tp, tp + fp, 0.0).alias("precision"),
        safe_ratio(tp, tp + fn, 0.0).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn, 0.0).alias("f1"),
    )


def threshold_scan(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Cumulative true and false positives per distinct score, highest first.

    Rows are counted per score before the running sum, so ties share a point.
    """
    counted = stage(
        df.groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
        .withColumn("_order", -F.col("score"))
    )
    running = running_totals(counted, ["_order"], {"tp": "pos", "fp": "neg"}, buckets)
    total = counted.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return running.drop("_order").crossJoin(F.broadcast(total))


def roc_curve(scan: DataFrame) -> DataFrame:
    """False against true positive rate per threshold, from ``threshold_scan``."""
    return scan.select(
        F.col("score").alias("threshold"),
        safe_ratio("fp", "n_neg").alias("fpr"),
        safe_ratio("tp", "n_pos").alias("tpr"),
    )


def pr_curve(scan: DataFrame) -> DataFrame:
    """Recall against precision per threshold."""
    return scan.select(
        F.col("score").alias("threshold"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio("tp", "n_pos").alias("recall"),
    )


def roc_auc(scan: DataFrame) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    negatives_below = F.col("n_neg") - F.col("fp")
    wins = F.sum(F.col("pos") * (negatives_below + F.col("neg") / F.lit(2.0)))
    return scan.agg(safe_ratio(wins, F.max(F.col("n_pos") * F.col("n_neg").cast("double"))).alias("auc"))


def roc_auc_by(df: DataFrame, group: str, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve of every ``group`` (a model, a segment), tied scores count half; one order for all.

    Running totals go over (group, falling score); a group's own totals begin where the groups before it
    end. Groups are few, scores and rows may be any number.
    """
    counted = stage(
        df.groupBy(F.col(group).alias("_g"), (-F.col(score)).alias("_order")).agg(
            F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
        )
    )
    running = running_totals(counted, ["_g", "_order"], {"fp": "neg"}, buckets)
    totals = counted.groupBy("_g").agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    # One row per group.
    earlier = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("n_neg").over(earlier), F.lit(0)))
    joined = running.join(F.broadcast(totals), "_g")
    below = F.col("n_neg") - (F.col("fp") - F.col("_before"))
    wins = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
    out = joined.groupBy("_g").agg(safe_ratio(wins, F.max(F.col("n_pos") * F.col("n_neg").cast("double"))).alias("auc"))
    return out.withColumnRenamed("_g", group)


def cost_curve(scan: DataFrame, cost_fp: float, cost_fn: float) -> DataFrame:
    """Total cost when every score from the threshold upwards is treated as positive."""
    missed = F.col("n_pos") - F.col("tp")
    cost = F.col("fp") * F.lit(cost_fp) + missed * F.lit(cost_fn)
    return scan.select(F.col("score").alias("threshold"), "tp", "fp", cost.alias("cost"))


def cost_threshold(scan: DataFrame, cost_fp: float, cost_fn: float) -> DataFrame:
    """The cheapest threshold; of equal ones the highest."""
    order = F.struct(F.col("cost"), -F.col("threshold"))
    return cost_curve(scan, cost_fp, cost_fn).agg(
        F.min_by("threshold", order).alias("threshold"), F.min("cost").alias("cost")
    )


def class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Balanced weight n / (k n_class) on every row, by a broadcast of one row per class.

    A row without label has no class to be weighed by; it fails the job instead of getting lost.
    """
    known = F.when(F.col(label).isNull(), F.raise_error(F.lit(f"{label} is NULL"))).otherwise(F.col(label))
    df = df.withColumn(label, known.cast(df.schema[label].dataType))
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    weights = counts.crossJoin(F.broadcast(total)).select(label, (F.col("_all") / (F.col("_k") * F.col("_n"))).alias(out))
    return df.join(F.broadcast(weights), label)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows and balanced weight per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("_all"), F.count(F.lit(1)).alias("_k"))
    return counts.crossJoin(F.broadcast(total)).select(
        label, "n_rows", (F.col("_all") / (F.col("_k") * F.col("n_rows"))).alias("weight")
    )


def mode_per_column(df: DataFrame, columns) -> DataFrame:
    """Most frequent non-NULL value per column in one pass; the lowest value wins ties.

    Values are counted per column and value on the map side, so a column with many
    distinct values does not gather in one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    counted = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.c", "p.v")
        .filter("v IS NOT NULL")
        .groupBy("c", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.struct(-F.col("n"), F.col("v"))
    return counted.groupBy(F.col("c").alias("column_name")).agg(
        F.min_by("v", best).alias("mode_value"), F.max("n").alias("n_rows")
    )


def share_of_top_n(df: DataFrame, name: str, value: str, n: int = 5) -> DataFrame:
    """Share of the ``n`` largest values in the total, in percent."""
    top = df.orderBy(F.desc(value), name).limit(n).agg(F.sum(value).alias("_top"))
    total = df.agg(F.sum(value).alias("_all"))
    return top.crossJoin(total).select((safe_ratio("_top", "_all") * F.lit(100.0)).alias("top_share_pct"))


def mmm_accuracy(df: DataFrame, geo: str, split: str, actual: str, expected: str) -> DataFrame:
    """R squared, MAPE and weighted MAPE per geo and nationally, for train, test and all rows.

    The national level sums the geos per day first.
    """
    return _accuracy(df, [geo], split, actual, expected).withColumnRenamed(geo, "geo")


def mmm_accuracy_national(df: DataFrame, day: str, split: str, actual: str, expected: str) -> DataFrame:
    daily = df.groupBy(day, split).agg(F.sum(actual).alias(actual), F.sum(expected).alias(expected))
    return _accuracy(daily.withColumn("geo", F.lit("national")), ["geo"], split, actual, expected)


def _accuracy(df, groups, split, actual, expected):
    y, e = F.col(actual), F.col(actual) - F.col(expected)
    sizes = [
        F.count(F.lit(1)).alias("n"),
        (F.lit(1.0) - safe_ratio(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
        F.avg(F.abs(safe_ratio(e, y))).alias("mape"),
        safe_ratio(F.sum(F.abs(e)), F.sum(y)).alias("wmape"),
    ]
    by_split = df.groupBy(*groups, split).agg(*sizes)
    overall = df.groupBy(*groups).agg(*sizes).withColumn(split, F.lit("all"))
    return by_split.unionByName(overall).withColumnRenamed(split, "evaluation_set")

