"""Descriptive aggregates: counts, crosstabs, distributions, concentration, association."""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions.scalars import coalesced_sum, histogram_bin, row_total, safe_ratio
from mixloom.operators.ordering import exact_quantiles, running_totals
from mixloom.operators.quality import value_share
from mixloom.sources.staging import stage


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share in percent."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return value_share(counted, "n_rows", "pct")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties by value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.orderBy(F.desc("n_rows"), column).limit(k)


def sum_by(df: DataFrame, dimension: str, value: str, out: str) -> DataFrame:
    return df.groupBy(dimension).agg(F.sum(value).alias(out))


def crosstab(df: DataFrame, a: str, b: str, values) -> DataFrame:
    """Counts of ``a`` by ``b``, wide and zero-filled; ``values`` fixes the columns."""
    return df.groupBy(a).pivot(b, list(values)).agg(F.count(F.lit(1))).fillna(0)


def row_share(df: DataFrame, a: str, b: str) -> DataFrame:
    """Share of each ``b`` within ``a`` in percent, long."""
    counted = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n_rows"))
    # One row per pair of category values.
    total = F.sum("n_rows").over(Window.partitionBy(a))
    return counted.withColumn("pct", F.col("n_rows") * 100.0 / total)


def top_n_per_group(df: DataFrame, group: str, category: str, n: int = 3) -> DataFrame:
    """The ``n`` most frequent categories of each group; ties by category."""
    counted = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("n_rows"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n_rows"), F.col(category)))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= n)


def daily_sum(df: DataFrame, day: str, columns, total: str | None = None) -> DataFrame:
    """Sums per day; ``total`` adds the sum across the columns."""
    out = df.groupBy(day).agg(*[coalesced_sum(c).alias(c) for c in columns])
    return out.withColumn(total, row_total(columns)) if total else out


def column_totals(df: DataFrame, columns, name="column_name", value="total", strip_suffix="") -> DataFrame:
    """Total of each column, long; a common suffix is cut from the names."""
    renamed = {c: c.removesuffix(strip_suffix) for c in columns}
    wide = df.agg(*[coalesced_sum(c).alias(renamed[c]) for c in columns])
    return wide.unpivot([], list(renamed.values()), name, value)


def totals_by_group(df: DataFrame, group: str, columns, strip_suffix="") -> DataFrame:
    """Total of each column per group, NULL counted as 0."""
    return df.groupBy(group).agg(*[coalesced_sum(c).alias(c.removesuffix(strip_suffix)) for c in columns])


def concentration(df: DataFrame, columns, strip_suffix="") -> DataFrame:
    """Share of each column's total in the total of all."""
    totals = column_totals(df, columns, "channel", "total_spend", strip_suffix)
    return value_share(totals, "total_spend", "pct_of_total")


def boxplot_stats(df: DataFrame, columns) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and number of outliers per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggregates, parts = [], []
    for i, c in enumerate(columns):
        q1, q2, q3 = (float("nan") if q is None else q for q in quartiles[c])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = (F.col(c) >= F.lit(low)) & (F.col(c) <= F.lit(high))
        aggregates.append(
            F.struct(
                F.min(F.when(inside, F.col(c))).cast("double").alias("low"),
                F.max(F.when(inside, F.col(c))).cast("double").alias("high"),
                F.count_if(~inside).alias("out"),
            ).alias(f"c{i}")
        )
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(q1).alias("q1"),
                F.lit(q2).alias("median"),
                F.lit(q3).alias("q3"),
                F.col(f"c{i}.low").alias("whisker_low"),
                F.col(f"c{i}.high").alias("whisker_high"),
                F.col(f"c{i}.out").alias("n_outliers"),
            )
        )
    return df.agg(*aggregates).select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts over the observed range; bins without rows are listed with 0."""
    edges = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    binned = (
        df.filter(F.col(column).isNotNull())
        .crossJoin(F.broadcast(edges))
        .select(histogram_bin(F.col(column).cast("double"), "lo", "hi", bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    frame = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(binned, "bin", "left").select(
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_low"),
        (F.col("lo") + width * (F.col("bin") + F.lit(1))).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"),
    )


def quantile_trim(df: DataFrame, column: str, prob: float = 0.99) -> DataFrame:
    """Rows up to the ``prob`` quantile of ``column``."""
    edge = exact_quantiles(df, [column], [prob])[column][0]
    return df.filter(F.lit(False)) if edge is None else df.filter(F.col(column) <= F.lit(edge))


def lorenz(customers: DataFrame, key: str, value: str, buckets: int | None = None, digits: int | None = None) -> DataFrame:
    """Cumulative share of value against cumulative share of customers, largest first; ties by key.

    Values that are sums of doubles differ in their last bits with the order of addition; with ``digits`` the
    order is that of the values rounded so far, and equal ones are ties.
    """
    order = F.col(value) if digits is None else F.round(value, digits)
    base = stage(customers.select(key, F.col(value).alias("_value"), (-order).alias("_order")))
    ones = base.withColumn("_one", F.lit(1).cast("long"))
    running = running_totals(ones, ["_order", key], {"_cum_value": "_value", "_rank": "_one"}, buckets)
    total = base.agg(F.sum("_value").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    return running.crossJoin(F.broadcast(total)).select(
        key,
        F.col("_rank").alias("customer_rank"),
        (F.col("_cum_value") * 100.0 / F.col("_sum")).alias("cum_value_pct"),
        (F.col("_rank") * 100.0 / F.col("_n")).alias("cum_customer_pct"),
    )


def seasonality(df: DataFrame, number, name, value: str) -> DataFrame:
    """Mean per calendar unit, with the number that gives calendar order."""
    return df.groupBy(number.alias("unit_no"), name.alias("unit_name")).agg(F.avg(value).alias("mean_value"))


def anova_oneway(df: DataFrame, group, value: str) -> DataFrame:
    """F statistic of a one-way analysis of variance, from one pass of group moments."""
    v = F.col(value).cast("double")
    # var_pop is merged numerically stably, unlike a sum of squares.
    groups = df.filter(v.isNotNull()).groupBy(group.alias("g")).agg(
        F.count(v).alias("n"), F.avg(v).alias("m"), (F.var_pop(v) * F.count(v)).alias("within")
    )
    totals = groups.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum("within").alias("ssw"),
        # Between-group squares as weighted moments of the group means.
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - F.pow(F.sum(F.col("n") * F.col("m")), 2) / F.sum("n")).alias(
            "ssb"
        ),
    )
    df_between, df_within = F.col("k") - F.lit(1), F.col("n") - F.col("k")
    return totals.select(
        df_between.alias("df_between"),
        df_within.alias("df_within"),
        safe_ratio(F.col("ssb") / df_between, F.col("ssw") / df_within).alias("f_statistic"),
    )


def anova_test(df: DataFrame, group, value: str, level: float = 0.05) -> DataFrame:
    """``anova_oneway`` with its p-value; only the one-row result reaches the driver."""
    row = anova_oneway(df, group, value).first()
    p = f_survival(row["f_statistic"], row["df_between"], row["df_within"])
    return df.sparkSession.createDataFrame(
        [(int(row["df_between"]), int(row["df_within"]), float(row["f_statistic"]), p, p < level)],
        "df_between long, df_within long, f_statistic double, p_value double, significant boolean",
    )


def f_survival(f: float, d1: int, d2: int) -> float:
    """Upper tail of the F distribution by the continued fraction of the incomplete beta."""
    x = d2 / (d2 + d1 * f)
    return _incomplete_beta(d2 / 2.0, d1 / 2.0, x)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return min(1.0, max(0.0, x))
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b
    return front * _beta_fraction(a, b, x) / a


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Evaluate the fraction from its tail; 300 levels are ample for x below the mean."""
    tail = 1.0
    for m in range(300, 0, -1):
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        tail = 1.0 + even / (1.0 + odd / tail)
    first = -(a + b) * x / (a + 1.0)
    return 1.0 / (1.0 + first / tail)


def corr_matrix(df: DataFrame, columns) -> DataFrame:
    """Pearson correlations of complete pairs, all in one pass, long."""
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"p{i}").alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def partial_corr_matrix(df: DataFrame, columns) -> DataFrame:
    """Correlation of each pair given all other columns, NULL taken as 0.

    The covariance matrix is one aggregate; its inverse P, a p x p matrix of the
    columns, gives -Pij / sqrt(Pii Pjj), which equals the correlation of regression
    residuals.
    """
    columns = list(columns)
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    pairs = list(itertools.combinations_with_replacement(range(len(columns)), 2))
    row = filled.agg(*[F.covar_samp(columns[i], columns[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    cov = np.array([[row[f"p{min(i, j)}_{max(i, j)}"] for j in range(len(columns))] for i in range(len(columns))])
    scale = np.sqrt(np.diag(cov))
    scale[scale == 0.0] = 1.0
    precision = np.linalg.pinv(cov / np.outer(scale, scale), hermitian=True)
    root = np.sqrt(np.diag(precision))
    with np.errstate(divide="ignore", invalid="ignore"):
        partial = -precision / np.outer(root, root)
    np.fill_diagonal(partial, 1.0)
    cells = [
        (a, b, None if math.isnan(partial[i, j]) else float(partial[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(cells, "col_a string, col_b string, partial_r double")
