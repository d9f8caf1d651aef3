"""Marketing-mix fit: a bootstrap ensemble of non-negative ridge regressions.

Not a posterior sampler. A grid of carry-over and saturation settings is crossed with
bootstrap replicates of the weeks. The Gram matrix of each setting is summed per week
once, in the JVM; a replicate only reweights those weekly blocks. What remains per
setting and replicate is a system as small as the number of columns.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.functions.dates import period_index
from mixloom.functions.scalars import hill, safe_ratio
from mixloom.operators.media import adstock, with_lags
from mixloom.operators.panel import temporal_split
from mixloom.sources.staging import stage

ALPHAS = (0.2, 0.5, 0.8)
ECS = (0.5, 1.0, 2.0)
# Cumulative Poisson(1) probabilities for bootstrap weights 0..5.
POISSON_ONE = (0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406)
DAYS = (1, 2, 3, 4, 5, 6)


def design(panel: DataFrame, media: DataFrame, channels, alphas=ALPHAS, ecs=ECS) -> DataFrame:
    """One row per setting, geo and day: saturated media, controls, scaled outcome, week and split.

    The outcome is divided by the mean of its geo, which replaces geo effects.
    """
    spark = panel.sparkSession
    alpha_grid = spark.createDataFrame([(float(a),) for a in alphas], "alpha double")
    ec_grid = spark.createDataFrame([(float(e),) for e in ecs], "ec double")
    carried = (
        with_lags(media)
        .crossJoin(F.broadcast(alpha_grid))
        .withColumn("adstocked", adstock(F.col("alpha")))
        .crossJoin(F.broadcast(ec_grid))
        .withColumn("response", hill("adstocked", "ec", F.lit(1.0)))
    )
    wide = carried.groupBy("alpha", "ec", "geo", "day").pivot("channel", list(channels)).agg(F.sum("response"))
    named = wide.withColumnsRenamed({c: f"x{i}" for i, c in enumerate(channels)})
    means = panel.groupBy("GEO").agg(F.avg("NET_REVENUE").alias("_mean"))
    last = panel.agg(F.greatest(F.max("TREND"), F.lit(1)).alias("_last"))
    controls = temporal_split(panel, "DATE_DAY").join(means, "GEO").crossJoin(F.broadcast(last))
    k = len(channels)
    columns = [
        F.lit(1.0).alias(f"x{k}"),
        F.col("DISCOUNT_RATE").cast("double").alias(f"x{k + 1}"),
        (F.col("TREND") / F.col("_last")).cast("double").alias(f"x{k + 2}"),
        *[(F.col("DAY_OF_WEEK") == d).cast("double").alias(f"x{k + 2 + d}") for d in DAYS],
    ]
    rows = controls.select(
        F.col("GEO").alias("geo"),
        F.col("DATE_DAY").alias("day"),
        period_index("DATE_DAY").alias("week"),
        (F.col("split") == "test").alias("is_holdout"),
        safe_ratio("NET_REVENUE", "_mean", 0.0).alias("y"),
        *columns,
    )
    return named.fillna(0.0).join(rows, ["geo", "day"])


def weekly_gram(rows: DataFrame, size: int) -> DataFrame:
    """Upper triangle of X'X, X'y and y'y per setting, week and split, in one aggregate."""
    x = [F.col(f"x{i}") for i in range(size)]
    pairs = list(itertools.combinations_with_replacement(range(size), 2))
    return rows.groupBy("alpha", "ec", "week", "is_holdout").agg(
        *[F.sum(x[i] * x[j]).alias(f"g{n}") for n, (i, j) in enumerate(pairs)],
        *[F.sum(x[i] * F.col("y")).alias(f"b{i}") for i in range(size)],
        F.sum(F.col("y") * F.col("y")).alias("yy"),
    )


def bootstrap_weights(weeks: DataFrame, replicates: int, seed: int) -> DataFrame:
    """Poisson(1) weight per week and replicate, from a hash, so that it is repeatable."""
    expanded = weeks.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    u = F.pmod(F.xxhash64("draw", "week", F.lit(seed)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    weight = sum([(u > F.lit(p)).cast("int") for p in POISSON_ONE], F.lit(0))
    return expanded.withColumn("w", weight.cast("double"))


#: A sweep that moves no coefficient by more than this ends the descent; more sweeps than this are an error.
SWEEP_TOLERANCE = 1e-9
MAX_SWEEPS = 100_000


def solve_blocks(size: int, n_media: int, ridge: float, centre: float):
    """Per-batch solver for rows of summed Gram matrices; numpy on p x p systems."""
    n_pairs = size * (size + 1) // 2
    upper = np.triu_indices(size)

    def unpack(pdf, prefix):
        gram = np.zeros((len(pdf), size, size))
        gram[:, upper[0], upper[1]] = pdf[[f"{prefix}g{n}" for n in range(n_pairs)]].to_numpy()
        gram = gram + np.transpose(np.triu(gram, 1), (0, 2, 1))
        return gram, pdf[[f"{prefix}b{i}" for i in range(size)]].to_numpy()

    def run(batches):
        for pdf in batches:
            gram, cross = unpack(pdf, "t_")
            penalty = ridge * np.trace(gram, axis1=1, axis2=2) / size
            system = gram + penalty[:, None, None] * np.eye(size)
            rhs = cross.copy()
            rhs[:, :n_media] += penalty[:, None] * centre
            beta = np.zeros_like(rhs)
            # Coordinate descent; media effects stay non-negative.
            for _ in range(MAX_SWEEPS):
                before = beta.copy()
                for i in range(size):
                    rest = rhs[:, i] - np.einsum("nj,nj->n", system[:, i, :], beta) + system[:, i, i] * beta[:, i]
                    value = rest / np.maximum(system[:, i, i], 1e-12)
                    beta[:, i] = np.maximum(value, 0.0) if i < n_media else value
                if (np.abs(beta - before) <= SWEEP_TOLERANCE * np.maximum(1.0, np.abs(beta))).all():
                    break
            else:
                raise ValueError(f"coordinate descent did not converge in {MAX_SWEEPS} sweeps")
            held, held_cross = unpack(pdf, "h_")
            sse = (
                pdf["h_yy"].to_numpy()
                - 2.0 * np.einsum("ni,ni->n", held_cross, beta)
                + np.einsum("ni,nij,nj->n", beta, held, beta)
            )
            out = pdf[["draw", "alpha", "ec"]].copy()
            out["holdout_sse"] = sse
            out["beta"] = list(beta)
            yield out

    return run


def mmm_fit(
    panel: DataFrame,
    media: DataFrame,
    channels,
    replicates: int = 100,
    alphas=ALPHAS,
    ecs=ECS,
    ridge: float = 0.01,
    prior_effect: float = 0.0,
    seed: int = 42,
) -> DataFrame:
    """Bootstrap draws of coefficients, one row per draw: the setting best on the held-out weeks.

    ``prior_effect`` is the value towards which ridge pulls the media effects.
    """
    channels = list(channels)
    size = len(channels) + 3 + len(DAYS)
    rows = design(panel, media, channels, alphas, ecs)
    blocks = stage(weekly_gram(rows, size))
    sums = [c for c in blocks.columns if c[0] in "gby" and c not in ("geo",)]
    weights = bootstrap_weights(blocks.select("week").distinct(), replicates, seed)
    train = F.when(~F.col("is_holdout"), F.col("w")).otherwise(0.0)
    held = F.col("is_holdout").cast("double")
    summed = (
        blocks.join(F.broadcast(weights), "week")
        .groupBy("draw", "alpha", "ec")
        .agg(
            *[F.sum(F.col(c) * train).alias(f"t_{c}") for c in sums],
            *[F.sum(F.col(c) * held).alias(f"h_{c}") for c in sums],
        )
    )
    fitted = summed.mapInPandas(
        solve_blocks(size, len(channels), ridge, prior_effect),
        "draw int, alpha double, ec double, holdout_sse double, beta array<double>",
    )
    best = F.struct("holdout_sse", "alpha", "ec")
    return fitted.groupBy("draw").agg(
        F.min(best).alias("_best"), F.min_by("beta", best).alias("coefficients")
    ).select("draw", "_best.alpha", "_best.ec", "_best.holdout_sse", "coefficients")


def fit_draws(fit: DataFrame, panel: DataFrame, channels) -> DataFrame:
    """Draws table per geo and channel; effects are scaled back by the geo mean."""
    means = panel.groupBy(F.col("GEO").alias("geo")).agg(F.avg("NET_REVENUE").alias("_mean"))
    effects = F.array(
        *[F.struct(F.lit(c).alias("channel"), F.element_at("coefficients", i + 1).alias("b")) for i, c in enumerate(channels)]
    )
    long = fit.select("draw", "alpha", "ec", F.explode(effects).alias("e"))
    # Replicates times channels, a setting of the fit.
    return means.crossJoin(F.broadcast(long)).select(
        "draw",
        "geo",
        "e.channel",
        (F.col("e.b") * F.col("_mean")).alias("beta"),
        "alpha",
        "ec",
        F.lit(1.0).alias("slope"),
    )


def fitted_values(fit: DataFrame, panel: DataFrame, media: DataFrame, channels, alphas=ALPHAS, ecs=ECS) -> DataFrame:
    """Actual and expected outcome per geo and day, median over draws."""
    channels = list(channels)
    size = len(channels) + 3 + len(DAYS)
    rows = design(panel, media, channels, alphas, ecs).join(F.broadcast(fit), ["alpha", "ec"])
    expected = sum([F.col(f"x{i}") * F.element_at("coefficients", i + 1) for i in range(size)], F.lit(0.0))
    middle = rows.groupBy("geo", "day", "is_holdout").agg(F.percentile(expected, F.lit(0.5)).alias("_e"))
    base = panel.select(F.col("GEO").alias("geo"), F.col("DATE_DAY").alias("day"), F.col("NET_REVENUE").alias("actual"))
    means = base.groupBy("geo").agg(F.avg("actual").alias("_mean"))
    return (
        middle.join(base, ["geo", "day"])
        .join(means, "geo")
        .select(
            "geo",
            "day",
            F.when(F.col("is_holdout"), "test").otherwise("train").alias("split"),
            "actual",
            (F.col("_e") * F.col("_mean")).alias("expected"),
        )
    )
