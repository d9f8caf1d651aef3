"""Investment decisions: channel metrics, allocation strategies, budget optimisation and reports.

These work on one row per channel, or on one row per channel and step of a spend grid.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions.scalars import safe_ratio
from mixloom.operators.media import channel_spend

# Fixed values of the published analysis.
SATURATION_LEVEL = 1.0
EXTRA_SHARE = 0.20
SATURATED_CUT = 0.30
LOWER_BOUND, UPPER_BOUND = 0.5, 2.0
UNDER, OVER = "Under-invested", "Over-invested"


def investment_status(roi: DataFrame, mroi: DataFrame) -> DataFrame:
    """Median ROI and marginal ROI side by side; above 1 at the margin is under-invested."""
    joined = roi.select("channel", "roi_median").join(mroi.select("channel", "mroi_median"), "channel")
    return joined.withColumn("status", F.when(F.col("mroi_median") > 1, UNDER).otherwise(OVER))


def channel_metrics(media: DataFrame, roi: DataFrame, mroi: DataFrame, level: float = SATURATION_LEVEL) -> DataFrame:
    """Total spend, median returns and the saturation flag per channel."""
    return (
        channel_spend(media)
        .join(roi.select("channel", "roi_median"), "channel")
        .join(mroi.select("channel", "mroi_median"), "channel")
        .withColumn("is_saturated", F.col("mroi_median") < level)
    )


def best_channel(metrics: DataFrame, by: str = "mroi_median") -> DataFrame:
    """The channel with the highest value; ties by name."""
    order = F.struct(-F.col(by), F.col("channel"))
    return metrics.agg(F.min_by("channel", order).alias("channel"), F.max(by).alias(by))


def _with_budget(metrics: DataFrame, share: float) -> DataFrame:
    totals = metrics.agg(
        (F.sum("spend_total") * F.lit(share)).alias("_extra"), F.count(F.lit(1)).alias("_n")
    )
    return metrics.crossJoin(F.broadcast(totals))


def _multipliers(new_spend: DataFrame) -> DataFrame:
    return new_spend.select("channel", "new_spend", safe_ratio("new_spend", "spend_total").alias("multiplier"))


def strategy_equal(metrics: DataFrame, share: float = EXTRA_SHARE) -> DataFrame:
    """The extra budget in equal parts."""
    new = F.col("spend_total") + F.col("_extra") / F.col("_n")
    return _multipliers(_with_budget(metrics, share).withColumn("new_spend", new))


def strategy_best_mroi(metrics: DataFrame, share: float = EXTRA_SHARE) -> DataFrame:
    """All of the extra budget to the channel with the best marginal return."""
    best = best_channel(metrics).select(F.col("channel").alias("_best"))
    extra = F.when(F.col("channel") == F.col("_best"), F.col("_extra")).otherwise(0.0)
    budget = _with_budget(metrics, share).crossJoin(F.broadcast(best))
    return _multipliers(budget.withColumn("new_spend", F.col("spend_total") + extra))


def strategy_saturation_aware(
    metrics: DataFrame, share: float = EXTRA_SHARE, cut: float = SATURATED_CUT, level: float = SATURATION_LEVEL
) -> DataFrame:
    """Cut saturated channels; the freed and the extra budget go to the others by marginal return.

    With all channels saturated there is nowhere to move the budget; that is an error.
    """
    saturated = F.col("mroi_median") < level
    sums = metrics.agg(
        (F.sum("spend_total") * F.lit(share)).alias("_extra"),
        F.coalesce(F.sum(F.when(saturated, F.col("spend_total"))) * F.lit(cut), F.lit(0.0)).alias("_freed"),
        F.sum(F.when(~saturated, F.col("mroi_median"))).alias("_weight"),
    )
    if sums.filter("_weight IS NULL").count():
        raise ValueError("all channels are saturated; there is nowhere to move the budget")
    part = (F.col("_freed") + F.col("_extra")) * F.col("mroi_median") / F.col("_weight")
    new = F.when(saturated, F.col("spend_total") * F.lit(1.0 - cut)).otherwise(F.col("spend_total") + part)
    return _multipliers(metrics.crossJoin(F.broadcast(sums)).withColumn("new_spend", new))


def strategy_top_channel(metrics: DataFrame, by: str = "roi_median", factor: float = 1.5) -> DataFrame:
    """Half as much again on the best performer."""
    best = best_channel(metrics, by).select(F.col("channel").alias("_best"))
    scale = F.when(F.col("channel") == F.col("_best"), F.lit(factor)).otherwise(1.0)
    return _multipliers(metrics.crossJoin(F.broadcast(best)).withColumn("new_spend", F.col("spend_total") * scale))


def strategy_random_half(metrics: DataFrame, seed: int = 42, factor: float = 1.1) -> DataFrame:
    """Ten percent more on a seeded random half of the channels."""
    token = F.md5(F.concat(F.col("channel"), F.lit(f"#{seed}")))
    # One row per channel.
    place = F.row_number().over(Window.orderBy("_token"))
    total = metrics.agg(F.count(F.lit(1)).alias("_n"))
    ranked = metrics.withColumn("_token", token).withColumn("_place", place).crossJoin(F.broadcast(total))
    scale = F.when(F.col("_place") <= F.floor(F.col("_n") / 2), F.lit(factor)).otherwise(1.0)
    return _multipliers(ranked.withColumn("new_spend", F.col("spend_total") * scale))


def strategy_kpis(result: DataFrame, metrics: DataFrame, price: DataFrame, share: float = EXTRA_SHARE) -> DataFrame:
    """Incremental purchases and return of a scenario on the extra budget."""
    extra = metrics.agg((F.sum("spend_total") * F.lit(share)).alias("_extra"))
    return (
        result.crossJoin(F.broadcast(extra))
        .crossJoin(F.broadcast(price))
        .withColumns(
            {
                "incremental_purchases": safe_ratio("delta_abs", "avg_price"),
                "incremental_roi": safe_ratio("delta_abs", "_extra"),
            }
        )
        .drop("_extra", "avg_price")
    )


def spend_grid(lower: float = LOWER_BOUND, upper: float = UPPER_BOUND, steps: int = 60) -> list[float]:
    """Spend multipliers from the lower to the upper bound."""
    return [lower + (upper - lower) * i / steps for i in range(steps + 1)]


def _best_plan(spends: list[np.ndarray], outcomes: list[np.ndarray], budget: float) -> list[int]:
    """Index of the point to take of each channel: the best sum of outcomes within the budget, then the least spend.

    Multiple-choice knapsack by max-plus convolution of the channels' points: after each channel only
    plans that no cheaper plan equals in outcome are kept, so the search is exact for any curve and budget.
    """
    limit = budget + abs(budget) * 1e-12
    # What the channels to come need at least.
    rest = np.concatenate([np.cumsum([s.min() for s in spends[::-1]])[::-1][1:], [0.0]])
    spent, gained, trail = np.zeros(1), np.zeros(1), []
    for at, (s, g) in enumerate(zip(spends, outcomes, strict=True)):
        total, value = np.add.outer(spent, s).ravel(), np.add.outer(gained, g).ravel()
        affordable = np.flatnonzero(total + rest[at] <= limit)
        if not len(affordable):  # the budget does not pay the lowest spends
            return [int(x.argmin()) for x in spends]
        order = affordable[np.lexsort((-value[affordable], total[affordable]))]
        best = np.maximum.accumulate(value[order])
        kept = order[np.concatenate([[True], best[1:] > best[:-1]])]
        trail.append((kept // len(s), kept % len(s)))
        spent, gained = total[kept], value[kept]
    plan, state = [], len(spent) - 1
    for before, point in reversed(trail):
        plan.append(int(point[state]))
        state = int(before[state])
    return plan[::-1]


def optimize_budgets(curve: DataFrame, budgets: DataFrame, outcome: str = "median") -> DataFrame:
    """``optimize_budget`` for every row of ``budgets`` (column ``budget``), each in a task of its own."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [p.sort_values("spend") for _, p in group.groupby("channel", sort=True)]
        plan = _best_plan([p["spend"].to_numpy() for p in parts], [p["outcome"].to_numpy() for p in parts], key[0])
        rows = [p.iloc[i] for p, i in zip(parts, plan, strict=True)]
        spent = sum(r["spend"] for r in rows)
        return pd.DataFrame(
            {
                "budget": key[0],
                "channel": [r["channel"] for r in rows],
                "spend_historical": [(p["spend"] / p["multiplier"]).max() for p in parts],
                "spend": [r["spend"] for r in rows],
                "incremental_outcome": [r["outcome"] for r in rows],
                "unspent": key[0] - spent,
            }
        )

    points = curve.select("channel", "multiplier", "spend", F.col(outcome).cast("double").alias("outcome")).filter("outcome is not null")
    # A curve has channels times grid points.
    paired = budgets.select(F.col("budget").cast("double").alias("budget")).distinct().join(F.broadcast(points))
    kinds = "budget double, channel string, spend_historical double, spend double, incremental_outcome double, unspent double"
    return paired.groupBy("budget").applyInPandas(run, kinds)


def optimize_budget(curve: DataFrame, budget: float | None = None, outcome: str = "median") -> DataFrame:
    """Spend per channel that maximises the outcome under a fixed budget, for curves of any shape.

    ``curve`` comes from ``response_curve`` over ``spend_grid``. Every channel takes one point of its
    curve; no other plan within the budget has a larger sum, so no step up that raises the outcome could
    be paid from ``unspent``. Without a budget it is the historical spend. A budget below the lowest spends
    leaves every channel there, and ``unspent`` is negative.
    """
    if budget is None:
        per_channel = curve.groupBy("channel").agg(F.max(F.try_divide("spend", "multiplier")).alias("spend_historical"))
        budgets = per_channel.agg(F.sum("spend_historical").alias("budget"))
    else:
        budgets = curve.sparkSession.range(1).select(F.lit(float(budget)).alias("budget"))
    return optimize_budgets(curve, budgets, outcome).drop("budget")


def compare_allocation(optimised: DataFrame, historical: DataFrame) -> DataFrame:
    """Spend, revenue and returns per channel before and after."""
    after = optimised.select(
        "channel",
        F.col("spend").alias("spend_optimized"),
        F.col("incremental_outcome").alias("revenue_optimized"),
        *[F.col(c).alias(f"{c}_optimized") for c in ("roi", "mroi") if c in optimised.columns],
    )
    before = historical.select(
        "channel",
        F.col("spend").alias("spend_historical"),
        F.col("incremental_outcome").alias("revenue_historical"),
        *[F.col(c).alias(f"{c}_historical") for c in ("roi",) if c in historical.columns],
    )
    delta = F.col("spend_optimized") - F.col("spend_historical")
    return before.join(after, "channel").withColumns(
        {
            "spend_delta": delta,
            "spend_delta_pct": F.round(safe_ratio(delta, "spend_historical") * F.lit(100.0), 1),
            "revenue_delta": F.col("revenue_optimized") - F.col("revenue_historical"),
        }
    )


def optimization_totals(comparison: DataFrame) -> DataFrame:
    """Totals before and after; each return is divided by its own spend."""
    sums = comparison.agg(
        *[
            F.sum(c).alias(c)
            for c in ("spend_historical", "spend_optimized", "revenue_historical", "revenue_optimized")
        ]
    )
    gain = F.col("revenue_optimized") - F.col("revenue_historical")
    return sums.withColumns(
        {
            "revenue_gain": gain,
            "revenue_gain_pct": safe_ratio(gain, "revenue_historical") * F.lit(100.0),
            "roi_historical": safe_ratio("revenue_historical", "spend_historical"),
            "roi_optimized": safe_ratio("revenue_optimized", "spend_optimized"),
        }
    )


def reallocation_report(comparison: DataFrame) -> DataFrame:
    """Direction and size of the change per channel."""
    delta = F.col("spend_optimized") - F.col("spend_historical")
    return comparison.select(
        "channel",
        F.when(delta > 0, "Increase").otherwise("Decrease").alias("direction"),
        delta.alias("spend_delta"),
        F.col("spend_historical").alias("spend_from"),
        F.col("spend_optimized").alias("spend_to"),
    )

