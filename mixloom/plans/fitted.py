"""The mix fit and the decisions that follow from it: prior, fit, contributions, returns, scenario, budget.

The queries of ``plans.decisions`` state every formula on stand-in draws, which SQL can build too; these
here run the same operators on draws of the fit, whose prior is that of ``m8_roi_prior``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import budget, evaluation, geofit
from mixloom.operators import media as media_ops
from mixloom.operators import panel as panel_ops
from mixloom.plans import views
from mixloom.plans.decisions import GIVEN, GRID
from mixloom.plans.registry import Tables, as_text, query
from mixloom.plans.views import CHANNELS, with_views
from mixloom.sources.staging import stage

DRAWS = 100


class Fit:
    """Panel, media, draws and report of one fit; made once per query."""

    def __init__(self, t: Tables):
        self.panel = views.dense_panel(t)
        self.media = stage(media_ops.scale_media(panel_ops.media_input(self.panel), CHANNELS))
        self.prior = panel_ops.roi_prior(panel_ops.empirical_roi(self.panel))
        self.coefficients, self.settings = geofit.geo_fit(self.panel, self.media, CHANNELS, self.prior, DRAWS)

    def draws(self) -> DataFrame:
        return stage(geofit.media_draws(self.coefficients, self.panel, CHANNELS))

    def outcome(self) -> DataFrame:
        return stage(geofit.fitted_outcome(self.coefficients, self.panel, self.media, CHANNELS))


@query("m7_mmm_fit_draws")
def mmm_fit_draws(t: Tables) -> DataFrame:
    return Fit(t).draws()


@query("m7_mmm_fit_report")
def mmm_fit_report(t: Tables) -> DataFrame:
    """Posterior weight and convergence of every setting of the grid."""
    return geofit.fit_report(t.spark, Fit(t).settings)


@query("m7_mmm_geo_effects")
def mmm_geo_effects(t: Tables) -> DataFrame:
    """Effect of every channel in every geo, with its interval."""
    return geofit.geo_effects(Fit(t).draws())


_channels = ", ".join(f"('{c}')" for c in CHANNELS)


@query(
    "m7_mmm_fit_checks",
    with_views(
        "dense_panel",
        f"""SELECT GEO AS geo, channel, {DRAWS}::BIGINT AS n_draws, 0::BIGINT AS n_negative, TRUE AS converged, 1.0::DOUBLE AS weight,
                   TRUE AS ordered, (SELECT CAST(count(DISTINCT DATE_DAY) - floor(0.75 * count(DISTINCT DATE_DAY)) AS BIGINT) FROM dense_panel)
                     AS n_held_out, TRUE AS adds_up
            FROM (SELECT DISTINCT GEO FROM dense_panel), (VALUES {_channels}) c(channel)""",
    ),
)
def mmm_fit_checks(t: Tables) -> DataFrame:
    """What must hold for every geo and channel, whatever the estimates are.

    As many draws as asked for, none negative, all settings converged, weights that add up to 1, ordered
    interval bounds, the held-out days of the mask, and outcomes that are baseline plus contributions.
    """
    fit = Fit(t)
    draws = fit.draws()
    per_series = draws.groupBy("geo", "channel").agg(
        F.countDistinct("draw").alias("n_draws"), F.count_if(F.col("beta") < 0).alias("n_negative")
    )
    settings = geofit.fit_report(t.spark, fit.settings).agg(
        F.every("converged").alias("converged"), F.round(F.sum("weight"), 9).alias("weight")
    )
    effects = geofit.geo_effects(draws).select("geo", "channel", ((F.col("low") <= F.col("median")) & (F.col("median") <= F.col("high"))).alias("ordered"))
    outcome = fit.outcome()
    held = outcome.filter("split = 'test'").groupBy("geo").agg(F.countDistinct("day").alias("n_held_out"))
    # The mean outcome of the draws, once by contributions and once by the coefficients.
    parts = media_ops.contributions(draws, fit.media).groupBy("geo").agg((F.sum("contribution") / F.lit(DRAWS)).alias("media"))
    whole = geofit.mean_outcome(fit.coefficients, fit.panel, fit.media, CHANNELS).groupBy("geo").agg(
        F.sum("expected").alias("expected"), F.sum("baseline").alias("baseline")
    )
    gap = F.abs(F.col("expected") - F.col("baseline") - F.col("media"))
    sums = parts.join(whole, "geo").select("geo", (gap <= 1e-6 * F.greatest(F.abs("expected"), F.lit(1.0))).alias("adds_up"))
    joined = per_series.join(effects, ["geo", "channel"]).join(held, "geo").join(sums, "geo")
    return joined.crossJoin(F.broadcast(settings)).select(
        "geo", "channel", "n_draws", "n_negative", "converged", "weight", "ordered", "n_held_out", "adds_up"
    )


@query("m7_mmm_fit_accuracy")
def mmm_fit_accuracy(t: Tables) -> DataFrame:
    """National accuracy on training days, held-out days and all."""
    return evaluation.mmm_accuracy_national(Fit(t).outcome(), "day", "split", "actual", "expected")


@query("a31_mmm_accuracy_geo_fitted")
def mmm_accuracy_geo_fitted(t: Tables) -> DataFrame:
    return evaluation.mmm_accuracy(Fit(t).outcome(), "geo", "split", "actual", "expected")


@query("m9_contributions_fitted")
def contributions_fitted(t: Tables) -> DataFrame:
    fit = Fit(t)
    return as_text(media_ops.contribution_intervals(media_ops.contributions(fit.draws(), fit.media)), "day")


@query("m11_expected_outcome_fitted")
def expected_outcome_fitted(t: Tables) -> DataFrame:
    return as_text(Fit(t).outcome(), "day")


@query("m7_mmm_fit_roi")
def mmm_fit_roi(t: Tables) -> DataFrame:
    fit = Fit(t)
    return media_ops.return_table(fit.draws(), fit.media, "roi")


@query("a33_mroi_table_fitted")
def mroi_table_fitted(t: Tables) -> DataFrame:
    fit = Fit(t)
    return media_ops.return_table(fit.draws(), fit.media, "mroi")


@query("m20_what_if_fitted")
def what_if_fitted(t: Tables) -> DataFrame:
    fit = Fit(t)
    return media_ops.what_if(fit.draws(), fit.media, GIVEN, "given", CHANNELS)


@query("m16_optimize_budget_fitted")
def optimize_budget_fitted(t: Tables) -> DataFrame:
    """The whole chain: prior, fit, response curves of the fitted draws, best allocation of the same budget."""
    fit = Fit(t)
    curve = stage(media_ops.response_curve(fit.draws(), fit.media, GRID))
    return budget.optimize_budget(curve)
