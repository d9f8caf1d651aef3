"""Marketing-mix fit with geo effects: a hierarchical linear model from per-geo Gram matrices.

For geo g and day t the scaled outcome is x(t)' b_g + noise, where x holds the saturated media of one
carry-over and saturation setting, an intercept and the controls. The coefficients of the geos are drawn
around common ones, b_g ~ N(mu, diag(tau^2)), so geos with little evidence lean on the others (partial
pooling). The common media effects have a prior: centre and precision per channel, the moments of a
log-normal prior on the return (``panel.roi_prior``).

All that the data say is in one small matrix per geo and setting, summed once by ``groupBy``. Each pass of
the fit is one aggregate over that table; only sums as large as the number of coefficients squared reach
the driver, whatever the number of geos and days. A pass gives the marginal likelihood, its gradient and its expected
information, and the next state is a step of Fisher scoring: the common effects go to their maximum given the
variances, the logarithms of the variances take a damped step that is taken back if the likelihood falls. Variances
near 0, on which the EM algorithm creeps, take no more passes than others. The settings of the grid get posterior
weights from their marginal likelihoods; draws are dealt to settings by weight. Given a setting, common effects are
drawn from their posterior given the variances, then the geos' effects given these, media effects truncated at 0.

Intervals are conditional on the variances, which are point estimates. Held-out days take no part in the
fit; they are for ``fitted_outcome`` to be judged on.
"""

from __future__ import annotations

import itertools
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators.mixfit import ALPHAS, DAYS, ECS, design
from mixloom.sources.staging import stage

SETTING = ["alpha", "ec"]
#: Weight of the prior on a variance between geos, in geos, and its centre as a share of the outcome's mean.
VARIANCE_WEIGHT = 2.0
VARIANCE_CENTRE = 0.1
#: Passes over the Gram table after which a fit that still moves is reported as not converged.
MAX_PASSES = 120
#: A setting whose next step promises no more log-likelihood than this has converged.
TOLERANCE = 1e-6
#: Largest step of the logarithm of a variance.
LARGEST_STEP = 3.0
SWEEPS = 25


@dataclass(frozen=True)
class State:
    """Common effects, variances between geos and noise variance of one setting."""

    mu: np.ndarray
    tau2: np.ndarray
    sigma2: float

    def vector(self) -> np.ndarray:
        return np.concatenate([self.mu, np.log(self.tau2), [math.log(self.sigma2)]])

    @staticmethod
    def of(vector: np.ndarray) -> State:
        p = (len(vector) - 1) // 2
        logs = np.clip(vector[p:], -40.0, 40.0)
        return State(vector[:p], np.exp(logs[:p]), float(np.exp(logs[p])))


@dataclass(frozen=True)
class SettingFit:
    """How a setting's fit ended, and what draws need of it."""

    alpha: float
    ec: float
    state: State
    log_likelihood: float
    weight: float
    converged: bool
    passes: int
    change: float
    mean: np.ndarray
    precision: np.ndarray


def geo_gram(rows: DataFrame, size: int) -> DataFrame:
    """Upper triangle of X'X, X'y, y'y and the number of training days, per setting and geo."""
    x = [F.col(f"x{i}") for i in range(size)]
    train = F.when(~F.col("is_holdout"), F.lit(1.0)).otherwise(0.0)
    pairs = list(itertools.combinations_with_replacement(range(size), 2))
    return rows.groupBy(*SETTING, "geo").agg(
        F.array(*[F.sum(x[i] * x[j] * train) for i, j in pairs]).alias("gram"),
        F.array(*[F.sum(x[i] * F.col("y") * train) for i in range(size)]).alias("cross"),
        F.sum(F.col("y") * F.col("y") * train).alias("yy"),
        F.sum(train).alias("n"),
    )


def _unpack(pdf: pd.DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    upper = np.triu_indices(size)
    gram = np.zeros((len(pdf), size, size))
    gram[:, upper[0], upper[1]] = np.stack(pdf["gram"].to_list())
    gram = gram + np.transpose(np.triu(gram, 1), (0, 2, 1))
    return gram, np.stack(pdf["cross"].to_list()), pdf["yy"].to_numpy(), pdf["n"].to_numpy()


def _geo_posterior(gram: np.ndarray, cross: np.ndarray, state: State) -> tuple[np.ndarray, np.ndarray]:
    """Precision and covariance of the geos' effects given the common ones."""
    precision = gram / state.sigma2 + np.diag(1.0 / state.tau2)
    return precision, np.linalg.inv(precision)


@dataclass(frozen=True)
class Sums:
    """What a pass sums up over the geos of a setting; V is the covariance of a geo's outcomes, r their residuals."""

    geos: float
    trace: float  # tr V^-1
    trace2: float  # tr V^-2
    log_likelihood: float
    rest2: float  # r' V^-2 r
    score: np.ndarray  # X' V^-1 r, the gradient by the common effects
    score2: np.ndarray  # its squares, geo by geo
    cross2: np.ndarray  # diagonal of X' V^-2 X
    info: np.ndarray  # X' V^-1 X
    info2: np.ndarray  # its squares, geo by geo

    @staticmethod
    def of(v: np.ndarray, p: int) -> Sums:
        vectors, squares = v[5 : 5 + 3 * p].reshape(3, p), v[5 + 3 * p :].reshape(2, p, p)
        return Sums(*(float(x) for x in v[:5]), *vectors, *squares)

    def __getitem__(self, i: int) -> float:
        return (self.geos, self.trace, self.trace2, self.log_likelihood)[i]


def _pass(states: dict[tuple[float, float], State], size: int):
    """Per batch of the Gram table and setting, the sums that the next state and the likelihood need."""

    def run(batches):
        for pdf in batches:
            for key, part in pdf.groupby(SETTING, sort=False):
                if key not in states:
                    continue
                state = states[key]
                s2 = state.sigma2
                gram, cross, yy, n = _unpack(part, size)
                precision, cov = _geo_posterior(gram, cross, state)
                # Marginal likelihood of the geo's outcomes, by the determinant lemma.
                rest = cross - gram @ state.mu
                rr = yy - 2 * cross @ state.mu + np.einsum("i,gij,j->g", state.mu, gram, state.mu)
                pulled = np.einsum("gij,gj->gi", cov, rest)
                quad = (rr - (rest * pulled).sum(1) / s2) / s2
                logdet = n * math.log(s2) + np.log(state.tau2).sum() + np.linalg.slogdet(precision)[1]
                loglik = -0.5 * (n * math.log(2 * math.pi) + logdet + quad)
                # V^-1 X is X m / s2.
                covgram = cov @ gram
                m = np.eye(size) - covgram / s2
                info = gram @ m / s2
                score = (rest - np.einsum("gij,gj->gi", gram, pulled) / s2) / s2
                rest2 = (rr - 2 * (rest * pulled).sum(1) / s2 + np.einsum("gi,gij,gj->g", pulled, gram, pulled) / s2**2) / s2**2
                cross2 = np.einsum("gki,gkl,gli->gi", m, gram, m) / s2**2
                shared = np.einsum("gii->g", covgram)
                trace = (n - shared / s2) / s2
                trace2 = (n - 2 * shared / s2 + np.einsum("gij,gji->g", covgram, covgram) / s2**2) / s2**2
                parts = [[len(part), trace.sum(), trace2.sum(), loglik.sum(), rest2.sum()], score.sum(0), (score**2).sum(0), cross2.sum(0)]
                sums = np.concatenate([*parts, info.sum(0).ravel(), (info**2).sum(0).ravel()])
                yield pd.DataFrame({"alpha": [key[0]], "ec": [key[1]], "sums": [sums]})

    return run


def _totals(grams: DataFrame, states: dict, size: int) -> dict[tuple[float, float], Sums]:
    parts = grams.mapInPandas(_pass(states, size), "alpha double, ec double, sums array<double>")
    summed = parts.select(*SETTING, F.posexplode("sums").alias("i", "v")).groupBy(*SETTING, "i").agg(F.sum("v").alias("v"))
    # Per setting of the grid, a few numbers for each pair of coefficients.
    out: dict[tuple[float, float], np.ndarray] = {key: np.zeros(5 + 3 * size + 2 * size * size) for key in states}
    for r in summed.collect():
        out[r["alpha"], r["ec"]][r["i"]] = r["v"]
    return {key: Sums.of(v, size) for key, v in out.items()}


def _penalised(loglik: float, state: State, centre: np.ndarray, precision: np.ndarray) -> float:
    """Log-likelihood with the priors on common effects and variances."""
    weight = VARIANCE_WEIGHT
    on_mu = -0.5 * float((precision * (state.mu - centre) ** 2).sum())
    on_tau = -0.5 * float(((weight + 2) * np.log(state.tau2) + weight * VARIANCE_CENTRE**2 / state.tau2).sum())
    return loglik + on_mu + on_tau


def _ridged(matrix: np.ndarray) -> np.ndarray:
    """A column that never varies says nothing and has no prior: a little ridge keeps its effect where it is."""
    return matrix + np.eye(len(matrix)) * 1e-9 * max(1.0, float(np.trace(matrix)) / len(matrix))


def _next_state(sums: Sums, state: State, centre: np.ndarray, precision: np.ndarray, damping: float) -> tuple[State, float]:
    """The state after a step of Fisher scoring, and the log-likelihood that the undamped step promises."""
    pull = sums.score + precision * (centre - state.mu)
    towards = np.linalg.solve(_ridged(sums.info + np.diag(precision)), pull)
    tau2, s2, prior = state.tau2, state.sigma2, VARIANCE_WEIGHT * VARIANCE_CENTRE**2 / state.tau2
    by_tau = 0.5 * tau2 * (sums.score2 - np.diag(sums.info)) - 0.5 * (VARIANCE_WEIGHT + 2) + 0.5 * prior
    gradient = np.append(by_tau, 0.5 * s2 * (sums.rest2 - sums.trace))
    # By the logarithms of the variances; they and the common effects tell nothing about each other.
    told = np.empty((len(tau2) + 1, len(tau2) + 1))
    told[:-1, :-1] = 0.5 * sums.info2 * np.outer(tau2, tau2) + np.diag(0.5 * prior)
    told[-1, :-1] = told[:-1, -1] = 0.5 * sums.cross2 * tau2 * s2
    told[-1, -1] = 0.5 * sums.trace2 * s2**2
    told = _ridged(told)
    gain = 0.5 * float(pull @ towards + gradient @ np.linalg.solve(told, gradient))
    step = np.linalg.solve(told + damping * np.diag(np.diag(told)), gradient)
    logs = np.concatenate([np.log(tau2), [math.log(s2)]]) + np.clip(step, -LARGEST_STEP, LARGEST_STEP)
    return State.of(np.concatenate([state.mu + towards, logs])), gain


def fit_settings(grams: DataFrame, priors: dict, size: int, max_passes: int = MAX_PASSES) -> list[SettingFit]:
    """Fisher scoring for every setting at once; a pass over ``grams`` (staged) serves all that still move.

    ``priors``: setting to centre and precision of the common effects (precision 0: no prior).
    """
    keys = sorted(priors)
    trial = {}
    for key in keys:
        centre, precision = priors[key]
        trial[key] = State(np.where(precision > 0, centre, 0.0), np.full(size, VARIANCE_CENTRE**2), 1.0)
    best: dict = {}  # penalised likelihood, sums and state of the best point so far
    damping, gains, ended = dict.fromkeys(keys, 0.0), dict.fromkeys(keys, math.inf), dict.fromkeys(keys, 0)
    passes, converged = 0, dict.fromkeys(keys, False)
    while passes < max_passes and trial:
        totals = _totals(grams, trial, size)
        passes += 1
        for key, state in list(trial.items()):
            ended[key] = passes
            value = _penalised(totals[key].log_likelihood, state, *priors[key])
            if key not in best or value >= best[key][0] - 1e-9:
                best[key] = (value, totals[key], state)
                damping[key] = damping[key] / 8 if damping[key] > 0.01 else 0.0
            else:
                # The step went too far: a shorter one from where it began.
                damping[key] = max(4 * damping[key], 1.0)
            trial[key], gains[key] = _next_state(best[key][1], best[key][2], *priors[key], damping[key])
            if gains[key] < TOLERANCE:
                converged[key] = True
                del trial[key]
    values = np.array([best[key][0] for key in keys])
    weights = np.exp(values - values.max())
    weights = weights / weights.sum()
    out = []
    for key, weight in zip(keys, weights, strict=True):
        centre, precision = priors[key]
        value, sums, state = best[key]
        whole = _ridged(sums.info + np.diag(precision))
        mean = np.linalg.solve(whole, sums.score + sums.info @ state.mu + precision * centre)
        out.append(SettingFit(*key, state, value, float(weight), converged[key], ended[key], float(gains[key]), mean, whole))
    return out


def _truncated(mean: np.ndarray, sd: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Normal draws above 0, by rejection: from the normal itself or, far out in its tail, an exponential."""
    low = -mean / sd
    out = np.empty_like(mean)
    todo = np.arange(len(mean))
    while len(todo):
        a = low[todo]
        near = a < 0.5
        rate = (a + np.sqrt(a**2 + 4)) / 2
        z = np.where(near, rng.standard_normal(len(todo)), a + rng.exponential(size=len(todo)) / np.where(near, 1.0, rate))
        kept = np.where(near, z > a, rng.random(len(todo)) < np.exp(-((z - rate) ** 2) / 2))
        out[todo[kept]] = mean[todo[kept]] + sd[todo[kept]] * z[kept]
        todo = todo[~kept]
    return np.maximum(out, 0.0)


def positive_normal(mean: np.ndarray, precision: np.ndarray, positive: int, rng: np.random.Generator, sweeps: int = SWEEPS) -> np.ndarray:
    """One draw for each row of ``mean`` from a normal whose first ``positive`` entries are truncated at 0.

    Starts from the untruncated draw, clipped, and takes ``sweeps`` Gibbs sweeps if any entry was clipped.
    """
    factor = np.linalg.cholesky(precision)
    draws = mean + np.linalg.solve(factor.T, rng.standard_normal(mean.shape).T).T
    clipped = (draws[:, :positive] < 0).any(axis=1)
    if not clipped.any():
        return draws
    x, centre = np.maximum(draws[clipped], np.where(np.arange(mean.shape[1]) < positive, 0.0, -np.inf)), mean[clipped]
    for _ in range(sweeps):
        for j in range(mean.shape[1]):
            own = precision[j, j]
            pull = (x - centre) @ precision[j] - own * (x[:, j] - centre[:, j])
            at, sd = centre[:, j] - pull / own, np.full(len(x), 1.0 / math.sqrt(own))
            x[:, j] = _truncated(at, sd, rng) if j < positive else at + sd * rng.standard_normal(len(x))
    draws[clipped] = x
    return draws


def _draws(fits: list[SettingFit], counts: list[int], size: int, positive: int, seed: int):
    """Geo effects for the draws of each setting; the common effects of a draw are the same for all geos."""
    common, first = {}, 0
    for fit, count in zip(fits, counts, strict=True):
        rng = np.random.default_rng([seed, first])
        mu = positive_normal(np.tile(fit.mean, (count, 1)), fit.precision, positive, rng) if count else np.zeros((0, size))
        common[fit.alpha, fit.ec] = (fit, np.arange(first, first + count), mu)
        first += count

    def run(batches):
        for pdf in batches:
            for (alpha, ec, geo), part in pdf.groupby([*SETTING, "geo"], sort=False):
                fit, numbers, mu = common[alpha, ec]
                if not len(numbers):
                    continue
                gram, cross, _, _ = _unpack(part, size)
                precision, cov = _geo_posterior(gram, cross, fit.state)
                mean = (cross[0] / fit.state.sigma2 + mu / fit.state.tau2) @ cov[0]
                rng = np.random.default_rng([seed, int(numbers[0]), zlib.crc32(str(geo).encode())])
                effects = positive_normal(mean, precision[0], positive, rng)
                yield pd.DataFrame({"draw": numbers.astype(np.int32), "geo": geo, "alpha": alpha, "ec": ec, "coefficients": list(effects)})

    return run


def effect_prior(prior: DataFrame | None, rows: DataFrame, panel: DataFrame, media: DataFrame, channels, size: int) -> dict:
    """Centre and precision of the common effects per setting.

    A log-normal prior on the return (mu, sigma; one row, or one per channel) has a mean and a variance; a
    channel's return is its effect times the ratio of its summed response, in money, to its spend. So
    both are carried over to effects by that ratio. Without a prior, or without spend, precision is 0.
    """
    channels = list(channels)
    means = panel.groupBy(F.col("GEO").alias("geo")).agg(F.avg("NET_REVENUE").alias("_mean"))
    responses = rows.join(means, "geo").groupBy(*SETTING).agg(*[F.sum(F.col(f"x{i}") * F.col("_mean")).alias(f"r{i}") for i in range(len(channels))])
    spent = {r["channel"]: r["spend"] for r in media.groupBy("channel").agg(F.sum("spend").alias("spend")).collect()}
    moments = {}
    if prior is not None:
        per_channel = "channel" in prior.columns
        for r in prior.collect():
            if r["mu"] is None or r["sigma"] is None:
                continue
            mean = math.exp(r["mu"] + r["sigma"] ** 2 / 2)
            sd = mean * math.sqrt(math.expm1(r["sigma"] ** 2))
            for c in [r["channel"]] if per_channel else channels:
                moments[c] = (mean, sd)
    out = {}
    for r in responses.collect():  # one row per setting
        centre, precision = np.zeros(size), np.zeros(size)
        for i, c in enumerate(channels):
            response = r[f"r{i}"] or 0.0
            if c in moments and response > 0 and (spent.get(c) or 0.0) > 0:
                ratio = spent[c] / response
                centre[i], precision[i] = moments[c][0] * ratio, 1.0 / (moments[c][1] * ratio) ** 2
        out[r["alpha"], r["ec"]] = (centre, precision)
    return out


def deal_draws(weights, draws: int) -> list[int]:
    """Whole numbers of draws in proportion to the weights, by largest remainder."""
    shares = np.asarray(weights) * draws
    counts = np.floor(shares).astype(int)
    order = np.argsort(-(shares - counts), kind="stable")
    counts[order[: draws - counts.sum()]] += 1
    return counts.tolist()


def effect_draws(grams: DataFrame, fits: list[SettingFit], draws: int, size: int, positive: int, seed: int = 42) -> DataFrame:
    """Coefficients per draw and geo; the first ``positive`` are not negative. Draws are dealt to settings by weight."""
    counts = deal_draws([f.weight for f in fits], draws)
    return grams.mapInPandas(_draws(fits, counts, size, positive, seed), "draw int, geo string, alpha double, ec double, coefficients array<double>")


def geo_fit(
    panel: DataFrame,
    media: DataFrame,
    channels,
    prior: DataFrame | None = None,
    draws: int = 100,
    alphas=ALPHAS,
    ecs=ECS,
    seed: int = 42,
    max_passes: int = MAX_PASSES,
) -> tuple[DataFrame, list[SettingFit]]:
    """Draws of all coefficients per draw and geo, and the report per setting.

    ``panel`` and ``media`` are read several times and should be staged. Draws: draw, geo, alpha, ec,
    coefficients (media effects in order of ``channels``, intercept, controls; on the scale of the geo's
    mean outcome).
    """
    channels = list(channels)
    size = len(channels) + 3 + len(DAYS)
    rows = stage(design(panel, media, channels, alphas, ecs))
    grams = stage(geo_gram(rows, size))
    priors = effect_prior(prior, rows, panel, media, channels, size)
    if not priors:
        raise ValueError("the panel has no rows to fit")
    fits = fit_settings(grams, priors, size, max_passes)
    return stage(effect_draws(grams, fits, draws, size, len(channels), seed)), fits


def fit_report(spark, fits: list[SettingFit]) -> DataFrame:
    """One row per setting: posterior weight, log-likelihood, convergence, passes, promise of one more step, noise."""
    rows = [(f.alpha, f.ec, f.weight, float(f.log_likelihood), f.converged, f.passes, f.change, math.sqrt(f.state.sigma2)) for f in fits]
    names = "alpha double, ec double, weight double, log_likelihood double, converged boolean, passes int, change double, noise double"
    return spark.createDataFrame(rows, names)


def media_draws(fit: DataFrame, panel: DataFrame, channels) -> DataFrame:
    """Draws table per geo and channel, effects in money: what the response operators take."""
    means = panel.groupBy(F.col("GEO").alias("geo")).agg(F.avg("NET_REVENUE").alias("_mean"))
    effects = F.array(*[F.struct(F.lit(c).alias("channel"), F.element_at("coefficients", i + 1).alias("b")) for i, c in enumerate(channels)])
    long = fit.select("draw", "geo", "alpha", "ec", F.explode(effects).alias("e")).join(means, "geo")
    return long.select("draw", "geo", "e.channel", (F.col("e.b") * F.col("_mean")).alias("beta"), "alpha", "ec", F.lit(1.0).alias("slope"))


def geo_effects(draws: DataFrame) -> DataFrame:
    """Median and 95 % interval of the media effect per geo and channel."""
    q = F.percentile("beta", F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975)))
    found = draws.groupBy("geo", "channel").agg(q.alias("q"), F.avg("beta").alias("mean"))
    names = ("low", "median", "high")
    return found.select("geo", "channel", "mean", *[F.element_at("q", i + 1).alias(n) for i, n in enumerate(names)])


def _terms(fit: DataFrame, panel: DataFrame, media: DataFrame, channels, alphas, ecs) -> DataFrame:
    """Baseline (``rest``) and whole expectation (``all``) per draw, geo and day, over the geo's mean."""
    channels = list(channels)
    size = len(channels) + 3 + len(DAYS)
    rows = design(panel, media, channels, alphas, ecs).join(fit, ["alpha", "ec", "geo"])
    terms = [F.col(f"x{i}") * F.element_at("coefficients", i + 1) for i in range(size)]
    rest = sum(terms[len(channels) :], F.lit(0.0))
    return rows.select("geo", "day", "is_holdout", rest.alias("rest"), sum(terms, F.lit(0.0)).alias("all"))


def mean_outcome(fit: DataFrame, panel: DataFrame, media: DataFrame, channels, alphas=ALPHAS, ecs=ECS) -> DataFrame:
    """Expected outcome and baseline per geo and day, mean over draws."""
    means = panel.groupBy(F.col("GEO").alias("geo")).agg(F.avg("NET_REVENUE").alias("_mean"))
    per_day = _terms(fit, panel, media, channels, alphas, ecs).groupBy("geo", "day").agg(F.avg("all").alias("all"), F.avg("rest").alias("rest"))
    return per_day.join(means, "geo").select("geo", "day", (F.col("all") * F.col("_mean")).alias("expected"), (F.col("rest") * F.col("_mean")).alias("baseline"))


def fitted_outcome(fit: DataFrame, panel: DataFrame, media: DataFrame, channels, alphas=ALPHAS, ecs=ECS) -> DataFrame:
    """Actual outcome, and median and 95 % interval of expected outcome and baseline per geo and day, with the split.

    The interval is of the expectation; the noise of single days is not in it.
    """
    totals = _terms(fit, panel, media, channels, alphas, ecs)
    q = F.array(F.lit(0.025), F.lit(0.5), F.lit(0.975))
    middle = totals.groupBy("geo", "day", "is_holdout").agg(F.percentile("all", q).alias("q"), F.percentile("rest", F.lit(0.5)).alias("b"))
    base = panel.select(F.col("GEO").alias("geo"), F.col("DATE_DAY").alias("day"), F.col("NET_REVENUE").cast("double").alias("actual"))
    means = base.groupBy("geo").agg(F.avg("actual").alias("_mean"))
    return (
        middle.join(base, ["geo", "day"])
        .join(means, "geo")
        .select(
            "geo",
            "day",
            F.when(F.col("is_holdout"), "test").otherwise("train").alias("split"),
            "actual",
            (F.element_at("q", 2) * F.col("_mean")).alias("expected"),
            (F.element_at("q", 1) * F.col("_mean")).alias("expected_low"),
            (F.element_at("q", 3) * F.col("_mean")).alias("expected_high"),
            (F.col("b") * F.col("_mean")).alias("baseline"),
        )
    )
