"""Predictive lifetime value: BG/NBD purchase counts and Gamma-Gamma order values.

Formulas: Fader, Hardie and Lee (2005), "Counting your customers the easy way", and
Fader and Hardie (2013), "The Gamma-Gamma model of monetary value".
"""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions.dates import period_index
from mixloom.functions.scalars import (
    DIGAMMA_SERIES,
    LGAMMA_SHIFT,
    TRIGAMMA_SERIES,
    digamma,
    gauss_2f1,
    lgamma,
    log_sum_exp,
    safe_ratio,
    trigamma,
)
from mixloom.sources.staging import stage, staging_root

# Fixed values of the published analysis: weeks per month, months, monthly discount rate.
WEEKS_PER_MONTH = 4.345
CLV_PERIODS = 52
DISCOUNT_RATE = 0.01
PENALTY = 0.01
#: Largest derivative of the mean log-likelihood (by log parameter) that counts as a stationary point.
FLAT_GRADIENT = 1e-3


@dataclass(frozen=True)
class FitReport:
    """How a fit ended: whether it converged, passes over the data, largest remaining derivative."""

    converged: bool
    passes: int
    gradient: float


@dataclass(frozen=True)
class BgNbd:
    r: float
    alpha: float
    a: float
    b: float
    report: FitReport | None = field(default=None, compare=False)

    def columns(self) -> dict[str, Column]:
        return {n: F.lit(float(getattr(self, n))) for n in ("r", "alpha", "a", "b")}


@dataclass(frozen=True)
class GammaGamma:
    p: float
    q: float
    v: float
    report: FitReport | None = field(default=None, compare=False)

    def columns(self) -> dict[str, Column]:
        return {n: F.lit(float(getattr(self, n))) for n in ("p", "q", "v")}


def btyd_summary(tx: DataFrame, customer: str, date: str, value: str, end: Column, unit: str = "week") -> DataFrame:
    """Repeat purchases (frequency), recency, age T and mean repeat value per customer.

    All purchases of a customer in one period count as one. The first period is
    taken off by aggregation, so no window over the purchases is needed.
    """
    periods = tx.groupBy(F.col(customer), period_index(date, unit).alias("_p")).agg(F.sum(value).alias("_v"))
    rolled = periods.groupBy(customer).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_p").alias("_first"),
        F.max("_p").alias("_last"),
        F.sum("_v").alias("_sum"),
        F.min_by("_v", "_p").alias("_v0"),
    )
    repeats = F.col("_n") - F.lit(1)
    return rolled.select(
        customer,
        repeats.alias("frequency"),
        (F.col("_last") - F.col("_first")).cast("long").alias("recency"),
        (period_index(end, unit) - F.col("_first")).cast("long").alias("T"),
        safe_ratio(F.when(repeats > 0, F.col("_sum") - F.col("_v0")), repeats, 0.0).alias("monetary_value"),
    )


def calibration_holdout(
    tx: DataFrame, customer: str, date: str, value: str, cal_end: str, end: Column, unit: str = "week"
) -> DataFrame:
    """Summary up to ``cal_end`` with the number of purchase periods after it."""
    limit = F.lit(cal_end).cast("date")
    cal = btyd_summary(tx.filter(F.col(date) <= limit), customer, date, value, limit, unit)
    later = (
        tx.filter((F.col(date) > limit) & (F.col(date) <= end))
        .select(customer, period_index(date, unit).alias("_p"))
        .distinct()
        .groupBy(customer)
        .agg(F.count(F.lit(1)).alias("frequency_holdout"))
    )
    return (
        cal.join(later, customer, "left")
        .fillna(0, ["frequency_holdout"])
        .withColumn("duration_holdout", (period_index(end, unit) - period_index(limit, unit)).cast("long"))
        .withColumnsRenamed({"frequency": "frequency_cal", "recency": "recency_cal", "T": "T_cal"})
    )


def repeat_buyers(summary: DataFrame) -> DataFrame:
    return summary.filter((F.col("frequency") > 0) & (F.col("monetary_value") > 0))


def bgnbd_constant(r: float, alpha: float, a: float, b: float) -> float:
    """The part of a customer's log-likelihood that depends on the parameters alone."""
    return r * math.log(alpha) - math.lgamma(r) + math.lgamma(a + b) - math.lgamma(b)


def bgnbd_loglik_column(x, tx, age, r, alpha, a, b) -> Column:
    """Log-likelihood of one customer without its constant, in log space throughout."""
    counts = lgamma(r + x) + lgamma(b + x) - lgamma(a + b + x)
    alive = -(r + x) * F.log(alpha + age)
    gone = F.log(a) - F.log(b + F.greatest(x, F.lit(1.0)) - F.lit(1.0)) - (r + x) * F.log(alpha + tx)
    return counts + F.when(x > 0, log_sum_exp(alive, gone)).otherwise(alive)


def gamma_gamma_constant(p: float, q: float, v: float) -> float:
    """The part of a repeat buyer's log-likelihood that depends on the parameters alone."""
    del p
    return q * math.log(v) - math.lgamma(q)


def gamma_gamma_loglik_column(x, m, p, q, v) -> Column:
    """Log-likelihood of one repeat buyer without its constant."""
    px = p * x
    return (
        lgamma(px + q) - lgamma(px) + (px - F.lit(1.0)) * F.log(m) + px * F.log(x) - (px + q) * F.log(x * m + v)
    )


def _bgnbd_row(parameters: dict[str, Column], scale: float = 1.0) -> Column:
    x, tx, age = (F.col(c).cast("double") for c in ("frequency", "recency", "T"))
    return bgnbd_loglik_column(x, tx * scale, age * scale, **parameters)


def _gg_row(parameters: dict[str, Column]) -> Column:
    return gamma_gamma_loglik_column(F.col("frequency").cast("double"), F.col("monetary_value"), **parameters)


def bgnbd_loglik(summary: DataFrame, model: BgNbd) -> DataFrame:
    """Total log-likelihood, over distinct purchase histories weighted by their count."""
    row = _bgnbd_row(model.columns()) + F.lit(bgnbd_constant(model.r, model.alpha, model.a, model.b))
    return _histories(summary).agg(F.sum(F.col("n") * row).alias("log_likelihood"))


def gamma_gamma_loglik(summary: DataFrame, model: GammaGamma) -> DataFrame:
    row = _gg_row(model.columns()) + F.lit(gamma_gamma_constant(model.p, model.q, model.v))
    return repeat_buyers(summary).agg(F.sum(row).alias("log_likelihood"))


def _histories(summary: DataFrame) -> DataFrame:
    """Distinct (frequency, recency, T) with counts: the sufficient statistics of BG/NBD."""
    return summary.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("n"))


def bgnbd_fit(summary: DataFrame, penalty: float = PENALTY) -> BgNbd:
    """Penalised maximum likelihood.

    The customers are compressed to distinct histories once; every optimiser step is
    then one aggregate over that table. Time is rescaled so that the oldest customer
    has age 10, and the penalty applies on that scale.
    """
    histories = stage(_histories(summary))
    oldest = histories.agg(F.max("T")).first()[0]
    scale = 10.0 / oldest if oldest else 1.0
    x, tx, age = F.col("frequency").cast("double"), F.col("recency") * F.lit(scale), F.col("T") * F.lit(scale)
    rows = histories.select(x.alias("x"), tx.alias("tx"), age.alias("age"), F.col("n").cast("double").alias("w"))
    (r, alpha, a, b), report = _maximise(rows, _bgnbd_terms, _bgnbd_constant_terms, 4, penalty)
    return BgNbd(r, alpha / scale, a, b, report)


def gamma_gamma_fit(summary: DataFrame, penalty: float = PENALTY) -> GammaGamma:
    """Penalised maximum likelihood on repeat buyers; each step is one aggregate."""
    buyers = stage(repeat_buyers(summary).select(F.col("frequency").cast("double").alias("x"), F.col("monetary_value").alias("m")))
    rows = buyers.select("x", "m", F.lit(1.0).alias("w"))
    parameters, report = _maximise(rows, _gg_terms, _gg_constant_terms, 3, penalty)
    return GammaGamma(*parameters, report)


def clv_fits(summary: DataFrame, penalty: float = PENALTY) -> tuple[BgNbd, GammaGamma]:
    """Both models of a staged summary; neither fit needs the other, so their many short jobs run side by side."""
    staging_root(summary.sparkSession)  # chosen once, before the threads ask for it
    inherit = inheritable_thread_target(summary.sparkSession)
    with ThreadPoolExecutor(2) as pool:
        model, spend = (pool.submit(inherit(fit), summary, penalty) for fit in (bgnbd_fit, gamma_gamma_fit))
        return model.result(), spend.result()


def _bgnbd_terms(parameters: list[Column]) -> list[list[Column]]:
    """Stages of columns of one history: helpers, then value, gradient and upper Hessian by parameter.

    With A = alive, G = gone and s the share of G in their sum, log(e^A + e^G) has gradient
    (1 - s) A' + s G' and Hessian (1 - s) A'' + s G'' + s (1 - s) (G' - A')(G' - A')'.
    """
    r, alpha, a, b = parameters
    x, tx, age = F.col("x"), F.col("tx"), F.col("age")
    one, zero = F.lit(1.0), F.lit(0.0)
    left = b + F.greatest(x, one) - one
    first = [
        (-(r + x) * F.log(alpha + age)).alias("_alive"),
        (F.log(a) - F.log(left) - (r + x) * F.log(alpha + tx)).alias("_gone"),
        F.log(alpha + age).alias("_la"),
        F.log(alpha + tx).alias("_lt"),
        digamma(r + x).alias("_dr"),
        trigamma(r + x).alias("_tr"),
        digamma(b + x).alias("_db"),
        trigamma(b + x).alias("_tb"),
        digamma(a + b + x).alias("_dab"),
        trigamma(a + b + x).alias("_tab"),
        (lgamma(r + x) + lgamma(b + x) - lgamma(a + b + x)).alias("_counts"),
    ]
    odds = F.col("_gone") - F.col("_alive")
    second = [F.when(x > 0, one / (one + F.exp(-odds))).otherwise(zero).alias("_s")]
    s = F.col("_s")
    value = F.col("_counts") + F.when(x > 0, log_sum_exp("_alive", "_gone")).otherwise(F.col("_alive"))
    # Derivatives of A and G by r, alpha, a, b.
    ga = [-F.col("_la"), -(r + x) / (alpha + age), zero, zero]
    gg = [-F.col("_lt"), -(r + x) / (alpha + tx), one / a, -one / left]
    ha = {(0, 1): -one / (alpha + age), (1, 1): (r + x) / ((alpha + age) * (alpha + age))}
    hg = {(0, 1): -one / (alpha + tx), (1, 1): (r + x) / ((alpha + tx) * (alpha + tx)), (2, 2): -one / (a * a), (3, 3): one / (left * left)}
    counts = [F.col("_dr"), zero, -F.col("_dab"), F.col("_db") - F.col("_dab")]
    curved = {(0, 0): F.col("_tr"), (2, 2): -F.col("_tab"), (2, 3): -F.col("_tab"), (3, 3): F.col("_tb") - F.col("_tab")}
    gradient = [counts[i] + (one - s) * ga[i] + s * gg[i] for i in range(4)]
    hessian = []
    for i, j in itertools.combinations_with_replacement(range(4), 2):
        spread = s * (one - s) * (gg[i] - ga[i]) * (gg[j] - ga[j])
        hessian.append(curved.get((i, j), zero) + (one - s) * ha.get((i, j), zero) + s * hg.get((i, j), zero) + spread)
    return [first, second, [value, *gradient, *hessian]]


def _bgnbd_constant_terms(r, alpha, a, b) -> tuple[float, list[float], dict[tuple[int, int], float]]:
    """Value, gradient and Hessian of ``bgnbd_constant``."""
    gradient = [math.log(alpha) - psi(r), r / alpha, psi(a + b), psi(a + b) - psi(b)]
    both = psi_prime(a + b)
    hessian = {(0, 0): -psi_prime(r), (0, 1): 1 / alpha, (1, 1): -r / alpha**2, (2, 2): both, (2, 3): both, (3, 3): both - psi_prime(b)}
    return bgnbd_constant(r, alpha, a, b), gradient, hessian


def _gg_terms(parameters: list[Column]) -> list[list[Column]]:
    """Stages of columns of one repeat buyer: helpers, then value, gradient and upper Hessian by p, q, v."""
    p, q, v = parameters
    x, m = F.col("x"), F.col("m")
    px, one = p * x, F.lit(1.0)
    first = [
        (lgamma(px + q) - lgamma(px)).alias("_counts"),
        digamma(px + q).alias("_dq"),
        digamma(px).alias("_dp"),
        trigamma(px + q).alias("_tq"),
        trigamma(px).alias("_tp"),
        F.log(m).alias("_lm"),
        F.log(x).alias("_lx"),
        (x * m + v).alias("_all"),
        F.log(x * m + v).alias("_lall"),
    ]
    dq, dp, tq, tp, whole, lall = (F.col(c) for c in ("_dq", "_dp", "_tq", "_tp", "_all", "_lall"))
    value = F.col("_counts") + (px - one) * F.col("_lm") + px * F.col("_lx") - (px + q) * lall
    gradient = [x * (dq - dp + F.col("_lm") + F.col("_lx") - lall), dq - lall, -(px + q) / whole]
    hessian = [x * x * (tq - tp), x * tq, -x / whole, tq, -one / whole, (px + q) / (whole * whole)]
    return [first, [value, *gradient, *hessian]]


def _gg_constant_terms(p, q, v) -> tuple[float, list[float], dict[tuple[int, int], float]]:
    """Value, gradient and Hessian of ``gamma_gamma_constant``."""
    gradient = [0.0, math.log(v) - psi(q), q / v]
    return gamma_gamma_constant(p, q, v), gradient, {(1, 1): -psi_prime(q), (1, 2): 1 / v, (2, 2): -q / v**2}


def psi(x: float) -> float:
    """Digamma of a number, by the series of ``functions.scalars.digamma``."""
    y = x + LGAMMA_SHIFT
    tail = sum(c / y ** (2 * i + 2) for i, c in enumerate(DIGAMMA_SERIES))
    return math.log(y) - 0.5 / y + tail - sum(1.0 / (x + k) for k in range(LGAMMA_SHIFT))


def psi_prime(x: float) -> float:
    """Trigamma of a number."""
    y = x + LGAMMA_SHIFT
    tail = sum(c / y ** (2 * i + 3) for i, c in enumerate(TRIGAMMA_SERIES))
    return 1.0 / y + 0.5 / y**2 + tail + sum(1.0 / (x + k) ** 2 for k in range(LGAMMA_SHIFT))


def _maximise(data, terms, constant, k, penalty, max_jobs=80, tolerance=1e-9):
    """Newton ascent on the logarithms of positive parameters.

    One aggregate gives value, gradient and Hessian of the sum over ``data`` at one parameter vector; no
    row is multiplied. Only these sums reach the driver. A step that does not improve is halved.
    ``data`` has a weight ``w``; parameters are columns of a one-row table, so that all jobs share
    their compiled code.
    """
    spark = data.sparkSession
    corners = list(itertools.combinations_with_replacement(range(k), 2))
    names = [f"_p{i}" for i in range(k)]
    stages = terms([F.col(n) for n in names])

    def evaluate(at):
        """Penalised mean negative log-likelihood with its gradient and Hessian by log parameter."""
        theta = np.exp(at)
        table = spark.sql(f"SELECT {', '.join(f'{v!r}D AS {n}' for v, n in zip(theta.tolist(), names, strict=True))}")
        rows = data.crossJoin(F.broadcast(table))
        for helpers in stages[:-1]:
            rows = rows.select("*", *helpers)
        weighted = [F.sum(F.col("w") * c).alias(f"s{i}") for i, c in enumerate(stages[-1])]
        row = rows.agg(F.sum("w").alias("w"), *weighted).first()
        if not row["w"] or row["s0"] is None or not all(math.isfinite(v) for v in row):
            return math.inf, None, None
        sums = np.array([row[f"s{i}"] for i in range(len(stages[-1]))]) / row["w"]
        value, first, second = constant(*theta.tolist())
        gradient = sums[1 : 1 + k] + np.array(first)
        hessian = np.zeros((k, k))
        for n, (i, j) in enumerate(corners):
            hessian[i, j] = hessian[j, i] = sums[1 + k + n] + second.get((i, j), 0.0)
        # Negative, with the penalty, and by the logarithms of the parameters.
        gradient, hessian = -gradient + 2 * penalty * theta, -hessian + 2 * penalty * np.eye(k)
        by_log = gradient * theta
        curvature = hessian * np.outer(theta, theta) + np.diag(by_log)
        return -(sums[0] + value) + penalty * float((theta**2).sum()), by_log, curvature

    at = np.zeros(k)
    here, gradient, curvature = evaluate(at)
    if not math.isfinite(here):
        raise ValueError("the likelihood is not finite at the start; check the summary for negative or missing values")
    step, jobs, converged = None, 1, False
    while jobs < max_jobs:
        if step is None:
            # Positive curvature makes the step a descent; its length is limited.
            values, vectors = np.linalg.eigh(curvature)
            step = -vectors @ ((vectors.T @ gradient) / np.maximum(np.abs(values), 1e-9))
            step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        tried = evaluate(at + step)
        jobs += 1
        if tried[0] < here:
            gained = here - tried[0]
            at, (here, gradient, curvature), step = at + step, tried, None
            if gained < tolerance * max(1.0, abs(here)):
                converged = True
                break
        else:
            step = step / 2
            if np.abs(step).max() < 1e-8:
                # No step improves: a minimum, if the gradient says so, too.
                converged = float(np.abs(gradient).max()) < FLAT_GRADIENT
                break
    report = FitReport(converged, jobs, float(np.abs(gradient).max()))
    return [float(v) for v in np.exp(at)], report


def _growth(x, age, t, m: BgNbd) -> Column:
    """Expected purchases within ``t`` before the correction for having left.

    Euler's transformation of the published expression; its series has numerator
    parameters that do not grow with the customer's history.
    """
    a, b, r, alpha = m.a, m.b, m.r, m.alpha
    z = t / (F.lit(alpha) + age + t)
    top = F.lit(a + b - 1.0) + x
    series = gauss_2f1(F.lit(a + b - 1.0 - r), F.lit(a - 1.0), top, z)
    return top / F.lit(a - 1.0) * (F.lit(1.0) - F.pow(F.lit(1.0) - z, F.lit(a - 1.0)) * series)


def _departure(x, tx, age, m: BgNbd) -> Column:
    """1 / probability of being alive."""
    odds = F.exp((F.lit(m.r) + x) * (F.log(F.lit(m.alpha) + age) - F.log(F.lit(m.alpha) + tx)))
    left = F.lit(m.a) / (F.lit(m.b - 1.0) + F.greatest(x, F.lit(1.0))) * odds
    return F.lit(1.0) + F.when(x > 0, left).otherwise(F.lit(0.0))


def bgnbd_p_alive(summary: DataFrame, model: BgNbd, x="frequency", tx="recency", age="T") -> DataFrame:
    """Probability that the customer still buys."""
    x, tx, age = (F.col(c).cast("double") for c in (x, tx, age))
    return summary.withColumn("p_alive", F.lit(1.0) / _departure(x, tx, age, model))


def bgnbd_expected_purchases(
    summary: DataFrame, model: BgNbd, t, x="frequency", tx="recency", age="T", out="expected_purchases"
) -> DataFrame:
    """Expected purchases in the next ``t`` periods (a number or the name of a column)."""
    horizon = F.col(t) if isinstance(t, str) else F.lit(t)
    table = _growth_table(summary, [horizon.cast("double").alias("_t")], x, age, model)
    keyed = summary.withColumn("_t", horizon.cast("double"))
    joined = keyed.join(table, [x, age, "_t"], "left")
    fx, ftx, fage = (F.col(c).cast("double") for c in (x, tx, age))
    return joined.select(*summary.columns, (F.col("_growth") / _departure(fx, ftx, fage, model)).alias(out))


def _growth_table(summary, extra, x, age, model):
    """The series per distinct (frequency, age, horizon); customers share few of them."""
    distinct = summary.select(x, age, *extra).distinct()
    return distinct.withColumn(
        "_growth", _growth(F.col(x).cast("double"), F.col(age).cast("double"), F.col("_t"), model)
    )


def gg_expected_value(summary: DataFrame, model: GammaGamma, out="expected_value") -> DataFrame:
    """Mean order value shrunk towards the population mean."""
    x = F.col("frequency").cast("double")
    weight = F.lit(model.p) * x / (F.lit(model.p) * x + F.lit(model.q - 1.0))
    population = model.v * model.p / (model.q - 1.0)
    return summary.withColumn(
        out, weight * F.col("monetary_value") + (F.lit(1.0) - weight) * F.lit(population)
    )


def predicted_clv(
    summary: DataFrame,
    model: BgNbd,
    spend: GammaGamma,
    n_periods: int = CLV_PERIODS,
    period_len: float = WEEKS_PER_MONTH,
    rate: float = DISCOUNT_RATE,
) -> DataFrame:
    """Discounted value of the expected purchases of ``n_periods`` periods.

    ``period_len`` is the length of one period in the unit of the summary: 52 periods
    of 4.345 weeks are 52 months; for 52 weeks pass ``period_len=1``. The discounted
    sum depends on frequency and age only, so it is built once per distinct pair and
    joined back; no customer row is multiplied by the number of periods.
    """
    pairs = summary.select("frequency", "T").distinct()
    x, age = F.col("frequency").cast("double"), F.col("T").cast("double")
    steps = pairs.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(n_periods))))
    growth = _growth(x, age, F.col("_k") * F.lit(period_len), model)
    # Summation by parts: sum (E_k - E_{k-1}) d^k = sum E_k (d^k - d^{k+1}) + E_n d^{n+1}.
    d = 1.0 / (1.0 + rate)
    factor = F.pow(F.lit(d), F.col("_k"))
    weight = F.when(F.col("_k") == n_periods, factor).otherwise(factor * F.lit(1.0 - d))
    discounted = steps.groupBy("frequency", "T").agg(F.sum(growth * weight).alias("_discounted"))
    valued = gg_expected_value(summary, spend).join(discounted, ["frequency", "T"], "left")
    tx = F.col("recency").cast("double")
    return valued.select(
        *summary.columns,
        "expected_value",
        (F.col("expected_value") * F.col("_discounted") / _departure(x, tx, age, model)).alias("predicted_clv"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R squared over complete pairs, with the number of excluded rows."""
    complete = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    y = F.when(complete, F.col(actual).cast("double"))
    error = y - F.col(predicted)
    return df.agg(
        F.count(error).alias("n"),
        F.count_if(~complete).alias("n_excluded"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - safe_ratio(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def holdout_evaluation(cal_holdout: DataFrame, model: BgNbd) -> DataFrame:
    """Accuracy of predicted holdout purchases."""
    predicted = bgnbd_expected_purchases(
        cal_holdout, model, "duration_holdout", "frequency_cal", "recency_cal", "T_cal", "predicted_frequency"
    )
    return regression_metrics(predicted, "frequency_holdout", "predicted_frequency")
