"""Scalar column builders shared by the operators.

All of them stay inside Catalyst expressions, so they take part in whole-stage
code generation and never start a Python worker.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value) if isinstance(value, str) else F.lit(value)


def safe_ratio(numerator, denominator, default=None) -> Column:
    """Division that gives NULL (or ``default``) for a zero or NULL denominator.

    ANSI mode makes a plain division by zero fail the job.
    """
    ratio = F.try_divide(_c(numerator), _c(denominator))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def clip_lower(column, floor=0.0) -> Column:
    """Raise values below ``floor`` to it; NULL stays NULL (``greatest`` would drop it)."""
    column = _c(column)
    return F.when(column < floor, F.lit(floor)).otherwise(column)


def coalesced_sum(column) -> Column:
    """Aggregate: sum that is 0 for a group with no value."""
    return F.coalesce(F.sum(_c(column)), F.lit(0.0))


def row_total(columns) -> Column:
    """Sum across columns of one row, NULL counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0.0)) for c in columns])


def quantile_score(column, edges, descending=False) -> Column:
    """1-based bin of right-closed value intervals delimited by ``edges``.

    ``edges`` includes both ends; the lowest value belongs to bin 1. Equal values
    always share a bin, unlike ``ntile``.
    """
    column = _c(column)
    inner = list(edges)[1:-1]
    above = reduce(
        lambda a, b: a + b,
        [F.when(column > F.lit(float(e)), 1).otherwise(0) for e in inner],
        F.lit(0),
    )
    bins = len(edges) - 1
    score = F.lit(bins) - above if descending else above + F.lit(1)
    return F.when(column.isNotNull(), score.cast("int"))


def equal_width_score(column, low, high, bins, descending=False) -> Column:
    """1-based bin of ``bins`` right-closed intervals of equal width."""
    column = _c(column)
    width = (float(high) - float(low)) / bins
    if width == 0.0:
        # All values equal: the symmetric interval around them puts them in the middle bin.
        position = F.lit((bins + 1) // 2)
    else:
        position = F.greatest(
            F.lit(1), F.least(F.lit(bins), F.ceil((column - F.lit(float(low))) / F.lit(width)))
        )
    score = F.lit(bins + 1) - position if descending else position
    return F.when(column.isNotNull(), score.cast("int"))


def histogram_bin(column, low, high, bins) -> Column:
    """0-based bin of ``bins`` left-closed intervals; the last one is closed on both sides."""
    column, low, high = _c(column), _c(low), _c(high)
    position = F.floor(F.try_divide((column - low) * F.lit(float(bins)), high - low))
    return F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.coalesce(position, F.lit(0)))).cast("int")


# Coefficients of the Stirling series of log-gamma (Bernoulli numbers).
STIRLING = (1.0 / 12.0, -1.0 / 360.0, 1.0 / 1260.0, -1.0 / 1680.0)
HALF_LOG_TWO_PI = 0.9189385332046727
LGAMMA_SHIFT = 8


def lgamma(column) -> Column:
    """Log-gamma for positive arguments; Spark SQL has none.

    The Stirling series is taken at ``x + 8`` and stepped back by the recurrence,
    which keeps the error below 1e-11.
    """
    x = _c(column).cast("double")
    y = x + F.lit(float(LGAMMA_SHIFT))
    inverse = F.lit(1.0) / y
    squared = inverse * inverse
    tail = reduce(lambda acc, c: acc * squared + F.lit(c), reversed(STIRLING[:-1]), F.lit(STIRLING[-1]))
    steps = reduce(lambda a, b: a * b, [x + F.lit(float(k)) for k in range(LGAMMA_SHIFT)])
    return (y - F.lit(0.5)) * F.log(y) - y + F.lit(HALF_LOG_TWO_PI) + tail * inverse - F.log(steps)


#: Coefficients of 1/y^2, 1/y^4, ... in the asymptotic series of the digamma function after
#: log(y) - 1/(2y), and of 1/y^3, 1/y^5, ... in that of the trigamma function after 1/y + 1/(2y^2).
DIGAMMA_SERIES = (-1 / 12, 1 / 120, -1 / 252, 1 / 240, -1 / 132, 691 / 32760, -1 / 12)
TRIGAMMA_SERIES = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730, 7 / 6)


def _gamma_derivative(column, lead, series, step) -> Column:
    """Asymptotic series at ``x + 8``, stepped back by the recurrence."""
    x = _c(column).cast("double")
    y = x + F.lit(float(LGAMMA_SHIFT))
    inverse = F.lit(1.0) / y
    squared = inverse * inverse
    tail = reduce(lambda acc, c: acc * squared + F.lit(c), reversed(series[:-1]), F.lit(series[-1]))
    return reduce(lambda a, b: a + b, [step(x + F.lit(float(k))) for k in range(LGAMMA_SHIFT)], lead(y, inverse, tail * squared))


def digamma(column) -> Column:
    """Derivative of log-gamma for positive arguments, to 1e-12."""
    return _gamma_derivative(column, lambda y, i, tail: F.log(y) - F.lit(0.5) * i + tail, DIGAMMA_SERIES, lambda x: F.lit(-1.0) / x)


def trigamma(column) -> Column:
    """Second derivative of log-gamma for positive arguments, to 1e-12."""
    return _gamma_derivative(column, lambda y, i, tail: i + F.lit(0.5) * i * i + tail * i, TRIGAMMA_SERIES, lambda x: F.lit(1.0) / (x * x))


def log_sum_exp(a, b) -> Column:
    """log(exp(a) + exp(b)) without overflow."""
    a, b = _c(a), _c(b)
    top = F.greatest(a, b)
    return top + F.log1p(F.exp(F.least(a, b) - top))


def gauss_2f1(a, b, c, z, tolerance=1e-12) -> Column:
    """Gauss series of the hypergeometric function for 0 <= z < 1 with c >= a + b - 1.

    Terms then shrink at least like z^n, so each row takes as many as bring what is left out, a
    geometric tail, below ``tolerance``: a few for small z, 6,000 for z = 0.995.
    """
    a, b, c, z = (_c(v).cast("double") for v in (a, b, c, z))
    needed = F.ceil(F.log(F.lit(tolerance) * (F.lit(1.0) - z)) / F.log(z)).cast("int")
    terms = F.greatest(F.lit(8), F.coalesce(F.when(z > 0, needed), F.lit(8)))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc, n):
        n = n.cast("double")
        term = acc["term"] * (a + n) * (b + n) / ((c + n) * (n + F.lit(1.0))) * z
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(F.sequence(F.lit(0), terms - F.lit(1)), start, step, lambda acc: acc["total"])


def hill(column, ec, slope) -> Column:
    """Saturation x^s / (x^s + ec^s); 0.5 at ``ec``."""
    powered = F.pow(_c(column), _c(slope))
    return powered / (powered + F.pow(_c(ec), _c(slope)))
