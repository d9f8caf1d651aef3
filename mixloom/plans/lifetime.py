"""Queries over predictive lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.operators import descriptive, scoring
from mixloom.operators import lifetime as life
from mixloom.plans import views
from mixloom.plans.registry import Tables, query, rounded
from mixloom.plans.sales import histogram_sql
from mixloom.plans.views import with_views
from mixloom.sources.staging import stage

# Parameters at which likelihoods and expectations are compared with SQL.
MODEL = life.BgNbd(r=1.34, alpha=23.9, a=0.6, b=1.9)
SPEND = life.GammaGamma(p=2.95, q=3.4, v=2.99)
HORIZON = 26.0
# The first three quarters of the observed days calibrate, the rest is held out.
CALIBRATION_SHARE = 0.75
REPORT = "converged boolean, passes int, gradient double"
UNIT_COLUMNS = ["customer_id", "frequency", "recency", "T", "monetary_value"]


def _transactions(t: Tables) -> DataFrame:
    return stage(views.order_sales(t).select("customer_id", "order_date", "gross_revenue_usd"))


def _summary_of(tx: DataFrame) -> DataFrame:
    end = tx.agg(F.date_add(F.max("order_date"), 1)).first()[0]
    return life.btyd_summary(tx, "customer_id", "order_date", "gross_revenue_usd", F.lit(end))


def _summary(t: Tables) -> DataFrame:
    return stage(_summary_of(_transactions(t)))


def _cal_holdout(t: Tables) -> DataFrame:
    tx = _transactions(t)
    days = F.floor(F.datediff(F.max("order_date"), F.min("order_date")) * F.lit(CALIBRATION_SHARE)).cast("int")
    cut = F.date_add(F.min("order_date"), days)
    end, cal_end = tx.agg(F.date_add(F.max("order_date"), 1), cut).first()
    return stage(
        life.calibration_holdout(tx, "customer_id", "order_date", "gross_revenue_usd", cal_end, F.lit(end))
    )


def _week(date: str) -> str:
    return f"CAST((CAST(date_trunc('week', {date}) AS DATE) - DATE '1969-12-29') / 7 AS BIGINT)"


def _summary_cte(name: str, end: str, where: str = "TRUE") -> str:
    return f"""
    {name}_w AS (SELECT customer_id, {_week('order_date')} AS w, sum(gross_revenue_usd) AS v FROM order_sales
                 WHERE {where} GROUP BY ALL),
    {name}_f AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY w) AS place FROM {name}_w),
    {name} AS (SELECT customer_id, count(*) - 1 AS frequency, max(w) - min(w) AS recency,
                      {_week(end)} - min(w) AS T, coalesce(avg(v) FILTER (place > 1), 0) AS monetary_value
               FROM {name}_f GROUP BY 1)"""


_end = "(SELECT max(order_date) + 1 FROM order_sales)"
SUMMARY = _summary_cte("s", _end)
_cal_end = f"""(SELECT min(order_date) + CAST(floor((max(order_date) - min(order_date)) * {CALIBRATION_SHARE}) AS INTEGER)
               FROM order_sales)"""
CAL = (
    _summary_cte("c", _cal_end, f"order_date <= {_cal_end}")
    + f""",
    ch AS (SELECT c.customer_id, frequency AS frequency_cal, recency AS recency_cal, T AS T_cal,
                  monetary_value, coalesce(h.n, 0) AS frequency_holdout,
                  {_week(_end)} - {_week(_cal_end)} AS duration_holdout
           FROM c LEFT JOIN (SELECT customer_id, count(DISTINCT {_week('order_date')}) AS n FROM order_sales
                             WHERE order_date > {_cal_end} GROUP BY 1) h USING (customer_id))"""
)


def _with_summary(body: str) -> str:
    return with_views("order_sales", f"WITH {SUMMARY} {body}")


@query(
    "c1_btyd_summary",
    _with_summary(
        "SELECT customer_id, frequency, recency, T, round(monetary_value, 4) AS monetary_value FROM s"
    ),
)
def btyd_summary(t: Tables) -> DataFrame:
    return rounded(_summary_of(_transactions(t)), 4, "monetary_value")


HOLDOUT_COLUMNS = "customer_id, frequency_cal, recency_cal, T_cal, frequency_holdout, duration_holdout"


@query(
    "c2_calibration_holdout",
    with_views(
        "order_sales",
        f"WITH {CAL} SELECT {HOLDOUT_COLUMNS}, round(monetary_value, 4) AS monetary_value FROM ch",
    ),
)
def calibration_holdout(t: Tables) -> DataFrame:
    return rounded(_cal_holdout(t), 4, "monetary_value")


@query(
    "j16_calibration_left_holdout",
    with_views(
        "order_sales",
        f"WITH {CAL} SELECT frequency_holdout, count(*) AS n_customers FROM ch GROUP BY 1",
    ),
)
def calibration_left_holdout(t: Tables) -> DataFrame:
    return _cal_holdout(t).groupBy("frequency_holdout").agg(F.count(F.lit(1)).alias("n_customers"))


def _bgnbd_ll_sql(m: life.BgNbd) -> str:
    r, al, a, b = (f"{v}::DOUBLE" for v in (m.r, m.alpha, m.a, m.b))
    return f"""
        lgamma({r} + frequency) - lgamma({r}) + {r} * ln({al}) + lgamma({a} + {b}) + lgamma({b} + frequency)
        - lgamma({b}) - lgamma({a} + {b} + frequency)
        + ln(power({al} + T, -({r} + frequency))
             + CASE WHEN frequency > 0
                    THEN {a} / ({b} + greatest(frequency, 1) - 1) * power({al} + recency, -({r} + frequency))
                    ELSE 0 END)"""


@query("c3_bgnbd_loglik", _with_summary(f"SELECT round(sum({_bgnbd_ll_sql(MODEL)}), 4) AS log_likelihood FROM s"))
def bgnbd_loglik(t: Tables) -> DataFrame:
    return rounded(life.bgnbd_loglik(_summary(t), MODEL), 4, "log_likelihood")


@query("c4_bgnbd_fit")
def bgnbd_fit(t: Tables) -> DataFrame:
    """Fitted on the calibration period only, so that the holdout stays unseen."""
    cal = _cal_holdout(t).withColumnsRenamed({"frequency_cal": "frequency", "recency_cal": "recency", "T_cal": "T"})
    m = life.bgnbd_fit(cal)
    row = [(m.r, m.alpha, m.a, m.b, m.report.converged, m.report.passes, m.report.gradient)]
    parameters = t.spark.createDataFrame(row, f"r double, alpha double, a double, b double, {REPORT}")
    return parameters.crossJoin(life.bgnbd_loglik(cal, m))


def _p_alive_sql(m: life.BgNbd, x="frequency", tx="recency", age="T") -> str:
    return f"""(1 / (1 + CASE WHEN {x} > 0 THEN {m.a}::DOUBLE / ({m.b}::DOUBLE + {x} - 1)
                     * power(({m.alpha}::DOUBLE + {age}) / ({m.alpha}::DOUBLE + {tx}), {m.r}::DOUBLE + {x}) ELSE 0 END))"""


def _expected_sql(m: life.BgNbd, t: str, x="frequency", tx="recency", age="T", terms: int = 600) -> str:
    """The published form of the expectation, with the series in log-gamma terms."""
    r, al, a, b = (f"{v}::DOUBLE" for v in (m.r, m.alpha, m.a, m.b))
    p, q, c = f"({r} + {x})", f"({b} + {x})", f"({a} + {b} + {x} - 1)"
    z = f"({t} / ({al} + {age} + {t}))"
    series = f"""list_sum(list_transform(range(0, {terms}), lambda j:
        exp(lgamma({p} + j) - lgamma({p}) + lgamma({q} + j) - lgamma({q}) - lgamma({c} + j) + lgamma({c})
            - lgamma(j + 1) + j * ln({z}))))"""
    return f"""({c} / ({a} - 1) * (1 - power(({al} + {age}) / ({al} + {age} + {t}), {p}) * {series})
               * {_p_alive_sql(m, x, tx, age)})"""


@query(
    "c5_bgnbd_expected_purchases",
    _with_summary(f"SELECT customer_id, round({_expected_sql(MODEL, f'{HORIZON}::DOUBLE')}, 6) AS expected_purchases FROM s"),
)
def bgnbd_expected_purchases(t: Tables) -> DataFrame:
    predicted = life.bgnbd_expected_purchases(_summary(t), MODEL, HORIZON)
    return rounded(predicted.select("customer_id", "expected_purchases"), 6, "expected_purchases")


@query("c6_bgnbd_p_alive", _with_summary(f"SELECT customer_id, round({_p_alive_sql(MODEL)}, 6) AS p_alive FROM s"))
def bgnbd_p_alive(t: Tables) -> DataFrame:
    return rounded(life.bgnbd_p_alive(_summary(t), MODEL).select("customer_id", "p_alive"), 6, "p_alive")


@query("p21_repeat_buyers", _with_summary("SELECT customer_id, frequency FROM s WHERE frequency > 0 AND monetary_value > 0"))
def repeat_buyers(t: Tables) -> DataFrame:
    return life.repeat_buyers(_summary(t)).select("customer_id", "frequency")


def _gg_ll_sql(g: life.GammaGamma) -> str:
    p, q, v = (f"{x}::DOUBLE" for x in (g.p, g.q, g.v))
    px = f"({p} * frequency)"
    return f"""lgamma({px} + {q}) - lgamma({px}) - lgamma({q}) + {q} * ln({v}) + ({px} - 1) * ln(monetary_value)
               + {px} * ln(frequency) - ({px} + {q}) * ln(frequency * monetary_value + {v})"""


@query(
    "c7_gamma_gamma_loglik",
    _with_summary(
        f"SELECT round(sum({_gg_ll_sql(SPEND)}), 4) AS log_likelihood FROM s WHERE frequency > 0 AND monetary_value > 0"
    ),
)
def gamma_gamma_loglik(t: Tables) -> DataFrame:
    return rounded(life.gamma_gamma_loglik(_summary(t), SPEND), 4, "log_likelihood")


@query("c7_gamma_gamma_fit")
def gamma_gamma_fit(t: Tables) -> DataFrame:
    summary = _summary(t)
    g = life.gamma_gamma_fit(summary)
    row = [(g.p, g.q, g.v, g.report.converged, g.report.passes, g.report.gradient)]
    parameters = t.spark.createDataFrame(row, f"p double, q double, v double, {REPORT}")
    return parameters.crossJoin(life.gamma_gamma_loglik(summary, g))


def _gg_value_sql(g: life.GammaGamma) -> str:
    w = f"({g.p}::DOUBLE * frequency / ({g.p}::DOUBLE * frequency + {g.q}::DOUBLE - 1))"
    return f"({w} * monetary_value + (1 - {w}) * ({g.p}::DOUBLE * {g.v}::DOUBLE / ({g.q}::DOUBLE - 1)))"


@query(
    "c8_gg_expected_value",
    _with_summary(f"SELECT customer_id, round({_gg_value_sql(SPEND)}, 4) AS expected_value FROM s"),
)
def gg_expected_value(t: Tables) -> DataFrame:
    valued = life.gg_expected_value(_summary(t), SPEND)
    return rounded(valued.select("customer_id", "expected_value"), 4, "expected_value")


PERIODS = life.CLV_PERIODS
_clv_sql = f"""
    k AS (SELECT frequency, T, n, {_expected_sql(MODEL, f'(n * {life.WEEKS_PER_MONTH}::DOUBLE)', tx='T')}
                 / {_p_alive_sql(MODEL, tx='T')} AS growth
          FROM (SELECT DISTINCT frequency, T FROM s), (SELECT unnest(range(1, {PERIODS + 1})) AS n)),
    d AS (SELECT frequency, T, sum(step / power(1.01::DOUBLE, n)) AS discounted
          FROM (SELECT *, growth - coalesce(lag(growth) OVER (PARTITION BY frequency, T ORDER BY n), 0) AS step FROM k)
          GROUP BY 1, 2),
    p AS (SELECT s.*, {_gg_value_sql(SPEND)} AS expected_value,
                 {_gg_value_sql(SPEND)} * discounted * {_p_alive_sql(MODEL)} AS predicted_clv
          FROM s JOIN d USING (frequency, T))"""


def _predicted(t: Tables) -> DataFrame:
    return life.predicted_clv(_summary(t), MODEL, SPEND, PERIODS)


def _with_predicted(body: str) -> str:
    return with_views("order_sales", f"WITH {SUMMARY}, {_clv_sql} {body}")


@query(
    "c9_predicted_clv",
    _with_predicted("SELECT customer_id, round(expected_value, 4) AS expected_value, round(predicted_clv, 4) AS predicted_clv FROM p"),
)
def predicted_clv(t: Tables) -> DataFrame:
    columns = ["customer_id", "expected_value", "predicted_clv"]
    return rounded(_predicted(t).select(*columns), 4, "expected_value", "predicted_clv")


@query(
    "k3_top_predicted_clv",
    _with_predicted(
        """SELECT customer_id, frequency, recency, T, round(monetary_value, 2) AS monetary_value,
                  round(predicted_clv, 2) AS predicted_clv FROM p ORDER BY p.predicted_clv DESC, customer_id LIMIT 20"""
    ),
)
def top_predicted_clv(t: Tables) -> DataFrame:
    top = scoring.top_k(
        _predicted(t).select(*UNIT_COLUMNS, "predicted_clv"), [F.desc("predicted_clv"), F.col("customer_id")], 20
    )
    return rounded(top, 2, "monetary_value", "predicted_clv")


@query("a22_histogram_predicted_clv", _with_predicted(histogram_sql("p", "predicted_clv", 40)))
def histogram_predicted_clv(t: Tables) -> DataFrame:
    predicted = stage(_predicted(t).select("predicted_clv"))
    return rounded(descriptive.histogram(predicted, "predicted_clv", 40), 4, "bin_low", "bin_high")


@query(
    "a23_trimmed_histogram",
    _with_predicted(
        "SELECT * FROM (WITH tr AS (SELECT predicted_clv FROM p WHERE predicted_clv <= "
        f"(SELECT quantile_cont(predicted_clv, 0.99) FROM p)) {histogram_sql('tr', 'predicted_clv', 40)})"
    ),
)
def trimmed_histogram(t: Tables) -> DataFrame:
    predicted = stage(_predicted(t).select("predicted_clv"))
    trimmed = descriptive.quantile_trim(predicted, "predicted_clv", 0.99)
    return rounded(descriptive.histogram(trimmed, "predicted_clv", 40), 4, "bin_low", "bin_high")


@query("c9_predicted_clv_fitted")
def predicted_clv_fitted(t: Tables) -> DataFrame:
    """Both models fitted on the whole period, 52 monthly periods."""
    summary = _summary(t)
    model, spend = life.clv_fits(summary)
    return life.predicted_clv(summary, model, spend)


@query(
    "c10_holdout_evaluation",
    with_views(
        "order_sales",
        f"""WITH {CAL}, e AS (SELECT frequency_holdout AS y, {_expected_sql(
            MODEL, 'CAST(duration_holdout AS DOUBLE)', 'frequency_cal', 'recency_cal', 'T_cal')} AS p FROM ch)
            SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_excluded, round(sqrt(avg((y - p) ** 2)), 6) AS rmse,
                   round(avg(abs(y - p)), 6) AS mae,
                   round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM e""",
    ),
)
def holdout_evaluation(t: Tables) -> DataFrame:
    return rounded(life.holdout_evaluation(_cal_holdout(t), MODEL), 6, "rmse", "mae", "r2")


@query("c10_holdout_evaluation_fitted")
def holdout_evaluation_fitted(t: Tables) -> DataFrame:
    """Fit on the calibration period, judge on the holdout."""
    cal = _cal_holdout(t)
    names = {"frequency_cal": "frequency", "recency_cal": "recency", "T_cal": "T"}
    model = life.bgnbd_fit(cal.withColumnsRenamed(names))
    return life.holdout_evaluation(cal, model)


@query(
    "a30_regression_metrics",
    """SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_excluded, round(sqrt(avg((y - p) ** 2)), 4) AS rmse,
              round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2
       FROM (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS p FROM lineitem JOIN part ON p_partkey = l_partkey)""",
)
def regression_metrics(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p")
    )
    return rounded(rounded(life.regression_metrics(lines, "y", "p"), 4, "rmse", "mae"), 6, "r2")


_FIT_SQL = "SELECT TRUE AS converged, TRUE AS flat, TRUE AS few_passes, TRUE AS better_than_start"


def _fit_checks(t: Tables, report: life.FitReport, fitted: DataFrame, start: DataFrame) -> DataFrame:
    better = fitted.first()[0] >= start.first()[0]
    row = [(report.converged, report.gradient < 1e-4, report.passes <= 25, better)]
    return t.spark.createDataFrame(row, "converged boolean, flat boolean, few_passes boolean, better_than_start boolean")


@query("c4_bgnbd_fit_checks", _FIT_SQL)
def bgnbd_fit_checks(t: Tables) -> DataFrame:
    """The fit ends at a stationary point, in few passes, above the likelihood of its starting point."""
    cal = stage(_cal_holdout(t).withColumnsRenamed({"frequency_cal": "frequency", "recency_cal": "recency", "T_cal": "T"}))
    m = life.bgnbd_fit(cal)
    return _fit_checks(t, m.report, life.bgnbd_loglik(cal, m), life.bgnbd_loglik(cal, life.BgNbd(1.0, 1.0, 1.0, 1.0)))


@query("c7_gamma_gamma_fit_checks", _FIT_SQL)
def gamma_gamma_fit_checks(t: Tables) -> DataFrame:
    summary = stage(_summary(t))
    g = life.gamma_gamma_fit(summary)
    return _fit_checks(t, g.report, life.gamma_gamma_loglik(summary, g), life.gamma_gamma_loglik(summary, life.GammaGamma(1.0, 1.0, 1.0)))
