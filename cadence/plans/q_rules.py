"""Queries for sections 2.11 (scoring rules) and 2.8 E1-E4 (evaluation)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.operators import evaluate as EV
from cadence.operators import rules as RL
from cadence.operators import summary as SM
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import FEATURES, _W, rounded, with_panel
from cadence.plans.q_features import SPEC, featured, month

K = "entity, period"
_LATEST_COLS = ["period", "cdi_smooth", "inflation", "investment", "governance_index", "gdp_growth",
                "log_gdp_volatility"]
_LATEST = ("latest AS (SELECT entity, " + ", ".join(_LATEST_COLS) + " FROM features "
           "QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) = 1)")


def _latest(spark, d):
    return RL.latest(featured(spark, d).select("entity", *_LATEST_COLS), SPEC)


@query("r1_latest", rounded(with_panel("SELECT * FROM latest", FEATURES, _LATEST), K))
def r1_latest(spark, d):
    return finish(_latest(spark, d))


def _r2_sql() -> str:
    last_cols = sorted({c for lag, cur, _ in RL.VOLATILITY_FALLBACKS for c in (lag, cur)})
    parts = []
    for lag, cur, dflt in RL.VOLATILITY_FALLBACKS:
        parts.append(f"COALESCE(l.{lag}, l.{cur}, m.med_{cur}, {dflt}, 0.0) AS {lag}")
    return rounded(with_panel(
        "SELECT l.entity, l.period, " + ", ".join(parts) + " FROM (SELECT entity, period, " + ", ".join(last_cols) +
        " FROM features QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) = 1) l JOIN "
        "(SELECT entity, " + ", ".join(f"median({cur}) AS med_{cur}" for _, cur, _ in RL.VOLATILITY_FALLBACKS) +
        " FROM features GROUP BY entity) m USING (entity)", FEATURES), K)


@query("r2_fallback", _r2_sql())
def r2_fallback(spark, d):
    return finish(RL.fallback_features(featured(spark, d), SPEC))


@query("r2_fallback_current", rounded(with_panel(
    "SELECT l.entity, l.period, " + ", ".join(f"COALESCE(l.{c}, m.med_{c}, 0.0) AS {c}" for c in RL.GROWTH_INPUTS) +
    " FROM (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY entity ORDER BY period DESC) = 1) l "
    "JOIN (SELECT entity, " + ", ".join(f"median({c}) AS med_{c}" for c in RL.GROWTH_INPUTS) +
    " FROM features GROUP BY entity) m USING (entity)", FEATURES), K))
def r2_fallback_current(spark, d):
    return finish(RL.fallback_current(featured(spark, d), SPEC))


@query("r4_vol_level", rounded(with_panel(
    "SELECT entity, period, exp(log_gdp_volatility) AS volatility, CASE WHEN exp(log_gdp_volatility) > 2.0 THEN "
    "'HIGH' WHEN exp(log_gdp_volatility) > 1.0 THEN 'MODERATE' WHEN log_gdp_volatility IS NOT NULL THEN 'LOW' END "
    "AS volatility_level FROM latest", FEATURES, _LATEST), "entity, period, volatility_level"))
def r4_vol_level(spark, d):
    l = _latest(spark, d).select("entity", "period", F.exp("log_gdp_volatility").alias("volatility"))
    return finish(RL.volatility_level(l, "volatility"))


@query("r5_risk_flags", with_panel(
    "SELECT entity, period, list_filter([CASE WHEN cdi_smooth > 70 THEN 'High commodity dependence' END, "
    "CASE WHEN inflation > 10 THEN 'High inflation' END, CASE WHEN investment < 20 THEN 'Low investment' END, "
    "CASE WHEN governance_index < -0.5 THEN 'Weak governance' END], lambda x: x IS NOT NULL) AS risk_factors "
    "FROM latest", FEATURES, _LATEST))
def r5_risk_flags(spark, d):
    return RL.risk_flags(_latest(spark, d)).select("entity", "period", "risk_factors")


_NAIVE = ("naive AS (SELECT entity, avg(gdp_growth) AS forecast, max(period) + 1 AS period FROM ("
          "SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS rn FROM panel_month) "
          "WHERE rn <= 5 GROUP BY entity)")


@query("r6_outlook", rounded(with_panel(
    "SELECT entity, period, forecast, CASE WHEN forecast > 5 THEN 'Strong growth' WHEN forecast > 2 THEN "
    "'Moderate growth' WHEN forecast > 0 THEN 'Slow growth' WHEN forecast > -2 THEN 'Slight contraction' "
    "WHEN forecast IS NOT NULL THEN 'Recession risk' END AS outlook FROM naive", _NAIVE), "entity, period, outlook"))
def r6_outlook(spark, d):
    return finish(RL.outlook(SM.naive_forecast(month(spark, d), SPEC), "forecast"))


@query("r7_vs_history", rounded(with_panel(
    "SELECT n.entity, n.period, n.forecast, h.historical_mean, n.forecast - h.historical_mean AS difference, "
    "CASE WHEN n.forecast - h.historical_mean > 0 THEN 'above' WHEN n.forecast - h.historical_mean IS NOT NULL "
    "THEN 'below' END AS position FROM naive n LEFT JOIN (SELECT entity, avg(gdp_growth) AS historical_mean "
    "FROM panel_month GROUP BY entity) h USING (entity)", _NAIVE), "entity, period, position"))
def r7_vs_history(spark, d):
    m = month(spark, d)
    return finish(RL.versus_history(SM.naive_forecast(m, SPEC), m, SPEC, "forecast"))


# ---- evaluation of simple column predictors of next-period growth -------------------------------
_PRED = f"""
preds AS (
  SELECT * FROM (
    SELECT entity, period, lead(gdp_growth) OVER ({_W}) AS y, gdp_growth AS persistence,
           avg(gdp_growth) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS expanding_mean,
           avg(gdp_growth) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling3
    FROM panel_month)
  WHERE y IS NOT NULL AND persistence IS NOT NULL AND expanding_mean IS NOT NULL AND rolling3 IS NOT NULL),
long_preds AS (FROM preds UNPIVOT (yhat FOR model IN (persistence, expanding_mean, rolling3)))"""

#: Nine significant digits: a zero target makes a term of 2^52 times the error, whose last digits are rounding.
_NINE = ("CASE WHEN {x} = 0 THEN 0.0 ELSE CAST(concat(CAST(round({x} / CAST(concat('1e', CAST(floor(log10(abs({x}))) - 8 AS INTEGER)) AS DOUBLE))"
         " AS BIGINT), 'e', CAST(floor(log10(abs({x}))) - 8 AS INTEGER)) AS DOUBLE) END")


def nine_digits(df, c="mape"):
    return df.withColumn(c, F.expr(_NINE.format(x=c)))


_METRICS = f"""
metrics AS (
  SELECT model, n, r2, sqrt(ssr / n) AS rmse, mae, {_NINE.format(x="(mape_r * 100.0)")} AS mape,
         1.0 - (1.0 - r2) * (CAST(n - 1 AS DOUBLE) / NULLIF(CAST(n - 2 AS DOUBLE), 0)) AS adj_r2,
         mean_residual, std_residual, max_error
  FROM (SELECT *, CASE WHEN n < 2 THEN NULL WHEN sst = 0 THEN CASE WHEN ssr = 0 THEN 1.0 ELSE 0.0 END
                       ELSE 1.0 - ssr / sst END AS r2
        FROM (SELECT model, count(*) AS n, sum((y - yhat) * (y - yhat)) AS ssr, var_pop(y) * count(*) AS sst,
                     avg(abs(y - yhat)) AS mae, avg(abs(y - yhat) / greatest(abs(y), 2.220446049250313e-16)) AS mape_r,
                     avg(y - yhat) AS mean_residual, stddev_pop(y - yhat) AS std_residual,
                     max(abs(y - yhat)) AS max_error
              FROM long_preds GROUP BY model)))"""

PREDICTORS = ["persistence", "expanding_mean", "rolling3"]


def predictions(spark, d):
    """Three column predictors of next-period growth."""
    w = SPEC.window()
    run, last3 = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(-2, 0)
    p = month(spark, d).select(
        "entity", "period", F.lead("gdp_growth").over(w).alias("y"), F.col("gdp_growth").alias("persistence"),
        F.avg("gdp_growth").over(run).alias("expanding_mean"), F.avg("gdp_growth").over(last3).alias("rolling3")).na.drop("any")
    return EV.stack_predictions(p, ["entity", "period"], "y", PREDICTORS)


@query("e1_metrics", rounded(with_panel("SELECT * FROM metrics", _PRED, _METRICS), "model, n, mape"))
def e1_metrics(spark, d):
    return finish(nine_digits(EV.metrics(predictions(spark, d))))


@query("e2_compare_models", rounded(with_panel(
    "SELECT *, CAST(row_number() OVER (ORDER BY rmse ASC NULLS LAST, model) AS INTEGER) AS rank FROM metrics", _PRED, _METRICS),
    "model, n, rank, mape"))
def e2_compare_models(spark, d):
    return finish(nine_digits(EV.compare(EV.metrics(predictions(spark, d)), "rmse")))


@query("e3_eval_report", rounded(with_panel(
    "SELECT *, rank = 1 AS best FROM (SELECT *, CAST(row_number() OVER (ORDER BY r2 DESC NULLS LAST, model) AS INTEGER) AS rank "
    "FROM metrics)", _PRED, _METRICS), "model, n, rank, best, mape"))
def e3_eval_report(spark, d):
    return finish(nine_digits(EV.report(predictions(spark, d), "r2")))


_Z95 = 1.959963984540054  # the normal quantile of a 95 % interval


@query("e4_pred_interval", rounded(with_panel(
    f"SELECT entity, period, persistence AS pred, y - persistence AS residual, "
    f"persistence - {_Z95!r} * stddev_pop(y - persistence) OVER () AS lower, "
    f"persistence + {_Z95!r} * stddev_pop(y - persistence) OVER () AS upper FROM preds", _PRED), K))
def e4_pred_interval(spark, d):
    p = predictions(spark, d).filter(F.col("model") == "persistence").select(
        "entity", "period", F.col("yhat").alias("pred"), (F.col("y") - F.col("yhat")).alias("residual"))
    return finish(EV.prediction_interval(p, "pred", "residual", 0.95))
