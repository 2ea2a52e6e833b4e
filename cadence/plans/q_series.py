"""Queries for section 2.10 (per-entity time series) on the user x day panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import series as TS
from cadence.plans.catalog import SHIFT, finish, query
from cadence.plans.oracle_cte import PANEL_DAY, rounded, with_panel
from cadence.sources.star import panel_day
from cadence.session import materialize
from cadence.spec import PanelSpec

DAY = PanelSpec(name=None)
TARGET = "value"
K = "entity, period"
_W = "PARTITION BY entity ORDER BY period"


def prep(spark, d):
    return materialize(TS.prepare(panel_day(spark, d), DAY, TARGET))


_PREP = f"""
pd0 AS (SELECT entity, period, CAST({TARGET} AS DOUBLE) AS y FROM panel_day
        WHERE entity IN (SELECT entity FROM panel_day GROUP BY entity HAVING count(*) >= 5)),
pd1 AS (SELECT *, row_number() OVER ({_W}) AS pos FROM pd0),
pd2 AS (SELECT *,
   last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
   last_value(y IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
   first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
   first_value(y IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM pd1),
prep AS (SELECT entity, period, y FROM (SELECT entity, period, CASE WHEN y IS NOT NULL THEN y WHEN p0 IS NULL THEN NULL
          WHEN p1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * CAST(pos - p0 AS DOUBLE) / CAST(p1 - p0 AS DOUBLE) END AS y
          FROM pd2) WHERE y IS NOT NULL)"""


def _sql(body: str, *extra: str) -> str:
    return with_panel(body, PANEL_DAY, _PREP, *extra, month=False)


@query("t1_prepare", rounded(_sql("SELECT * FROM prep"), K))
def t1_prepare(spark, d):
    return finish(prep(spark, d))


_TREND = """
tr1 AS (SELECT entity, count(*) AS n, min(period) AS first_period, max(period) AS last_period, avg(CAST(period AS DOUBLE)) AS mt,
               avg(y) AS my, var_pop(CAST(period AS DOUBLE)) AS vt, var_pop(y) AS vy, covar_pop(CAST(period AS DOUBLE), y) AS c
        FROM prep GROUP BY entity),
tr2 AS (SELECT *, c / NULLIF(vt, 0) AS slope, c * c / NULLIF(vt * vy, 0) AS fit FROM tr1),
tr4 AS (SELECT *, my - slope * mt AS intercept,
               CASE WHEN vt = 0 OR vy <= 0 THEN 0.0 WHEN fit > 1.0 - 1e-12 THEN 1.0 ELSE fit END AS r2 FROM tr2),
tr AS (
  SELECT entity, n, slope, intercept, r2,
         CASE WHEN n > 2 THEN sqrt((1.0 - r2) * vy / vt / (n - 2)) END AS std_err,
         slope * (last_period - first_period) AS total_change
  FROM tr4)"""


@query("t2_trend", rounded(_sql("SELECT * FROM tr", _TREND), "entity, n", shift=SHIFT))
def t2_trend(spark, d):
    return finish(TS.trend_stats(prep(spark, d), DAY), shift=SHIFT)


@query("t2_trend_test")
def t2_trend_test(spark, d):
    return finish(TS.trend(prep(spark, d), DAY))


@query("t3_trend_line", rounded(_sql(
    "SELECT entity, period, y, slope * period + intercept AS trend FROM prep JOIN tr USING (entity)", _TREND), K, shift=SHIFT))
def t3_trend_line(spark, d):
    p = prep(spark, d)
    return finish(TS.trend_line(p, TS.trend_stats(p, DAY), DAY), shift=SHIFT)


_DEC = f"""
dp AS (SELECT *, row_number() OVER ({_W}) - 1 AS pos, count(*) OVER (PARTITION BY entity) AS n FROM prep),
dq AS (SELECT *, CAST(LEAST(4, floor(n / 2)) AS INTEGER) AS p FROM dp),
dr AS (SELECT *, CAST(floor(p / 2) AS INTEGER) AS k,
         CASE WHEN p = 4 THEN (0.5 * lag(y, 2) OVER ({_W}) + lag(y, 1) OVER ({_W}) + y + lead(y, 1) OVER ({_W})
                               + 0.5 * lead(y, 2) OVER ({_W})) / 4.0
              WHEN p = 3 THEN (lag(y, 1) OVER ({_W}) + y + lead(y, 1) OVER ({_W})) / 3.0
              ELSE (0.5 * lag(y, 1) OVER ({_W}) + y + 0.5 * lead(y, 1) OVER ({_W})) / 2.0 END AS ma0 FROM dq),
ds AS (SELECT *, CASE WHEN pos >= k AND pos <= n - 1 - k THEN ma0 END AS ma, k AS front, n - 1 - k AS back FROM dr),
de AS (SELECT entity, CASE WHEN count(CASE WHEN pos >= front AND pos < LEAST(front + p, back) THEN ma END) >= 2 THEN regr_slope(CASE WHEN pos >= front AND pos < LEAST(front + p, back) THEN ma END, CASE WHEN pos >= front AND pos < LEAST(front + p, back) THEN CAST(pos AS DOUBLE) END) END AS f_slope,
               CASE WHEN count(CASE WHEN pos >= front AND pos < LEAST(front + p, back) THEN ma END) >= 2 THEN regr_intercept(CASE WHEN pos >= front AND pos < LEAST(front + p, back) THEN ma END, CASE WHEN pos >= front AND pos < LEAST(front + p, back) THEN CAST(pos AS DOUBLE) END) END AS f_intercept,
               CASE WHEN count(CASE WHEN pos >= GREATEST(front, back - p) AND pos < back THEN ma END) >= 2 THEN regr_slope(CASE WHEN pos >= GREATEST(front, back - p) AND pos < back THEN ma END, CASE WHEN pos >= GREATEST(front, back - p) AND pos < back THEN CAST(pos AS DOUBLE) END) END AS b_slope,
               CASE WHEN count(CASE WHEN pos >= GREATEST(front, back - p) AND pos < back THEN ma END) >= 2 THEN regr_intercept(CASE WHEN pos >= GREATEST(front, back - p) AND pos < back THEN ma END, CASE WHEN pos >= GREATEST(front, back - p) AND pos < back THEN CAST(pos AS DOUBLE) END) END AS b_intercept FROM ds GROUP BY entity),
dt AS (SELECT ds.*, CASE WHEN pos < front THEN f_slope * CAST(pos AS DOUBLE) + f_intercept
                         WHEN pos > back THEN b_slope * CAST(pos AS DOUBLE) + b_intercept ELSE ma END AS trend
       FROM ds JOIN de USING (entity)),
du AS (SELECT *, y - trend AS detrended, pos % p AS phase FROM dt),
ph AS (SELECT entity, phase, avg(detrended) AS phase_mean FROM du GROUP BY entity, phase),
pc AS (SELECT entity, avg(phase_mean) AS phase_center FROM ph GROUP BY entity),
dec AS (SELECT du.entity, du.period, du.y AS observed, du.trend, ph.phase_mean - pc.phase_center AS seasonal,
               du.detrended - (ph.phase_mean - pc.phase_center) AS resid, du.p AS period_length
        FROM du JOIN ph USING (entity, phase) JOIN pc USING (entity))"""


@query("t5_decompose", rounded(_sql("SELECT * FROM dec", _DEC), "entity, period, period_length", shift=SHIFT))
def t5_decompose(spark, d):
    return finish(TS.decompose(prep(spark, d), DAY), shift=SHIFT)


@query("t6_var_share", rounded(_sql(
    "SELECT entity, " + ", ".join(
        f"var_pop({c}) / NULLIF(var_pop(observed), 0) * 100.0 AS {c}_var_pct" for c in ("trend", "seasonal", "resid"))
    + " FROM dec GROUP BY entity", _DEC), "entity"))
def t6_var_share(spark, d):
    return finish(TS.variance_shares(TS.decompose(prep(spark, d), DAY), DAY))


@query("t7_adf")
def t7_adf(spark, d):
    return finish(TS.adf(prep(spark, d), DAY))


_L = TS.MAX_ACF_LAGS
_ACF = f"""
am AS (SELECT entity, avg(y) AS m, count(*) AS n FROM prep GROUP BY entity),
ad AS (SELECT p.entity, p.period, y - m AS d, n FROM prep p JOIN am USING (entity)),
al AS (SELECT entity, n, d, {", ".join(f"lead(d, {k}) OVER ({_W}) AS d{k}" for k in range(1, _L + 1))} FROM ad),
asum AS (SELECT entity, first(n) AS n, sum(d * d) AS s0, {", ".join(f"sum(d * d{k}) AS s{k}" for k in range(1, _L + 1))}
         FROM al GROUP BY entity),
acfs AS (SELECT *, CAST(LEAST({_L}, n // 2 - 1) AS INTEGER) AS nlags, 1.96 / sqrt(CAST(n AS DOUBLE)) AS conf_band
         FROM asum)"""


@query("t8_acf", rounded(_sql(
    "SELECT entity, n, nlags, conf_band, lag, acf, lag > 0 AND abs(acf) > conf_band AS significant FROM (" +
    " UNION ALL ".join(f"SELECT entity, n, nlags, conf_band, {k} AS lag, "
                       + ("1.0" if k == 0 else f"s{k} / NULLIF(s0, 0)") + " AS acf FROM acfs" for k in range(0, _L + 1))
    + ") WHERE nlags >= 2 AND lag <= nlags", _ACF), "entity, n, nlags, lag, significant"))
def t8_acf(spark, d):
    return finish(TS.acf(prep(spark, d), DAY))


@query("t9_pacf")
def t9_pacf(spark, d):
    return finish(TS.pacf(prep(spark, d), DAY))


def _arima(spark, d, orders=TS.FULL_ORDERS):
    p = prep(spark, d)
    design = materialize(TS.arima_design(p, DAY, TS.differencing(p, DAY)))
    fits = materialize(TS.arima_orders(design, DAY, orders))
    return design, fits, materialize(TS.select_order(fits, DAY))


@query("t10_arima")
def t10_arima(spark, d):
    design, _, best = _arima(spark, d)
    return finish(TS.arima_metrics(TS.arima_fitted(design, best, DAY), best, DAY))


@query("t10_arima_fitted")
def t10_arima_fitted(spark, d):
    design, _, best = _arima(spark, d)
    return finish(TS.arima_fitted(design, best, DAY).select("entity", "period", "y", "fitted", "residual"))


@query("t11_order_search")
def t11_order_search(spark, d):
    _, fits, _ = _arima(spark, d)
    return finish(fits.select("entity", "p", "d", "q", F.col("search_aic").alias("aic"), F.col("search_bic").alias("bic"),
                              F.col("n_common").alias("n_used")))


@query("t11_order_short")
def t11_order_short(spark, d):
    _, _, best = _arima(spark, d, TS.SHORT_ORDERS)
    return finish(best.select("entity", "p", "d", "q", F.col("search_aic").alias("aic")))


@query("t10_ar1", rounded(_sql("""
    SELECT entity, CAST(n AS BIGINT) AS n_used, const, ar1, ssr / n AS sigma2, n * (ln(2 * pi() * ssr / n) + 1) + 6 AS aic,
           n * (ln(2 * pi() * ssr / n) + 1) + 3 * ln(n) AS bic
    FROM (SELECT entity, count(*) AS n, regr_intercept(y, x) AS const, regr_slope(y, x) AS ar1,
                 regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x) AS ssr
          FROM (SELECT entity, y, lag(y) OVER (PARTITION BY entity ORDER BY period) AS x FROM prep) WHERE x IS NOT NULL GROUP BY entity)
    WHERE n > 3 AND ssr > 1e-9"""), "entity, n_used"))
def t10_ar1(spark, d):
    """The fixed order (1, 0, 0) for every series: regression on the value before."""
    p = prep(spark, d)
    level = p.select("entity").distinct().withColumn("d", F.lit(0))
    best = TS.arima_fixed(TS.arima_design(p, DAY, level), DAY, 1, 0).where(F.col("sigma2") * F.col("n_used") > 1e-9)
    return finish(best.select("entity", "n_used", "const", F.get("ar", F.lit(0)).alias("ar1"), "sigma2", "aic", "bic"))


@query("t7_adf_design", rounded(_sql("""
    SELECT entity, period, pos, level, y - level AS dy, lag(y - level) OVER w AS dl1, lag(y - level, 2) OVER w AS dl2
    FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) - 1 AS pos, lag(y) OVER (PARTITION BY entity ORDER BY period) AS level
          FROM prep) WINDOW w AS (PARTITION BY entity ORDER BY period)"""), "entity, period, pos"))
def t7_adf_design(spark, d):
    """Rows of the unit-root regression with two lags."""
    return finish(TS.adf_design(prep(spark, d), DAY, 2).select("entity", "period", F.col("pos").cast("long").alias("pos"), "level", "dy", "dl1", "dl2"))


_CYCLE = _DEC.replace("CAST(LEAST(4, floor(n / 2)) AS INTEGER) AS p", "CASE WHEN 3 <= floor(n / 2) THEN 3 ELSE 2 END AS p")


@query("t5_decompose_period", rounded(_sql("SELECT * FROM dec", _CYCLE), "entity, period, period_length", shift=SHIFT))
def t5_decompose_period(spark, d):
    """Decomposition with a given period of 3."""
    return finish(TS.decompose(prep(spark, d), DAY, 3), shift=SHIFT)


@query("t12_forecast")
def t12_forecast(spark, d):
    design, _, best = _arima(spark, d)
    return finish(TS.arima_forecast(TS.arima_fitted(design, best, DAY), best, DAY, 3))


@query("t13_series_report")
def t13_series_report(spark, d):
    return finish(TS.series_report(panel_day(spark, d), DAY, TARGET))
