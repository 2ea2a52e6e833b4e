"""Queries for section 2.3 (feature derivation) on the monthly nation panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import features as FT
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import (CDI_RAW, FEATURES, GOV_INDEX, INGEST, _W, pad_pct,
                                      roll, rounded, with_panel)
from cadence.sources.star import panel_month
from cadence.session import materialize
from cadence.spec import PanelSpec

SPEC = PanelSpec()
K = "entity, period"


def month(spark, d):
    """The derived panel, materialised once: every later pass (fits, folds,
    statistics) reads entities x periods rows instead of re-joining lineitem."""
    return materialize(panel_month(spark, d))


def ingested(spark, d):
    return FT.ingest_derivations(month(spark, d), SPEC)


def featured(spark, d):
    return FT.feature_set(ingested(spark, d), SPEC)


@query("f1_capped_sum", rounded(with_panel(f"SELECT entity, period, {CDI_RAW} AS cdi_raw FROM panel_month"), K))
def f1_capped_sum(spark, d):
    return finish(FT.capped_sum(month(spark, d)).select("entity", "period", "cdi_raw"))


@query("f2_rolling_mean", rounded(with_panel(
    f"SELECT entity, period, cdi_raw, {roll('avg', 'cdi_raw', 3, 1)} AS cdi_smooth "
    f"FROM (SELECT entity, period, {CDI_RAW} AS cdi_raw FROM panel_month)"), K))
def f2_rolling_mean(spark, d):
    p = FT.capped_sum(month(spark, d))
    return finish(FT.rolling_mean(p, SPEC, "cdi_raw", "cdi_smooth", 3, 1)
                  .select("entity", "period", "cdi_raw", "cdi_smooth"))


@query("f3_row_mean", rounded(with_panel(f"SELECT entity, period, {GOV_INDEX} AS governance_index FROM panel_month"), K))
def f3_row_mean(spark, d):
    return finish(FT.row_mean(month(spark, d)).select("entity", "period", "governance_index"))


@query("f4_pct_change", rounded(with_panel(
    f"SELECT entity, period, exchange_rate, {pad_pct('exchange_rate')} AS exchange_rate_change, "
    f"((exchange_rate / NULLIF(lag(exchange_rate) OVER ({_W}), 0)) - 1.0) * 100.0 AS exchange_rate_change_nopad "
    f"FROM panel_month"), K))
def f4_pct_change(spark, d):
    p = FT.pct_change(month(spark, d), SPEC, "exchange_rate", "exchange_rate_change", pad=True)
    p = FT.pct_change(p, SPEC, "exchange_rate", "exchange_rate_change_nopad", pad=False)
    return finish(p.select("entity", "period", "exchange_rate", "exchange_rate_change",
                           "exchange_rate_change_nopad"))


@query("f5_rolling_std3", rounded(with_panel(
    "SELECT entity, period, exchange_rate_change, exchange_rate_volatility FROM ingest", INGEST), K))
def f5_rolling_std3(spark, d):
    return finish(ingested(spark, d).select("entity", "period", "exchange_rate_change",
                                            "exchange_rate_volatility"))


@query("f6_rolling_std5", rounded(with_panel(
    f"SELECT entity, period, gdp_growth, {roll('stddev_samp', 'gdp_growth', 5, 3)} AS gdp_volatility "
    f"FROM panel_month"), K))
def f6_rolling_std5(spark, d):
    p = FT.rolling_std(month(spark, d), SPEC, "gdp_growth", "gdp_volatility", 5, 3)
    return finish(p.select("entity", "period", "gdp_growth", "gdp_volatility"))


_VOL = f"(SELECT entity, period, {roll('stddev_samp', 'gdp_growth', 5, 3)} AS gdp_volatility FROM panel_month)"


@query("f7_log_vol", rounded(with_panel(
    f"SELECT entity, period, gdp_volatility, CASE WHEN gdp_volatility + 0.01 > 0 "
    f"THEN ln(gdp_volatility + 0.01) END AS log_gdp_volatility FROM {_VOL}"), K))
def f7_log_vol(spark, d):
    p = FT.rolling_std(month(spark, d), SPEC, "gdp_growth", "gdp_volatility", 5, 3)
    return finish(FT.log_offset(p).select("entity", "period", "gdp_volatility", "log_gdp_volatility"))


@query("f8_exp_vol", rounded(with_panel(
    "SELECT entity, period, log_gdp_volatility, exp(log_gdp_volatility) AS gdp_volatility_est FROM features",
    FEATURES), K))
def f8_exp_vol(spark, d):
    p = FT.exp_back(featured(spark, d))
    return finish(p.select("entity", "period", "log_gdp_volatility", "gdp_volatility_est"))


@query("f9_lag", rounded(with_panel(
    f"SELECT entity, period, lag(inflation) OVER ({_W}) AS inflation_lag1, "
    f"lag(trade_openness) OVER ({_W}) AS trade_openness_lag1, lag(investment) OVER ({_W}) AS investment_lag1, "
    f"lag(gdp_growth) OVER ({_W}) AS gdp_growth_lag1 FROM panel_month"), K))
def f9_lag(spark, d):
    p = FT.add_lags(month(spark, d), SPEC, ["inflation", "trade_openness", "investment", "gdp_growth"])
    return finish(p.select("entity", "period", "inflation_lag1", "trade_openness_lag1",
                           "investment_lag1", "gdp_growth_lag1"))


@query("f10_lead_target", rounded(with_panel(
    f"SELECT * FROM (SELECT entity, period, gdp_growth, lead(gdp_growth) OVER ({_W}) AS gdp_growth_next "
    f"FROM panel_month) WHERE gdp_growth_next IS NOT NULL AND gdp_growth IS NOT NULL"), K))
def f10_lead_target(spark, d):
    p = FT.add_lead(month(spark, d), SPEC).select("entity", "period", "gdp_growth", "gdp_growth_next")
    return finish(p.na.drop("any", subset=["gdp_growth_next", "gdp_growth"]))


F11_COLS = ("entity, period, cdi_raw, cdi_smooth, gdp_volatility, log_gdp_volatility, governance_index, "
            "exchange_rate_change, exchange_rate_volatility, cdi_smooth_lag1, inflation_lag1, "
            "trade_openness_lag1, investment_lag1, governance_index_lag1, exchange_rate_volatility_lag1")


@query("f11_feature_set", rounded(with_panel(f"SELECT {F11_COLS} FROM features", FEATURES), K))
def f11_feature_set(spark, d):
    return finish(featured(spark, d).select(*[c.strip() for c in F11_COLS.split(",")]))


_USABLE = ["cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1",
           "governance_index_lag1", "exchange_rate_volatility_lag1", "log_gdp_volatility"]
_KEYF = ["cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1", "log_gdp_volatility"]


@query("f12_usable_counts", with_panel(
    "SELECT feature, non_null, rows FROM (SELECT " +
    ", ".join(f"count({c}) AS {c}" for c in _USABLE) + ", CAST(count_if(" +
    " AND ".join(f"{c} IS NOT NULL" for c in _KEYF) + ") AS BIGINT) AS __all_key_features__, count(*) AS rows FROM features) "
    "UNPIVOT (non_null FOR feature IN (" + ", ".join(_USABLE) + ", __all_key_features__))", FEATURES))
def f12_usable_counts(spark, d):
    return FT.usable_counts(featured(spark, d), _USABLE, _KEYF)


_INTERP = f"""
b AS (SELECT entity, period, inflation, row_number() OVER ({_W}) AS pos FROM panel_month),
c AS (SELECT *,
   last_value(CASE WHEN inflation IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
   last_value(inflation IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
   first_value(CASE WHEN inflation IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
   first_value(inflation IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM b)"""


@query("f13_interpolate", rounded(with_panel(
    "SELECT entity, period, inflation_interp FROM (SELECT entity, period, CASE WHEN inflation IS NOT NULL THEN inflation "
    "WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN v0 "
    "ELSE v0 + (v1 - v0) * CAST(pos - p0 AS DOUBLE) / CAST(p1 - p0 AS DOUBLE) END AS inflation_interp FROM c) "
    "WHERE inflation_interp IS NOT NULL", _INTERP), K))
def f13_interpolate(spark, d):
    p = FT.interpolate(month(spark, d), SPEC, "inflation", "inflation_interp")
    return finish(p.select("entity", "period", "inflation_interp"))


_Z = ["inflation", "investment", "trade_openness"]


@query("f14_zscore", rounded(with_panel(
    "SELECT entity, period, " + ", ".join(
        f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN CASE WHEN {c} IS NOT NULL THEN 0.0 END "
        f"ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}_z" for c in _Z) +
    " FROM panel_month"), K))
def f14_zscore(spark, d):
    return finish(FT.zscore(month(spark, d), _Z).select("entity", "period", *[f"{c}_z" for c in _Z]))


def _positioned(spark, d):
    from cadence.operators import split as SP
    return SP.entity_positions(month(spark, d), SPEC)


@query("f6_rolling_std5_skewsafe", rounded(with_panel(
    f"SELECT entity, period, gdp_growth, {roll('stddev_samp', 'gdp_growth', 5, 3)} AS gdp_volatility "
    f"FROM panel_month"), K))
def f6_rolling_std5_skewsafe(spark, d):
    """F6 through positions and a bounded fan-out aggregate (no per-entity window partition)."""
    p = FT.rolling_join(_positioned(spark, d), SPEC, "gdp_growth", "gdp_volatility", 5, 3, "std")
    return finish(p.select("entity", "period", "gdp_growth", "gdp_volatility"))


@query("f9_lag_skewsafe", rounded(with_panel(
    f"SELECT entity, period, lag(inflation) OVER ({_W}) AS inflation_lag1, "
    f"lag(trade_openness) OVER ({_W}) AS trade_openness_lag1, lag(investment) OVER ({_W}) AS investment_lag1, "
    f"lag(gdp_growth) OVER ({_W}) AS gdp_growth_lag1 FROM panel_month"), K))
def f9_lag_skewsafe(spark, d):
    """F9 through positions and an equi-join on (entity, position - 1)."""
    p = FT.lag_join(_positioned(spark, d), SPEC, ["inflation", "trade_openness", "investment", "gdp_growth"])
    return finish(p.select("entity", "period", "inflation_lag1", "trade_openness_lag1", "investment_lag1",
                           "gdp_growth_lag1"))
