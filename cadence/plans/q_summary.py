"""Queries for section 2.5 (aggregations, grouping, top-k, bucketing)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import summary as SM
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import FEATURES, PANEL_DAY, rounded, with_panel
from cadence.plans.q_features import SPEC, featured, month
from cadence.sources.star import panel_day
from cadence.spec import PanelSpec

DAY = PanelSpec(name=None)


@query("a1_overview", with_panel(
    "SELECT count(*) AS n_rows, count(DISTINCT entity) AS n_entities, min(period) AS first_period, "
    "max(period) AS last_period FROM panel_month"))
def a1_overview(spark, d):
    return SM.overview(month(spark, d), SPEC)


def _union_stats(cols, fields_sql, source="features"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, " + ", ".join(f.format(c=c) for f in fields_sql) + f" FROM {source}"
        for c in cols)


@query("a2_var_stats", rounded(with_panel(
    _union_stats(SM.KEY_VARS, ["avg({c}) AS mean", "stddev_samp({c}) AS std"]), FEATURES), "variable"))
def a2_var_stats(spark, d):
    return finish(SM.var_stats(featured(spark, d)))


_DESC = ["count({c}) AS count", "avg({c}) AS mean", "stddev_samp({c}) AS std", "CAST(min({c}) AS DOUBLE) AS min",
         "quantile_cont({c}, 0.25) AS q25", "quantile_cont({c}, 0.5) AS q50", "quantile_cont({c}, 0.75) AS q75",
         "CAST(max({c}) AS DOUBLE) AS max"]
DESCRIBE_VARS = ["cdi_smooth", "gdp_growth", "gdp_volatility", "governance_index", "inflation",
                 "investment", "trade_openness"]


@query("a3_describe", rounded(with_panel(_union_stats(DESCRIBE_VARS, _DESC), FEATURES), "variable, count"))
def a3_describe(spark, d):
    return finish(SM.describe(featured(spark, d), DESCRIBE_VARS))


_QCUT = """
qs AS (SELECT quantile_cont(cdi_smooth, 0.25) AS q1, quantile_cont(cdi_smooth, 0.5) AS q2,
              quantile_cont(cdi_smooth, 0.75) AS q3 FROM features),
qcut AS (SELECT f.*, CASE WHEN cdi_smooth <= q1 THEN 'Q1 (Low)' WHEN cdi_smooth <= q2 THEN 'Q2'
                          WHEN cdi_smooth <= q3 THEN 'Q3' ELSE 'Q4 (High)' END AS cdi_quartile
         FROM features f CROSS JOIN qs WHERE cdi_smooth IS NOT NULL)"""


@query("a4_grouped_describe", rounded(with_panel(
    "SELECT cdi_quartile, " + ", ".join(f.format(c="gdp_volatility") for f in _DESC) +
    " FROM qcut GROUP BY cdi_quartile", FEATURES, _QCUT), "cdi_quartile, count"))
def a4_grouped_describe(spark, d):
    q = SM.quartile_bucket(featured(spark, d))
    return finish(SM.grouped_describe(q, "cdi_quartile", "gdp_volatility"))


@query("a5_entity_means", rounded(with_panel(
    "SELECT * FROM (SELECT entity, " + ", ".join(f"avg({c}) AS {c}" for c in SM.CLUSTER_FEATURES) +
    ", min_by(entity_name, period) AS entity_name FROM features GROUP BY entity) WHERE " +
    " AND ".join(f"{c} IS NOT NULL" for c in SM.CLUSTER_FEATURES), FEATURES), "entity, entity_name"))
def a5_entity_means(spark, d):
    return finish(SM.entity_means(featured(spark, d), SPEC, minimum=3))


@query("a6_topn", rounded(with_panel(
    "SELECT entity, avg(cdi_smooth) AS mean_cdi_smooth FROM features GROUP BY entity "
    "ORDER BY mean_cdi_smooth DESC NULLS LAST, entity LIMIT 5", FEATURES), "entity"))
def a6_topn(spark, d):
    return finish(SM.top_n(featured(spark, d), SPEC, "cdi_smooth", 5))


@query("a7_counts", with_panel("SELECT entity, count(*) AS n_rows FROM panel_day GROUP BY entity", PANEL_DAY,
                               month=False))
def a7_counts(spark, d):
    return SM.entity_counts(panel_day(spark, d), DAY)


_A8 = ["cdi_smooth", "gdp_volatility", "inflation", "investment", "gdp_growth"]


@query("a8_region_compare", rounded(with_panel(
    "SELECT entity_name, " + ", ".join(f"round_even(avg({c}), 2) AS {c}" for c in _A8) +
    " FROM features GROUP BY entity_name", FEATURES), "entity_name"))
def a8_region_compare(spark, d):
    return finish(SM.region_compare(featured(spark, d), SPEC))


@query("a9_entity_kpis", rounded(with_panel(
    "SELECT entity, avg(cdi_smooth) AS avg_cdi, exp(avg(log_gdp_volatility)) AS avg_volatility, "
    "avg(inflation) AS avg_inflation, avg(investment) AS avg_investment FROM features GROUP BY entity",
    FEATURES), "entity"))
def a9_entity_kpis(spark, d):
    return finish(SM.entity_kpis(featured(spark, d), SPEC))


@query("a10_growth_stats", rounded(with_panel(
    "SELECT entity, avg(gdp_growth) AS avg_growth, max(gdp_growth) AS max_growth, min(gdp_growth) AS min_growth, "
    "stddev_samp(gdp_growth) AS std_growth FROM panel_month GROUP BY entity"), "entity"))
def a10_growth_stats(spark, d):
    return finish(SM.growth_stats(month(spark, d), SPEC))


@query("a11_median_split", rounded(with_panel(
    """SELECT m AS median_split_value, CAST(count_if(s > m) AS BIGINT) AS n_high, CAST(count_if(NOT (s > m)) AS BIGINT) AS n_low,
              avg(CASE WHEN s > m THEN o END) AS high_mean, avg(CASE WHEN NOT (s > m) THEN o END) AS low_mean,
              avg(CASE WHEN NOT (s > m) THEN o END) - avg(CASE WHEN s > m THEN o END) AS difference,
              (avg(CASE WHEN NOT (s > m) THEN o END) - avg(CASE WHEN s > m THEN o END)) > 0 AS paradox_confirmed
       FROM em CROSS JOIN (SELECT median(s) AS m FROM em) GROUP BY m""", FEATURES,
    "em AS (SELECT * FROM (SELECT entity, avg(cdi_smooth) AS s, avg(gdp_growth) AS o FROM features "
    "GROUP BY entity) WHERE s IS NOT NULL AND o IS NOT NULL)"), "n_high, n_low, paradox_confirmed"))
def a11_median_split(spark, d):
    return finish(SM.median_split(featured(spark, d), SPEC))


@query("a12_qcut", rounded(with_panel("SELECT entity, period, cdi_smooth, cdi_quartile FROM qcut", FEATURES, _QCUT),
                           "entity, period, cdi_quartile"))
def a12_qcut(spark, d):
    return finish(SM.quartile_bucket(featured(spark, d)).select("entity", "period", "cdi_smooth", "cdi_quartile"))


@query("a13_histogram", rounded(with_panel(
    """SELECT bin, lo + CAST(bin - 1 AS DOUBLE) * ((hi - lo) / 30) AS bin_low,
              lo + CAST(bin AS DOUBLE) * ((hi - lo) / 30) AS bin_high, n
       FROM (SELECT LEAST(30, CAST(floor((gdp_growth - lo) / (hi - lo) * 30) AS INTEGER) + 1) AS bin, lo, hi,
                    count(*) AS n
             FROM panel_month CROSS JOIN (SELECT min(gdp_growth) AS lo, max(gdp_growth) AS hi FROM panel_month)
             WHERE gdp_growth IS NOT NULL GROUP BY 1, 2, 3)"""), "bin, n"))
def a13_histogram(spark, d):
    return finish(SM.histogram(month(spark, d), "gdp_growth", 30))


@query("a14_linefit", rounded(with_panel(
    "SELECT regr_slope(log_gdp_volatility, cdi_smooth) AS slope, "
    "regr_intercept(log_gdp_volatility, cdi_smooth) AS intercept, "
    "CAST(regr_count(log_gdp_volatility, cdi_smooth) AS BIGINT) AS n FROM features", FEATURES), "n"))
def a14_linefit(spark, d):
    return finish(SM.line_fit(featured(spark, d), "cdi_smooth", "log_gdp_volatility"))


_NAIVE = ("naive AS (SELECT entity, avg(gdp_growth) AS forecast, max(period) + 1 AS period FROM ("
          "SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS rn FROM panel_month) "
          "WHERE rn <= 5 GROUP BY entity)")


@query("a15_naive_forecast", rounded(with_panel("SELECT entity, forecast, period FROM naive", _NAIVE), "entity, period"))
def a15_naive_forecast(spark, d):
    return finish(SM.naive_forecast(month(spark, d), SPEC))


@query("a16_sorted", rounded(with_panel("SELECT entity, period, gdp_level FROM panel_month ORDER BY entity, period"),
                             "entity, period"))
def a16_sorted(spark, d):
    return finish(SM.sort_panel(month(spark, d).select("entity", "period", "gdp_level"), SPEC))


@query("a17_distinct", with_panel("SELECT DISTINCT entity, entity_name FROM panel_month"))
def a17_distinct(spark, d):
    return SM.distinct_names(month(spark, d), SPEC)


@query("a18_union_forecast", rounded(with_panel(
    "SELECT entity, period, gdp_growth, 'Historical' AS type FROM panel_month UNION ALL "
    "SELECT entity, period, forecast AS gdp_growth, 'Forecast' AS type FROM naive", _NAIVE),
    "entity, period, type"))
def a18_union_forecast(spark, d):
    m = month(spark, d)
    return finish(SM.union_forecast(m, SM.naive_forecast(m, SPEC), SPEC))
