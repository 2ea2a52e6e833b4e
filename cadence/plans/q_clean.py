"""Queries for section 2.4 (cleaning and quality)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import clean as CL
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import FEATURES, _W, rounded, with_panel
from cadence.plans.q_features import SPEC, featured
from cadence.sources.star import caution_entities, read

K = "entity, period"
IMP = ["gdp_growth", "inflation", "trade_openness", "investment", "cdi_raw", "cdi_smooth",
       "governance_index", "exchange_rate_volatility", "gdp_volatility", "log_gdp_volatility",
       "cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1",
       "governance_index_lag1", "exchange_rate_volatility_lag1"]
FEATURE_TABLE_COLS = [
    "entity", "entity_no", "entity_name", "period", "gdp_level", "fuel_exports_pct", "metals_exports_pct",
    "agri_exports_pct", "food_exports_pct", "exchange_rate", "inflation", "trade_openness", "investment",
    "control_corruption", "govt_effectiveness", "political_stability", "regulatory_quality", "rule_of_law",
    "voice_accountability", "gdp_growth", "cdi_raw", "exchange_rate_change", "governance_index",
    "exchange_rate_volatility", "cdi_smooth", "gdp_volatility", "log_gdp_volatility", "cdi_smooth_lag1",
    "inflation_lag1", "trade_openness_lag1", "investment_lag1", "governance_index_lag1",
    "exchange_rate_volatility_lag1"]


def _impute_sql(stat: str) -> str:
    em = "em AS (SELECT entity, " + ", ".join(f"{stat}({c}) AS e_{c}" for c in IMP) + " FROM features GROUP BY entity)"
    f1 = ("f1 AS (SELECT entity, period, " + ", ".join(f"COALESCE(features.{c}, em.e_{c}) AS {c}" for c in IMP)
          + " FROM features LEFT JOIN em USING (entity))")
    gm = "gm AS (SELECT " + ", ".join(f"{stat}({c}) AS g_{c}" for c in IMP) + " FROM f1)"
    body = ("SELECT * FROM (SELECT entity, period, " + ", ".join(f"COALESCE({c}, g_{c}) AS {c}" for c in IMP)
            + " FROM f1 CROSS JOIN gm) WHERE log_gdp_volatility IS NOT NULL")
    return rounded(with_panel(body, FEATURES, em, f1, gm), K)


@query("d1_impute_median", _impute_sql("median"))
def d1_impute_median(spark, d):
    f = featured(spark, d).select("entity", "period", *IMP)
    return finish(CL.impute(f, SPEC, "median", cols=IMP))


@query("d1_impute_mean", _impute_sql("avg"))
def d1_impute_mean(spark, d):
    f = featured(spark, d).select("entity", "period", *IMP)
    return finish(CL.impute(f, SPEC, "mean", cols=IMP))


@query("d1_ffill_bfill", rounded(with_panel(
    "SELECT * FROM (SELECT entity, period, " + ", ".join(
        f"COALESCE(last_value({c} IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        for c in IMP) + " FROM features) WHERE log_gdp_volatility IS NOT NULL", FEATURES), K))
def d1_ffill_bfill(spark, d):
    f = featured(spark, d).select("entity", "period", *IMP)
    return finish(CL.impute(f, SPEC, "forward_fill", cols=IMP))


@query("d1_drop", rounded(with_panel(
    "SELECT entity, period, " + ", ".join(CL.DROP_KEYS) + " FROM features WHERE " +
    " AND ".join(f"{c} IS NOT NULL" for c in CL.DROP_KEYS), FEATURES), K))
def d1_drop(spark, d):
    return finish(CL.drop_missing(featured(spark, d)).select("entity", "period", *CL.DROP_KEYS))


@query("d1_impute_report", with_panel(
    "SELECT column_name, round(median, 6) + 0 AS median FROM ("
    "UNPIVOT (SELECT " + ", ".join(f"median({c}) AS {c}" for c in IMP) + " FROM imputed) "
    "ON COLUMNS(*) INTO NAME column_name VALUE median) m JOIN ("
    "UNPIVOT (SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in IMP) + " FROM features) "
    "ON COLUMNS(*) INTO NAME column_name VALUE n_null) z USING (column_name) WHERE n_null > 0",
    FEATURES,
    "em AS (SELECT entity, " + ", ".join(f"median({c}) AS e_{c}" for c in IMP) + " FROM features GROUP BY entity)",
    "f1 AS (SELECT entity, period, " + ", ".join(f"COALESCE(features.{c}, em.e_{c}) AS {c}" for c in IMP)
    + " FROM features LEFT JOIN em USING (entity))",
    "gm AS (SELECT " + ", ".join(f"median({c}) AS g_{c}" for c in IMP) + " FROM f1)",
    "imputed AS (SELECT " + ", ".join(f"COALESCE({c}, g_{c}) AS {c}" for c in IMP) + " FROM f1 CROSS JOIN gm)"))
def d1_impute_report(spark, d):
    f = featured(spark, d).select("entity", "period", *IMP)
    after = CL.impute(f, SPEC, "median", cols=IMP, target=None)
    rep = CL.imputation_report(f, after, SPEC, cols=IMP).withColumnRenamed("column", "column_name")
    return finish(rep)


_CAP = ["inflation", "trade_openness", "investment", "gdp_growth"]


@query("d2_iqr_cap", rounded(with_panel(
    "SELECT entity, period, " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL ELSE GREATEST(q1_{c} - 3.0 * (q3_{c} - q1_{c}), "
        f"LEAST(q3_{c} + 3.0 * (q3_{c} - q1_{c}), {c})) END AS {c}" for c in _CAP) +
    " FROM features CROSS JOIN (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in _CAP) +
    " FROM features)", FEATURES), K))
def d2_iqr_cap(spark, d):
    f = featured(spark, d).select("entity", "period", *_CAP)
    return finish(CL.iqr_cap(f, _CAP, 3.0))


_ZF = ["inflation", "trade_openness", "investment", "gdp_growth"]


def _zfilter_sql(threshold: float = 3.0) -> str:
    ctes, prev = [], "features"
    for i, c in enumerate(_ZF):
        ctes.append(f"z{i} AS (SELECT t.* FROM {prev} t CROSS JOIN (SELECT avg({c}) AS m, stddev_samp({c}) AS s "
                    f"FROM {prev}) st WHERE abs((t.{c} - st.m) / st.s) < {threshold})")
        prev = f"z{i}"
    return rounded(with_panel(f"SELECT entity, period, {', '.join(_ZF)} FROM {prev}", FEATURES, *ctes), K)


@query("d3_zscore_filter", _zfilter_sql())
def d3_zscore_filter(spark, d):
    f = featured(spark, d).select("entity", "period", *_ZF)
    return finish(CL.zscore_filter(f, _ZF, 3.0, sequential=True))


_VALID = with_panel("""
SELECT * FROM (
  SELECT true AS has_required_columns,
         COALESCE(max(k) <= 1, true) AS no_duplicates,
         COALESCE(bool_and(r), true) AS valid_ranges,
         COALESCE(min(n) >= 3, true) AS sufficient_data,
         (SELECT bool_and((total - nn) * 100 < total * 50)
            FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM features) ON COLUMNS(*) INTO NAME c VALUE nn),
                 (SELECT count(*) AS total FROM features)) AS acceptable_missing
  FROM (SELECT entity, sum(k) AS n, max(k) AS k, bool_and(r) AS r FROM (
          SELECT entity, period, count(*) AS k,
                 bool_and(COALESCE(log_gdp_volatility > -10 AND log_gdp_volatility < 10
                                   AND cdi_smooth_lag1 >= 0 AND cdi_smooth_lag1 <= 100, false)) AS r
          FROM features GROUP BY entity, period) GROUP BY entity))
UNPIVOT (passed FOR "check" IN (has_required_columns, no_duplicates, valid_ranges, sufficient_data,
                                acceptable_missing))""", FEATURES)


@query("d4_validate", _VALID)
def d4_validate(spark, d):
    return CL.validate(featured(spark, d).select(*FEATURE_TABLE_COLS), SPEC)


_CAUTION = ("caution AS (SELECT n_name AS entity, concat('limited coverage in region ', "
            "CAST(n_regionkey AS VARCHAR)) AS reason FROM nation WHERE n_nationkey % 3 = 0)")
_QNULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in CL.QUALITY_COLS)
_QUALITY = f"""
quality AS (
  SELECT entity, n_years, concat_ws('-', CAST(first_period AS VARCHAR), CAST(last_period AS VARCHAR)) AS period_range,
         round_even(missing_raw, 1) AS missing_pct, reason IS NOT NULL AS has_caution,
         COALESCE(reason, '') AS caution_reason, round_even(score_raw, 0) AS quality_score,
         CASE WHEN score_raw >= 70 THEN 'Good' WHEN score_raw >= 50 THEN 'Moderate' ELSE 'Low' END AS quality_level
  FROM (SELECT *, GREATEST(0.0, LEAST(100.0, 100.0 - CAST(GREATEST(0, (10 - n_years) * 5) AS DOUBLE) - missing_raw
                                       - CASE WHEN reason IS NOT NULL THEN 20.0 ELSE 0.0 END)) AS score_raw
        FROM (SELECT p.*, c.reason, CAST(nulls AS DOUBLE) / NULLIF(CAST(n_years * {len(CL.QUALITY_COLS)} AS DOUBLE), 0) * 100.0 AS missing_raw
              FROM (SELECT entity, count(*) AS n_years, min(period) AS first_period, max(period) AS last_period,
                           sum({_QNULLS}) AS nulls FROM features GROUP BY entity) p
              LEFT JOIN caution c USING (entity))))"""


def _quality(spark, d):
    return CL.quality_score(featured(spark, d), SPEC, caution_entities(spark, d))


@query("d5_quality_score", rounded(with_panel("SELECT * FROM quality", FEATURES, _CAUTION, _QUALITY),
                                   "entity, n_years, period_range, has_caution, caution_reason, quality_level"))
def d5_quality_score(spark, d):
    return finish(_quality(spark, d))


@query("d6_quality_summary", with_panel(
    "SELECT a.quality_level, a.n_entities, a.n_caution, a.best_score, COALESCE(e.caution_examples, []) AS "
    "caution_examples FROM (SELECT quality_level, count(*) AS n_entities, CAST(count_if(has_caution) AS BIGINT) AS n_caution, "
    "max(quality_score) + 0 AS best_score FROM quality GROUP BY quality_level) a LEFT JOIN (SELECT quality_level, "
    "list_sort(list(entity)) AS caution_examples FROM (SELECT *, row_number() OVER (PARTITION BY quality_level "
    "ORDER BY entity) AS rn FROM quality WHERE has_caution) WHERE rn <= 5 GROUP BY quality_level) e "
    "USING (quality_level)", FEATURES, _CAUTION, _QUALITY))
def d6_quality_summary(spark, d):
    return finish(CL.quality_summary(_quality(spark, d), SPEC))


@query("d6_caution_rows", with_panel("SELECT entity, quality_level, caution_reason FROM quality WHERE has_caution", FEATURES, _CAUTION, _QUALITY))
def d6_caution_rows(spark, d):
    return finish(CL.caution_rows(_quality(spark, d), SPEC))


_ANULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in CL.AVAILABILITY_COLS)


@query("d7_availability", rounded(with_panel(
    f"SELECT entity, n_periods, first_period, last_period, missing_pct, "
    f"(n_periods < 10 OR missing_pct > 30.0) AS notice FROM ("
    f"SELECT entity, count(*) AS n_periods, min(period) AS first_period, max(period) AS last_period, "
    f"CAST(sum({_ANULLS}) AS DOUBLE) / NULLIF(CAST(count(*) * {len(CL.AVAILABILITY_COLS)} AS DOUBLE), 0) * 100.0 "
    f"AS missing_pct FROM features GROUP BY entity)", FEATURES),
    "entity, n_periods, first_period, last_period, notice"))
def d7_availability(spark, d):
    return finish(CL.availability(featured(spark, d), SPEC))


@query("d8_missing_report", with_panel(
    "SELECT column_name, missing, round_even(CAST(missing AS DOUBLE) / CAST(n AS DOUBLE) * 100.0, 1) + 0 "
    "AS missing_pct FROM (UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM features) ON COLUMNS(*) "
    "INTO NAME column_name VALUE missing) CROSS JOIN (SELECT count(*) AS n FROM features) WHERE missing > 0",
    FEATURES))
def d8_missing_report(spark, d):
    f = featured(spark, d).select(*FEATURE_TABLE_COLS)
    return finish(CL.missing_report(f).withColumnRenamed("column", "column_name"))


@query("d9_duplicates", "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders "
                        "GROUP BY o_custkey, o_orderdate HAVING count(*) > 1")
def d9_duplicates(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderdate")
    return CL.duplicates(o, ["o_custkey", "o_orderdate"])
