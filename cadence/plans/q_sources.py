"""Queries for sections 2.1 (sources and sinks), 2.2 (projections) and 2.6 (joins)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import features as FT
from cadence.operators import select as SL
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import FEATURES, INGEST, LONG_INDICATORS, rounded, with_panel
from cadence.plans.q_clean import FEATURE_TABLE_COLS
from cadence.plans.q_features import SPEC, featured, month
from cadence.sources import files as FS
from cadence.sources import indicators as IN
from cadence.sources.star import entity_groups, long_indicators, read
from cadence.spec import numeric_candidates

K = "entity, period"
NAMES = [n for _, n, _ in IN.INDICATOR_CATALOGUE]
PANEL_NAMES = ["gdp_growth", "inflation", "trade_openness", "investment", "fuel_exports_pct",
               "metals_exports_pct", "agri_exports_pct", "food_exports_pct", "exchange_rate",
               "control_corruption", "govt_effectiveness", "political_stability", "regulatory_quality",
               "rule_of_law", "voice_accountability"]

_CAT = ("cat AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', '{n}', '{d}')" for c, n, d in IN.INDICATOR_CATALOGUE) + ") AS t(code, name, description))")
_LI = with_panel("{body}", LONG_INDICATORS, _CAT)


def _li(body: str) -> str:
    return _LI.replace("{body}", body)


def payload_texts(spark, d):
    m = month(spark, d)
    li = long_indicators(spark, d, m)
    ents = m.select("entity").distinct()
    return IN.build_payloads(li, IN.catalogue(spark)).unionByName(IN.empty_and_bad_payloads(ents))


def parsed(spark, d):
    return IN.parse_payloads(payload_texts(spark, d))


@query("s1_parse_payload", rounded(_li(
    "SELECT entity, entity_name, period, code AS indicator_code, value FROM long_indicators "
    "JOIN cat ON indicator = name"), "entity, entity_name, period, indicator_code"))
def s1_parse_payload(spark, d):
    return finish(parsed(spark, d))


@query("s1_payload_status", _li(
    "SELECT 'ok' AS status, count(*) AS n FROM (SELECT DISTINCT code, entity, floor(period / 12) "
    "FROM long_indicators JOIN cat ON indicator = name) UNION ALL "
    "SELECT 'empty', count(DISTINCT entity) FROM panel_month UNION ALL "
    "SELECT 'invalid', count(DISTINCT entity) FROM panel_month"))
def s1_payload_status(spark, d):
    return IN.classify_payloads(payload_texts(spark, d)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _wide(spark, d):
    return IN.pivot_wide(IN.rename_indicators(parsed(spark, d), IN.catalogue(spark)), PANEL_NAMES)


@query("s2_pivot_panel", rounded(with_panel(
    "SELECT entity, period, entity_name, " + ", ".join(PANEL_NAMES) + " FROM panel_month"),
    "entity, period, entity_name"))
def s2_pivot_panel(spark, d):
    return finish(_wide(spark, d))


@query("s3_rename_indicator", rounded(_li(
    "SELECT entity, entity_name, period, code AS indicator_code, name AS indicator, description, value "
    "FROM long_indicators JOIN cat ON indicator = name"),
    "entity, entity_name, period, indicator_code, indicator, description"))
def s3_rename_indicator(spark, d):
    return finish(IN.rename_indicators(parsed(spark, d), IN.catalogue(spark)))


@query("s4_fetch_range", rounded(with_panel(
    "SELECT entity, period, entity_name, " + ", ".join(PANEL_NAMES) +
    " FROM panel_month WHERE period BETWEEN 24000 AND 24023"), "entity, period, entity_name"))
def s4_fetch_range(spark, d):
    return finish(IN.fetch_range(payload_texts(spark, d), IN.catalogue(spark), PANEL_NAMES, 24000, 24023))


@query("s5_ingest", rounded(with_panel(
    "SELECT entity, period, cdi_raw, exchange_rate_change, exchange_rate_volatility, governance_index "
    "FROM ingest ORDER BY entity, period", INGEST), K))
def s5_ingest(spark, d):
    out = FT.ingest_derivations(_wide(spark, d), SPEC).orderBy("entity", "period")
    return finish(out.select("entity", "period", "cdi_raw", "exchange_rate_change", "exchange_rate_volatility",
                             "governance_index"))


_RT_COLS = ["entity", "entity_no", "entity_name", "period", "gdp_level", "inflation", "gdp_growth"]


@query("s8_csv_roundtrip", rounded(with_panel("SELECT " + ", ".join(_RT_COLS) + " FROM panel_month"),
                                   "entity, entity_no, entity_name, period"))
def s8_csv_roundtrip(spark, d):
    p = month(spark, d).select(*_RT_COLS)
    path = FS.write_table(p, FS.scratch_path(spark, "panel-csv"), "csv")
    return finish(FS.read_table(spark, path, p.schema, "csv"))


_GROUPS = ("groups AS (SELECT r_name AS group_name, n_name AS entity FROM nation JOIN region "
           "ON n_regionkey = r_regionkey UNION ALL SELECT 'default', n_name FROM nation)")


@query("s9_group_filter", rounded(with_panel(
    "SELECT entity, period, gdp_growth FROM panel_month WHERE entity IN "
    "(SELECT entity FROM groups WHERE group_name = 'AFRICA')", _GROUPS), K))
def s9_group_filter(spark, d):
    p = month(spark, d).select("entity", "period", "gdp_growth")
    return finish(FS.group_filter(p, entity_groups(spark, d), "AFRICA"))


@query("s9_group_fallback", rounded(with_panel(
    "SELECT entity, period, gdp_growth FROM panel_month WHERE entity IN "
    "(SELECT entity FROM groups WHERE group_name = 'default')", _GROUPS), K))
def s9_group_fallback(spark, d):
    p = month(spark, d).select("entity", "period", "gdp_growth")
    return finish(FS.group_filter(p, entity_groups(spark, d), "ATLANTIS"))


@query("s10_entity_name", with_panel(
    "SELECT entity, COALESCE(dn, static_name, entity) AS display_name, "
    "CASE WHEN dn IS NOT NULL THEN 'data' WHEN static_name IS NOT NULL THEN 'static' ELSE 'code' END AS name_source "
    "FROM (SELECT entity, max(CASE WHEN entity_no % 4 = 0 THEN NULL ELSE entity_name END) AS dn "
    "FROM panel_month GROUP BY entity) LEFT JOIN (SELECT n_name AS entity, concat('Nation ', "
    "CAST(n_nationkey AS VARCHAR)) AS static_name FROM nation WHERE n_nationkey % 8 = 0) USING (entity)"))
def s10_entity_name(spark, d):
    p = month(spark, d).withColumn(
        "entity_name", F.when(F.col("entity_no") % 4 == 0, F.lit(None)).otherwise(F.col("entity_name")))
    static = (read(spark, d, "nation").filter(F.col("n_nationkey") % 8 == 0)
              .select(F.col("n_name").alias("entity"),
                      F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string")).alias("static_name")))
    return FS.resolve_names(p, static)


@query("p1_panel_filter", rounded(with_panel(
    "SELECT entity, period, gdp_growth, inflation FROM panel_month WHERE entity IN ('NATION_1', 'NATION_5', "
    "'NATION_7') AND period >= 24000 AND period <= 24012"), K))
def p1_panel_filter(spark, d):
    p = month(spark, d).select("entity", "period", "gdp_growth", "inflation")
    return finish(SL.panel_filter(p, SPEC, ["NATION_1", "NATION_5", "NATION_7"], 24000, 24012))


_P2 = ["inflation_lag1", "investment_lag1", "log_gdp_volatility"]


@query("p2_dropna_any", rounded(with_panel(
    "SELECT entity, period, " + ", ".join(_P2) + " FROM features WHERE " +
    " AND ".join(f"{c} IS NOT NULL" for c in _P2), FEATURES), K))
def p2_dropna_any(spark, d):
    return finish(SL.drop_any(featured(spark, d).select("entity", "period", *_P2), _P2))


_P3 = ["gdp_growth", "inflation", "investment"]


@query("p3_dropna_all", rounded(with_panel(
    "SELECT entity, period, " + ", ".join(_P3) + " FROM panel_month WHERE NOT (" +
    " AND ".join(f"{c} IS NULL" for c in _P3) + ")"), K))
def p3_dropna_all(spark, d):
    return finish(SL.drop_all(month(spark, d).select("entity", "period", *_P3), _P3))


_P5F = ["cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1", "governance_index_lag1",
        "exchange_rate_volatility_lag1", "log_gdp_volatility"]


def _p5_sql() -> str:
    em = "em AS (SELECT entity, " + ", ".join(f"median({c}) AS e_{c}" for c in _P5F) + " FROM features GROUP BY entity)"
    f1 = ("f1 AS (SELECT entity, period, " + ", ".join(f"COALESCE(features.{c}, em.e_{c}) AS {c}" for c in _P5F)
          + " FROM features LEFT JOIN em USING (entity))")
    gm = "gm AS (SELECT " + ", ".join(f"median({c}) AS g_{c}" for c in _P5F) + " FROM f1)"
    body = ("SELECT * FROM (SELECT entity, period, " + ", ".join(f"COALESCE({c}, g_{c}) AS {c}" for c in _P5F)
            + " FROM f1 CROSS JOIN gm) WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _P5F))
    return rounded(with_panel(body, FEATURES, em, f1, gm), K)


@query("p5_model_frame", _p5_sql())
def p5_model_frame(spark, d):
    frame, _ = SL.model_frame(featured(spark, d), SPEC)
    return finish(frame)


_P7 = ["inflation", "investment", "trade_openness", "gdp_growth"]


@query("p7_fill_const", rounded(with_panel(
    "SELECT entity, period, " + ", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in _P7) + " FROM panel_month"), K))
def p7_fill_const(spark, d):
    return finish(SL.fill_const(month(spark, d).select("entity", "period", *_P7), _P7, 0.0))


@query("p9_numeric_candidates", with_panel(
    "SELECT column_name AS \"column\", non_null FROM (UNPIVOT (SELECT count(COLUMNS(* EXCLUDE (entity, entity_name, "
    "period, entity_no))) FROM features) ON COLUMNS(*) INTO NAME column_name VALUE non_null) WHERE non_null > 5",
    FEATURES))
def p9_numeric_candidates(spark, d):
    return numeric_candidates(featured(spark, d).select(*FEATURE_TABLE_COLS), SPEC)


@query("j1_outer_merge", rounded(with_panel(
    "SELECT entity, entity_name, period, " + ", ".join(PANEL_NAMES) + " FROM panel_month WHERE NOT (" +
    " AND ".join(f"{c} IS NULL" for c in PANEL_NAMES) + ")"), "entity, entity_name, period"))
def j1_outer_merge(spark, d):
    li = long_indicators(spark, d, month(spark, d)).filter(F.col("value").isNotNull())
    frames = [li.filter(F.col("indicator") == n).select("entity", "entity_name", "period", F.col("value").alias(n))
              for n in PANEL_NAMES]
    return finish(SL.outer_merge(frames, ["entity", "entity_name", "period"]))


_S7_SCHEMA = "l_orderkey long, l_linenumber int, l_quantity double"


@query("s7_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49")
def s7_scan(spark, d):
    """Declared-schema scan: only the three declared columns are read, the filter reaches the scan."""
    li = FS.read_table(spark, f"{d}/lineitem.parquet", _S7_SCHEMA, "parquet")
    return li.filter(F.col("l_quantity") >= 49)
