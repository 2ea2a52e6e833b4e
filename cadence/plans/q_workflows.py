"""Queries for section 2.12 (end-to-end runs) and the streaming form of S1."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import boost as BO
from cadence.operators import evaluate as EV
from cadence.operators import linear as LN
from cadence.operators import split as SP
from cadence.plans import runs as RN
from cadence.plans.catalog import ORACLE, finish, query
from cadence.plans.oracle_cte import INGEST, _W, roll, rounded, with_panel
from cadence.plans.q_features import SPEC, featured, ingested
from cadence.plans.q_models import MODEL_FEATURES, TARGET, model_frame
from cadence.plans.q_sources import payload_texts
from cadence.session import materialize
from cadence.sources import files as FS
from cadence.streaming.landing import ingest_available

K = "entity, period"
L3_COLS = ["entity", "period", "cdi_raw", "cdi_smooth", "gdp_volatility", "log_gdp_volatility",
           "cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1"]

_L3 = INGEST + f""",
cl AS (SELECT * FROM ingest WHERE NOT (gdp_growth IS NULL AND inflation IS NULL AND trade_openness IS NULL
                                      AND investment IS NULL AND cdi_raw IS NULL)),
cl2 AS (SELECT *, {roll('avg', 'cdi_raw', 3, 1)} AS cdi_smooth,
               {roll('stddev_samp', 'gdp_growth', 5, 3)} AS gdp_volatility FROM cl),
l3 AS (SELECT entity, period, cdi_raw, cdi_smooth, gdp_volatility,
              CASE WHEN gdp_volatility + 0.01 > 0 THEN ln(gdp_volatility + 0.01) END AS log_gdp_volatility,
              lag(cdi_smooth) OVER ({_W}) AS cdi_smooth_lag1, lag(inflation) OVER ({_W}) AS inflation_lag1,
              lag(trade_openness) OVER ({_W}) AS trade_openness_lag1, lag(investment) OVER ({_W}) AS investment_lag1
       FROM cl2)"""
_L3_SQL = rounded(with_panel("SELECT * FROM l3 WHERE log_gdp_volatility IS NOT NULL", _L3), K)


@query("l3_min_features", _L3_SQL)
def l3_min_features(spark, d):
    out = RN.feature_stage(RN.clean_stage(ingested(spark, d)), SPEC)
    return finish(out.select(*L3_COLS))


@query("l2_staged", _L3_SQL)
def l2_staged(spark, d):
    _, outputs = RN.staged_run(spark, ingested(spark, d), SPEC)
    return finish(outputs["features"].select(*L3_COLS))


@query("l2_stage_log")
def l2_stage_log(spark, d):
    log, _ = RN.staged_run(spark, ingested(spark, d), SPEC)
    return log.select("stage", "ok", "rows", "error")


@query("l1_findings")
def l1_findings(spark, d):
    """The complete analysis: overview, ridge and boosting on a fold split, clusters, PCA, median split."""
    mf = model_frame(spark, d)
    train = materialize(SP.add_folds(mf.filter(F.col("fold") < 4).drop("ordinal", "fold", "ts_fold"), SPEC, 5))
    test = mf.filter(F.col("fold") == 4)
    ridge = LN.fit_ridge(train, MODEL_FEATURES, TARGET, "fold")
    gbt = BO.fit_gbt(train, MODEL_FEATURES, TARGET, "fold", 5)
    r = LN.predict(test, ridge, "yhat").select(F.lit("ridge").alias("model"), F.col(TARGET).alias("y"), "yhat")
    g = BO.predict(test, gbt, "yhat").select(F.lit("gbt").alias("model"), F.col(TARGET).alias("y"), "yhat")
    scores = {row["model"]: row["r2"] for row in EV.metrics(r.unionByName(g)).collect()}  # two rows
    return finish(RN.findings(spark, featured(spark, d), SPEC, scores.get("ridge"), scores.get("gbt")))


@query("s1_stream_parse")
def s1_stream_parse(spark, d):
    """Landed payload files parsed by a Structured Streaming query (availableNow) into Parquet."""
    landing = FS.scratch_path(spark, "landing")
    payload_texts(spark, d).write.text(landing)
    table = ingest_available(spark, landing, FS.scratch_path(spark, "records"))
    return finish(table.select("entity", "entity_name", F.col("period").cast("int").alias("period"),
                               "indicator_code", "value"))


ORACLE["s1_stream_parse"] = ORACLE["s1_parse_payload"]
