"""Queries for sections 2.7 (supervised models) and 2.8 X1-X5 (explanations)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cadence.operators import boost as BO
from cadence.operators import evaluate as EV
from cadence.operators import explain as XP
from cadence.operators import forecast as FC
from cadence.operators import linear as LN
from cadence.operators import select as SL
from cadence.operators import split as SP
from cadence.operators import trees as TR
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import FEATURES, rounded, with_panel
from cadence.plans.q_features import SPEC, featured, month
from cadence.session import materialize
from cadence.sources import files as FS

K = "entity, period"
MODEL_FEATURES = ["cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1",
                  "governance_index_lag1", "exchange_rate_volatility_lag1"]
TARGET = "log_gdp_volatility"
SPLIT_KEY = "(entity_no * 31 + period) % 10 < 8"


def split_col():
    return F.pmod(F.col("entity_no") * 31 + F.col("period"), F.lit(10)) < 8


@query("m1_split", with_panel(f"SELECT entity, period, {SPLIT_KEY} AS is_train FROM panel_month"))
def m1_split(spark, d):
    m = month(spark, d).select("entity", "entity_no", "period")
    return SP.modulo_split(m, F.col("entity_no") * 31 + F.col("period")).select("entity", "period", "is_train")


@query("m1_hash_split")
def m1_hash_split(spark, d):
    return SP.hash_split(month(spark, d).select("entity", "period"), SPEC, 0.8, 42)


@query("m2_ordered_split", with_panel(
    "SELECT entity, period, ordinal, ordinal < CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS is_train FROM "
    "(SELECT entity, period, row_number() OVER (ORDER BY entity, period) - 1 AS ordinal, count(*) OVER () AS n "
    "FROM panel_month)"))
def m2_ordered_split(spark, d):
    return SP.ordered_split(month(spark, d).select("entity", "period"), SPEC, 0.2).select(
        "entity", "period", "ordinal", "is_train")


def _fold_sql(src: str, k: int = 5) -> str:
    return (f"SELECT *, CASE WHEN ordinal < (n % {k}) * (n // {k} + 1) THEN CAST(ordinal // (n // {k} + 1) AS INTEGER) "
            f"ELSE CAST((n % {k}) + (ordinal - (n % {k}) * (n // {k} + 1)) // (n // {k}) AS INTEGER) END AS fold, "
            f"CASE WHEN ordinal >= n - {k} * (n // {k + 1}) THEN CAST((ordinal - (n - {k} * (n // {k + 1}))) "
            f"// (n // {k + 1}) AS INTEGER) END AS ts_fold FROM (SELECT *, row_number() OVER (ORDER BY entity, period) "
            f"- 1 AS ordinal, count(*) OVER () AS n FROM {src})")


@query("m3_folds", with_panel("SELECT entity, period, ordinal, fold, ts_fold FROM (" +
                              _fold_sql("(SELECT entity, period FROM panel_month)") + ")"))
def m3_folds(spark, d):
    return SP.add_folds(month(spark, d).select("entity", "period"), SPEC, 5).select(
        "entity", "period", "ordinal", "fold", "ts_fold")


def model_frame(spark, d):
    """Complete rows of the six lagged features and the log-volatility target, with folds."""
    return _frame_of(featured(spark, d))


def _frame_of(features):
    f = features.select("entity", "entity_no", "period", *MODEL_FEATURES, TARGET)
    f = SL.drop_any(f, MODEL_FEATURES + [TARGET])
    return materialize(SP.add_folds(f, SPEC, 5))


_GK = len(MODEL_FEATURES) + 1
_FRAME_SQL = ("frame AS (" + _fold_sql(
    "(SELECT entity, period, " + ", ".join(MODEL_FEATURES) + f", {TARGET} FROM features WHERE " +
    " AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES + [TARGET]) + ")") + ")")
_Z = ["CAST(1.0 AS DOUBLE)"] + [f"(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ())" for c in MODEL_FEATURES]
_ZSQL = ("zf AS (SELECT fold, " + ", ".join(f"{z} AS z{i}" for i, z in enumerate(_Z)) + f", {TARGET} AS y FROM frame)")
_GRAM_COLS = (["count(*) AS g_n"] +
              [f"sum(z{i} * z{j}) AS g_{i}_{j}" for i in range(_GK) for j in range(i, _GK)] +
              [f"sum(z{i} * y) AS g_{i}_y" for i in range(_GK)] + ["sum(y * y) AS g_y_y"])


@query("m4_ridge_gram", rounded(with_panel(
    "SELECT fold, " + ", ".join(_GRAM_COLS) + " FROM zf GROUP BY fold", FEATURES, _FRAME_SQL, _ZSQL),
    "fold, g_n", 4))
def m4_ridge_gram(spark, d):
    grams, _, _ = LN.fold_grams(model_frame(spark, d), MODEL_FEATURES, TARGET, "fold")
    return finish(grams, 4)


def _fit_ridge(mf):
    return LN.fit_ridge(mf, MODEL_FEATURES, TARGET, "fold")


def _ridge(spark, d):
    mf = model_frame(spark, d)
    return mf, _fit_ridge(mf)


@query("m4_ridge_predict")
def m4_ridge_predict(spark, d):
    mf, fit = _ridge(spark, d)
    return finish(LN.predict(mf, fit).select("entity", "period", TARGET, "prediction"))


@query("m5_ridge_cv")
def m5_ridge_cv(spark, d):
    _, fit = _ridge(spark, d)
    return finish(LN.cv_scores(spark, fit))


@query("m6_ridge_coef")
def m6_ridge_coef(spark, d):
    _, fit = _ridge(spark, d)
    return finish(LN.coefficients(spark, fit))


def _fit_gbt(mf):
    return BO.fit_gbt(mf, MODEL_FEATURES, TARGET, "fold", 5)


def _gbt(spark, d):
    mf = model_frame(spark, d)
    return mf, _fit_gbt(mf)


@query("m9_gbt")
def m9_gbt(spark, d):
    mf, fit = _gbt(spark, d)
    return finish(BO.predict(mf, fit).select("entity", "period", TARGET, "prediction"))


@query("m10_gbt_importance")
def m10_gbt_importance(spark, d):
    _, fit = _gbt(spark, d)
    return finish(BO.importance(spark, MODEL_FEATURES, fit.model.featureImportances.toArray()))


@query("m12_grid_results")
def m12_grid_results(spark, d):
    _, fit = _gbt(spark, d)
    return finish(BO.grid_results(spark, fit))


def _forecast_split(features):
    data, feats = FC.prepare(features, SPEC)
    data = materialize(SP.ordered_split(data, SPEC, 0.2))
    return data.filter("is_train"), data.filter(~F.col("is_train")), feats


def _forecast(spark, d, model_type="rf", n_trees=50):
    train, test, feats = _forecast_split(featured(spark, d))
    return FC.fit(train, SPEC, feats, model_type=model_type, n_trees=n_trees), train, test


@query("m13_forecaster")
def m13_forecaster(spark, d):
    fc, _, test = _forecast(spark, d, "ridge")
    return finish(fc.predict(test).select("entity", "period", FC.TARGET, "prediction"))


@query("m14_ensemble_interval")
def m14_ensemble_interval(spark, d):
    fc, _, test = _forecast(spark, d, "rf")
    return finish(FC.ensemble_interval(fc, test).select("entity", "period", FC.TARGET, "prediction", "lower", "upper"))


@query("m15_forecast_importance")
def m15_forecast_importance(spark, d):
    fc, _, _ = _forecast(spark, d, "rf")
    return finish(fc.importance(spark))


@query("m17_forecast_run")
def m17_forecast_run(spark, d):
    """Data -> ordered split -> fit -> evaluate, for the ridge and forest forecasters."""
    train, test, feats = _forecast_split(featured(spark, d))
    outs = [FC.evaluate(FC.fit(train, SPEC, feats, model_type=mt, n_trees=50), test, spark) for mt in ("ridge", "rf")]
    return finish(outs[0].unionByName(outs[1]))


def _train_test(spark, d):
    """The imputed model frame, split by a key: training rows with folds, test rows, features.  The panel is built once."""
    features = materialize(featured(spark, d))
    frame, feats = SL.model_frame(features, SPEC)
    frame = frame.join(features.select("entity", "period", "entity_no"), ["entity", "period"])
    frame = materialize(SP.modulo_split(frame, F.col("entity_no") * 31 + F.col("period")))
    return materialize(SP.add_folds(frame.filter("is_train"), SPEC, 5)), frame.filter(~F.col("is_train")), feats


@query("m18_train_run")
def m18_train_run(spark, d):
    """Model frame (imputed) -> hash split -> ridge and boosting -> ranked test metrics."""
    train, test, feats = _train_test(spark, d)
    ridge = LN.fit_ridge(train, feats, TARGET, "fold")
    gbt = BO.fit_gbt(train, feats, TARGET, "fold", 5)
    r = LN.predict(test, ridge, "yhat").select(F.lit("ridge").alias("model"), F.col(TARGET).alias("y"), "yhat")
    g = BO.predict(test, gbt, "yhat").select(F.lit("gbt").alias("model"), F.col(TARGET).alias("y"), "yhat")
    return finish(EV.report(r.unionByName(g), "r2"))


@query("s11_model_roundtrip")
def s11_model_roundtrip(spark, d):
    """Persist the forest forecaster, the ridge and the boosting fit, reload them; predictions must agree."""
    from cadence.sources import models as MS
    features = materialize(featured(spark, d))
    train, test, feats = _forecast_split(features)
    fc = FC.fit(train, SPEC, feats, model_type="rf", n_trees=20)
    path = FS.scratch_path(spark, "forecaster-rf")
    MS.save_forecaster(spark, fc, path)
    back = MS.load_forecaster(spark, path)
    mf = _frame_of(features)
    ridge = _fit_ridge(mf)
    rpath = FS.scratch_path(spark, "ridge")
    MS.save_ridge(spark, ridge, rpath)
    ridge2 = MS.load_ridge(spark, rpath)
    trees = back.predict(fc.predict(test, "p_saved"), "p_loaded").select(
        F.lit("forecaster_rf").alias("model"), "entity", "period", "p_saved", "p_loaded")
    lin = LN.predict(LN.predict(mf, ridge, "p_saved"), ridge2, "p_loaded").select(
        F.lit("ridge").alias("model"), "entity", "period", "p_saved", "p_loaded")
    boost = _fit_gbt(mf)
    bpath = FS.scratch_path(spark, "boost")
    MS.save_boost(spark, boost, bpath)
    boosted = BO.predict(BO.predict(mf, boost, "p_saved"), MS.load_boost(spark, bpath), "p_loaded").select(
        F.lit("boost").alias("model"), "entity", "period", "p_saved", "p_loaded")
    out = trees.unionByName(lin).unionByName(boosted)
    return finish(out.withColumn("same", F.abs(F.col("p_saved") - F.col("p_loaded")) < 1e-12))


# ---- explanations ----------------------------------------------------------------------------
X_FEATURES = ["cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1"]
# Fixed test scorer for the SQL-checked Shapley queries: (coefficient, feature indexes).
SCORER = [(0.02, (0,)), (-0.1, (1,)), (0.01, (2,)), (0.05, (3,)), (0.001, (0, 1)), (0.0005, (2, 3))]


def _xframe(spark, d):
    f = featured(spark, d).select("entity", "entity_no", "period", *X_FEATURES)
    f = SL.drop_any(f, X_FEATURES)
    return f.withColumn("is_train", split_col())


def _bg(frame):
    return XP.background_moments(frame.filter("is_train"), [F.col(c) for c in X_FEATURES], [v for _, v in SCORER])


_XSQL = ("xf AS (SELECT entity, entity_no, period, " + ", ".join(X_FEATURES) + f", {SPLIT_KEY} AS is_train "
         "FROM features WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in X_FEATURES) + ")",
         "bg AS (SELECT * FROM xf WHERE is_train)",
         "mo AS (SELECT avg(cdi_smooth_lag1) AS m0, avg(inflation_lag1) AS m1, avg(trade_openness_lag1) AS m2, "
         "avg(investment_lag1) AS m3, avg(cdi_smooth_lag1 * inflation_lag1) AS m01, "
         "avg(trade_openness_lag1 * investment_lag1) AS m23 FROM bg)")
_PHI = {
    "cdi_smooth_lag1": "0.02 * (x0 - m0) + 0.001 * 0.5 * ((x0 * m1 - m01) + (x0 * x1 - m0 * x1))",
    "inflation_lag1": "-0.1 * (x1 - m1) + 0.001 * 0.5 * ((m0 * x1 - m01) + (x0 * x1 - x0 * m1))",
    "trade_openness_lag1": "0.01 * (x2 - m2) + 0.0005 * 0.5 * ((x2 * m3 - m23) + (x2 * x3 - m2 * x3))",
    "investment_lag1": "0.05 * (x3 - m3) + 0.0005 * 0.5 * ((m2 * x3 - m23) + (x2 * x3 - x2 * m3))",
}
_PHI_SQL = ("phi AS (SELECT entity, period, feature, phi FROM (SELECT entity, period, " +
            ", ".join(f"{v} AS \"{k}\"" for k, v in _PHI.items()) +
            " FROM (SELECT entity, period, cdi_smooth_lag1 AS x0, inflation_lag1 AS x1, trade_openness_lag1 AS x2, "
            "investment_lag1 AS x3 FROM xf WHERE NOT is_train) CROSS JOIN mo) UNPIVOT (phi FOR feature IN (" +
            ", ".join(f"\"{k}\"" for k in _PHI) + ")))")


def _phi(spark, d):
    frame = _xframe(spark, d)
    bg = _bg(frame)
    test = frame.filter(~F.col("is_train"))
    return XP.shapley_polynomial(test, ["entity", "period"], X_FEATURES, SCORER, bg), bg


@query("x1_shapley_exact", rounded(with_panel("SELECT * FROM phi", FEATURES, *_XSQL, _PHI_SQL),
                                   "entity, period, feature"))
def x1_shapley_exact(spark, d):
    return finish(_phi(spark, d)[0])


_LIN = [0.02, -0.1, 0.01, 0.05]


@query("x2_shapley_linear", rounded(with_panel(
    "SELECT entity, period, feature, phi FROM (SELECT entity, period, 0.02 * (cdi_smooth_lag1 - m0) AS "
    "cdi_smooth_lag1, -0.1 * (inflation_lag1 - m1) AS inflation_lag1, 0.01 * (trade_openness_lag1 - m2) AS "
    "trade_openness_lag1, 0.05 * (investment_lag1 - m3) AS investment_lag1 FROM xf CROSS JOIN mo WHERE NOT is_train) "
    "UNPIVOT (phi FOR feature IN (cdi_smooth_lag1, inflation_lag1, trade_openness_lag1, investment_lag1))",
    FEATURES, *_XSQL), "entity, period, feature"))
def x2_shapley_linear(spark, d):
    frame = _xframe(spark, d)
    bg = _bg(frame)
    return finish(XP.shapley_linear(frame.filter(~F.col("is_train")), ["entity", "period"], X_FEATURES, _LIN, bg))


@query("x2_shapley_ridge")
def x2_shapley_ridge(spark, d):
    """Closed-form Shapley of the fitted ridge (z-scored features): every row against the means of all training rows."""
    mf, fit = _ridge(spark, d)
    moments = XP.background_moments(mf, [fit.z(j) for j in range(len(MODEL_FEATURES))])
    return finish(XP.shapley_linear(mf, ["entity", "period"], MODEL_FEATURES, fit.coef, moments, transform=fit.z))


def _explained(spark, d):
    """The fitted booster's contributions of every row of the model frame, materialised, with the base value."""
    mf, fit = _gbt(spark, d)
    explainer = TR.Explainer.of(TR.flatten(spark, fit.model, len(MODEL_FEATURES)))
    return mf, fit, materialize(XP.shapley_trees(mf, ["entity", "period"], MODEL_FEATURES, explainer)), explainer.base


@query("x1_shapley_model")
def x1_shapley_model(spark, d):
    """Path-dependent Shapley values of the fitted boosting model for every row."""
    return finish(_explained(spark, d)[2])


@query("x1_model_additivity", with_panel(
    f"SELECT entity, period, {len(MODEL_FEATURES)} AS n_features, TRUE AS additive FROM frame", FEATURES, _FRAME_SQL))
def x1_model_additivity(spark, d):
    """Base value plus contributions against the booster's own prediction, for every row."""
    mf, fit, phi, base = _explained(spark, d)
    sums = phi.groupBy("entity", "period").agg(F.count("*").cast("int").alias("n_features"), F.sum("phi").alias("s"))
    both = BO.predict(mf, fit).select("entity", "period", "prediction").join(sums, ["entity", "period"])
    return both.select("entity", "period", "n_features", (F.abs(F.lit(base) + F.col("s") - F.col("prediction")) < 1e-9).alias("additive"))


@query("x3_model")
def x3_model(spark, d):
    """Importance by mean size of the fitted booster's contributions."""
    return finish(XP.importance(_explained(spark, d)[2]))


@query("x4_model")
def x4_model(spark, d):
    """Every row's prediction by the fitted booster, explained by its three largest contributions."""
    _, _, phi, base = _explained(spark, d)
    return finish(XP.explain_rows(phi, ["entity", "period"], base))


@query("x5_run")
def x5_run(spark, d):
    """The training run's booster explained on its test rows: contributions, importance and drivers in one table."""
    train, test, feats = _train_test(spark, d)
    fit = BO.fit_gbt(train, feats, TARGET, "fold", 5)
    explainer = TR.Explainer.of(TR.flatten(spark, fit.model, len(feats)))
    phi = materialize(XP.shapley_trees(test, ["entity", "period"], feats, explainer))
    return finish(XP.report(phi, ["entity", "period"], explainer.base))


@query("x3_shapley_importance", rounded(with_panel(
    "SELECT feature, shap_importance, shap_importance / sum(shap_importance) OVER () * 100.0 AS importance_pct, "
    "CAST(row_number() OVER (ORDER BY shap_importance DESC, feature) AS INTEGER) AS rank FROM "
    "(SELECT feature, avg(abs(phi)) AS shap_importance FROM phi GROUP BY feature)",
    FEATURES, *_XSQL, _PHI_SQL), "feature, rank"))
def x3_shapley_importance(spark, d):
    return finish(XP.importance(_phi(spark, d)[0]))


_BASE_SQL = ("base AS (SELECT 0.02 * m0 - 0.1 * m1 + 0.01 * m2 + 0.05 * m3 + 0.001 * m01 + 0.0005 * m23 "
             "AS base_value FROM mo)")


@query("x4_explain_rows", rounded(with_panel(
    "SELECT entity, period, base_value, base_value + s AS prediction, " + ", ".join(
        f"top{k}_feature, top{k}_phi, top{k}_direction" for k in (1, 2, 3)) + " FROM (SELECT entity, period, "
    "sum(phi) AS s, " + ", ".join(
        f"max(CASE WHEN rn = {k} THEN feature END) AS top{k}_feature, max(CASE WHEN rn = {k} THEN phi END) AS "
        f"top{k}_phi, max(CASE WHEN rn = {k} THEN CASE WHEN phi > 0 THEN 'increases' ELSE 'decreases' END END) "
        f"AS top{k}_direction" for k in (1, 2, 3)) +
    " FROM (SELECT *, row_number() OVER (PARTITION BY entity, period ORDER BY abs(phi) DESC, feature) AS rn "
    "FROM phi) GROUP BY entity, period) CROSS JOIN base", FEATURES, *_XSQL, _PHI_SQL, _BASE_SQL),
    "entity, period, top1_feature, top2_feature, top3_feature, top1_direction, top2_direction, top3_direction"))
def x4_explain_rows(spark, d):
    phi, bg = _phi(spark, d)
    return finish(XP.explain_rows(phi, ["entity", "period"], XP.polynomial_base(SCORER, bg)))


@query("r3_score")
def r3_score(spark, d):
    """Score every entity's latest row with the fitted ridge: fallback chain for the inputs,
    predicted log volatility, its level (exp, without removing the offset), level class, risk list."""
    from cadence.operators import rules as RL
    mf, fit = _ridge(spark, d)
    feats = featured(spark, d)
    inputs = RL.fallback_features(feats, SPEC)
    scored = inputs.withColumn("predicted_log_volatility", fit.prediction()) \
        .withColumn("predicted_volatility", F.exp("predicted_log_volatility"))
    scored = RL.volatility_level(scored, "predicted_volatility")
    latest = RL.latest(feats.select("entity", "period", "cdi_smooth", "inflation", "investment", "governance_index"),
                       SPEC)
    flags = RL.risk_flags(latest).select("entity", "risk_factors")
    return finish(scored.join(flags, "entity").select("entity", "period", *MODEL_FEATURES, "predicted_log_volatility",
                                                       "predicted_volatility", "volatility_level", "risk_factors"))


@query("r3_growth")
def r3_growth(spark, d):
    """Score every entity's latest row with the fitted growth forecaster: fallback chain for the inputs, forecast of
    the next period, its outlook class and its difference from the entity's own history (R2, R3, R6, R7)."""
    from cadence.operators import rules as RL
    fc, _, _ = _forecast(spark, d, "ridge")
    feats = featured(spark, d)
    scored = fc.predict(RL.fallback_current(feats, SPEC, fc.features), "forecast")
    return finish(RL.versus_history(RL.outlook(scored, "forecast"), feats, SPEC, "forecast"))
