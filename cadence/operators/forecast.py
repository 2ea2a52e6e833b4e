"""One-step-ahead forecaster.

Features at period t predict the target at t+1 (a ``lead`` over the entity
window).  ``model_type`` is ``ridge`` (sufficient-statistics ridge), ``gbr``
(``GBTRegressor``) or ``rf`` (``RandomForestRegressor``).  Cross-validation
uses expanding time-series folds cut on the global (entity, period) order,
as the reference does.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators import boost as BO
from cadence.operators import evaluate as EV
from cadence.operators import features as FT
from cadence.operators import linear as LN
from cadence.operators import split as SP
from cadence.operators import trees as TR
from cadence.session import materialize
from cadence.spec import PanelSpec, present

FORECAST_FEATURES = ("cdi_smooth", "inflation", "trade_openness", "investment", "governance_index",
                     "exchange_rate_volatility", "gdp_growth")
TARGET = "gdp_growth_next"


def prepare(df: DataFrame, spec: PanelSpec, target_col: str = "gdp_growth",
            features: Sequence[str] = FORECAST_FEATURES) -> tuple[DataFrame, list[str]]:
    """M13 input (F10): next-period target; rows missing the target or a feature dropped."""
    feats = present(df, features)
    out = FT.add_lead(df, spec, target_col, TARGET).select(spec.entity, spec.period, *feats, TARGET)
    return out.na.drop("any", subset=[TARGET]).na.drop("any", subset=feats), feats


@dataclass
class Forecaster:
    model_type: str
    features: list[str]
    mu: list[float] = field(default_factory=list)
    sd: list[float] = field(default_factory=list)
    ridge: LN.RidgeFit | None = None
    tree_model: object = None
    cv_r2: list[float] = field(default_factory=list)

    def scaled(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[X.standardize(c, self.mu[j], self.sd[j]).alias(f"{c}__z")
                                for j, c in enumerate(self.features)])

    def zcols(self) -> list[str]:
        return [f"{c}__z" for c in self.features]

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        s = self.scaled(df)
        if self.model_type == "ridge":
            return s.withColumn(out, self.ridge.prediction()).drop(*self.zcols())
        scored = self.tree_model.transform(BO.assembler(self.zcols()).transform(s))
        return scored.withColumnRenamed("prediction", out).drop("features", *self.zcols())

    def importance(self, spark) -> DataFrame:
        if self.model_type == "ridge":
            return BO.importance(spark, self.features, [abs(c) for c in self.ridge.coef])
        return BO.importance(spark, self.features, self.tree_model.featureImportances.toArray())


def _tree_estimator(model_type: str, seed: int, n_trees: int):
    if model_type == "gbr":
        return GBTRegressor(featuresCol="features", labelCol="label", maxIter=n_trees, maxDepth=4, stepSize=0.1,
                            subsamplingRate=0.8, seed=seed, checkpointInterval=10)
    if model_type == "rf":
        return RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=n_trees, maxDepth=10,
                                     seed=seed)
    raise ValueError(f"unknown model type {model_type!r}")


def _fit_once(train: DataFrame, model_type: str, zcols: list[str], seed: int, n_trees: int):
    data = BO.assembler(zcols).transform(train).select("features", F.col(TARGET).cast("double").alias("label"))
    return _tree_estimator(model_type, seed, n_trees).fit(data)


def fit(train: DataFrame, spec: PanelSpec, features: Sequence[str], model_type: str = "rf",
        cv_folds: int = 5, seed: int = 42, n_trees: int = 200, scale: bool = True,
        parallelism: int = 4) -> Forecaster:
    """M13 fit + M16 CV scores (expanding time-series folds over the training rows)."""
    feats = list(features)
    if scale:
        st = X.one_row(train.agg(*[F.avg(c).alias(f"m{j}") for j, c in enumerate(feats)],
                                 *[F.stddev_pop(c).alias(f"s{j}") for j, c in enumerate(feats)]))
        mu, sd = [st[f"m{j}"] for j in range(len(feats))], [st[f"s{j}"] for j in range(len(feats))]
    else:
        mu, sd = [0.0] * len(feats), [1.0] * len(feats)
    fc = Forecaster(model_type, feats, mu, sd)
    numbered, n = SP.ordinal_and_count(train, spec)
    if model_type == "ridge":
        fc.ridge, fc.cv_r2 = LN.expanding_ridge(fc.scaled(numbered), fc.zcols(), TARGET, n, cv_folds)
        return fc
    s = materialize(fc.scaled(numbered))
    fc.tree_model = _fit_once(s, model_type, fc.zcols(), seed, n_trees)

    # expanding window: fold i tests block i and trains on every row before it; the fold fits are independent
    # jobs and are submitted concurrently.
    def score(block):
        lo, hi = block
        tr, te = s.filter(F.col("ordinal") < lo), s.filter((F.col("ordinal") >= lo) & (F.col("ordinal") < hi))
        m = _fit_once(tr, model_type, fc.zcols(), seed, n_trees)
        pred = m.transform(BO.assembler(fc.zcols()).transform(te)).withColumnRenamed("prediction", "yhat")
        r = EV.metrics(pred.select(F.lit("cv").alias("model"), F.col(TARGET).alias("y"), "yhat")).first()
        return r["r2"] if r is not None and r["r2"] is not None else float("nan")

    starts = SP.ts_fold_starts(n, cv_folds)
    with ThreadPoolExecutor(max_workers=min(parallelism, cv_folds)) as pool:
        fc.cv_r2 = list(pool.map(score, zip(starts, starts[1:])))
    return fc


def evaluate(fc: Forecaster, test: DataFrame, spark) -> DataFrame:
    """Test r2 / rmse / mae plus CV mean and std."""
    pred = fc.predict(test, "yhat").select(F.lit(fc.model_type).alias("model"), F.col(TARGET).alias("y"), "yhat")
    m = EV.metrics(pred)
    arr = np.array([v for v in fc.cv_r2 if v == v])
    return m.select("model", "n", "r2", "rmse", "mae",
                    F.lit(float(arr.mean()) if arr.size else None).cast("double").alias("mean_cv_r2"),
                    F.lit(float(arr.std()) if arr.size else None).cast("double").alias("std_cv_r2"))


def ensemble_interval(fc: Forecaster, df: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Prediction +- z x population std of the ensemble's member predictions.

    Random forest: per-tree predictions; boosting: the staged (cumulative)
    predictions, as the reference does; ridge: NULL bounds.  All trees are scored in one pass over
    the rows (``trees``); rows with a null feature have no prediction.
    """
    if fc.model_type == "ridge":
        return fc.predict(df).withColumn("lower", X.null_double()).withColumn("upper", X.null_double())
    flat = TR.flatten(df.sparkSession, fc.tree_model, len(fc.features))
    z = F.lit(EV.z_value(confidence))
    out = TR.member_spread(df, [X.standardize(c, fc.mu[j], fc.sd[j]) for j, c in enumerate(fc.features)], flat, fc.model_type == "gbr")
    return (out.withColumn("lower", F.col("prediction") - z * F.col("__std"))
            .withColumn("upper", F.col("prediction") + z * F.col("__std")).drop("__std"))
