"""Model persistence (S11): fitted models plus a one-row JSON of metadata.

Spark ML models use their own writers; the sufficient-statistics ridge is a
handful of numbers, stored as one JSON row.  Everything is written with
Spark to the given (shared) path, so any executor or a later job can load it.
"""

from __future__ import annotations

import json

from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import SparkSession

from cadence.operators.boost import BoostFit
from cadence.operators.forecast import Forecaster
from cadence.operators.linear import RidgeFit


def _write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(path)


def _read_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_ridge(spark: SparkSession, fit: RidgeFit, path: str) -> None:
    _write_meta(spark, f"{path}/meta", {"kind": "ridge", "features": fit.features, "target": fit.target,
                                        "mu": fit.mu, "sd": fit.sd, "alpha": fit.alpha, "coef": fit.coef,
                                        "intercept": fit.intercept, "cv_r2": fit.cv_r2, "n": fit.n})


def load_ridge(spark: SparkSession, path: str) -> RidgeFit:
    m = _read_meta(spark, f"{path}/meta")
    return RidgeFit(m["features"], m["target"], m["mu"], m["sd"], m["alpha"], m["coef"], m["intercept"],
                    m.get("cv_r2", []), [], m.get("n", 0))


def save_boost(spark: SparkSession, fit: BoostFit, path: str) -> None:
    """The best model of a boosting fit, its parameters, features and target."""
    fit.model.write().overwrite().save(f"{path}/trees")
    _write_meta(spark, f"{path}/meta", {"kind": "boost", "features": fit.features, "target": fit.target, "best": fit.best})


def load_boost(spark: SparkSession, path: str) -> BoostFit:
    m = _read_meta(spark, f"{path}/meta")
    return BoostFit(m["features"], m["target"], None, [m["best"]], GBTRegressionModel.load(f"{path}/trees"))


def save_forecaster(spark: SparkSession, fc: Forecaster, path: str) -> None:
    meta = {"kind": "forecaster", "model_type": fc.model_type, "features": fc.features, "mu": fc.mu, "sd": fc.sd,
            "cv_r2": fc.cv_r2}
    if fc.model_type == "ridge":
        save_ridge(spark, fc.ridge, f"{path}/ridge")
    else:
        fc.tree_model.write().overwrite().save(f"{path}/trees")
    _write_meta(spark, f"{path}/meta", meta)


def load_forecaster(spark: SparkSession, path: str) -> Forecaster:
    m = _read_meta(spark, f"{path}/meta")
    fc = Forecaster(m["model_type"], m["features"], m["mu"], m["sd"], cv_r2=m.get("cv_r2", []))
    if fc.model_type == "ridge":
        fc.ridge = load_ridge(spark, f"{path}/ridge")
    else:
        loader = GBTRegressionModel if fc.model_type == "gbr" else RandomForestRegressionModel
        fc.tree_model = loader.load(f"{path}/trees")
    return fc
