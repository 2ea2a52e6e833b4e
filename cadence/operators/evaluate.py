"""Evaluation (E1-E4): regression metrics per model, ranking, reports, intervals.

Input is long: one row per (model, observation) with ``y`` and ``yhat``.
Every metric comes out of one ``groupBy(model).agg``, so any number of
models and rows are scored in one pass; the ranked table is as small as the
number of models.
"""

from __future__ import annotations

from statistics import NormalDist
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import exprs as X

EPS = 2.220446049250313e-16  # float64 machine epsilon, the floor of the percentage-error denominator


def z_value(confidence: float) -> float:
    return NormalDist().inv_cdf((1.0 + confidence) / 2.0)


def metrics(long_df: DataFrame, model: str = "model", y: str = "y", yhat: str = "yhat",
            p: int = 1) -> DataFrame:
    """r2, rmse, mae, mape (x100), adj_r2, mean/std (population) residual, max error.

    mape = mean(|e| / max(|y|, eps)) with eps = 2^-52, so a zero target makes a term of |e| * 2^52.
    """
    e = F.col(y) - F.col(yhat)
    ay, ae = F.abs(F.col(y)), F.abs(e)
    g = long_df.groupBy(model).agg(
        F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("ssr"), (F.var_pop(y) * F.count(F.lit(1))).alias("sst"),
        F.avg(ae).alias("mae"),
        F.avg(ae / F.greatest(ay, F.lit(EPS))).alias("mape_r"),
        F.avg(e).alias("mean_residual"), F.stddev_pop(e).alias("std_residual"), F.max(ae).alias("max_error"))
    r2 = (F.when(F.col("n") < 2, X.null_double())
          .when(F.col("sst") == 0, F.when(F.col("ssr") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("ssr") / F.col("sst")))
    adj = F.lit(1.0) - (F.lit(1.0) - F.col("r2")) * X.share(F.col("n") - 1, F.col("n") - p - 1)
    return (g.withColumn("r2", r2)
            .select(model, "n", "r2", F.sqrt(F.col("ssr") / F.col("n")).alias("rmse"), "mae",
                    (F.col("mape_r") * 100.0).alias("mape"), adj.alias("adj_r2"), "mean_residual",
                    "std_residual", "max_error"))


def compare(metrics_df: DataFrame, metric: str = "r2", model: str = "model") -> DataFrame:
    """Sort by the metric (r2 high first, error metrics low first) and rank.

    The table has one row per model, so the unpartitioned window is tiny.
    """
    order = F.col(metric).desc_nulls_last() if metric in ("r2", "adj_r2") else F.col(metric).asc_nulls_last()
    return metrics_df.withColumn("rank", F.row_number().over(Window.orderBy(order, F.col(model))))


def report(long_df: DataFrame, metric: str = "r2", model: str = "model") -> DataFrame:
    """Ranked metrics with a flag on the best model."""
    ranked = compare(metrics(long_df, model), metric, model)
    return ranked.withColumn("best", F.col("rank") == 1)


def stack_predictions(df: DataFrame, keys: Sequence[str], y: str, preds: Sequence[str]) -> DataFrame:
    """Wide (keys, y, pred_a, pred_b, ...) -> long (keys, model, y, yhat)."""
    return df.unpivot([*keys, y], list(preds), "model", "yhat").withColumnRenamed(y, "y")


def prediction_interval(df: DataFrame, pred: str, residual: str, confidence: float = 0.95,
                        by: str | None = None) -> DataFrame:
    """Pred +- z * population std of the residuals (per group when ``by``)."""
    z = z_value(confidence)
    if by:
        sd = df.groupBy(by).agg(F.stddev_pop(residual).alias("__sd"))
        j = df.join(sd, by, "left")
    else:
        j = df.withColumn("__sd", X.lit_d(X.one_row(df.agg(F.stddev_pop(residual).alias("s")))["s"]))
    m = F.lit(z) * F.col("__sd")
    return j.withColumn("lower", F.col(pred) - m).withColumn("upper", F.col(pred) + m).drop("__sd")
