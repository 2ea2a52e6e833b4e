"""End-to-end runs (L1-L3): compositions of the operators with Parquet hand-off.

Stage outputs are written under the session's shared checkpoint folder and
read back by the next stage (the disk hand-off of the reference's scripts),
each stage timed; a failing stage stops the run and is reported.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from cadence.operators import cluster as CU
from cadence.operators import features as FT
from cadence.operators import pca as PC
from cadence.operators import select as SL
from cadence.operators import summary as SM
from cadence.sources import files as FS
from cadence.spec import PanelSpec

CLEAN_KEYS = ("gdp_growth", "inflation", "trade_openness", "investment", "cdi_raw")
SUMMARY_VARS = ("cdi_smooth", "gdp_growth", "log_gdp_volatility", "inflation", "investment")


def clean_stage(ingested: DataFrame) -> DataFrame:
    """L3 (clean): drop rows whose key indicators are all missing."""
    return SL.drop_all(ingested, CLEAN_KEYS)


def feature_stage(clean: DataFrame, spec: PanelSpec) -> DataFrame:
    """L3 (features): smoothed CDI, volatility and its log, four lags, rows with a target."""
    out = FT.rolling_mean(clean, spec, "cdi_raw", "cdi_smooth", 3, 1)
    out = FT.rolling_std(out, spec, "gdp_growth", "gdp_volatility", 5, 3)
    out = FT.log_offset(out)
    out = FT.add_lags(out, spec, FT.LAG_FEATURES_SHORT)
    return out.na.drop("any", subset=["log_gdp_volatility"])


def staged_run(spark: SparkSession, ingested: DataFrame, spec: PanelSpec) -> tuple[DataFrame, dict[str, DataFrame]]:
    """L2: ingest -> clean -> features -> summary, Parquet between stages.

    Returns the stage log (stage, ok, seconds, rows, error) and the outputs.
    """
    root = FS.scratch_path(spark, "staged-run")
    log, outputs = [], {}
    steps: list[tuple[str, Callable[[], DataFrame]]] = [
        ("ingest", lambda: ingested),
        ("clean", lambda: clean_stage(outputs["ingest"])),
        ("features", lambda: feature_stage(outputs["clean"], spec)),
    ]
    for name, make in steps:
        t0 = time.time()
        try:
            path = FS.write_table(make(), f"{root}/{name}")
            outputs[name] = spark.read.parquet(path)
            rows = outputs[name].count()
            log.append((name, True, time.time() - t0, rows, None))
        except Exception as e:  # noqa: BLE001 - the run reports the failing stage and stops
            log.append((name, False, time.time() - t0, None, f"{type(e).__name__}: {str(e)[:200]}"))
            break
    if "features" in outputs:
        t0 = time.time()
        outputs["summary"] = SM.describe(outputs["features"], SUMMARY_VARS)
        outputs["counts"] = SM.entity_counts(outputs["features"], spec)
        log.append(("summary", True, time.time() - t0, outputs["summary"].count(), None))
    stage_log = spark.createDataFrame(log, "stage string, ok boolean, seconds double, rows long, error string")
    return stage_log, outputs


def findings(spark: SparkSession, features: DataFrame, spec: PanelSpec, ridge_r2: float | None,
             boost_r2: float | None) -> DataFrame:
    """L1 summary: overview, model scores, clustering, PCA and the median split as (finding, value) rows."""
    ov = SM.overview(features, spec).first()
    ent = SM.entity_means(features, spec, SM.CLUSTER_FEATURES, minimum=3)
    lab, fit = CU.fit_kmeans(ent, SM.CLUSTER_FEATURES, 3, 10)
    sil = CU.silhouette_score(lab, fit.zcols)
    _, pf = PC.fit(ent, SM.CLUSTER_FEATURES, 3)
    ms = SM.median_split(features, spec).first()
    rows = [("n_rows", float(ov["n_rows"])), ("n_entities", float(ov["n_entities"])),
            ("first_period", float(ov["first_period"])), ("last_period", float(ov["last_period"])),
            ("ridge_test_r2", ridge_r2), ("boosting_test_r2", boost_r2),
            ("kmeans_silhouette_sq", sil), ("pca_variance_3", float(sum(pf.ratio[:3]))),
            ("median_split_difference", ms["difference"] if ms else None)]
    return spark.createDataFrame(rows, "finding string, value double")
