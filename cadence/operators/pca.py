"""Principal components of the entity-level table.

One aggregate of pairwise products of the z-scored features gives the p x p
covariance (sample, n - 1); the eigen-decomposition of that small matrix runs
on the driver, and scores are column expressions (a projection per row).
Component signs are fixed so the largest absolute loading is positive.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators.cluster import scaled
from cadence.spec import present

# Theme words of each feature in component interpretations.
THEMES = {"cdi_smooth": "commodity dependence", "cdi_raw": "commodity dependence",
          "gdp_volatility": "economic instability", "log_gdp_volatility": "economic instability",
          "governance_index": "governance quality", "inflation": "price stability",
          "investment": "capital formation", "trade_openness": "trade integration"}
LOADING_THRESHOLD = 0.3


def covariance(ent_z: DataFrame, zcols: Sequence[str], names: Sequence[str]) -> DataFrame:
    """U13 (distributed part): sample covariance of every feature pair, long form."""
    aggs = [F.covar_samp(a, b).alias(f"c_{i}_{j}") for i, a in enumerate(zcols) for j, b in enumerate(zcols) if j >= i]
    wide = ent_z.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(names[i]).alias("feature_i"), F.lit(names[j]).alias("feature_j"),
                              F.col(f"c_{i}_{j}").alias("covariance"))
                     for i in range(len(zcols)) for j in range(len(zcols)) if j >= i])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


@dataclass
class PCAFit:
    features: list[str]
    zcols: list[str]
    eigenvalues: list[float]
    components: list[list[float]]  # components[c][j] = loading of feature j on component c

    @property
    def ratio(self) -> list[float]:
        tot = sum(self.eigenvalues)
        return [v / tot if tot else float("nan") for v in self.eigenvalues]


def fit(ent: DataFrame, features: Sequence[str], n_components: int = 3, minimum: int = 2) -> tuple[DataFrame, PCAFit]:
    """Scaled features -> covariance -> eigenvectors -> per-entity scores PC1..PCk."""
    feats = present(ent, features)
    if len(feats) < minimum:
        raise ValueError(f"PCA needs at least {minimum} features, found {feats}")
    z, zcols = scaled(ent, feats)
    cov_rows = covariance(z, zcols, feats).collect()  # p (p + 1) / 2 numbers
    p = len(feats)
    idx = {f: i for i, f in enumerate(feats)}
    c = np.zeros((p, p))
    for r in cov_rows:
        c[idx[r["feature_i"]], idx[r["feature_j"]]] = c[idx[r["feature_j"]], idx[r["feature_i"]]] = r["covariance"] or 0.0
    vals, vecs = np.linalg.eigh(c)
    order = np.argsort(-vals)
    vals, vecs = vals[order], vecs[:, order]
    comps = []
    for k in range(p):
        v = vecs[:, k]
        if v[np.argmax(np.abs(v))] < 0:
            v = -v
        comps.append([float(x) for x in v])
    pf = PCAFit(feats, zcols, [float(max(v, 0.0)) for v in vals], comps)
    k = min(n_components, p)
    scores = [X.sum_of([F.col(zc) * F.lit(comps[i][j]) for j, zc in enumerate(zcols)]).alias(f"PC{i + 1}")
              for i in range(k)]
    return z.select("*", *scores), pf


def scree(spark, pf: PCAFit) -> DataFrame:
    """Explained variance ratio and cumulative ratio of every component."""
    ratio = pf.ratio
    cum = np.cumsum(ratio)
    return spark.createDataFrame([(f"PC{i + 1}", i + 1, float(pf.eigenvalues[i]), float(ratio[i]), float(cum[i]))
                                  for i in range(len(ratio))],
                                 "component string, component_no int, eigenvalue double, variance_ratio double, "
                                 "cumulative_ratio double")


def loadings(spark, pf: PCAFit, n_components: int = 3) -> DataFrame:
    """(feature, component, loading) long form."""
    rows = [(f, f"PC{c + 1}", c + 1, pf.components[c][j]) for c in range(min(n_components, len(pf.features)))
            for j, f in enumerate(pf.features)]
    return spark.createDataFrame(rows, "feature string, component string, component_no int, loading double")


def interpret(load: DataFrame, ratio_df: DataFrame, threshold: float = LOADING_THRESHOLD) -> DataFrame:
    """Per component the two largest positive / negative loadings (listed when beyond
    the threshold), and a theme sentence from the two largest absolute loadings."""
    themes = load.sparkSession.createDataFrame(list(THEMES.items()), "feature string, theme string")
    w_pos = Window.partitionBy("component").orderBy(F.col("loading").desc(), "feature")
    w_neg = Window.partitionBy("component").orderBy(F.col("loading").asc(), "feature")
    w_abs = Window.partitionBy("component").orderBy(F.abs("loading").desc(), "feature")
    t = (load.join(F.broadcast(themes), "feature", "left")  # fixed 8-row dimension
         .withColumn("rp", F.row_number().over(w_pos)).withColumn("rn", F.row_number().over(w_neg))
         .withColumn("ra", F.row_number().over(w_abs)))
    phrase = F.when(F.col("theme").isNotNull(), F.concat(F.when(F.col("loading") > 0, "high").otherwise("low"),
                                                        F.lit(" "), F.col("theme")))
    g = t.groupBy("component", "component_no").agg(
        F.array_sort(F.collect_list(F.when((F.col("rp") <= 2) & (F.col("loading") > threshold), F.col("feature"))))
        .alias("positive_features"),
        F.array_sort(F.collect_list(F.when((F.col("rn") <= 2) & (F.col("loading") < -threshold), F.col("feature"))))
        .alias("negative_features"),
        F.max(F.when(F.col("ra") == 1, phrase)).alias("__p1"), F.max(F.when(F.col("ra") == 2, phrase)).alias("__p2"),
        F.max(F.when(F.col("feature") == "cdi_smooth", F.signum("loading"))).alias("__s_cdi"),
        F.max(F.when(F.col("feature") == "governance_index", F.signum("loading"))).alias("__s_gov"))
    parts = F.array_compact(F.array("__p1", "__p2"))
    text = F.when(F.size(parts) > 0, F.concat(F.lit("This component captures "), F.array_join(parts, " and "))) \
        .otherwise(F.lit("Mixed characteristics"))
    return (g.join(ratio_df.select("component", "variance_ratio"), "component")
            .select("component", "component_no", "variance_ratio", "positive_features", "negative_features",
                    text.alias("interpretation"),
                    (F.col("__s_cdi") != F.col("__s_gov")).alias("cdi_governance_opposed")))
