"""Exact Shapley values.

* ``shapley_polynomial``: f is a polynomial (sum of coefficient x product of features) and the value of a coalition S for
  row x is the mean of f(x_S, b_rest) over all background rows b.  That needs only means of products of
  background columns (``background_moments``: one aggregate over all training rows), so phi is a column expression per row.
* ``shapley_linear``: the closed form coef_j (x_j - mean_b x_j) (X2).
* ``shapley_trees``: fitted forests and boosters, path dependent (``trees``): no background, one narrow pass.
"""

from __future__ import annotations

import itertools
import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators import trees as TR

Moments = dict[tuple[int, ...], float]


def background_moments(df: DataFrame, columns: Sequence[Column], products: Sequence[Sequence[int]] = ()) -> Moments:
    """Means over all rows of ``df`` of every column and of every product of columns that is named (and of its sub-products)."""
    wanted = {(j,) for j in range(len(columns))}
    for p in products:
        wanted |= {s for r in range(1, len(set(p)) + 1) for s in itertools.combinations(sorted(set(p)), r)}
    order = sorted(wanted)
    means = []
    for k, idx in enumerate(order):
        e = F.lit(1.0)
        for j in idx:
            e = e * columns[j].cast("double")
        means.append(F.avg(e).alias(f"m{k}"))
    row = df.agg(*means).first()  # one number per product
    return {(): 1.0} | {idx: row[f"m{k}"] for k, idx in enumerate(order)}


def sample_moments(rows: Sequence[Sequence[float]]) -> Moments:
    """The same of a few rows at hand."""
    n = len(rows[0])
    return {idx: sum(math.prod(r[j] for j in idx) for r in rows) / len(rows) for k in range(n + 1) for idx in itertools.combinations(range(n), k)}


def _long(df: DataFrame, keys: Sequence[str], features: Sequence[str], phis: Sequence[Column]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), p.alias("phi")) for f, p in zip(features, phis)])
    return df.select(*keys, F.explode(arr).alias("s")).select(*keys, "s.feature", "s.phi")


def shapley_polynomial(df: DataFrame, keys: Sequence[str], features: Sequence[str],
                       terms: Sequence[tuple[float, tuple[int, ...]]], moments: Moments) -> DataFrame:
    """X1 for polynomial scorers: exact phi per (row, feature) from background moments."""
    x = [F.col(c).cast("double") for c in features]
    phis = [F.lit(0.0) for _ in features]
    for coef, var in terms:
        t = tuple(sorted(set(var)))
        for i in t:
            rest = [j for j in t if j != i]
            contrib = F.lit(0.0)
            for r in range(len(rest) + 1):
                w = math.factorial(r) * math.factorial(len(t) - r - 1) / math.factorial(len(t))
                for s in itertools.combinations(rest, r):
                    with_i = sorted(s + (i,))
                    prod_s = F.lit(1.0)
                    for j in s:
                        prod_s = prod_s * x[j]
                    gain = (prod_s * x[i] * F.lit(moments[tuple(j for j in t if j not in with_i)])
                            - prod_s * F.lit(moments[tuple(j for j in t if j not in s)]))
                    contrib = contrib + F.lit(w) * gain
            phis[i] = phis[i] + F.lit(coef) * contrib
    return _long(df, keys, features, phis)


def polynomial_value(features: Sequence[str], terms) -> Column:
    e = F.lit(0.0)
    for coef, var in terms:
        p = F.lit(float(coef))
        for j in var:
            p = p * F.col(features[j]).cast("double")
        e = e + p
    return e


def polynomial_base(terms, moments: Moments) -> float:
    return sum(c * moments[tuple(sorted(set(v)))] for c, v in terms)


def shapley_linear(df: DataFrame, keys: Sequence[str], features: Sequence[str], coefs: Sequence[float],
                   moments: Moments, transform: Callable[[int], Column] | None = None) -> DataFrame:
    """phi_j = coef_j (x_j - mean of x_j over the background).

    ``transform(j)`` optionally maps feature j first (e.g. the model's z-score);
    the moments are then those of the transformed columns.
    """
    x = [transform(j) if transform else F.col(c).cast("double") for j, c in enumerate(features)]
    return _long(df, keys, features, [F.lit(float(c)) * (x[j] - F.lit(moments[j,])) for j, c in enumerate(coefs)])


def shapley_trees(df: DataFrame, keys: Sequence[str], features: Sequence[str], explainer: TR.Explainer,
                  transform: Callable[[int], Column] | None = None) -> DataFrame:
    """X1 of a fitted forest or booster: (keys, feature, phi) of every row without null features."""
    x = [transform(j) if transform else F.col(c) for j, c in enumerate(features)]
    phi = TR.shapley(df.select(*keys, *[e.cast("double").alias(c) for e, c in zip(x, features)]), [F.col(c) for c in features], explainer)
    return _long(phi, keys, features, [F.get("phi", F.lit(j)) for j in range(len(features))])


def importance(phi: DataFrame) -> DataFrame:
    """Mean |phi| per feature, share of the total, rank."""
    g = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("shap_importance"))
    total = F.sum("shap_importance").over(Window.partitionBy())  # over one row per feature
    return (g.withColumn("importance_pct", F.col("shap_importance") / F.when(total != 0, total) * 100.0)
            .withColumn("rank", F.row_number().over(Window.orderBy(F.col("shap_importance").desc(), "feature"))))


def explain_rows(phi: DataFrame, keys: Sequence[str], base_value: float, top: int = 3) -> DataFrame:
    """Base value, prediction = base + sum(phi), and the top contributions per row."""
    w = Window.partitionBy(*keys).orderBy(F.abs("phi").desc(), F.col("feature"))
    r = phi.withColumn("__rn", F.row_number().over(w))
    aggs = [F.sum("phi").alias("__sum")]
    for k in range(1, top + 1):
        aggs += [F.max(F.when(F.col("__rn") == k, F.col("feature"))).alias(f"top{k}_feature"),
                 F.max(F.when(F.col("__rn") == k, F.col("phi"))).alias(f"top{k}_phi"),
                 F.max(F.when(F.col("__rn") == k, F.when(F.col("phi") > 0, "increases").otherwise("decreases")))
                 .alias(f"top{k}_direction")]
    g = r.groupBy(*keys).agg(*aggs)
    return g.select(*keys, F.lit(float(base_value)).alias("base_value"),
                    (F.lit(float(base_value)) + F.col("__sum")).alias("prediction"),
                    *[c for k in range(1, top + 1) for c in (f"top{k}_feature", f"top{k}_phi", f"top{k}_direction")])


def report(phi: DataFrame, keys: Sequence[str], base_value: float, top: int = 3) -> DataFrame:
    """What an explanation run hands over, as rows of one table: ``part`` 'value' (every contribution), 'importance'
    (mean size and share per feature) and 'driver' (the ``top`` contributions of every row, with base value and prediction)."""
    phi = phi.select(*keys, "feature", "phi")
    none = {"value": "double", "pct": "double", "rank": "int", "direction": "string", "base_value": "double", "prediction": "double"}
    cols = ["part", *keys, "feature", *none]

    def part(name: str, df: DataFrame) -> DataFrame:
        for k in keys:
            if k not in df.columns:
                df = df.withColumn(k, F.lit(None).cast(phi.schema[k].dataType))
        for c, t in none.items():
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast(t))
        return df.withColumn("part", F.lit(name)).select(*cols)

    imp = importance(phi).select("feature", F.col("shap_importance").alias("value"), F.col("importance_pct").alias("pct"), "rank")
    w = Window.partitionBy(*keys).orderBy(F.abs("phi").desc(), "feature")
    ranked = (phi.withColumn("rank", F.row_number().over(w).cast("int")).withColumn("base_value", F.lit(float(base_value)))
              .withColumn("prediction", F.lit(float(base_value)) + F.sum("phi").over(Window.partitionBy(*keys)))
              .withColumn("direction", F.when(F.col("phi") > 0, "increases").otherwise("decreases")))
    return (part("value", phi.withColumnRenamed("phi", "value")).unionByName(part("importance", imp))
            .unionByName(part("driver", ranked.where(F.col("rank") <= top).withColumnRenamed("phi", "value"))))
