"""Ridge regression from per-fold sufficient statistics (M4-M8).

One pass over the data: ``groupBy(fold)`` sums of [1, z_1..z_p] outer products
and their products with y (plain sums, combined map-side).  Everything else -
the 50-alpha x k-fold search, the final fit, the cross-validated R2 - is
arithmetic on k small matrices on the driver (p x p, p <= 7), and prediction is
a column expression.  Features are z-scored with population statistics of
all rows before the folds are cut, as the reference does (fit-then-transform).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.functions.linalg import gram_sums
from cadence.functions.stats import gram_unpack
from cadence.operators import split as SP

ALPHAS = tuple(float(a) for a in np.logspace(-2, 3, 50))


@dataclass
class RidgeFit:
    features: list[str]
    target: str
    mu: list[float]
    sd: list[float]
    alpha: float
    coef: list[float]
    intercept: float
    cv_r2: list[float] = field(default_factory=list)
    alpha_path: list[tuple[float, float]] = field(default_factory=list)
    n: int = 0

    def z(self, j: int):
        return X.standardize(self.features[j], self.mu[j], self.sd[j]) if self.sd else F.col(self.features[j])

    def prediction(self):
        """Column expression of the fitted value."""
        e = F.lit(self.intercept)
        for j, c in enumerate(self.coef):
            e = e + F.lit(c) * self.z(j)
        return e


def _solve(tot: np.ndarray, tot_y: np.ndarray, n: float, alpha: float):
    """Centered ridge on sums of [1, z] rows: returns (intercept, coef)."""
    m = tot[0, 1:] / n
    my = tot_y[0] / n
    szz = tot[1:, 1:] - n * np.outer(m, m)
    szy = tot_y[1:] - n * m * my
    coef = np.linalg.solve(szz + alpha * np.eye(len(m)), szy)
    return my - m @ coef, coef


def _sse(g: np.ndarray, gy: np.ndarray, yy: float, b0: float, coef: np.ndarray) -> float:
    """Sum of squared errors of (b0, coef) on the rows summarised by (g, gy, yy)."""
    b = np.concatenate([[b0], coef])
    return float(yy - 2.0 * b @ gy + b @ g @ b)


def fold_grams(df: DataFrame, features: Sequence[str], target: str, fold_col: str = "fold",
               scale: bool = True) -> tuple[DataFrame, list[float], list[float]]:
    """Per-fold Gram sums of [1, z_1..z_p] and y (the one distributed pass)."""
    if scale:
        st = X.one_row(df.agg(*[F.avg(c).alias(f"m{j}") for j, c in enumerate(features)],
                              *[F.stddev_pop(c).alias(f"s{j}") for j, c in enumerate(features)]))
        mu = [st[f"m{j}"] for j in range(len(features))]
        sd = [st[f"s{j}"] for j in range(len(features))]
        regs = [F.lit(1.0)] + [X.standardize(c, mu[j], sd[j]) for j, c in enumerate(features)]
    else:
        mu, sd = [], []
        regs = [F.lit(1.0)] + [F.col(c).cast("double") for c in features]
    return gram_sums(df, [fold_col], regs, F.col(target).cast("double")), mu, sd


def fit_ridge(df: DataFrame, features: Sequence[str], target: str, fold_col: str = "fold",
              alphas: Sequence[float] = ALPHAS, scale: bool = True) -> RidgeFit:
    """M4/M5: alpha by k-fold mean squared error, final fit on all rows, CV R2 at the best alpha."""
    features = list(features)
    grams, mu, sd = fold_grams(df, features, target, fold_col, scale)
    got = grams.collect()  # one row per fold: k small matrices
    got.sort(key=lambda r: r[fold_col])
    return ridge_of_grams([gram_unpack(r.asDict(), len(features) + 1) for r in got], features, target, mu, sd, alphas)


def ridge_of_grams(folds: Sequence[tuple], features: list[str], target: str, mu: list[float], sd: list[float],
                   alphas: Sequence[float] = ALPHAS) -> RidgeFit:
    """The search and the final fit from (X'X, X'y, y'y, n) of each fold."""
    tot = sum(f[0] for f in folds)
    tot_y = sum(f[1] for f in folds)
    n_all = sum(f[3] for f in folds)
    path = []
    for a in alphas:
        mses = []
        for g, gy, yy, n in folds:
            b0, coef = _solve(tot - g, tot_y - gy, n_all - n, a)
            mses.append(_sse(g, gy, yy, b0, coef) / n)
        path.append((float(a), float(np.mean(mses))))
    best = min(range(len(path)), key=lambda i: (path[i][1], i))
    alpha = path[best][0]
    cv_r2 = []
    for g, gy, yy, n in folds:
        b0, coef = _solve(tot - g, tot_y - gy, n_all - n, alpha)
        sst = yy - gy[0] ** 2 / n
        cv_r2.append(1.0 - _sse(g, gy, yy, b0, coef) / sst if sst > 0 else 0.0)
    b0, coef = _solve(tot, tot_y, n_all, alpha)
    return RidgeFit(features, target, mu, sd, alpha, [float(c) for c in coef], float(b0), cv_r2, path, n_all)


def expanding_ridge(df: DataFrame, features: Sequence[str], target: str, n: int, k: int = 5,
                    ordinal: str = "ordinal") -> tuple[RidgeFit, list[float]]:
    """M4 and M16 in one pass: the ridge on all ``n`` rows and its R2 on each of ``k`` expanding time-series folds.

    The rows before each test block are cut into that block's own folds.  All these cuts are known from ``n``, so one aggregate
    sums the Gram matrices between neighbouring cuts (at most k x k + 3 k segments), and every training set, fold and test
    block is a run of segments.  ``features`` are used as they are (scaled before)."""
    features, tests = list(features), SP.ts_fold_starts(n, k)
    wanted = [SP.kfold_starts(n, k)] + [SP.kfold_starts(t, k) for t in tests[:-1]]
    cuts = sorted({c for w in wanted for c in w} | set(tests))
    segment = X.sum_of([(F.col(ordinal) >= c).cast("int") for c in cuts])
    p = len(features) + 1
    grams, _, _ = fold_grams(df.withColumn("__segment", segment), features, target, "__segment", False)
    sums = {cuts[r["__segment"] - 1]: gram_unpack(r.asDict(), p) for r in grams.collect()}

    def between(lo: int, hi: int) -> tuple:
        own = [sums[c] for c in cuts if lo <= c < hi and c in sums]
        return tuple(sum(s[j] for s in own) for j in range(4)) if own else (np.zeros((p, p)), np.zeros(p), 0.0, 0)

    def fit(starts: list[int]) -> RidgeFit:
        folds = [between(lo, hi) for lo, hi in zip(starts, starts[1:])]
        return ridge_of_grams([f for f in folds if f[3]], features, target, [], [])

    scores = []
    for lo, hi, starts in zip(tests, tests[1:], wanted[1:]):
        g, gy, yy, rows = between(lo, hi)
        if rows < 2 or between(0, lo)[3] < 2:
            scores.append(float("nan"))
            continue
        m = fit(starts)
        sse, sst = _sse(g, gy, yy, m.intercept, np.array(m.coef)), yy - gy[0] ** 2 / rows
        scores.append(1.0 - sse / sst if sst > 1e-12 * yy else float(sse <= 1e-12 * yy))
    return fit(wanted[0]), scores


def predict(df: DataFrame, fit: RidgeFit, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, fit.prediction())


def coefficients(spark, fit: RidgeFit) -> DataFrame:
    """M6/M7/M8: coefficient, |coefficient|, normalised importance and direction per feature."""
    total = sum(abs(c) for c in fit.coef) or 1.0
    rows = [(f, c, abs(c), abs(c) / total, abs(c) / total * 100.0, "increases" if c > 0 else "decreases")
            for f, c in zip(fit.features, fit.coef)]
    df = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double, "
                                     "importance double, importance_pct double, direction string")
    return df.orderBy(F.col("abs_coefficient").desc())


def cv_scores(spark, fit: RidgeFit) -> DataFrame:
    """M5: per-fold R2 at the chosen alpha, with mean and (population) std."""
    arr = np.array(fit.cv_r2)
    rows = [(i, float(v), float(arr.mean()), float(arr.std()), fit.alpha) for i, v in enumerate(fit.cv_r2)]
    return spark.createDataFrame(rows, "fold int, r2 double, mean_r2 double, std_r2 double, alpha double")
