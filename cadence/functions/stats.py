"""Small numeric kernels applied to aggregated rows (one row per group).

Nothing here sees raw data: Spark reduces each group to sufficient
statistics (counts, sums, Gram matrices, autocovariance sums) first, and these
functions finish the job on those few numbers inside a ``mapInPandas`` task.
Only numpy and the standard library are used.
"""

from __future__ import annotations

import math

import numpy as np


# ---------------------------------------------------------------- distributions
def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularized incomplete beta (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or not np.isfinite(df) or df <= 0 or (isinstance(t, float) and math.isnan(t)):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


# ---------------------------------------------------------------- ADF tables
# MacKinnon (1994) response-surface coefficients for the p-value
# of the unit-root t statistic with a constant and one variable (N = 1), and
# MacKinnon (2010) finite-sample critical-value coefficients (1 %, 5 %, 10 %).
ADF_TAU_MAX_C = 2.74
ADF_TAU_MIN_C = -18.83
ADF_TAU_STAR_C = -1.61
ADF_SMALLP_C = (2.1659, 1.4412, 0.038269)
ADF_LARGEP_C = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRIT_C = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def adf_pvalue(stat: float) -> float:
    """MacKinnon approximate p-value of an ADF statistic (constant, N = 1)."""
    if stat is None or math.isnan(stat):
        return float("nan")
    if stat > ADF_TAU_MAX_C:
        return 1.0
    if stat < ADF_TAU_MIN_C:
        return 0.0
    coef = ADF_SMALLP_C if stat <= ADF_TAU_STAR_C else ADF_LARGEP_C
    return norm_cdf(sum(c * stat ** i for i, c in enumerate(coef)))


def adf_critical(nobs: int) -> dict[str, float]:
    return {k: sum(c / nobs ** i for i, c in enumerate(v)) for k, v in ADF_CRIT_C.items()}


def adf_maxlag(n: int) -> int:
    """Default lag bound: ceil(12 (n/100)^(1/4)), capped at n//2 - 2 (constant term)."""
    return max(0, min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25))))


# ---------------------------------------------------------------- least squares
def ols_from_gram(xtx: np.ndarray, xty: np.ndarray, yty: float, n: int, ridge: float = 0.0):
    """Solve (X'X + ridge I) b = X'y; return b, ssr, standard errors, t values, llf, aic.

    ``ridge`` is not applied to position 0 when that is the intercept (callers
    pass the intercept first and ridge only for penalised fits).
    """
    k = len(xty)
    a = xtx + ridge * np.eye(k)
    try:
        b = np.linalg.solve(a, xty)
    except np.linalg.LinAlgError:
        b = np.linalg.lstsq(a, xty, rcond=None)[0]
    ssr = float(max(yty - 2.0 * b @ xty + b @ xtx @ b, 0.0))
    dof = n - k
    if dof > 0 and ssr > 0:
        try:
            cov = np.linalg.inv(xtx) * (ssr / dof)
            se = np.sqrt(np.maximum(np.diag(cov), 0.0))
        except np.linalg.LinAlgError:
            se = np.full(k, np.nan)
    else:
        se = np.full(k, np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        tv = b / se
    llf = -0.5 * n * (math.log(2.0 * math.pi) + math.log(ssr / n) + 1.0) if ssr > 0 and n > 0 else float("nan")
    aic = -2.0 * llf + 2.0 * k
    return b, ssr, se, tv, llf, aic


def solve_many(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Solutions of many equal-sized systems a (n, k, k), y (n, k); singular ones by least squares."""
    out, single = np.empty_like(y), np.linalg.slogdet(a)[0] == 0
    if not single.all():
        try:
            out[~single] = np.linalg.solve(a[~single], y[~single][..., None])[..., 0]
        except np.linalg.LinAlgError:
            single[:] = True
    for i in np.flatnonzero(single):
        try:
            out[i] = np.linalg.solve(a[i], y[i])
        except np.linalg.LinAlgError:
            out[i] = np.linalg.lstsq(a[i], y[i], rcond=None)[0]
    return out


def ols_many(xtx: np.ndarray, xty: np.ndarray, yty: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and sums of squared residuals of many regressions with as many regressors each."""
    if not xtx.shape[-1]:
        return xty, yty
    b = solve_many(xtx, xty)
    row, col = b[:, None, :], xty[..., None]
    ssr = yty - (2.0 * row @ col)[:, 0, 0] + (row @ xtx @ b[..., None])[:, 0, 0]
    return b, np.where(ssr < 0.0, 0.0, ssr)


def log_likelihood(ssr: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of many regressions with positive sums of squared residuals."""
    return np.array([-0.5 * m * (math.log(2 * math.pi * s / m) + 1.0) for s, m in zip(ssr.tolist(), n.tolist())])


def gram_unpack(row, k: int, prefix: str = "g"):
    """Rebuild (X'X, X'y, y'y, n) from the flat sums produced by ``linalg.gram_sums``."""
    xtx = np.empty((k, k))
    for i in range(k):
        for j in range(i, k):
            v = row[f"{prefix}_{i}_{j}"]
            xtx[i, j] = xtx[j, i] = 0.0 if v is None or (isinstance(v, float) and math.isnan(v)) else v
    xty = np.array([row[f"{prefix}_{i}_y"] or 0.0 for i in range(k)], dtype=float)
    return xtx, xty, float(row[f"{prefix}_y_y"] or 0.0), int(row[f"{prefix}_n"] or 0)


# ---------------------------------------------------------------- autocorrelation
def pacf_yule_walker(acov_sums: np.ndarray, n: int, nlags: int) -> np.ndarray:
    """PACF by Yule-Walker with the adjusted (n - k) autocovariance denominator.

    ``acov_sums[k]`` = sum_t d_t d_{t+k} of the demeaned series.
    """
    r = np.array([acov_sums[k] / (n - k) for k in range(nlags + 1)], dtype=float)
    out = [1.0]
    for k in range(1, nlags + 1):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        try:
            phi = np.linalg.solve(toeplitz, r[1:k + 1])
            out.append(float(phi[-1]))
        except np.linalg.LinAlgError:
            out.append(float("nan"))
    return np.array(out)
