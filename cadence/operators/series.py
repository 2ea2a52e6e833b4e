"""Per-entity time-series analysis for every entity in one job.

The reference analyses one entity per call; here each operator is a grouped
plan over all entities.  Row-order work (lags, moving averages, positions)
uses the shared per-entity window; everything that summarises a series
(trend sums, autocovariance sums, regression Gram matrices) is a
``groupBy(entity).agg`` of plain sums that combine map-side.  Python only
finishes per-entity summary rows (t and normal tails, MacKinnon tables,
Yule-Walker, small least-squares solves) inside ``mapInPandas``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions import exprs as X
from cadence.functions import stats as ST
from cadence.functions import lagged as LG
from cadence.operators import features as FT
from cadence.operators import slices as SC
from cadence.session import materialize
from cadence.spec import PanelSpec

SIG_LEVEL = 0.05
ACF_Z = 1.96
MAX_ACF_LAGS = 10


def prepare(df: DataFrame, spec: PanelSpec, target: str, min_rows: int = 5,
            missing: str = "interpolate") -> DataFrame:
    """Entities with at least ``min_rows`` rows; interpolate (or drop) missing values.

    Returns (entity, period, y).
    """
    base = df.select(spec.entity, spec.period, F.col(target).cast("double").alias("y"))
    enough = base.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_rows)
    kept = base.join(enough.select(spec.entity), spec.entity, "left_semi")
    if missing == "drop":
        return kept.filter(F.col("y").isNotNull())
    return FT.interpolate(kept, spec, "y", "y", drop_missing=True)


def _t_pvalue_frame(df: DataFrame, t_col: str, df_col: str, out: str = "p_value") -> DataFrame:
    """Append a two-sided Student-t p-value computed on (aggregated) rows."""
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.DoubleType())])

    def run(batches):
        for pdf in batches:
            pdf[out] = [ST.t_two_sided_p(t, d) if t is not None and d is not None and not pd.isna(t)
                        and not pd.isna(d) else None for t, d in zip(pdf[t_col], pdf[df_col])]
            yield pdf

    return df.mapInPandas(run, schema)


#: A share of explained variance this near to 1 is a perfect line: the rest is rounding, whatever the unit of measure.
PERFECT = 1e-12


def trend_stats(prep: DataFrame, spec: PanelSpec) -> DataFrame:
    """T2/T4 (SQL part): slope, intercept, r2, slope std error, total change per entity.

    Least squares from centred moments (covariance and variances are updated around running means), so
    nothing depends on the size of the values.
    """
    t, y = F.col(spec.period).cast("double"), F.col("y")
    g = prep.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("n"), F.min(spec.period).alias("first_period"), F.max(spec.period).alias("last_period"),
        F.avg(t).alias("mt"), F.avg(y).alias("my"), F.var_pop(t).alias("vt"), F.var_pop(y).alias("vy"), F.covar_pop(t, y).alias("c"))
    slope = X.share(F.col("c"), F.col("vt"))
    fit = X.share(F.col("c") * F.col("c"), F.col("vt") * F.col("vy"))
    r2 = (F.when((F.col("vt") == 0) | (F.col("vy") <= 0), F.lit(0.0)).when(fit > 1.0 - PERFECT, F.lit(1.0)).otherwise(fit))
    g = (g.withColumn("slope", slope).withColumn("intercept", F.col("my") - F.col("slope") * F.col("mt")).withColumn("r2", r2))
    se = F.when(F.col("n") > 2, F.sqrt((F.lit(1.0) - F.col("r2")) * F.col("vy") / F.col("vt") / (F.col("n") - 2)))
    return (g.withColumn("std_err", se)
            .select(spec.entity, "n", "slope", "intercept", "r2", "std_err",
                    (F.col("slope") * (F.col("last_period") - F.col("first_period"))).alias("total_change")))


def trend(prep: DataFrame, spec: PanelSpec) -> DataFrame:
    """Trend statistics with p-value, direction and significance."""
    st = trend_stats(prep, spec)
    tv = F.when(F.col("r2") >= 1.0, F.lit(float("inf"))).otherwise(
        F.sqrt(F.col("r2") * (F.col("n") - 2) / (F.lit(1.0) - F.col("r2"))))
    with_t = st.withColumn("__t", tv).withColumn("__df", (F.col("n") - 2).cast("double"))
    out = _t_pvalue_frame(with_t, "__t", "__df").drop("__t", "__df")
    sig = F.col("p_value") < SIG_LEVEL
    return (out.withColumn("is_significant", sig)
            .withColumn("trend_direction", F.when(sig & (F.col("slope") > 0), "Increasing")
                        .when(sig, "Decreasing").otherwise("No significant trend")))


def trend_line(prep: DataFrame, stats: DataFrame, spec: PanelSpec) -> DataFrame:
    """Fitted trend value of every row."""
    j = prep.join(stats.select(spec.entity, "slope", "intercept"), spec.entity)
    return j.select(spec.entity, spec.period, "y",
                    (F.col("slope") * F.col(spec.period) + F.col("intercept")).alias("trend"))


def _positions(prep: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows with the length ``n`` of their series."""
    return prep.join(prep.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n")), spec.entity)


def _line(cond, prefix: str):
    """Least-squares slope and intercept of the moving average on the position, where ``cond`` holds (NULL for fewer
    than 2 points)."""
    y, x = F.when(cond, F.col("ma")), F.when(cond, F.col("pos").cast("double"))
    enough = F.count(y) >= 2
    return [F.when(enough, F.regr_slope(y, x)).alias(f"{prefix}_slope"), F.when(enough, F.regr_intercept(y, x)).alias(f"{prefix}_intercept")]


def decompose(prep: DataFrame, spec: PanelSpec, period: int | None = None) -> DataFrame:
    """T5: additive decomposition, period = min(4, n // 2), or the one given (at least 2; 2 where the series has less than two of them).

    Centred moving average (half weights at the ends for an even period), its
    ends extended by a least-squares line through the first / last ``period``
    trend points, seasonal = per-phase mean of the detrended values minus
    their mean, residual = detrended - seasonal.
    """
    y = F.col("y")
    longest = F.floor(F.col("n") / 2)
    wanted = F.least(F.lit(4), longest) if period is None else F.when(F.lit(period) <= longest, F.lit(period)).otherwise(F.lit(2))
    p = _positions(prep, spec).withColumn("p", wanted.cast("int")).withColumn("k", F.floor(F.col("p") / 2).cast("int"))
    half = 2 if period is None else max(1, period // 2)

    def averages(d: DataFrame, s: PanelSpec) -> DataFrame:
        w = s.window()
        at = {j: (F.lag("y", -j) if j < 0 else F.lead("y", j)).over(w) if j else y for j in range(-half, half + 1)}

        def mean(length: int):
            k = length // 2
            ends = F.lit(0.5) if length % 2 == 0 else F.lit(1.0)
            total = ends * at[-k]
            for j in range(1 - k, k):
                total = total + at[j]
            return (total + ends * at[k]) / F.lit(float(length))

        lengths = [2, 3, 4] if period is None else sorted({2, period})
        ma = None
        for length in lengths:
            ma = mean(length) if ma is None else F.when(F.col("p") == length, mean(length)).otherwise(ma)
        return d.withColumn("pos", SC.position(s)).withColumn("ma", ma)

    p = SC.over(p, spec, averages, before=half, after=half)
    p = p.withColumn("ma", F.when((F.col("pos") >= F.col("k")) & (F.col("pos") <= F.col("n") - 1 - F.col("k")),
                                  F.col("ma")))
    front, back = F.col("k"), F.col("n") - 1 - F.col("k")
    in_front = (F.col("pos") >= front) & (F.col("pos") < F.least(front + F.col("p"), back))
    in_back = (F.col("pos") >= F.greatest(front, back - F.col("p"))) & (F.col("pos") < back)
    pos_d = F.col("pos").cast("double")
    ends = p.groupBy(spec.entity).agg(*_line(in_front, "f"), *_line(in_back, "b"))
    t = p.join(ends, spec.entity)
    trend_v = (F.when(F.col("pos") < front, F.col("f_slope") * pos_d + F.col("f_intercept"))
               .when(F.col("pos") > back, F.col("b_slope") * pos_d + F.col("b_intercept")).otherwise(F.col("ma")))
    t = t.withColumn("trend", trend_v).withColumn("detrended", y - F.col("trend")) \
         .withColumn("phase", F.try_mod(F.col("pos"), F.col("p")))  # a series of one value has no period
    phase = t.groupBy(spec.entity, "phase").agg(F.avg("detrended").alias("phase_mean"))
    center = phase.groupBy(spec.entity).agg(F.avg("phase_mean").alias("phase_center"))
    seas = phase.join(center, spec.entity).select(
        spec.entity, "phase", (F.col("phase_mean") - F.col("phase_center")).alias("seasonal"))
    out = t.join(seas, [spec.entity, "phase"])
    return out.select(spec.entity, spec.period, F.col("y").alias("observed"), "trend", "seasonal",
                      (F.col("detrended") - F.col("seasonal")).alias("resid"), F.col("p").alias("period_length"))


def variance_shares(dec: DataFrame, spec: PanelSpec) -> DataFrame:
    """Population variance of each part as a percentage of the observed variance."""
    g = dec.groupBy(spec.entity).agg(*[F.var_pop(c).alias(c) for c in ("observed", "trend", "seasonal", "resid")])
    return g.select(spec.entity, *[(X.share(F.col(c), F.col("observed")) * F.lit(100.0)).alias(f"{c}_var_pct")
                                   for c in ("trend", "seasonal", "resid")])


# ------------------------------------------------------------------ ADF
def adf_design(prep: DataFrame, spec: PanelSpec, max_lags: int) -> DataFrame:
    """Rows of the ADF regression: dy_t on y_{t-1} and dy_{t-1..t-max_lags} (NULL where absent)."""
    def run(p: DataFrame, s: PanelSpec) -> DataFrame:
        w = s.window()
        p = p.withColumn("pos", SC.position(s)).withColumn("level", F.lag("y", 1).over(w)).withColumn("dy", F.col("y") - F.col("level"))
        return p.select("*", *[F.lag("dy", j).over(w).alias(f"dl{j}") for j in range(1, max_lags + 1)])

    return SC.over(_positions(prep, spec), spec, run, before=max_lags + 1)


def _adf_rows(ys: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """Regressors (1, y_{t-1}, dy_{t-1}, ...) and dy_t from windows (last axis) of at least ``lags`` + 2 values."""
    dy = np.diff(ys, axis=-1)
    return np.concatenate([np.ones((*ys.shape[:-1], 1)), ys[..., -2:-1], dy[..., ::-1][..., 1:lags + 1]], axis=-1), dy[..., -1]


def _head_windows(heads: np.ndarray, first: int, back: int) -> np.ndarray:
    """The windows of the rows ``first``, ... of many series' first values (a row each), padded with zeros before their start."""
    padded = np.concatenate([np.zeros((len(heads), back)), heads], axis=1)
    rows = np.arange(first, heads.shape[1])
    return padded[:, rows[:, None] + np.arange(back + 1)]


def _adf_lags(grams: np.ndarray, n: np.ndarray, maxlag: int) -> np.ndarray:
    """The lag order with the smallest AIC (-1: none can be fitted) of series with the same bound."""
    aic = np.full((len(n), maxlag + 1), np.inf)
    for lag in range(maxlag + 1):
        own = np.flatnonzero(n > lag + 2)
        if len(own):
            ssr = ST.ols_many(*LG.of_block(grams[own], range(lag + 2)))[1]
            own, ssr = own[ssr > 0], ssr[ssr > 0]
            aic[own, lag] = -2.0 * ST.log_likelihood(ssr, n[own]) + 2.0 * (lag + 2)
    aic[~np.isfinite(aic)] = np.inf
    return np.where(np.isfinite(aic).any(axis=1), aic.argmin(axis=1), -1)


def _level_t(grams: np.ndarray, n: np.ndarray, lag: int) -> np.ndarray:
    """t value of the level of many series' regressions (NaN: it has none)."""
    xtx, xty, yty = LG.of_block(grams, range(lag + 2))
    b, ssr = ST.ols_many(xtx, xty, yty)
    dof, out = n - (lag + 2), np.full(len(n), np.nan)
    own = np.flatnonzero((dof > 0) & (ssr > 0) & (np.linalg.slogdet(xtx)[0] != 0))
    if len(own):
        var = np.linalg.inv(xtx[own])[:, 1, 1] * (ssr[own] / dof[own])
        with np.errstate(divide="ignore", invalid="ignore"):
            out[own] = b[own, 1] / np.sqrt(np.maximum(var, 0.0))
    return out


def adf(prep: DataFrame, spec: PanelSpec) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag order by AIC.

    One Gram matrix per entity over the common sample (t > maxlag) with all candidate regressors: every lag order is a
    leading block of it (``lagged``).  The chosen order is fitted again on its own full sample, the
    common one and the rows before it.
    """
    n_max = X.one_row(prep.groupBy(spec.entity).count().agg(F.max("count").alias("m")))["m"] or 0
    back = ST.adf_maxlag(int(n_max)) + 1
    rows = LG.windows(prep, spec, back)

    def row(stat: float, lag: int, n: int) -> dict:
        stat = stat if np.isfinite(stat) else None
        pv, crit = None if stat is None else ST.adf_pvalue(stat), ST.adf_critical(n)
        return {"adf_statistic": stat, "p_value": pv, "used_lag": lag, "n_obs": n, "crit_1pct": crit["1%"], "crit_5pct": crit["5%"],
                "crit_10pct": crit["10%"], "is_stationary": None if pv is None else bool(pv < SIG_LEVEL)}

    def finish_adf(series: list[LG.State]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in series]
        fitting = [(i, s) for i, s in enumerate(series) if s[1][1] > 2]
        for (maxlag, _), places in LG.alike(fitting, lambda x: (ST.adf_maxlag(x[1][0]["n"]), len(x[1][2]))):
            own = [fitting[k] for k in places]
            grams, n, heads = np.stack([s[1][0] for _, s in own]), np.array([s[1][1] for _, s in own]), np.stack([s[2] for _, s in own])
            lags = _adf_lags(grams, n, maxlag)
            for lag in np.unique(lags[lags >= 0]).tolist():
                at = np.flatnonzero(lags == lag)
                x, y = _adf_rows(_head_windows(heads[at], lag + 1, maxlag + 1), maxlag)
                used = n[at] + y.shape[1]
                for k, stat, m in zip(at, _level_t(grams[at] + LG.products(x, y), used, lag).tolist(), used.tolist()):
                    out[own[k][0]].append(row(stat, lag, m))
        return out

    return LG.states(rows, spec, ["n"], lambda m: ST.adf_maxlag(m["n"]) + 1, lambda m, ys: _adf_rows(ys, ST.adf_maxlag(m["n"])), finish_adf,
                     f"`{spec.entity}` {_etype(prep, spec)}, adf_statistic double, p_value double, used_lag int, n_obs long, "
                     "crit_1pct double, crit_5pct double, crit_10pct double, is_stationary boolean")


# ------------------------------------------------------------------ ACF / PACF
def acov_sums(prep: DataFrame, spec: PanelSpec, max_lags: int = MAX_ACF_LAGS) -> DataFrame:
    """Per entity: n, nlags = min(max_lags, n // 2 - 1), and S_k = sum d_t d_{t+k} of the demeaned series."""
    mean = prep.groupBy(spec.entity).agg(F.avg("y").alias("m"), F.count(F.lit(1)).alias("n"))
    d = prep.join(mean, spec.entity).withColumn("d", F.col("y") - F.col("m"))
    d = SC.over(d, spec, lambda x, s: x.select("*", *[F.lead("d", k).over(s.window()).alias(f"d{k}") for k in range(1, max_lags + 1)]), after=max_lags)
    g = d.groupBy(spec.entity).agg(F.first("n").alias("n"), F.sum(F.col("d") * F.col("d")).alias("s0"),
                                   *[F.sum(F.col("d") * F.col(f"d{k}")).alias(f"s{k}") for k in range(1, max_lags + 1)])
    return g.withColumn("nlags", F.least(F.lit(max_lags), F.floor(F.col("n") / 2) - 1).cast("int"))


def acf(prep: DataFrame, spec: PanelSpec, max_lags: int = MAX_ACF_LAGS, sums: DataFrame | None = None) -> DataFrame:
    """Autocorrelation per lag 0..nlags (entities with nlags >= 2), band 1.96/sqrt(n)."""
    s = (sums if sums is not None else acov_sums(prep, spec, max_lags)).filter(F.col("nlags") >= 2)
    ci = F.lit(ACF_Z) / F.sqrt(F.col("n").cast("double"))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"),
                                        (F.lit(1.0) if k == 0 else X.share(F.col(f"s{k}"), F.col("s0"))).alias("acf"))
                               for k in range(0, max_lags + 1)]))
    out = s.select(spec.entity, "n", "nlags", ci.alias("conf_band"), rows.alias("r")).select(
        spec.entity, "n", "nlags", "conf_band", "r.lag", "r.acf").filter(F.col("lag") <= F.col("nlags"))
    return out.withColumn("significant", (F.col("lag") > 0) & (F.abs(F.col("acf")) > F.col("conf_band")))


def pacf(prep: DataFrame, spec: PanelSpec, max_lags: int = MAX_ACF_LAGS, sums: DataFrame | None = None) -> DataFrame:
    """Partial autocorrelation by Yule-Walker (adjusted), from the same sums as T8."""
    s = (sums if sums is not None else acov_sums(prep, spec, max_lags)).filter(F.col("nlags") >= 2)
    etype = prep.schema[spec.entity].dataType.simpleString()
    schema = f"`{spec.entity}` {etype}, lag int, pacf double, significant boolean"

    def run(batches):
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                n, nl = int(rec["n"]), int(rec["nlags"])
                sums = np.array([rec[f"s{k}"] if k == 0 else rec[f"s{k}"] for k in range(0, nl + 1)], dtype=float)
                vals = ST.pacf_yule_walker(sums, n, nl)
                band = ACF_Z / math.sqrt(n)
                for lag, v in enumerate(vals):
                    out.append({spec.entity: rec[spec.entity], "lag": lag, "pacf": float(v),
                                "significant": bool(lag > 0 and abs(v) > band)})
            yield pd.DataFrame(out, columns=[spec.entity, "lag", "pacf", "significant"])

    return s.mapInPandas(run, schema)


# ------------------------------------------------------------------ ARIMA
MAX_P = 3
MAX_Q = 3
FULL_ORDERS = tuple((p, q) for p in range(MAX_P + 1) for q in range(MAX_Q + 1))
SHORT_ORDERS = ((0, 1), (1, 0), (1, 1), (2, 1), (1, 2))  # the dashboard's short list
Z95 = 1.959963984540054


def _etype(df: DataFrame, spec: PanelSpec) -> str:
    return df.schema[spec.entity].dataType.simpleString()


def differencing(prep: DataFrame, spec: PanelSpec, adf_result: DataFrame | None = None) -> DataFrame:
    """d per entity: 0 when the ADF test rejects a unit root at 5 %, else 1."""
    a = adf_result if adf_result is not None else adf(prep, spec)
    return a.select(spec.entity, F.when(F.col("p_value") < SIG_LEVEL, 0).otherwise(1).alias("d"))


def long_ar_order(n: int, d: int) -> int:
    """Lags of the first autoregression: they grow with the logarithm of the series' length."""
    return max(1, min((n - d) // 5, int(round(math.log(max(n, 2)) ** 1.5))))


def _working(ys: np.ndarray, d: int) -> np.ndarray:
    """The working series of windows (last axis): the values, or their first differences."""
    return np.diff(ys, axis=-1) if d else ys


def _ar_rows(z: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Regressors (constant, m lags) and target of windows of at least m + 1 working values."""
    return np.column_stack([np.ones(len(z)), z[:, ::-1][:, 1:m + 1]]), z[:, -1]


def _innovations(z: np.ndarray, coef: np.ndarray, lags: int) -> np.ndarray:
    """The long autoregression's residuals of the last value and of the ``lags`` before it, newest first.  Windows lie along the
    last axis; ``coef`` is one autoregression, or one for each place of the first axis."""
    m = coef.shape[-1] - 1
    back = z[..., ::-1]
    return np.stack([back[..., j] - coef[..., :1] - (back[..., j + 1:j + 1 + m] @ coef[..., 1:, None])[..., 0] for j in range(lags + 1)], axis=-1)


def _order_rows(d: int, coef: np.ndarray, ys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Regressors (constant, 3 lags, 3 innovations) and target of windows of the series."""
    z = _working(ys, d)
    e = _innovations(z, coef, MAX_Q)[..., 1:]
    return np.concatenate([np.ones((*z.shape[:-1], 1)), z[..., ::-1][..., 1:MAX_P + 1], e], axis=-1), z[..., -1]


def _start(m: dict) -> int:
    """The first row for which every lag and innovation of the largest order exists."""
    return m["d"] + len(m["long_ar"]) - 1 + MAX_Q if "long_ar" in m else m["d"] + long_ar_order(m["n"], m["d"])


def arima_design(prep: DataFrame, spec: PanelSpec, d: DataFrame) -> DataFrame:
    """Rows with their window of values, the differencing ``d`` of the series and its long autoregression.

    Step 1 of Hannan-Rissanen: an autoregression whose order grows with the series' length, by grouped least squares;
    its residuals estimate the innovations that step 2 uses as regressors.
    """
    n_max = X.one_row(prep.groupBy(spec.entity).count().agg(F.max("count").alias("m")))["m"] or 0
    back = long_ar_order(int(n_max), 0) + max(MAX_P, MAX_Q) + 1
    rows = materialize(LG.windows(prep, spec, back).join(d.select(spec.entity, F.col("d").cast("int").alias("d")), spec.entity))

    def solve(series: list[LG.State]) -> list[list[dict]]:
        orders = [long_ar_order(m["n"], m["d"]) + 1 for m, _, _ in series]
        found = [np.zeros(k) for k in orders]
        enough = [i for i, s in enumerate(series) if s[1][1] > orders[i]]
        for (k,), places in LG.alike(enough, lambda i: (orders[i],)):
            own = [enough[j] for j in places]
            coef = ST.ols_many(*LG.of_block(np.stack([series[i][1][0] for i in own]), range(k)))[0]
            for i, b in zip(own, coef):
                found[i] = b
        return [[{"long_ar": b.tolist()}] for b in found]

    ar = LG.states(rows, spec, ["n", "d"], _start, lambda m, ys: _ar_rows(_working(ys, m["d"]), long_ar_order(m["n"], m["d"])), solve,
                   f"`{spec.entity}` {_etype(prep, spec)}, long_ar array<double>")
    return rows.join(ar, spec.entity)


FIT = ("d int, p int, q int, const double, ar array<double>, ma array<double>, sigma2 double, n_used long, llf double, aic double, "
       "bic double, search_aic double, search_bic double, n_common long")


def _fit(grams: np.ndarray, n: np.ndarray, p: int, q: int, d: int) -> tuple[np.ndarray, ...]:
    """Places of the series that one order can be fitted to, and their coefficients, variance, log-likelihood, AIC and BIC (no
    constant after differencing)."""
    block = ([0] if d == 0 else []) + list(range(1, 1 + p)) + list(range(1 + MAX_P, 1 + MAX_P + q))
    own = np.flatnonzero(n > len(block) + 1)
    b, ssr = ST.ols_many(*LG.of_block(grams[own], block))
    own, b, ssr = own[ssr > 0], b[ssr > 0], ssr[ssr > 0]
    llf, k = ST.log_likelihood(ssr, n[own]), len(block) + 1
    return own, b, ssr / n[own], llf, 2 * k - 2 * llf, k * np.array([math.log(m) for m in n[own].tolist()]) - 2 * llf


def arima_orders(design: DataFrame, spec: PanelSpec, orders=FULL_ORDERS) -> DataFrame:
    """Conditional least-squares fit of every (p, q) per entity.

    One Gram matrix per entity over all regressors of the largest order, on the rows where all of them exist: every order is a
    block of it, so their ``search_aic`` are compared on the same rows and in any unit of measure.  Coefficients, ``aic`` and
    ``bic`` are those of the order's own sample: the common one and the rows before it that the order can use.
    """
    def shape(s: LG.State) -> tuple[int, int, int]:
        return s[0]["d"], len(s[0]["long_ar"]) - 1, len(s[2])

    def solve(series: list[LG.State]) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in series]
        side = 2 + MAX_P + MAX_Q
        for (d, k, _), places in LG.alike(series, shape):
            own = [series[i] for i in places]
            grams = np.stack([g[0] if g[1] else np.zeros((side, side)) for _, g, _ in own])
            n, mean, coef = np.array([g[1] for _, g, _ in own]), [m["mean"] for m, _, _ in own], np.array([m["long_ar"] for m, _, _ in own])
            x, y = _order_rows(d, coef, _head_windows(np.stack([h for _, _, h in own]), 0, k + MAX_P + MAX_Q + 1))
            off, starts = 1 if d == 0 else 0, [max(d + p, k + d + q if q else 0) for p, q in orders]
            sums = {at: grams + LG.products(x[:, at:], y[:, at:]) for at in set(starts)}
            for (p, q), at in zip(orders, starts):
                used = n + max(0, y.shape[1] - at)
                rows = [{"d": d, "p": p, "q": q, "const": 0.0, "ar": [], "ma": [], "sigma2": None, "n_used": u, "llf": None, "aic": None, "bic": None,
                         "search_aic": None, "search_bic": None, "n_common": c} for u, c in zip(used.tolist(), n.tolist())]
                common = _fit(grams, n, p, q, d)
                search = dict(zip(common[0].tolist(), zip(common[4].tolist(), common[5].tolist())))
                for i, b, sigma2, llf, aic, bic in zip(*(v.tolist() for v in _fit(sums[at], used, p, q, d))):
                    ar = b[off:off + p]
                    rows[i] |= {"const": b[0] + mean[i] * (1.0 - sum(ar)) if d == 0 else 0.0, "ar": ar, "ma": b[off + p:], "sigma2": sigma2, "llf": llf,
                                "aic": aic, "bic": bic}
                    if i in search:
                        rows[i] |= dict(zip(("search_aic", "search_bic"), search[i]))
                for i, r in zip(places, rows):
                    out[i].append(r)
        return out

    return LG.states(design, spec, ["n", "mean", "d", "long_ar"], _start, lambda m, ys: _order_rows(m["d"], np.array(m["long_ar"]), ys), solve,
                     f"`{spec.entity}` {_etype(design, spec)}, {FIT}")


def select_order(fits: DataFrame, spec: PanelSpec) -> DataFrame:
    """The order with the smallest AIC on the common sample per entity (ties: smaller p, then q; without a common
    sample the smallest order that can be fitted)."""
    ok = fits.filter(F.col("aic").isNotNull())
    rank = F.struct(F.coalesce(F.col("search_aic"), F.lit(float("inf"))), F.col("p"), F.col("q"))
    return ok.groupBy(spec.entity).agg(F.min_by(F.struct(*[c for c in fits.columns if c != spec.entity]), rank).alias("b")).select(spec.entity, "b.*")


def arima_fixed(design: DataFrame, spec: PanelSpec, p: int, q: int) -> DataFrame:
    """T10 with a given order: the differencing is the design's."""
    if not (0 <= p <= MAX_P and 0 <= q <= MAX_Q):
        raise ValueError(f"orders up to ({MAX_P}, {MAX_Q})")
    return select_order(arima_orders(design, spec, [(p, q)]), spec)


def _lists(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place and length of every row's list, and the values of all of them."""
    c = b.column(name)
    at = c.offsets.to_numpy()
    return at[:-1], np.diff(at), np.concatenate([c.values.to_numpy(zero_copy_only=False), [0.0]])


def _padded(lists: tuple[np.ndarray, np.ndarray, np.ndarray], rows: np.ndarray, width: int, last: bool = False) -> np.ndarray:
    """The first ``width`` values of the rows' lists, zeros after shorter ones; or the last values, zeros before."""
    start, length, values = (lists[0][rows], lists[1][rows], lists[2])
    place = np.arange(width) + (length - width)[:, None] if last else np.broadcast_to(np.arange(width), (len(rows), width))
    there = (place >= 0) & (place < length[:, None])
    return np.where(there, values[np.where(there, start[:, None] + place, 0)], 0.0)


def arima_fitted(design: DataFrame, best: DataFrame, spec: PanelSpec) -> DataFrame:
    """T10 rows: fitted value and residual of the chosen model (level scale)."""
    j = design.join(best.select(spec.entity, "p", "q", "const", "ar", "ma"), spec.entity)
    names = [spec.entity, spec.period, "y", "fitted", "residual", "z", "innovation", "pos"]
    schema = T.StructType([j.schema[spec.entity], j.schema[spec.period], *T._parse_datatype_string(
        "y double, fitted double, residual double, z double, innovation double, pos long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, p, q, pos, y, mean, const = (b.column(c).to_numpy(zero_copy_only=False) for c in ("d", "p", "q", "pos", "y", "mean", "const"))
            ys, long_ar, ar, ma = (_lists(b, c) for c in ("ys", "long_ar", "ar", "ma"))
            k, z, hat = long_ar[1] - 1, np.full(len(y), np.nan), np.full(len(y), np.nan)
            for d_, k_ in {*zip(d.tolist(), k.tolist())}:
                own = np.flatnonzero((d == d_) & (k == k_))
                x, last = _order_rows(d_, _padded(long_ar, own, k_ + 1), _padded(ys, own, k_ + MAX_P + MAX_Q + 2, True)[:, None, :])
                weights = np.concatenate([_padded(ar, own, MAX_P), _padded(ma, own, MAX_Q)], axis=1)
                # lags are deviations from the mean: the constant of the level scale takes the mean out again
                level = const[own] + (0.0 if d_ else mean[own] * _padded(ar, own, MAX_P).sum(axis=1))
                z[own] = last[:, 0] + (0.0 if d_ else mean[own])
                hat[own] = (x[:, 0, 1:] * weights).sum(axis=1) + level
            z[pos < d] = np.nan
            fitted = np.where(d > 0, y - z + hat, hat)
            fitted[pos < np.maximum(d + p, np.where(q > 0, k + d + q, 0))] = np.nan
            made = [pa.array(c, pa.float64(), from_pandas=True) for c in (fitted, y - fitted, z, y - fitted)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names[:3]), *made, pa.array(pos.astype(np.int64))], names=names)

    return j.mapInArrow(run, schema)


def arima_metrics(fitted: DataFrame, best: DataFrame, spec: PanelSpec) -> DataFrame:
    """T10 summary: order, aic, bic and in-sample rmse, mae, r2 over rows with a fitted value."""
    r = F.col("residual")
    m = fitted.filter(F.col("fitted").isNotNull()).groupBy(spec.entity).agg(
        F.sqrt(F.avg(r * r)).alias("rmse"), F.avg(F.abs(r)).alias("mae"),
        F.sum(r * r).alias("__ssr"), (F.var_pop("y") * F.count(F.lit(1))).alias("__sst"))
    r2 = F.when(F.col("__sst") > 0, F.lit(1.0) - F.col("__ssr") / F.col("__sst")).otherwise(F.lit(0.0))
    return best.select(spec.entity, "p", "d", "q", "aic", "bic", "sigma2").join(m, spec.entity, "left") \
        .withColumn("r2", r2).drop("__ssr", "__sst")


def arima_forecast(fitted: DataFrame, best: DataFrame, spec: PanelSpec, steps: int = 3) -> DataFrame:
    """H-step forecasts with a 95 % band from psi weights, for every entity.

    The state is bounded per entity: the last 3 working values, the last 3
    innovations and the last level, gathered with a top-3 window.
    """
    w = Window.partitionBy(spec.entity).orderBy(F.col(spec.period).desc())
    last = fitted.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= max(MAX_P, MAX_Q))
    state = last.groupBy(spec.entity).agg(
        F.max(spec.period).alias("last_period"),
        F.array_sort(F.collect_list(F.struct(F.col("__rn").alias("k"), F.col("z").alias("z"),
                                             F.coalesce("innovation", F.lit(0.0)).alias("e"),
                                             F.col("y").alias("y")))).alias("hist"))
    s = state.join(best.select(spec.entity, "p", "d", "q", "const", "ar", "ma", "sigma2"), spec.entity)
    schema = (f"`{spec.entity}` {_etype(fitted, spec)}, {spec.period} int, step int, forecast double, "
              "lower_ci double, upper_ci double")

    def run(batches):
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                hist = list(rec["hist"])  # k = 1 is the latest row
                zs = [h["z"] if h["z"] is not None else 0.0 for h in hist]
                es = [h["e"] for h in hist]
                ylast = hist[0]["y"]
                last_period = None if pd.isna(rec["last_period"]) else int(rec["last_period"])
                ar = [] if rec["ar"] is None else [float(v) for v in rec["ar"]]
                ma = [] if rec["ma"] is None else [float(v) for v in rec["ma"]]
                c = 0.0 if rec["const"] is None else float(rec["const"])
                d, s2 = int(rec["d"]), (0.0 if rec["sigma2"] is None else float(rec["sigma2"]))
                zpath, epath = list(zs), list(es)  # index 0 = most recent
                psi = [1.0]
                for j in range(1, steps):
                    v = ma[j - 1] if j - 1 < len(ma) else 0.0
                    v += sum(ar[i - 1] * psi[j - i] for i in range(1, min(j, len(ar)) + 1))
                    psi.append(v)
                if d == 1:
                    psi = list(np.cumsum(psi))
                level = ylast
                for h in range(1, steps + 1):
                    zf = c + sum(a * (zpath[i] if i < len(zpath) else 0.0) for i, a in enumerate(ar)) \
                        + sum(b * (epath[i] if i < len(epath) else 0.0) for i, b in enumerate(ma))
                    zpath.insert(0, zf)
                    epath.insert(0, 0.0)
                    level = level + zf if d == 1 else zf
                    half = Z95 * math.sqrt(s2 * sum(x * x for x in psi[:h]))
                    out.append({spec.entity: rec[spec.entity], spec.period: None if last_period is None else last_period + h, "step": h,
                                "forecast": float(level), "lower_ci": float(level - half),
                                "upper_ci": float(level + half)})
            yield pd.DataFrame(out, columns=[spec.entity, spec.period, "step", "forecast", "lower_ci", "upper_ci"])

    return s.mapInPandas(run, schema)


def _listed(rows: DataFrame, spec: PanelSpec, name: str, *cols: str) -> DataFrame:
    """One list of structs per entity, sorted by the first of ``cols``."""
    return rows.groupBy(spec.entity).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))


def _lags(corr: DataFrame, spec: PanelSpec, value: str) -> DataFrame:
    """Per entity the correlations in order of their lags, and the lags that are significant."""
    return corr.groupBy(spec.entity).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", value))), lambda r: r[value]).alias(value),
        F.array_sort(F.collect_list(F.when(F.col("significant"), F.col("lag")))).alias(f"significant_{value}_lags"))


def series_report(panel: DataFrame, spec: PanelSpec, target: str, min_rows: int = 5,
                  orders=FULL_ORDERS, steps: int = 3, values: bool = True) -> DataFrame:
    """One row per entity with what every step finds: the prepared series, trend, stationarity, autocorrelation and partial
    autocorrelation, decomposition, ARIMA and its forecast of ``steps`` periods, and the summary text; entities that cannot be
    analysed carry an ``error`` instead (no entity is dropped).

    The values that T3, T5 and T10 give every row of a series are lists in order of its periods; without ``values`` they are left
    to those operators, for series too long to be one row.
    """
    panel = materialize(panel.select(spec.entity, spec.period, target))  # every part below reads these rows, and none makes another's again
    prep = materialize(prepare(panel, spec, target, min_rows))
    tr = materialize(trend(prep, spec))
    ad = materialize(adf(prep, spec))
    sums = materialize(acov_sums(prep, spec))
    dec = materialize(decompose(prep, spec))
    design = materialize(arima_design(prep, spec, differencing(prep, spec, ad)))
    best = materialize(select_order(arima_orders(design, spec, orders), spec))
    fitted = materialize(arima_fitted(design, best, spec))
    parts = [
        prep.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_obs"), F.min(spec.period).alias("first_period"), F.max(spec.period).alias("last_period")),
        tr.select(spec.entity, "slope", "intercept", F.col("r2").alias("trend_r2"), "p_value", "std_err", "trend_direction", "total_change", "is_significant"),
        ad.select(spec.entity, "adf_statistic", F.col("p_value").alias("adf_p_value"), F.col("used_lag").alias("adf_used_lag"),
                  F.col("n_obs").alias("adf_n_obs"), "crit_1pct", "crit_5pct", "crit_10pct", "is_stationary"),
        sums.filter(F.col("nlags") >= 2).select(spec.entity, "nlags", (F.lit(ACF_Z) / F.sqrt(F.col("n").cast("double"))).alias("conf_band")),
        _lags(acf(prep, spec, sums=sums), spec, "acf").withColumn("n_significant_acf_lags", F.size("significant_acf_lags").cast("long")),
        _lags(pacf(prep, spec, sums=sums), spec, "pacf"),
        dec.groupBy(spec.entity).agg(F.first("period_length").alias("period_length")),
        variance_shares(dec, spec),
        arima_metrics(fitted, best, spec),
        _listed(arima_forecast(fitted, best, spec, steps), spec, "forecast", "step", spec.period, "forecast", "lower_ci", "upper_ci"),
    ]
    if values:
        parts += [_listed(trend_line(prep, tr, spec), spec, "trend_line", spec.period, "y", "trend"),
                  _listed(dec, spec, "decomposition", spec.period, "observed", "trend", "seasonal", "resid"),
                  _listed(fitted, spec, "fitted", spec.period, "y", "fitted", "residual")]
    out = panel.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_rows"))
    for part in parts:
        out = out.join(part, spec.entity, "left")
    text = F.format_string("\nTIME SERIES ANALYSIS REPORT: %s\nTarget: %s\nPeriod: %s - %s\nObservations: %s\nTrend: %s\n", F.col(spec.entity).cast("string"),
                           F.lit(target), *[F.col(c).cast("string") for c in ("first_period", "last_period", "n_obs", "trend_direction")])
    return (out.withColumn("report", F.when(F.col("n_obs") > 0, text))
            .withColumn("error", F.when(F.col("n_rows") < min_rows,
                                        F.concat(F.lit("Not enough data: need at least "), F.lit(str(min_rows)), F.lit(" periods")))
                        .when(F.col("n_obs").isNull(), F.lit("Nothing to analyse"))))
