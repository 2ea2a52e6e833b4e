"""Time-series operators against independent numpy computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.functions import lagged as LG
from cadence.functions import stats as ST
from cadence.operators import series as TS
from cadence.spec import PanelSpec

SPEC = PanelSpec(name=None)


def _frame(spark, series: dict):
    rows = [(e, i, float(v)) for e, vals in series.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "entity string, period int, value double")


def _rw(n, seed, phi=1.0):
    rng = np.random.default_rng(seed)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = phi * x[t - 1] + rng.normal()
    return x + 10.0


# ---------------------------------------------------------------- scalar kernels
def test_student_t_pvalues():
    assert ST.t_two_sided_p(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert ST.t_two_sided_p(0.0, 5) == pytest.approx(1.0)
    assert ST.t_two_sided_p(float("inf"), 5) == 0.0


def test_mackinnon_tables():
    assert ST.adf_pvalue(-2.0) == pytest.approx(0.2866, abs=1e-3)
    assert ST.adf_pvalue(5.0) == 1.0 and ST.adf_pvalue(-30.0) == 0.0
    crit = ST.adf_critical(100)
    assert crit["1%"] == pytest.approx(-3.4975, abs=1e-3)
    assert crit["5%"] == pytest.approx(-2.8912, abs=1e-3)


# ---------------------------------------------------------------- trend
def test_trend_matches_polyfit_and_constant_series(spark):
    y = [2.0 + 0.3 * i + (0.5 if i % 2 else -0.5) for i in range(12)]
    df = _frame(spark, {"A": y, "C": [3.0] * 8})
    prep = TS.prepare(df, SPEC, "value")
    out = {r["entity"]: r for r in TS.trend(prep, SPEC).collect()}
    slope, intercept = np.polyfit(np.arange(12), y, 1)
    assert out["A"]["slope"] == pytest.approx(slope) and out["A"]["intercept"] == pytest.approx(intercept)
    assert out["A"]["trend_direction"] == "Increasing"
    assert out["C"]["r2"] == 0.0 and out["C"]["p_value"] == pytest.approx(1.0)


def test_prepare_drops_short_series(spark):
    df = _frame(spark, {"A": [1, 2, 3, 4, 5], "S": [1, 2, 3]})
    assert {r["entity"] for r in TS.prepare(df, SPEC, "value").collect()} == {"A"}


# ---------------------------------------------------------------- decomposition
def _decompose_ref(x, period):
    n = len(x)
    if period % 2 == 0:
        filt = np.array([0.5] + [1.0] * (period - 1) + [0.5]) / period
    else:
        filt = np.repeat(1.0 / period, period)
    k = len(filt) // 2
    trend = np.full(n, np.nan)
    for t in range(k, n - k):
        trend[t] = np.dot(filt, x[t - k:t + k + 1])
    front, back = k, n - 1 - k
    npts = period
    fl = min(front + npts, back)
    kf, nf = np.polyfit(np.arange(front, fl), trend[front:fl], 1)
    trend[:front] = np.arange(0, front) * kf + nf
    bf = max(front, back - npts)
    kb, nb = np.polyfit(np.arange(bf, back), trend[bf:back], 1)
    trend[back + 1:] = np.arange(back + 1, n) * kb + nb
    det = x - trend
    avgs = np.array([np.nanmean(det[i::period]) for i in range(period)])
    avgs -= avgs.mean()
    seasonal = np.tile(avgs, n // period + 1)[:n]
    return trend, seasonal, det - seasonal


@pytest.mark.parametrize("n", [5, 7, 13])
def test_decompose_matches_reference_algorithm(spark, n):
    rng = np.random.default_rng(n)
    x = np.cumsum(rng.normal(size=n)) + np.sin(np.arange(n))
    dec = TS.decompose(TS.prepare(_frame(spark, {"A": x}), SPEC, "value"), SPEC).orderBy("period").collect()
    period = min(4, n // 2)
    trend, seasonal, resid = _decompose_ref(x, period)
    # sums run on a 2^-32 grid (engine-independent), so agreement is ~1e-8, not 1e-15
    assert [r["trend"] for r in dec] == pytest.approx(list(trend), abs=1e-7)
    assert [r["seasonal"] for r in dec] == pytest.approx(list(seasonal), abs=1e-7)
    assert [r["resid"] for r in dec] == pytest.approx(list(resid), abs=1e-7)


# ---------------------------------------------------------------- ACF / PACF
def test_acf_and_pacf_match_numpy(spark):
    x = _rw(40, 3, phi=0.6)
    prep = TS.prepare(_frame(spark, {"A": x}), SPEC, "value")
    acf = [r["acf"] for r in TS.acf(prep, SPEC).orderBy("lag").collect()]
    d = x - x.mean()
    ref = [np.sum(d[:len(d) - k] * d[k:]) / np.sum(d * d) for k in range(11)]
    assert acf == pytest.approx(ref)
    pacf = [r["pacf"] for r in TS.pacf(prep, SPEC).orderBy("lag").collect()]
    r = np.array([np.sum(d[:len(d) - k] * d[k:]) / (len(d) - k) for k in range(11)])
    ref_p = [1.0] + [np.linalg.solve(np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)]),
                                     r[1:k + 1])[-1] for k in range(1, 11)]
    assert pacf == pytest.approx(ref_p)
    assert all(abs(v) <= 1.0 + 1e-12 for v in acf)


# ---------------------------------------------------------------- ADF
def _adf_ref(x):
    n = len(x)
    maxlag = min(n // 2 - 2, int(math.ceil(12.0 * (n / 100.0) ** 0.25)))
    dx = np.diff(x)

    def design(lag, start):
        rows, ys = [], []
        for t in range(start, n):  # t = position of y_t; dy_t = x[t] - x[t-1]
            rows.append([1.0, x[t - 1]] + [dx[t - 1 - j] for j in range(1, lag + 1)])
            ys.append(dx[t - 1])
        return np.array(rows), np.array(ys)

    best = None
    for lag in range(maxlag + 1):
        X, y = design(lag, maxlag + 1)
        b, *_ = np.linalg.lstsq(X, y, rcond=None)
        ssr = float(np.sum((y - X @ b) ** 2))
        m = len(y)
        aic = 2 * X.shape[1] + m * (math.log(2 * math.pi) + math.log(ssr / m) + 1)
        if best is None or aic < best[0]:
            best = (aic, lag)
    lag = best[1]
    X, y = design(lag, lag + 1)
    b, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ b
    s2 = resid @ resid / (len(y) - X.shape[1])
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * s2)
    return b[1] / se[1], lag, len(y)


@pytest.mark.parametrize("phi,seed", [(1.0, 1), (0.5, 2)])
def test_adf_matches_reference_procedure(spark, phi, seed):
    x = _rw(60, seed, phi)
    out = TS.adf(TS.prepare(_frame(spark, {"A": x}), SPEC, "value"), SPEC).first()
    stat, lag, nobs = _adf_ref(x)
    assert out["used_lag"] == lag and out["n_obs"] == nobs
    assert out["adf_statistic"] == pytest.approx(stat, rel=1e-6)
    assert out["p_value"] == pytest.approx(ST.adf_pvalue(stat), rel=1e-6)


# ---------------------------------------------------------------- ARIMA
def test_arima_recovers_ar1_and_forecast_band(spark):
    rng = np.random.default_rng(7)
    n, phi = 300, 0.7
    e = rng.normal(size=n)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = phi * x[t - 1] + e[t]
    prep = TS.prepare(_frame(spark, {"A": x + 5.0}), SPEC, "value")
    d = spark.createDataFrame([("A", 0)], "entity string, d int")
    design = TS.arima_design(prep, SPEC, d)
    fits = TS.arima_orders(design, SPEC, [(1, 0)])
    best = TS.select_order(fits, SPEC)
    b = best.first()
    assert b["ar"][0] == pytest.approx(phi, abs=0.1)
    fc = TS.arima_forecast(TS.arima_fitted(design, best, SPEC), best, SPEC, 3).orderBy("step").collect()
    assert [r["step"] for r in fc] == [1, 2, 3]
    widths = [r["upper_ci"] - r["lower_ci"] for r in fc]
    assert all(w > 0 for w in widths) and widths[0] < widths[2]


def _orders(spark, series):
    prep = TS.prepare(_frame(spark, series), SPEC, "value")
    d = prep.select("entity").distinct().withColumn("d", F.lit(0))
    return {r["entity"]: r for r in TS.select_order(TS.arima_orders(TS.arima_design(prep, SPEC, d), SPEC), SPEC).collect()}


def test_order_search_does_not_depend_on_the_unit(spark):
    rng = np.random.default_rng(11)
    noise = {f"n{k}": rng.normal(size=120) for k in range(12)}
    small, plain, large = ({k: v * s + t for k, v in noise.items()} for s, t in ((1e-3, 0.0), (1.0, 5.0), (1e3, 1e6)))
    got = [_orders(spark, x) for x in (small, plain, large)]
    assert all((a["p"], a["q"]) == (got[1][k]["p"], got[1][k]["q"]) for g in got for k, a in g.items())
    assert sum((r["p"], r["q"]) == (0, 0) for r in got[1].values()) >= 6  # mostly no terms for white noise


def test_orders_against_least_squares_on_the_common_sample(spark):
    x = _rw(90, 5, 0.6) + 3.0
    prep = TS.prepare(_frame(spark, {"A": x}), SPEC, "value")
    d = spark.createDataFrame([("A", 0)], "entity string, d int")
    design = TS.arima_design(prep, SPEC, d)
    fits = {(r["p"], r["q"]): r for r in TS.arima_orders(design, SPEC).collect()}
    n, m = len(x), TS.long_ar_order(90, 0)

    def solve(cols, t):
        A = np.column_stack(cols)
        b = np.linalg.lstsq(A, x[t], rcond=None)[0]
        return b, float(np.sum((x[t] - A @ b) ** 2))

    t = np.arange(m, n)
    long_ar = solve([np.ones(n - m)] + [x[t - j] for j in range(1, m + 1)], t)[0]
    e = np.full(n, np.nan)
    e[m:] = x[m:] - long_ar[0] - sum(long_ar[j] * x[t - j] for j in range(1, m + 1))
    for (p, q), r in fits.items():
        for start, aic in ((m + 3, r["search_aic"]), (max(p, m + q if q else 0), r["aic"])):
            t = np.arange(start, n)
            b, ssr = solve([np.ones(len(t))] + [x[t - j] for j in range(1, p + 1)] + [e[t - j] for j in range(1, q + 1)], t)
            assert aic == pytest.approx(2 * (p + q + 2) + len(t) * (math.log(2 * math.pi * ssr / len(t)) + 1), rel=1e-6), (p, q)
        assert [r["const"], *r["ar"], *r["ma"]] == pytest.approx(list(b), rel=1e-5, abs=1e-6)
    best = TS.arima_fixed(design, SPEC, 2, 1)
    fitted = {r["period"]: r for r in TS.arima_fitted(design, best, SPEC).collect()}
    r = fits[2, 1]
    periods = sorted(fitted)
    for t in range(m + 1, n):
        hat = r["const"] + r["ar"][0] * x[t - 1] + r["ar"][1] * x[t - 2] + r["ma"][0] * e[t - 1]
        assert fitted[periods[t]]["fitted"] == pytest.approx(hat, rel=1e-6)
    assert fitted[periods[m]]["fitted"] is None or m + 1 <= m
    with pytest.raises(ValueError):
        TS.arima_fixed(design, SPEC, 9, 0)


def test_decompose_with_a_given_period(spark):
    x = np.tile([1.0, 5.0, 0.0, 2.0, -8.0], 8) + np.arange(40)
    prep = TS.prepare(_frame(spark, {"A": x, "S": x[:7]}), SPEC, "value")
    out = TS.decompose(prep, SPEC, 5).orderBy("entity", "period").collect()
    a = [r for r in out if r["entity"] == "A"]
    assert [r["seasonal"] for r in a[:5]] == pytest.approx([1.0, 5.0, 0.0, 2.0, -8.0], abs=1e-9)
    assert all(abs(r["resid"]) < 1e-9 for r in a) and {r["period_length"] for r in out if r["entity"] == "S"} == {2}


def test_series_report_keeps_short_entities_with_error(spark):
    df = _frame(spark, {"A": list(_rw(30, 4, 0.5)), "S": [1.0, 2.0]})
    out = {r["entity"]: r for r in TS.series_report(df, SPEC, "value", orders=[(1, 0), (0, 1)]).collect()}
    assert out["S"]["error"] is not None and out["A"]["error"] is None
    assert out["A"]["aic"] is not None


def _mixed(n=60):
    """Series of many lengths, among them constant, linear and alternating ones (singular regressions)."""
    rng = np.random.default_rng(21)
    own = {f"s{k:03d}": np.cumsum(rng.normal(size=5 + k % 29)) if k % 2 else rng.normal(size=5 + k % 29) for k in range(n)}
    return own | {"t0": [3.0] * 12, "t1": list(range(15)), "t2": [1.0, -1.0] * 9, "t3": [1.0, 2.0, 4.0, 8.0, 16.0]}


def test_series_are_finished_in_blocks_over_all_partitions(spark):
    prep = TS.prepare(_frame(spark, _mixed()), SPEC, "value")
    got = LG.states(LG.windows(prep, SPEC, 3), SPEC, ["n"], lambda m: 3, lambda m, ys: (ys[:, :-1], ys[:, -1]),
                    lambda series: [[{"block": len(series), "rows": s[1][1] + len(s[2]), "n": s[0]["n"]}] for s in series],
                    "entity string, block int, rows long, n long").withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == 64 and all(r["rows"] == r["n"] for r in got)
    tasks = {r["task"]: r["block"] for r in got}
    assert len(tasks) > 1 and sum(tasks.values()) == 64  # one block of all its series in each of several tasks


def test_a_series_does_not_depend_on_those_beside_it(spark):
    series = _mixed(24)

    def results(x):
        prep = TS.prepare(_frame(spark, x), SPEC, "value")
        ad = {r["entity"]: r.asDict() for r in TS.adf(prep, SPEC).collect()}
        design = TS.arima_design(prep, SPEC, prep.select("entity").distinct().withColumn("d", F.when(F.col("entity") < "s010", 1).otherwise(0)))
        return ad, {(r["entity"], r["p"], r["q"]): r.asDict() for r in TS.arima_orders(design, SPEC).collect()}

    ad, fits = results(series)
    assert len(fits) == 28 * 16
    assert {k[0] for k in fits} == set(series)

    def same(x, y):
        assert x.keys() == y.keys()
        for c in x:
            assert x[c] == pytest.approx(y[c], rel=1e-6, abs=1e-9) if isinstance(x[c], (float, list)) else x[c] == y[c], c

    for e in ("s003", "s017"):
        alone, own = results({e: series[e]})
        same(alone[e], ad[e])
        for k, v in own.items():
            same(v, fits[k])


def test_the_report_reads_its_panel_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = _frame(spark, {"A": _rw(30, 4, 0.5), "B": _rw(25, 6), "S": [1.0, 2.0]})
    report = TS.series_report(df.mapInArrow(count, df.schema), SPEC, "value").collect()
    assert len(report) == 3 and seen.value == 57


def test_the_report_holds_every_step(spark):
    rng = np.random.default_rng(8)
    series = {"A": np.tile([1.0, 5.0, 0.0, -6.0], 8) + np.arange(32), "B": _rw(41, 6), "C": 4.0 + rng.normal(size=23)}
    df = _frame(spark, series)
    report = {r["entity"]: r.asDict(True) for r in TS.series_report(df, SPEC, "value", steps=4).collect()}
    prep = TS.prepare(df, SPEC, "value")
    ad = TS.adf(prep, SPEC)
    design = TS.arima_design(prep, SPEC, TS.differencing(prep, SPEC, ad))
    best = TS.select_order(TS.arima_orders(design, SPEC), SPEC)
    fitted = TS.arima_fitted(design, best, SPEC)

    def rows(d, *cols):
        own = {e: [] for e in series}
        for r in d.orderBy("entity", cols[0]).collect():
            own[r["entity"]].append({c: r[c] for c in cols})
        return own

    def same(got, want):
        assert len(got) == len(want) and want
        for g, w in zip(got, want):
            assert g == {c: v if v is None else pytest.approx(v, rel=1e-6, abs=1e-9) for c, v in w.items()}

    dec = rows(TS.decompose(prep, SPEC), "period", "observed", "trend", "seasonal", "resid")
    ahead = rows(TS.arima_forecast(fitted, best, SPEC, 4), "step", "period", "forecast", "lower_ci", "upper_ci")
    fits = rows(fitted, "period", "y", "fitted", "residual")
    partial, tests = rows(TS.pacf(prep, SPEC), "lag", "pacf", "significant"), rows(ad, "adf_statistic", "used_lag", "n_obs", "crit_5pct")
    shares = rows(TS.variance_shares(TS.decompose(prep, SPEC), SPEC), "trend_var_pct", "seasonal_var_pct", "resid_var_pct")
    for e, y in series.items():
        r, n = report[e], len(y)
        assert r["error"] is None and (r["n_rows"], r["n_obs"], r["first_period"], r["last_period"]) == (n, n, 0, n - 1)
        slope, intercept = np.polyfit(np.arange(n), y, 1)
        assert (r["slope"], r["intercept"], r["total_change"]) == pytest.approx((slope, intercept, slope * (n - 1)))
        assert [v["trend"] for v in r["trend_line"]] == pytest.approx(slope * np.arange(n) + intercept)
        dev = y - y.mean()
        acf = [(dev[k:] * dev[:n - k]).sum() / (dev * dev).sum() for k in range(r["nlags"] + 1)]
        assert r["nlags"] == min(10, n // 2 - 1) and r["acf"] == pytest.approx(acf) and r["conf_band"] == pytest.approx(1.96 / n ** 0.5)
        assert r["significant_acf_lags"] == [k for k, v in enumerate(acf) if k and abs(v) > 1.96 / n ** 0.5]
        assert r["n_significant_acf_lags"] == len(r["significant_acf_lags"])
        assert r["pacf"] == pytest.approx([v["pacf"] for v in partial[e]])
        assert r["significant_pacf_lags"] == [v["lag"] for v in partial[e] if v["significant"]]
        assert (r["adf_statistic"], r["adf_used_lag"], r["adf_n_obs"], r["crit_5pct"]) == pytest.approx(tuple(tests[e][0].values()))
        assert r["period_length"] == 4
        same([{c: r[c] for c in shares[e][0]}], shares[e])
        same(r["decomposition"], dec[e])
        same(r["fitted"], fits[e])
        same(r["forecast"], ahead[e])
        assert [v["period"] for v in r["forecast"]] == [n, n + 1, n + 2, n + 3]
        assert all(v["lower_ci"] < v["forecast"] < v["upper_ci"] for v in r["forecast"])
        assert r["report"] == (f"\nTIME SERIES ANALYSIS REPORT: {e}\nTarget: value\nPeriod: 0 - {n - 1}\nObservations: {n}\n"
                               f"Trend: {r['trend_direction']}\n")
    assert [v["seasonal"] for v in report["A"]["decomposition"][:4]] == pytest.approx([1.0, 5.0, 0.0, -6.0], abs=1e-9)
    bounded = TS.series_report(df, SPEC, "value", orders=[(1, 0)], values=False).columns
    assert {"forecast", "seasonal_var_pct", "pacf"} <= set(bounded) and not {"trend_line", "decomposition", "fitted"} & set(bounded)


def test_the_report_survives_series_that_a_step_cannot_take(spark):
    own = {"A": _rw(30, 4, 0.5).tolist(), "one": [None] * 5 + [3.0], "none": [None] * 6, "same": [2.0] * 12, "short": [1.0, 2.0],
           "gaps": [1.0, None, 3.0, 2.0, None, 8.0, 1.0, 4.0, None]}
    rows = [(e, i, v) for e, vals in own.items() for i, v in enumerate(vals)] + [("undated", None, float(v)) for v in _rw(9, 2)]
    df = spark.createDataFrame(rows, "entity string, period int, value double")
    out = {r["entity"]: r.asDict(True) for r in TS.series_report(df, SPEC, "value", orders=[(1, 0), (0, 1)]).collect()}
    assert set(out) == {*own, "undated"}
    assert {e: r["error"] for e, r in out.items() if r["error"]} == {
        "none": "Nothing to analyse", "short": "Not enough data: need at least 5 periods"}
    assert all(out[e][c] is None for e in ("none", "short") for c in ("n_obs", "slope", "decomposition", "forecast", "report"))
    assert out["one"]["n_obs"] == 1 and out["one"]["decomposition"] is None and out["one"]["forecast"] is None
    assert [v["seasonal"] for v in out["same"]["decomposition"]] == [0.0] * 12 and out["same"]["forecast"] is None
    assert [v["observed"] for v in out["gaps"]["decomposition"]] == [1.0, 2.0, 3.0, 2.0, 5.0, 8.0, 1.0, 4.0, 4.0]
    assert [v["period"] for v in out["A"]["forecast"]] == [30, 31, 32]
    assert [v["period"] for v in out["undated"]["forecast"]] == [None] * 3 and len(out["undated"]["decomposition"]) == 9
