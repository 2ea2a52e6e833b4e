"""Hand-worked values of the feature derivations."""

import math

import pytest

from cadence.operators import features as FT
from cadence.spec import PanelSpec

SPEC = PanelSpec(name=None)


def _series(spark, col, values, entity="AAA", start=2000):
    return spark.createDataFrame([(entity, start + i, None if v is None else float(v)) for i, v in enumerate(values)],
                                 f"entity string, period int, {col} double")


def _col(df, c):
    return [r[c] for r in df.orderBy("entity", "period").collect()]


def test_rolling_mean_three_rows_min_one(spark):
    df = _series(spark, "cdi_raw", [90, 92, 88, 91, 89])
    out = _col(FT.rolling_mean(df, SPEC, "cdi_raw", "cdi_smooth", 3, 1), "cdi_smooth")
    assert out[:3] == pytest.approx([90.0, 91.0, 90.0])
    assert out[3] == pytest.approx((92 + 88 + 91) / 3)


def test_rolling_std_five_rows_min_three(spark):
    vals = [5, 4.5, 5.5, 3, 6, 4, 5]
    df = _series(spark, "gdp_growth", vals)
    out = _col(FT.rolling_std(df, SPEC, "gdp_growth", "v", 5, 3), "v")
    assert out[0] is None and out[1] is None
    import statistics
    assert out[2] == pytest.approx(statistics.stdev(vals[:3]))
    assert out[6] == pytest.approx(statistics.stdev(vals[2:7]))


def test_lag_uses_previous_row_only(spark):
    df = _series(spark, "cdi_smooth", [90, 92, 88, 91, 89])
    out = _col(FT.add_lags(df, SPEC, ["cdi_smooth"]), "cdi_smooth_lag1")
    assert out[:3] == [None, 90.0, 92.0]


def test_lag_does_not_cross_entities(spark):
    a = _series(spark, "x", [1, 2], "A")
    b = _series(spark, "x", [10, 20], "B")
    out = FT.add_lags(a.unionByName(b), SPEC, ["x"]).orderBy("entity", "period").collect()
    assert [r["x_lag1"] for r in out] == [None, 1.0, None, 10.0]


def test_capped_sum_nulls_as_zero_and_cap(spark):
    df = spark.createDataFrame([("A", 2000, 40.0, 30.0, 20.0, 8.0), ("B", 2000, 50.0, None, 20.0, 10.0),
                                ("C", 2000, 60.0, 50.0, 10.0, 5.0), ("D", 2000, None, None, None, None)],
                               "entity string, period int, fuel_exports_pct double, metals_exports_pct double, "
                               "agri_exports_pct double, food_exports_pct double")
    out = _col(FT.capped_sum(df), "cdi_raw")
    assert out == [98.0, 80.0, 100.0, 0.0]


def test_row_mean_ignores_nulls(spark):
    df = spark.createDataFrame([("A", 1, 1.0, None, 3.0), ("B", 1, None, None, None)],
                               "entity string, period int, control_corruption double, govt_effectiveness double, "
                               "political_stability double")
    out = _col(FT.row_mean(df), "governance_index")
    assert out == [2.0, None]


def test_pct_change_pad_and_zero_base(spark):
    df = _series(spark, "x", [100, None, 110, 0, 5])
    pad = _col(FT.pct_change(df, SPEC, "x", "g", pad=True), "g")
    assert pad[0] is None and pad[1] == pytest.approx(0.0) and pad[2] == pytest.approx(10.0)
    assert pad[3] == pytest.approx(-100.0) and pad[4] is None  # zero base -> NULL, not inf
    nopad = _col(FT.pct_change(df, SPEC, "x", "g", pad=False), "g")
    assert nopad[1] is None and nopad[2] is None


def test_log_offset_and_exp_back(spark):
    df = _series(spark, "gdp_volatility", [0.0, 1.0])
    out = FT.exp_back(FT.log_offset(df))
    vals = out.orderBy("period").collect()
    assert vals[0]["log_gdp_volatility"] == pytest.approx(math.log(0.01))
    assert vals[1]["gdp_volatility_est"] == pytest.approx(1.01)  # offset not removed


def test_interpolate_linear_leading_trailing(spark):
    df = _series(spark, "v", [None, 1, None, None, 4, None])
    out = FT.interpolate(df, SPEC, "v", "v2", drop_missing=True).orderBy("period").collect()
    assert [r["v2"] for r in out] == pytest.approx([1.0, 2.0, 3.0, 4.0, 4.0])
    assert out[0]["period"] == 2001  # leading null dropped


def test_zscore_population_std_and_constant(spark):
    df = spark.createDataFrame([("A", i, float(v), 7.0) for i, v in enumerate([1, 2, 3])],
                               "entity string, period int, x double, c double")
    out = FT.zscore(df, ["x", "c"]).orderBy("period").collect()
    assert [r["x_z"] for r in out] == pytest.approx([-math.sqrt(1.5), 0.0, math.sqrt(1.5)])
    assert [r["c_z"] for r in out] == [0.0, 0.0, 0.0]


def test_feature_set_shares_one_shuffle(spark):
    df = spark.createDataFrame([("A", i, float(i), float(i % 3), 1.0) for i in range(10)],
                               "entity string, period int, cdi_raw double, gdp_growth double, inflation double")
    plan = FT.feature_set(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_skew_safe_positions_lag_and_rolling(spark):
    from pyspark.sql import functions as F

    from cadence.operators import split as SP
    rows = [("HOT", p, float((p * 37) % 11)) for p in range(3000)] + [("B", p, float(p)) for p in range(7)]
    df = spark.createDataFrame(rows, "entity string, period int, x double")
    # range partitioning on (entity, period) spreads the hot entity over several tasks
    ranged = df.repartitionByRange(12, "entity", "period").withColumn("p", F.spark_partition_id())
    assert ranged.filter("entity = 'HOT'").select("p").distinct().count() > 1
    pos = SP.entity_positions(df, SPEC, partitions=12).cache()
    assert all(r["pos"] == r["period"] for r in pos.collect())
    joined = FT.rolling_join(FT.lag_join(pos, SPEC, ["x"]), SPEC, "x", "v", 5, 3, "std")
    windowed = FT.rolling_std(FT.add_lags(df, SPEC, ["x"]), SPEC, "x", "v", 5, 3)
    a = {(r["entity"], r["period"]): (r["x_lag1"], r["v"]) for r in joined.collect()}
    b = {(r["entity"], r["period"]): (r["x_lag1"], r["v"]) for r in windowed.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        assert (a[k][1] is None and b[k][1] is None) or a[k][1] == pytest.approx(b[k][1])
