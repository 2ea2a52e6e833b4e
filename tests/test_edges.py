"""Edge cases: empty input, single-row and all-null entities, gaps, ties, zero denominators."""

import pytest
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators import clean as CL
from cadence.operators import evaluate as EV
from cadence.operators import features as FT
from cadence.operators import series as TS
from cadence.operators import summary as SM
from cadence.spec import PanelSpec, require

SPEC = PanelSpec(name=None)
SCHEMA = "entity string, period int, x double, log_gdp_volatility double"


def test_empty_panel_operators(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert FT.rolling_std(df, SPEC, "x", "v", 5, 3).count() == 0
    assert CL.impute(df, SPEC, "median", cols=["x"]).count() == 0
    ov = SM.overview(df, SPEC).first()
    assert ov["n_rows"] == 0 and ov["first_period"] is None
    checks = {r["check"]: r["passed"] for r in CL.validate(df, SPEC).collect()}
    assert checks["no_duplicates"] and checks["sufficient_data"]
    assert SM.histogram(df, "x").count() == 0


def test_single_row_and_all_null_entity(spark):
    df = spark.createDataFrame([("ONE", 2000, 5.0, 1.0), ("NUL", 2000, None, 1.0), ("NUL", 2001, None, 1.0),
                                ("B", 2000, 1.0, 1.0), ("B", 2001, 3.0, 1.0)], SCHEMA)
    vol = {(r["entity"], r["period"]): r["v"] for r in FT.rolling_std(df, SPEC, "x", "v", 5, 2).collect()}
    assert vol[("ONE", 2000)] is None and vol[("B", 2001)] == pytest.approx(2 ** 0.5)
    imp = {(r["entity"], r["period"]): r["x"] for r in CL.impute(df, SPEC, "median", cols=["x"]).collect()}
    assert imp[("NUL", 2000)] == 3.0  # global median of the entity-filled column (5, 1, 3)
    m = EV.metrics(spark.createDataFrame([("m", 2.0, 1.0)], "model string, y double, yhat double")).first()
    assert m["r2"] is None and m["adj_r2"] is None and m["rmse"] == 1.0


def test_windows_count_rows_not_periods(spark):
    df = spark.createDataFrame([("A", p, float(v), 0.0) for p, v in [(2000, 1), (2001, 2), (2010, 3)]], SCHEMA)
    by_rows = FT.rolling_mean(df, SPEC, "x", "m", 3, 1).orderBy("period").collect()
    by_range = FT.rolling_mean(df, SPEC, "x", "m", 3, 1, by_range=True).orderBy("period").collect()
    assert by_rows[2]["m"] == pytest.approx(2.0)  # the gap still counts as adjacent rows
    assert by_range[2]["m"] == pytest.approx(3.0)  # period range excludes 2000-2001


def test_top_n_ties_broken_by_entity(spark):
    df = spark.createDataFrame([(e, 1, 5.0, 0.0) for e in ["C", "A", "B"]] + [("D", 1, 1.0, 0.0)], SCHEMA)
    out = [r["entity"] for r in SM.top_n(df, SPEC, "x", 2).collect()]
    assert out == ["A", "B"]


def test_zero_denominators_are_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (0.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(X.share("a", "b")).collect()] == [None, None, 0.0]


def test_trend_skips_entities_below_minimum(spark):
    df = spark.createDataFrame([("A", p, float(p), 0.0) for p in range(4)], SCHEMA)
    assert TS.trend(TS.prepare(df, SPEC, "x"), SPEC).count() == 0


def test_column_check_minimum(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert require(df, ["x", "missing"], minimum=1) == ["x"]
    with pytest.raises(ValueError):
        require(df, ["missing", "other"], minimum=1)
    with pytest.raises(ValueError):
        SM.entity_means(df, SPEC, ["x", "nope1", "nope2"], minimum=3)


def test_quartile_bucket_lowest_included(spark):
    df = spark.createDataFrame([("A", i, float(v), 0.0) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8])], SCHEMA)
    lab = {r["x"]: r["q"] for r in SM.quartile_bucket(df, "x", "q").collect()}
    assert lab[1.0] == "Q1 (Low)" and lab[8.0] == "Q4 (High)"
    assert sum(1 for v in lab.values() if v == "Q1 (Low)") == 2


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([("A", i, float(i), 0.0) for i in range(31)], SCHEMA)
    h = {r["bin"]: r["n"] for r in SM.histogram(df, "x", 30).collect()}
    assert sum(h.values()) == 31 and h[30] == 2 and min(h) == 1
