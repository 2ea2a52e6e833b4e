"""Cleaning and quality operators (D1-D9) on small hand-made panels."""

import pytest

from cadence.operators import clean as CL
from cadence.spec import PanelSpec

SPEC = PanelSpec(name=None)


@pytest.fixture
def panel(spark):
    rows = [("A", 2000, 1.0, 10.0, 0.5), ("A", 2001, None, 20.0, 0.6), ("A", 2002, 3.0, None, None),
            ("B", 2000, None, 5.0, 0.1), ("B", 2001, None, 7.0, 0.2),
            ("C", 2000, 10.0, 1.0, 0.3), ("C", 2001, 30.0, 2.0, 0.4)]
    return spark.createDataFrame(rows, "entity string, period int, x double, y double, log_gdp_volatility double")


def test_impute_median_entity_then_global(spark, panel):
    out = {(r["entity"], r["period"]): r for r in CL.impute(panel, SPEC, "median", cols=["x", "y"], target=None).collect()}
    assert out[("A", 2001)]["x"] == 2.0  # entity median of 1, 3
    assert out[("A", 2002)]["y"] == 15.0
    # B has no x at all: global median of the entity-filled column (1, 2, 3, 10, 30) = 3
    assert out[("B", 2000)]["x"] == 3.0 and out[("B", 2001)]["x"] == 3.0


def test_impute_drops_missing_target(spark, panel):
    out = CL.impute(panel, SPEC, "median", cols=["x", "y"])
    assert out.count() == 6


def test_forward_then_backward_fill(spark, panel):
    out = {(r["entity"], r["period"]): r for r in
           CL.impute(panel, SPEC, "forward_fill", cols=["x", "y"], target=None).collect()}
    assert out[("A", 2001)]["x"] == 1.0 and out[("A", 2002)]["y"] == 20.0
    assert out[("B", 2000)]["x"] is None  # nothing to fill from


def test_iqr_cap_threshold(spark):
    df = spark.createDataFrame([(float(v),) for v in list(range(1, 10)) + [100]] + [(None,)], "value double")
    out = [r["value"] for r in CL.iqr_cap(df, ["value"], 1.5).collect()]
    # q1 = 3.25, q3 = 7.75 (linear) -> upper = 14.5
    assert max(v for v in out if v is not None) == pytest.approx(14.5)
    assert None in out


def test_zscore_filter_drops_outlier_and_nulls(spark):
    vals = [1.0] * 10 + [2.0] * 10 + [100.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert CL.zscore_filter(df, ["v"], 3.0).count() == 20


def test_validate_ok_duplicates_and_ranges(spark):
    ok = spark.createDataFrame([("A", y, 50.0, 0.5) for y in (2000, 2001, 2002)],
                               "entity string, period int, cdi_smooth_lag1 double, log_gdp_volatility double")
    res = {r["check"]: r["passed"] for r in CL.validate(ok, SPEC).collect()}
    assert all(res.values())
    dup = ok.unionByName(ok.limit(1))
    assert {r["check"]: r["passed"] for r in CL.validate(dup, SPEC).collect()}["no_duplicates"] is False
    bad = spark.createDataFrame([("A", 2000, 150.0, 0.5)], ok.schema)
    r2 = {r["check"]: r["passed"] for r in CL.validate(bad, SPEC).collect()}
    assert r2["valid_ranges"] is False and r2["sufficient_data"] is False


def test_quality_score_penalties(spark):
    rows = [("A", y, 1.0, None) for y in range(5)]
    df = spark.createDataFrame(rows, "entity string, period int, gdp_growth double, inflation double")
    caution = spark.createDataFrame([("A", "conflict")], "entity string, reason string")
    r = CL.quality_score(df, SPEC, caution, cols=["gdp_growth", "inflation"]).first()
    # 100 - (10 - 5) * 5 - 50 % missing - 20 = 5
    assert r["quality_score"] == 5.0 and r["quality_level"] == "Low" and r["has_caution"]
    assert r["period_range"] == "0-4"


def test_missing_report_sorted_and_positive(spark, panel):
    out = CL.missing_report(panel).collect()
    # x has 3 nulls; y and log_gdp_volatility 1 each (ties by name)
    assert [(r["column"], r["missing"]) for r in out] == [("x", 3), ("log_gdp_volatility", 1), ("y", 1)]
    assert out[0]["missing_pct"] == pytest.approx(42.9)
    assert all(r["missing"] > 0 for r in out)


def test_duplicates_group_null_keys(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), (None, 2), (None, 2), ("B", 3)], "k string, v int")
    assert CL.duplicates(df, ["k", "v"]).count() == 2
