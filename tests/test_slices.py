"""Sliced windows give what whole-entity windows give, with the rows of a long entity in many tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.functions import lagged as LG
from cadence.operators import clean as CL
from cadence.operators import features as FT
from cadence.operators import series as TS
from cadence.operators import slices as SC
from cadence.spec import PanelSpec

SPEC = PanelSpec(name=None)
COLS = ["exchange_rate", "cdi_raw", "gdp_growth", "inflation"]


@pytest.fixture(scope="module")
def panel(spark):
    r = np.random.default_rng(4)
    rows = []
    for entity, n in (("hot", 120), ("a", 31), ("b", 7), ("c", 1), ("void", 25)):
        for t in range(n):
            if entity == "hot" and 30 <= t < 75:  # a gap longer than several slices
                gap = True
            else:
                gap = r.random() < 0.2
            v = [None if gap or entity == "void" else float(x) for x in r.normal(10, 3, 4).round(3)]
            rows.append((entity, 2 * t, *v))
    return spark.createDataFrame(rows, "entity string, period int, exchange_rate double, cdi_raw double, gdp_growth double, inflation double").cache()


CASES = {
    "ingest": lambda p: FT.ingest_derivations(p, SPEC).drop("governance_index"),
    "features": lambda p: FT.feature_set(p, SPEC),
    "mean": lambda p: FT.rolling_mean(p, SPEC, "cdi_raw", "x", 5, 2),
    "by range": lambda p: FT.rolling_std(p, SPEC, "cdi_raw", "x", 5, 2, by_range=True),
    "pct": lambda p: FT.pct_change(FT.pct_change(p, SPEC, "cdi_raw", "x"), SPEC, "cdi_raw", "z", pad=False),
    "lead": lambda p: FT.add_lead(p, SPEC, "gdp_growth", "x", 3),
    "lags": lambda p: FT.add_lags(p, SPEC, ["gdp_growth", "inflation"], 4),
    "interpolate": lambda p: FT.interpolate(p, SPEC, "gdp_growth", "x", drop_missing=False),
    "fill": lambda p: CL.impute(p, SPEC, "forward_fill", COLS, target=None),
    "decompose": lambda p: TS.decompose(TS.prepare(p, SPEC, "gdp_growth"), SPEC),
    "decompose 6": lambda p: TS.decompose(TS.prepare(p, SPEC, "gdp_growth"), SPEC, 6),
    "acf": lambda p: TS.acf(TS.prepare(p, SPEC, "gdp_growth"), SPEC),
    "adf design": lambda p: TS.adf_design(TS.prepare(p, SPEC, "gdp_growth"), SPEC, 3),
    "adf": lambda p: TS.adf(TS.prepare(p, SPEC, "gdp_growth"), SPEC),
    "lag windows": lambda p: LG.windows(TS.prepare(p, SPEC, "gdp_growth"), SPEC, 9),
}


def flat(v):
    return [x for e in v for x in flat(e)] if isinstance(v, (list, tuple)) else [v]


@pytest.mark.parametrize("case", CASES)
def test_slices_change_nothing(panel, case, monkeypatch):
    keys = ["entity", "period"] if case not in ("acf", "adf") else ["entity"]
    whole = CASES[case](panel)
    by = keys + (["lag"] if case == "acf" else [])
    want = [r.asDict() for r in whole.orderBy(*by).collect()]
    monkeypatch.setattr(SC, "SLICE_ROWS", 11)
    sliced = CASES[case](panel)
    got = [r.asDict() for r in sliced.orderBy(*by).collect()]
    assert sorted(sliced.columns) == sorted(whole.columns) and len(got) == len(want)
    for a, b in zip(got, want):
        for c in b:
            x, y = flat(a[c]), flat(b[c])
            assert len(x) == len(y)
            for u, v in zip(x, y):
                assert u == v or u == pytest.approx(v, rel=1e-9, abs=1e-9), (case, b, c, a[c])


def test_a_hot_entity_spreads_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(SC, "SLICE_ROWS", 500)
    df = spark.range(9000).select(F.lit("hot").alias("entity"), F.col("id").cast("int").alias("period"), (F.col("id") % 7).cast("double").alias("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # 9000 rows would fit one task
    try:
        out = FT.rolling_mean(df, SPEC, "x", "m", 4, 1)
        sizes = [n for n in out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 9000 and len(sizes) > 3 and max(sizes) < 9000 / 2


def test_an_empty_panel(spark):
    df = spark.createDataFrame([], "entity string, period int, x double")
    assert FT.rolling_mean(df, SPEC, "x", "m", 3, 1).count() == 0 and FT.interpolate(df, SPEC, "x").count() == 0
