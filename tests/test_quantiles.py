"""Distributed selection against numpy, also when one group or one value holds most of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.operators import clean as CL
from cadence.operators import quantiles as QU
from cadence.operators import split as SP
from cadence.spec import PanelSpec

PS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def made(seed, n):
    r = np.random.default_rng(seed)
    group = np.where(r.random(n) < 0.4, "hot", r.integers(0, 9, n).astype(str))
    a = np.where(r.random(n) < 0.3, 5.0, r.normal(size=n).round(2))  # one value holds a third of the rows
    b = r.integers(-3, 3, n)
    return [(None if g == "8" else str(g), None if r.random() < 0.1 else float(x), None if g == "7" else int(y)) for g, x, y in zip(group, a, b)]


@pytest.mark.parametrize("n,partitions", [(1, 3), (2, 1), (7, 5), (2000, 1), (2000, 13), (2000, 64)])
def test_against_numpy(spark, n, partitions):
    rows = made(n, n)
    df = spark.createDataFrame(rows, "g string, a double, b int").repartition(4)
    got = {(r["g"], r["column"]): [r[f"q{k}"] for k in range(len(PS))] for r in QU.quantiles(df, ["a", "b"], PS, ["g"], partitions).collect()}
    want = {}
    for g in {x[0] for x in rows}:
        for k, c in ((1, "a"), (2, "b")):
            if own := [x[k] for x in rows if x[0] == g and x[k] is not None]:
                want[g, c] = np.quantile(own, PS)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-12), k
    whole = QU.of_columns(df, ["a", "b"], [0.5])
    for k, c in ((1, "a"), (2, "b")):
        own = [x[k] for x in rows if x[k] is not None]
        assert (whole[c] is None and not own) or whole[c][0] == pytest.approx(np.median(own))


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([("x", None, 1.0), ("y", None, 2.0)], "g string, a double, b double")
    assert QU.of_columns(df, ["a", "b"], [0.5]) == {"a": None, "b": [1.5]}
    assert QU.of_columns(df.limit(0), ["a", "b"], [0.5]) == {"a": None, "b": None}
    assert [tuple(r) for r in QU.medians(df, ["a", "b"], ["g"], "m_").orderBy("g").collect()] == [("x", None, 1.0), ("y", None, 2.0)]


def test_a_hot_column_spreads_over_tasks(spark):
    """One group with all rows: no task holds more than a small share of the values."""
    df = spark.range(40_000).select(F.lit("only").alias("g"), (F.col("id") * 7919 % 40_009).cast("double").alias("a"))
    seen = []
    real = QU.materialize

    def watched(x):
        out = real(x)
        seen.append([r["n"] for r in out.groupBy("__pid").agg(F.sum("__n").alias("n")).collect()])
        return out

    QU.materialize = watched
    try:
        (row,) = QU.quantiles(df, ["a"], [0.5], ["g"], 16).collect()
    finally:
        QU.materialize = real
    assert row["q0"] == np.median(np.arange(40_000) * 7919 % 40_009)
    assert len(seen[0]) == 16 and max(seen[0]) < 3 * 40_000 / 16


def test_no_percentile_aggregate_is_planned(spark, capsys):
    df = spark.createDataFrame([("x", 1, 1.0, 1.0), ("x", 2, None, 2.0)], "entity string, period int, a double, log_gdp_volatility double")
    CL.impute(df, PanelSpec("entity", "period"), "median", ["a"]).explain()
    assert "percentile" not in capsys.readouterr().out.lower()


def test_split_by_period(spark):
    df = spark.createDataFrame([("x", p) for p in range(10)], "entity string, period int")
    out = SP.ordered_split(df, PanelSpec("entity", "period"), 0.2, by="period")
    assert out.where("is_train").count() == 7
    assert SP.ordered_split(df.limit(0), PanelSpec("entity", "period"), 0.2, by="period").count() == 0
