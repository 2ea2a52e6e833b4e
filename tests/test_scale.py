"""Results that must not depend on the number of entities or the unit of measure."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.operators import evaluate as EV
from cadence.operators import series as TS
from cadence.operators import split as SP
from cadence.spec import PanelSpec

SPEC = PanelSpec(entity="entity", period="period", name=None, measures=("y",))


@pytest.mark.parametrize("entities, partitions", [(5_000, 8), (200_000, 8), (200_000, 200)])
def test_ordinals_are_exactly_the_row_numbers(spark, entities, partitions):
    df = spark.range(2 * entities - 1).select((F.col("id") / 2).cast("long").cast("string").alias("entity"), (F.col("id") % 2).cast("int").alias("period"),
                                              F.col("id").cast("double").alias("y")).repartition(7)
    got = SP.global_ordinal(df, SPEC, partitions=partitions)
    s = got.agg(F.count("*").alias("n"), F.countDistinct("ordinal").alias("d"), F.min("ordinal").alias("low"), F.max("ordinal").alias("high")).head()
    assert (s.n, s.d, s.low, s.high) == (2 * entities - 1, 2 * entities - 1, 0, 2 * entities - 2)


def series(spark, unit):
    rng = np.random.default_rng(3)
    y = (np.arange(24) * 0.7 + rng.normal(0, 1, 24) + np.tile([0, 1, 2, -1], 6)) * unit
    return spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "entity string, period int, y double")


@pytest.mark.parametrize("unit", [1e-9, 1e9])
def test_trend_and_parts_do_not_depend_on_the_unit(spark, unit):
    one, other = series(spark, 1.0), series(spark, unit)
    a, b = (TS.trend_stats(x, SPEC).head() for x in (one, other))
    assert b.r2 == pytest.approx(a.r2, rel=1e-9) and b.slope == pytest.approx(a.slope * unit, rel=1e-9)
    assert b.std_err == pytest.approx(a.std_err * unit, rel=1e-9)
    a, b = (TS.variance_shares(TS.decompose(x, SPEC), SPEC).head() for x in (one, other))
    for c in ("trend_var_pct", "seasonal_var_pct", "resid_var_pct"):
        assert b[c] == pytest.approx(a[c], rel=1e-9)


def test_small_percentage_errors_are_kept(spark):
    rows = [("m", float(i + 1), float(i + 1) * (1 + 1e-14)) for i in range(50)]
    got = EV.metrics(spark.createDataFrame(rows, "model string, y double, yhat double")).head()
    assert got.mape == pytest.approx(100 * np.mean([abs(a - b) / a for _, a, b in rows]), rel=1e-6) and got.mape > 0
