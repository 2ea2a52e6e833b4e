"""Flattened ensembles against Spark's own predictions and against enumerated coalitions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from cadence.operators import explain as XP
from cadence.operators import trees as TR

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = x[:, 0] * 2 + np.where(x[:, 1] > 0, x[:, 2], -x[:, 3]) + 0.1 * rng.normal(size=400)
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id int, a double, b double, c double, d double, y double")


def fitted(rows, kind):
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    est = (GBTRegressor(labelCol="y", maxIter=6, maxDepth=4, stepSize=0.3, subsamplingRate=0.8, seed=1) if kind == "gbt"
           else RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=5, seed=1))
    model = est.fit(data)
    return model, {r["id"]: r["prediction"] for r in model.transform(data).collect()}


def game(flat, x):
    """Path-dependent values by following every tree for every coalition."""
    def value(node, inside):
        j = flat.feature[node]
        if j < 0:
            return flat.value[node]
        left, right = flat.left[node], flat.right[node]
        if j in inside:
            return value(left if x[j] <= flat.threshold[node] else right, inside)
        return (flat.cover[left] * value(left, inside) + flat.cover[right] * value(right, inside)) / flat.cover[node]

    p = flat.n_features
    v = {s: sum(w * value(r, set(s)) for r, w in zip(flat.roots, flat.weights)) for k in range(p + 1) for s in itertools.combinations(range(p), k)}
    phi = [sum(math.factorial(len(s)) * math.factorial(p - len(s) - 1) / math.factorial(p) * (v[tuple(sorted((*s, j)))] - v[s])
               for s in v if j not in s) for j in range(p)]
    return v[()], phi


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_scores_and_contributions(spark, rows, kind):
    model, want = fitted(rows, kind)
    flat = TR.flatten(spark, model, 4)
    x = np.array([[r[c] for c in FEATURES] for r in rows.orderBy("id").collect()])
    assert flat.predict(x) == pytest.approx([want[i] for i in range(len(x))], abs=1e-12)
    explainer = TR.Explainer.of(flat)
    phi = explainer.values(x)
    assert explainer.base + phi.sum(1) == pytest.approx(flat.predict(x), abs=1e-10)
    for i in range(0, 400, 37):
        base, own = game(flat, x[i])
        assert explainer.base == pytest.approx(base) and phi[i] == pytest.approx(own, abs=1e-10)


def test_a_feature_split_twice_on_a_path():
    # a <= 0 ? (a <= -1 ? 5 : 1) : (b <= 0 ? 2 : 8)
    flat = TR.FlatTrees(np.array([0]), np.array([0, 0, 1, -1, -1, -1, -1]), np.array([0.0, -1.0, 0.0, 0, 0, 0, 0]),
                        np.array([1, 3, 5, -1, -1, -1, -1]), np.array([2, 4, 6, -1, -1, -1, -1]), np.array([0, 0, 0, 5.0, 1.0, 2.0, 8.0]),
                        np.array([10.0, 4, 6, 1, 3, 4, 2]), np.array([1.0]), 2)
    explainer = TR.Explainer.of(flat)
    for x in ([-2.0, 1.0], [-0.5, 0.0], [3.0, 0.5], [0.0, -4.0], [float("nan"), float("nan")]):
        base, own = game(flat, np.array(x))
        assert explainer.values(np.array([x]))[0] == pytest.approx(own) and explainer.base == pytest.approx(base)


def test_rows_of_any_kind(spark, rows):
    model, _ = fitted(rows, "gbt")
    explainer = TR.Explainer.of(TR.flatten(spark, model, 4))
    odd = rows.limit(5).unionByName(rows.limit(2).withColumn("b", F.lit(None).cast("double")))
    got = XP.shapley_trees(odd, ["id", "y"], FEATURES, explainer)
    assert got.columns == ["id", "y", "feature", "phi"] and got.count() == 20  # rows with a null feature have no values
    assert XP.shapley_trees(rows.limit(0), ["id"], FEATURES, explainer).count() == 0
    report = XP.report(got.drop("y"), ["id"], explainer.base).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in report} == {"value": 20, "importance": 4, "driver": 15}


def test_member_spread(spark, rows):
    model, want = fitted(rows, "gbt")
    flat = TR.flatten(spark, model, 4)
    got = {r["id"]: r for r in TR.member_spread(rows, [F.col(c) for c in FEATURES], flat, True).collect()}
    x = np.array([[got[i][c] for c in FEATURES] for i in range(400)])
    std = np.cumsum(flat.scores(x) * flat.weights, 1).std(1)
    assert [got[i]["prediction"] for i in range(400)] == pytest.approx([want[i] for i in range(400)], abs=1e-12)
    assert [got[i]["__std"] for i in range(400)] == pytest.approx(std)


def test_spread_does_not_lose_small_differences():
    flat = TR.FlatTrees(np.arange(4), np.full(4, -1), np.zeros(4), np.full(4, -1), np.full(4, -1), 1e9 + np.array([0.0, 1.0, 2.0, 3.0]), np.ones(4),
                        np.full(4, 0.25), 1)
    assert flat.scores(np.zeros((1, 1))).std(1)[0] == pytest.approx(1.25 ** 0.5)


def test_too_large_models_are_refused(spark, rows, monkeypatch):
    model, _ = fitted(rows, "rf")
    monkeypatch.setattr(TR, "MAX_NODES", 10)
    with pytest.raises(ValueError):
        TR.flatten(spark, model, 4)
