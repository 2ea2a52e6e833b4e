"""Fitted tree ensembles as flat arrays: scores of all trees and Shapley values in one vectorised pass.

``flatten`` reads a fitted Spark forest or booster from the files it saves itself to (one row per node, with the
training rows that reached it) into numpy arrays.  Their size is checked before they are broadcast: it depends on trees and
depth, never on the data.  Scoring and explaining are then narrow jobs over Arrow batches.

Shapley values are path dependent: a coalition's value follows the row where a split's feature is in the coalition, and
otherwise weighs both branches by their training rows.  For one leaf only the distinct features on its path matter,
and of a row only which of their conditions it meets.  So each leaf gets a table of one contribution per feature for each such
pattern, from the weights of the path (the coefficients of the product over its features of share + met * t), and a
row costs a look-up per leaf.  Base value plus contributions is the prediction, for every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.sources import files as FS

MAX_NODES = 1 << 20
MAX_BYTES = 256 << 20
MAX_PATH = 12  # distinct features on one path: a leaf's table has 2^this rows
ROWS = 4096  # rows scored at a time


@dataclass
class FlatTrees:
    """Nodes of all trees end to end; a leaf's ``feature`` is -1; ``left`` and ``right`` are positions."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    weights: np.ndarray
    n_features: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): every tree's unweighted prediction."""
        at = np.repeat(self.roots[None, :], len(x), 0)
        row = np.arange(len(x))[:, None]
        while (inner := self.feature[at] >= 0).any():
            goes_left = x[row, np.maximum(self.feature[at], 0)] <= self.threshold[at]
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
        return self.value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x) @ self.weights

    def leaves(self) -> list["Leaf"]:
        out = []
        for tree, root in enumerate(self.roots):
            stack = [(int(root), {})]
            while stack:
                node, path = stack.pop()
                j = int(self.feature[node])
                if j < 0:
                    out.append(Leaf.of(float(self.value[node] * self.weights[tree]), path))
                    continue
                low, high, share = path.get(j, (-np.inf, np.inf, 1.0))
                cut, whole = float(self.threshold[node]), float(self.cover[node])
                for child, bounds in ((self.left[node], (low, min(high, cut))), (self.right[node], (max(low, cut), high))):
                    stack.append((int(child), path | {j: (*bounds, share * float(self.cover[child]) / whole)}))
        return out


@dataclass
class Leaf:
    """The distinct features on a leaf's path with their conditions, and contributions by the pattern of conditions met."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    table: np.ndarray
    base: float

    @staticmethod
    def of(value: float, path: dict[int, tuple[float, float, float]]) -> "Leaf":
        d = len(path)
        if d > MAX_PATH:
            raise ValueError(f"a path with more than {MAX_PATH} features")
        low, high, share = (np.array([p[k] for p in path.values()], float) for k in range(3))
        met = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
        table = np.zeros((1 << d, d))
        for i in range(d):
            ways = np.ones((1 << d, 1))  # coefficients: coalitions of the other features, by size
            for j in range(d):
                if j != i:
                    ways = np.pad(ways * share[j], ((0, 0), (0, 1))) + np.pad(ways * met[:, j:j + 1], ((0, 0), (1, 0)))
            weight = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
            table[:, i] = value * (met[:, i] - share[i]) * (ways @ weight)
        return Leaf(np.array(list(path), int), low, high, table, value * float(np.prod(share)))


@dataclass
class Explainer:
    base: float
    leaves: list[Leaf]
    n_features: int

    @staticmethod
    def of(trees: FlatTrees) -> "Explainer":
        leaves = trees.leaves()
        return Explainer(math.fsum(leaf.base for leaf in leaves), leaves, trees.n_features)

    def nbytes(self) -> int:
        return sum(leaf.table.nbytes + 3 * leaf.low.nbytes + 256 for leaf in self.leaves)

    def values(self, x: np.ndarray) -> np.ndarray:
        """(rows, features): what each feature adds to the base value."""
        phi = np.zeros((len(x), self.n_features))
        for leaf in self.leaves:
            if len(leaf.features):
                own = x[:, leaf.features]
                met = ((own <= leaf.high) | (leaf.high == np.inf)) & ~(own <= leaf.low)
                phi[:, leaf.features] += leaf.table[met @ (1 << np.arange(len(leaf.features)))]
        return phi


def flatten(spark: SparkSession, model, n_features: int) -> FlatTrees:
    """Arrays of a fitted ``GBTRegressionModel`` or ``RandomForestRegressionModel``."""
    path = FS.scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    saved = spark.read.load(f"{path}/data").select("treeID", "nodeData.*")
    if saved.count() > MAX_NODES:
        raise ValueError("the ensemble has too many nodes to be broadcast")
    n = {}
    rows = saved.select("treeID", "id", "prediction", F.element_at("impurityStats", 1).alias("cover"), "leftChild", "rightChild",
                        F.col("split.featureIndex").alias("feature"), F.col("split.numCategories").alias("kinds"),
                        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("cut")).orderBy("treeID", "id").collect()
    if any(r["kinds"] >= 0 for r in rows):
        raise ValueError("splits by category are not supported")
    for k, r in enumerate(rows):
        n[r["treeID"], r["id"]] = k
    child = {c: np.array([n.get((r["treeID"], r[c]), -1) for r in rows], np.int64) for c in ("leftChild", "rightChild")}
    leaf = child["leftChild"] < 0
    trees = sorted({r["treeID"] for r in rows})
    # a booster adds its trees by their weights, a forest takes the mean
    weights = np.array(model.treeWeights, float) if hasattr(model, "evaluateEachIteration") else np.full(len(trees), 1.0 / len(trees))
    return FlatTrees(np.array([n[t, 0] for t in trees], np.int64), np.where(leaf, -1, [r["feature"] for r in rows]),
                     np.array([0.0 if r["cut"] is None else r["cut"] for r in rows]), child["leftChild"], child["rightChild"],
                     np.array([r["prediction"] for r in rows]), np.array([r["cover"] for r in rows], float), weights, n_features)


def _matrix(b: pa.RecordBatch, first: int, count: int) -> np.ndarray:
    return np.column_stack([b.column(first + j).to_numpy(zero_copy_only=False).astype(float) for j in range(count)])


def map_rows(df: DataFrame, features: Sequence[Column], shared, compute, new: Sequence[tuple[str, str]]) -> DataFrame:
    """``df`` with columns appended that ``compute(shared, x)`` gives for the rows' feature matrix; rows with a null feature go."""
    n, m = len(df.columns), len(features)
    wide = df.select("*", *[f.cast("double").alias(f"__x{j}") for j, f in enumerate(features)]).na.drop("any", subset=[f"__x{j}" for j in range(m)])
    schema = T.StructType([*df.schema.fields, *T._parse_datatype_string(", ".join(f"{c} {t}" for c, t in new)).fields])
    sent, names = df.sparkSession.sparkContext.broadcast(shared), [*df.columns, *(c for c, _ in new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                made = compute(sent.value, _matrix(part, n, m))
                cols = [pa.array(list(c)) if c.ndim > 1 else pa.array(c) for c in made]
                yield pa.RecordBatch.from_arrays([part.column(j) for j in range(n)] + cols, names=names)

    return wide.mapInArrow(run, schema)


def shapley(df: DataFrame, features: Sequence[Column], explainer: Explainer) -> DataFrame:
    """``df`` with ``phi`` (array, in the order of the features); nothing moves between tasks."""
    if explainer.nbytes() > MAX_BYTES:
        raise ValueError("the ensemble's tables are too large to be broadcast")
    return map_rows(df, features, explainer, lambda e, x: [e.values(x)], [("phi", "array<double>")])


def member_spread(df: DataFrame, features: Sequence[Column], trees: FlatTrees, staged: bool) -> DataFrame:
    """``df`` with ``prediction`` and ``__std``, the population deviation of the trees' predictions, or (``staged``) of the
    running sums of a booster's trees."""
    def compute(t: FlatTrees, x: np.ndarray):
        members = t.scores(x)
        return [members @ t.weights, (np.cumsum(members * t.weights, 1) if staged else members).std(1)]

    return map_rows(df, features, trees, compute, [("prediction", "double"), ("__std", "double")])
