"""Many k-means fits over one table at once.

Every (k, restart) is a set of centres; a round reads the scaled table once, gives each row to its nearest centre of
every fit that still moves and adds up count, sum and squared distance per centre.  Tasks put out one row
per centre they met, Spark adds them, and the driver sees one row per centre (at most ``max_k`` x restarts x ks).
A fit is done when none of its centres moved by more than ``TOL``; the others go on.  The start of each fit is drawn on
``SEEDS`` rows of the smallest key hashes (k-means++ on that fixed-size sample); all rows take part in every round.

Rows with a null feature take no part.  Of equally near centres the first is taken; a centre without rows stays.
With fewer different seed rows than k, centres repeat and the later copies stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEEDS = 4096
TOL, ROUNDS = 1e-4, 300
BLOCK = 2048  # rows per distance matrix


@dataclass
class Fit:
    k: int
    restart: int
    centers: np.ndarray
    cost: float = float("inf")
    counts: np.ndarray | None = None
    means: np.ndarray | None = None
    squares: np.ndarray | None = None  # mean squared norm of each centre's rows
    done: bool = False


def first_centers(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each further centre with a chance by its squared distance to the nearest so far."""
    own = [sample[rng.integers(len(sample))]]
    for _ in range(1, k):
        far = np.min([((sample - c) ** 2).sum(1) for c in own], axis=0)
        own.append(sample[rng.choice(len(sample), p=far / far.sum()) if far.sum() > 0 else 0])
    return np.array(own)


def distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centers[None, :, :]) ** 2).sum(-1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
        for at in range(0, len(x), BLOCK):
            yield x[at:at + BLOCK]


def _round(z: DataFrame, fits: list[Fit]) -> dict[tuple[int, int], tuple]:
    """(fit, centre) -> count, sums, squared norms, squared distances: one pass over the rows."""
    p = len(z.columns)
    centers = [f.centers for f in fits]  # small: k x restarts x p numbers
    schema = "fit int, centre int, n long, norm double, cost double, " + ", ".join(f"s{j} double" for j in range(p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((len(c), 3 + p)) for c in centers]
        for x in _rows(batches):
            norm = (x ** 2).sum(1)
            for i, c in enumerate(centers):
                d = distances(x, c)
                near = d.argmin(1)
                terms = np.column_stack([np.ones(len(x)), norm, d[np.arange(len(x)), near], x])
                np.add.at(held[i], near, terms)
        out = [(i, j, int(h[0]), *map(float, h[1:])) for i, own in enumerate(held) for j, h in enumerate(own) if h[0]]
        columns = list(zip(*out)) or [()] * (5 + p)
        types = [pa.int32(), pa.int32(), pa.int64()] + [pa.float64()] * (2 + p)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["fit", "centre", "n", "norm", "cost", *[f"s{j}" for j in range(p)]])

    sums = z.mapInArrow(run, schema).groupBy("fit", "centre").agg(*[F.sum(c).alias(c) for c in ["n", "norm", "cost", *[f"s{j}" for j in range(p)]]])
    return {(r.fit, r.centre): (r.n, np.array([r[f"s{j}"] for j in range(p)]), r.norm, r.cost) for r in sums.collect()}


def search(z: DataFrame, key: str, zcols: Sequence[str], ks: Sequence[int], restarts: int, seed: int = 42,
           rounds: int = ROUNDS) -> dict[int, Fit]:
    """The fit of least cost for each k; ``z`` should be materialised, each round reads it once.

    Centres, counts, means and costs all belong to the same last assignment."""
    rows = z.select(*[F.col(c).cast("double").alias(c) for c in zcols], F.xxhash64(F.col(key), F.lit(seed)).alias("__h")).na.drop()
    sample = np.array([r[:-1] for r in rows.orderBy("__h", *zcols).limit(SEEDS).collect()], float)
    if not len(sample):
        return {}
    rows = rows.drop("__h")
    fits = [Fit(k, r, first_centers(sample, k, np.random.default_rng((seed, k, r)))) for k in ks for r in range(restarts)]
    for at in range(rounds):
        moving = [f for f in fits if not f.done]
        if not moving:
            break
        sums = _round(rows, moving)
        for i, f in enumerate(moving):
            got = [sums.get((i, j)) for j in range(f.k)]
            f.counts = np.array([g[0] if g else 0 for g in got])
            f.means = np.array([g[1] / g[0] if g else f.centers[j] for j, g in enumerate(got)])
            f.squares = np.array([g[2] / g[0] if g else 0.0 for g in got])
            f.cost = float(sum(g[3] for g in got if g))
            f.done = bool(((f.means - f.centers) ** 2).sum(1).max() <= TOL ** 2) or at == rounds - 1
            if not f.done:
                f.centers = f.means
    return {k: min((f for f in fits if f.k == k), key=lambda f: (f.cost, f.restart)) for k in ks}


def silhouettes(z: DataFrame, zcols: Sequence[str], fits: dict[int, Fit]) -> dict[int, float]:
    """Mean squared-Euclidean silhouette of every fit in one pass, from the centres' counts, means and squared norms."""
    own = {k: (f.centers, f.counts, f.means, f.squares) for k, f in fits.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = dict.fromkeys(own, 0.0), 0
        for x in _rows(batches):
            n += len(x)
            for k, (centers, counts, means, squares) in own.items():
                near, at = distances(x, centers).argmin(1), np.arange(len(x))
                d = (x ** 2).sum(1)[:, None] - 2 * x @ means.T + squares
                d[:, counts == 0] = np.inf
                size = counts[near]
                a = d[at, near] * size / np.maximum(1, size - 1)
                d[at, near] = np.inf
                b = d.min(1)
                top = np.maximum(a, b)
                fine = (size > 1) & np.isfinite(b) & (top > 0)
                total[k] += float(((b - a)[fine] / top[fine]).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.float64()),
                                          pa.array([n] * len(total), pa.int64())], names=["k", "s", "n"])

    parts = z.select(*[F.col(c).cast("double").alias(c) for c in zcols]).na.drop().mapInArrow(run, "k int, s double, n long")
    return {r.k: r.s / r.n for r in parts.groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
