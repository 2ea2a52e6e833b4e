"""Hard negatives against plain sorting of all pairs."""

import random

import numpy as np
import pytest

from cadence.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, score double, at int, part int, dim int"


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    rows = [(i, [int(np.floor(x * 256)) for x in v], y) for i, v, y, *_ in rows
            if i is not None and v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v)]
    cap = 2 ** 63 - 1
    out = []
    for i, v, y in rows:
        if i % every:
            continue
        scored = sorted((-max(-cap, min(cap, sum(a * b for a, b in zip(v, w)))), j, z) for j, w, z in rows if j != i and len(w) == len(v))
        for p, j, _ in [x for x in scored if x[2] == y][:positives]:
            fits = [(-s, n) for s, n, z in scored if z != y and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, k, n, -p, s) for k, (s, n) in enumerate(fits, 1)]
    return sorted(out)


def made(n, labels, dim, seed, grid=None):
    r = random.Random(seed)
    return [(k, [r.choice(grid) if grid else r.gauss(0, 0.2) + 0.1 for _ in range(dim)], r.choice(labels), 0.0, 1, 1, 1) for k in range(n)]


@pytest.mark.parametrize("rows", [
    made(400, range(3), 8, 1),
    made(400, [0, 0, 0, 0, 1], 4, 2, grid=[-0.5, 0.0, 0.25, 0.5]),  # ties and a hot label
    made(60, range(3), 4, 3) + made(60, range(3), 6, 4),  # two kinds of vectors, repeated ids
    made(200, [7], 3, 5),  # no other label
    made(150, range(5), 1, 6, grid=[-1.0, 0.0, 1.0]),  # windows of a single score, and empty ones
])
def test_against_plain_sorting(spark, rows, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 37)
    monkeypatch.setattr(hn, "ANCHORS", 5)
    monkeypatch.setattr(hn, "OPEN_BLOCKS", 1)
    got = sorted(map(tuple, hn.mine(spark.createDataFrame(rows, SCHEMA), anchor_every=10).collect()))
    assert got == plain(rows, every=10)


def test_odd_rows(spark):
    rows = made(40, range(2), 3, 7) + [
        (0, None, 1, 0.0, 1, 1, 1), (10, [0.1, None, 0.2], 1, 0.0, 1, 1, 1), (11, [0.1, float("nan"), 0.2], 1, 0.0, 1, 1, 1),
        (12, [0.1, float("inf"), 0.2], 1, 0.0, 1, 1, 1), (13, [0.1, 0.1, 0.2], None, 0.0, 1, 1, 1), (None, [0.1, 0.1, 0.2], 1, 0.0, 1, 1, 1),
        (20, [], 0, 0.0, 1, 1, 1), (21, [], 0, 0.0, 1, 1, 1), (22, [], 1, 0.0, 1, 1, 1)]
    got = sorted(map(tuple, hn.mine(spark.createDataFrame(rows, SCHEMA), anchor_every=10).collect()))
    assert got == plain(rows, every=10) and (20, 21, 1, 22, 0, 0) in got
    assert hn.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_components_are_exact_and_scores_end_at_a_long(spark):
    rows = made(30, range(2), 2, 8) + [(k, [(1 + k % 7 / 7) * 1e7, (-1) ** k * 3e7 / (k + 1)], k % 2, 0.0, 1, 1, 1) for k in range(30, 50)]
    rows += [(50, [5e9, 1.0], 0, 0.0, 1, 1, 1), (51, [4e30, 1.0], 0, 0.0, 1, 1, 1), (52, [2e30, 1.0], 1, 0.0, 1, 1, 1)]
    got = sorted(map(tuple, hn.mine(spark.createDataFrame(rows, SCHEMA), anchor_every=10).collect()))
    assert got == plain(rows, every=10)
    a = np.array([[2.0 ** 60, 3.0], [1.0, 1.0]])
    assert hn.products(a, a).tolist() == [[2 ** 63 - 1, 2 ** 60 + 3], [2 ** 60 + 3, 2]]


def test_suffix_merge_of_overlapping_windows():
    positives = [(100, 1), (80, 2), (80, 3), (40, 4), (-5, 5)]
    limits, least = hn.upper_limits([s for s, _ in positives], 30, 90)
    assert (limits, least) == ([90, 72, 36], 12)
    slots = {0: [(90, 9), (75, 8)], 1: [(72, 7), (40, 6)], 2: [(36, 10), (12, 11)]}
    got = hn.answer(positives, slots, 3, 30, 90)
    assert got == [(1, 1, 9, 100, 90), (1, 2, 8, 100, 75), (1, 3, 7, 100, 72), (2, 1, 7, 80, 72), (2, 2, 6, 80, 40), (2, 3, 10, 80, 36),
                   (3, 1, 7, 80, 72), (3, 2, 6, 80, 40), (3, 3, 10, 80, 36), (4, 1, 10, 40, 36), (4, 2, 11, 40, 12)]
