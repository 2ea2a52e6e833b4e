import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from brute import counts, words
from cadence.llm import lm
from cadence.llm.elias_fano import ALPHA, LAMBDA, EliasFano, TrieLevel, alpha_code


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (7, 3), (1000, 40), (1000, 10 ** 7), (3000, 10 ** 13)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n))
    e, _ = EliasFano.open(EliasFano.build(v).to_bytes())
    assert (e.get(np.arange(n)) == v).all()
    x = np.concatenate([rng.integers(0, top + 9, 3000), v])
    assert (e.successor(x) == np.searchsorted(v, x)).all()


def test_level_from_a_memory_map(tmp_path):
    rng = np.random.default_rng(1)
    key, count = np.unique(rng.integers(0, 300, 9000) << 32 | rng.integers(0, 2000, 9000), return_counts=True)
    c, w = key >> 32, key & 0xFFFFFFFF
    (tmp_path / "level").write_bytes(TrieLevel.build(c, w, count).to_bytes())
    level = TrieLevel.open(np.memmap(tmp_path / "level", mode="r"))
    assert (level.find(c, w)[0] == np.arange(len(key))).all()
    q, r = rng.integers(0, 400, 20000), rng.integers(0, 2100, 20000)
    places = {int(k): i for i, k in enumerate(key)}
    assert level.find(q, r)[0].tolist() == [places.get(int(a) << 32 | int(b), -1) for a, b in zip(q, r)]
    for x in np.unique(c)[::37]:  # shares and the weight of the lower order add up to one
        own = c == x
        assert ALPHA[level.alpha[own]].sum() + LAMBDA[level.find(np.array([x]), np.array([0]))[2][0]] == pytest.approx(1, abs=0.04)


def test_quantised_probabilities():
    p = np.logspace(-6.9, 0, 200)
    assert (np.abs(np.log10(ALPHA[alpha_code(p)] / p)) < 0.015).all() and ALPHA[0] == 0


def brute(rows):
    """The same model unquantised, with one level of all contexts."""
    learnt = counts(rows, lm.held_out)
    n, v = sum(learnt.values()), len(learnt)
    pairs = Counter()
    for i, t in rows:
        w = [*words(t), None]
        if not lm.held_out(i):
            pairs.update(zip(["", *w[:-1]], w))
    spread, total = Counter(pairs.values()), Counter()
    n1, n2, n3, n4 = (max(1, spread[k]) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    off = np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.1, 0.2, 0.3], [0, 0.95, 1.5, 2.0])
    left = defaultdict(float)
    for (c, _), k in pairs.items():
        total[c] += k
        left[c] += off[min(k, 3)]
    out = []
    for i, t in rows:
        w = [*words(t), None]
        one = [(learnt[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        two = []
        for c, x, p in zip(["", *w[:-1]], w, one):
            k = pairs[c, x]
            two.append(((k - off[min(k, 3)]) / total[c] if k else 0) + left[c] / total[c] * p if total[c] else p)
        out.append((i, lm.held_out(i), len(w), sum(learnt[x] > 0 for x in w), n, sum(map(math.log10, one)), sum(map(math.log10, two))))
    return out


def test_scores_against_brute_force(spark, odd_docs, monkeypatch):
    spark_docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in spark_docs.collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one shard: one estimate of the discounts, as in the plain version
    try:
        got = lm.score(spark_docs.repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got, expect = sorted(map(tuple, got), key=repr), sorted(brute(rows), key=repr)
    for g, e in zip(got, expect, strict=True):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], rel=1e-9)
        assert g[6] == pytest.approx(e[6], abs=0.02 * e[2] + 0.05)


def test_more_shards_score_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lm.score(docs).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > 1.05 * held.base_score.sum()  # logarithms: a better model is nearer to 0
    assert got.train_tokens.nunique() == 1


def test_no_rows(no_docs):
    assert lm.score(no_docs).collect() == []


def test_nothing_to_learn_from(spark):
    held = [i for i in range(50) if lm.held_out(i)]
    got = lm.score(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in got)


def test_levels_are_tries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = lm.Model(docs)
    rows = [TrieLevel.open(bytes(r.level)) for r in m.levels().collect()]
    pairs = set()
    for r in docs.collect():
        if not lm.held_out(r.doc_id):
            w = [*words(r.text), None]
            pairs.update(zip(["", *w[:-1]], w))
    assert sum(x.successors.n for x in rows) == len(pairs)


def brute_orders(rows, order):
    """Interpolation over any number of orders, unquantised; a text's first word has the start as its only context."""
    learnt = counts(rows, lm.held_out)
    n, v = sum(learnt.values()), len(learnt)
    texts = [(i, ["", *words(t), None]) for i, t in rows]
    grams = [Counter() for _ in range(order + 1)]
    for k in range(2, order + 1):
        for i, w in texts:
            if not lm.held_out(i):
                grams[k].update(tuple(w[j - k + 1:j + 1]) for j in range(max(1, k - 1), len(w)))
    off, total, left = {}, {}, {}
    for k in range(2, order + 1):
        spread, total[k], left[k] = Counter(grams[k].values()), Counter(), defaultdict(float)
        n1, n2, n3, n4 = (max(1, spread[c]) for c in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        off[k] = np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.1, 0.2, 0.3], [0, 0.95, 1.5, 2.0])
        for g, c in grams[k].items():
            total[k][g[:-1]] += c
            left[k][g[:-1]] += off[k][min(c, 3)]
    out = {}
    for i, w in texts:
        s = 0.0
        for j in range(1, len(w)):
            p = (learnt[w[j]] + 0.5) / (n + 0.5 * (v + 1))
            for k in range(2, min(order, j + 1) + 1):
                g = tuple(w[j - k + 1:j + 1])
                if total[k][g[:-1]]:
                    c = grams[k][g]
                    p = ((c - off[k][min(c, 3)]) + left[k][g[:-1]] * p) / total[k][g[:-1]] if c else left[k][g[:-1]] * p / total[k][g[:-1]]
            s += math.log10(p)
        out.setdefault((i, len(w) - 1), []).append(s)
    return out


@pytest.mark.parametrize("order, shards", [(1, 3), (3, 1), (3, 7), (4, 3)])
def test_orders_against_brute_force(spark, odd_docs, order, shards):
    more = [(100 + i, f"the cat sat on the {'mat' if i % 3 else 'hat'} and {'slept' if i % 4 else 'ate'} again {i % 7}") for i in range(60)]
    docs = (spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(200)
            .unionByName(odd_docs.select("doc_id", "text")).unionByName(spark.createDataFrame(more, "doc_id long, text string")))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        got = lm.score(docs.repartition(3), order).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expect, own = brute_orders(rows, order), {}
    for r in got:
        own.setdefault((r.doc_id, r.n_tokens), []).append(r.score)
    assert own.keys() == expect.keys()
    for key, e in expect.items():
        assert sorted(own[key]) == pytest.approx(sorted(e), abs=0.02 * (order - 1) * key[1] + 0.05)


def test_scores_do_not_depend_on_the_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for shards in ("1", "6"):
            spark.conf.set("spark.sql.shuffle.partitions", shards)
            got.append({r.doc_id: r.score for r in lm.score(docs, lm.ORDER).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == pytest.approx(got[1], rel=1e-9)


def test_the_third_order_tells_a_repeated_passage(spark):
    train = [i for i in range(400) if not lm.held_out(i)][:80]
    held = [i for i in range(400, 500) if lm.held_out(i)][:2]
    rows = [(i, "a b c" if i % 2 else "d b e") for i in train] + [(held[0], "a b c"), (held[1], "a b e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    two, three = ({r.doc_id: r.score for r in lm.score(docs, k).collect()} for k in (2, 3))
    assert two[held[0]] == pytest.approx(two[held[1]], abs=0.3)
    assert three[held[0]] > three[held[1]] + 0.8
