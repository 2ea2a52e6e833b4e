"""Clustering and PCA of entity tables (U1-U16) against brute-force numpy."""

import numpy as np
import pytest

from cadence.operators import cluster as CU
from cadence.operators import lloyd as LL
from cadence.operators import pca as PC


@pytest.fixture(scope="module")
def entities(spark):
    rng = np.random.default_rng(0)
    centers = np.array([[0, 0, 0], [5, 5, 0], [0, 5, 5]])
    pts = np.vstack([c + rng.normal(0, 0.5, (10, 3)) for c in centers])
    rows = [(f"E{i:02d}", f"Name {i}", *map(float, p)) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "entity string, entity_name string, a double, b double, c double"), pts


def test_kmeans_recovers_groups_and_is_reproducible(spark, entities):
    df, _ = entities
    lab1, fit1 = CU.fit_kmeans(df, ["a", "b", "c"], 3, 3)
    lab2, _ = CU.fit_kmeans(df, ["a", "b", "c"], 3, 3)
    g1 = {r["entity"]: r["cluster"] for r in lab1.collect()}
    g2 = {r["entity"]: r["cluster"] for r in lab2.collect()}
    assert g1 == g2
    for block in range(3):
        assert len({g1[f"E{i:02d}"] for i in range(block * 10, block * 10 + 10)}) == 1
    assert [c[0] for c in fit1.centers] == sorted(c[0] for c in fit1.centers)


def _z(pts):
    return (pts - pts.mean(0)) / pts.std(0)


def test_silhouette_squared_matches_bruteforce(spark, entities):
    df, pts = entities
    lab, fit = CU.fit_kmeans(df, ["a", "b", "c"], 3, 2)
    rows = lab.orderBy("entity").collect()
    z = np.array([[r[c] for c in fit.zcols] for r in rows])
    lbl = np.array([r["cluster"] for r in rows])
    d2 = ((z[:, None, :] - z[None, :, :]) ** 2).sum(-1)
    ref = []
    for i in range(len(z)):
        own = lbl == lbl[i]
        a = d2[i, own & (np.arange(len(z)) != i)].mean()
        b = min(d2[i, lbl == k].mean() for k in set(lbl) if k != lbl[i])
        ref.append((b - a) / max(a, b))
    got = [r["silhouette"] for r in CU.silhouette(lab, fit.zcols).orderBy("entity").collect()]
    assert got == pytest.approx(ref)
    assert all(-1 <= s <= 1 for s in got)


def test_calinski_harabasz_matches_numpy(spark, entities):
    df, _ = entities
    lab, fit = CU.fit_kmeans(df, ["a", "b", "c"], 3, 2)
    rows = lab.collect()
    z = np.array([[r[c] for c in fit.zcols] for r in rows])
    lbl = np.array([r["cluster"] for r in rows])
    mu = z.mean(0)
    B = sum((lbl == k).sum() * ((z[lbl == k].mean(0) - mu) ** 2).sum() for k in set(lbl))
    W = sum(((z[lbl == k] - z[lbl == k].mean(0)) ** 2).sum() for k in set(lbl))
    ref = (B / 2) / (W / (len(z) - 3))
    assert CU.calinski_harabasz(lab, fit.zcols).first()["calinski_harabasz"] == pytest.approx(ref)


def test_profiles_names_and_peers(spark, entities):
    df, _ = entities
    lab, _ = CU.fit_kmeans(df, ["a", "b", "c"], 3, 2)
    prof = CU.profiles(lab, ["a", "b", "c"])
    rows = prof.collect()
    assert sum(r["n_entities"] for r in rows) == 30 and all(len(r["examples"]) == 5 for r in rows)
    renamed = prof.withColumnRenamed("avg_a", "avg_cdi_smooth")
    named = CU.library_names(renamed)
    assert {r["cluster_name"] for r in named.collect()} <= {n for n, _ in CU.LIBRARY_NAMES}
    peers = CU.peers(lab, named).collect()
    assert all(r["n_similar"] == 9 for r in peers)
    assert {r.entity for r in CU.similar(lab, "E03").collect()} == {f"E{i:02d}" for i in range(10)} - {"E03"}
    assert CU.similar(lab, "nobody").collect() == []


def test_pca_ratios_and_orthonormal_loadings(spark, entities):
    df, pts = entities
    scores, pf = PC.fit(df, ["a", "b", "c"], 3)
    assert sum(pf.ratio) == pytest.approx(1.0)
    comps = np.array(pf.components)
    assert comps @ comps.T == pytest.approx(np.eye(3), abs=1e-10)
    ev = np.linalg.eigvalsh(np.cov(_z(pts).T))[::-1]
    assert pf.ratio == pytest.approx(list(ev / ev.sum()))
    interp = PC.interpret(PC.loadings(spark, pf, 3), PC.scree(spark, pf)).collect()
    assert len(interp) == 3


def test_choose_k_query_tries_every_k(spark):
    from cadence.plans.q_unsupervised import u7_choose_k
    rows = sorted(u7_choose_k(spark, "/root/testdata/sf0.01").collect())
    assert [r.k for r in rows] == list(range(2, 11))
    assert [r.k for r in rows if r.is_best] == [max(rows, key=lambda r: (r.silhouette, -r.k)).k]


def _lloyd(z, centers, rounds=300):
    for _ in range(rounds):
        d = ((z[:, None, :] - centers[None]) ** 2).sum(-1)
        near = d.argmin(1)
        means = np.array([z[near == j].mean(0) if (near == j).any() else c for j, c in enumerate(centers)])
        if ((means - centers) ** 2).sum(1).max() <= LL.TOL ** 2:
            break
        centers = means
    return centers, float(d.min(1).sum())


def test_fused_rounds_equal_separate_fits(spark):
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(c, 1.0, (400, 3)) for c in ((0, 0, 0), (4, 0, 1), (0, 5, 2), (6, 6, 6))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)] + [(9999, None, 1.0, 1.0)],
                               "entity long, a double, b double, c double").repartition(7)
    got = LL.search(df, "entity", ["a", "b", "c"], [2, 3, 4, 5], 4, seed=1)
    sample = [r[1:] for r in df.na.drop().selectExpr("xxhash64(entity, 1)", "a", "b", "c").orderBy("`xxhash64(entity, 1)`").collect()]
    assert len(sample) == 1600 < LL.SEEDS
    for k, f in got.items():
        alone = [_lloyd(pts, LL.first_centers(np.array(sample), k, np.random.default_rng((1, k, r)))) for r in range(4)]
        centers, cost = min(alone, key=lambda t: t[1])
        assert f.cost == pytest.approx(cost) and f.centers == pytest.approx(centers)
        assert f.counts.sum() == 1600
    scores = LL.silhouettes(df, ["a", "b", "c"], got)
    for k, f in got.items():
        lab = CU.assign(df.na.drop(), ["a", "b", "c"], f.centers.tolist())
        assert scores[k] == pytest.approx(CU.silhouette_score(lab, ["a", "b", "c"]))


def test_search_of_equal_rows_and_of_none(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(20)], "entity long, a double, b double")
    got = LL.search(same, "entity", ["a", "b"], [3], 2)
    assert got[3].cost == 0 and got[3].counts.tolist() == [20, 0, 0]
    assert LL.silhouettes(same, ["a", "b"], got) == {3: 0.0}
    assert LL.search(same.limit(0), "entity", ["a", "b"], [3], 2) == {}


def test_names_and_peers_of_fitted_clusters(spark):
    from cadence.plans import q_unsupervised as Q
    lab, named = Q._fitted(spark, "/root/testdata/sf0.001")
    rows, prof = lab.toPandas(), {r.cluster: r for r in named.collect()}
    assert set(prof) == set(rows.cluster)
    for c, own in rows.groupby("cluster"):
        r = prof[c]
        assert r.n_entities == len(own) and r.examples == sorted(own.entity)[:5]
        cdi, vol, gov = (own[x].mean() for x in ("cdi_smooth", "gdp_volatility", "governance_index"))
        assert (r.avg_cdi_smooth, r.avg_governance_index) == pytest.approx((cdi, gov))
        name = ("Resource Curse" if gov < -0.3 else "Managed Resource Wealth") if cdi > 60 else "Diversified & Stable" if vol < 2 else "Transitional"
        assert r.cluster_name == name
    peers = Q.CU.peers(lab, named).collect()
    assert {r.entity: r.n_similar for r in peers} == {e: (rows.cluster == c).sum() - 1 for e, c in zip(rows.entity, rows.cluster)}
