"""Queries for section 2.9 (clustering and PCA of the entity-level table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import cluster as CU
from cadence.operators import pca as PC
from cadence.operators import summary as SM
from cadence.plans.catalog import finish, query
from cadence.plans.oracle_cte import FEATURES, rounded, with_panel
from cadence.plans.q_features import SPEC, featured
from cadence.session import materialize
from cadence.sources.star import panel_customer
from cadence.spec import PanelSpec

FEATS = list(SM.CLUSTER_FEATURES)
# Fixed test centres (z scale) for the label-given queries: all -1, all 0, all +1.
CENTRES = [[-1.0] * len(FEATS), [0.0] * len(FEATS), [1.0] * len(FEATS)]


def entity_table(spark, d):
    return materialize(SM.entity_means(featured(spark, d), SPEC, FEATS, minimum=3))


def labelled(spark, d):
    ent = entity_table(spark, d)
    z, zcols = CU.scaled(ent, FEATS)
    return CU.assign(z, zcols, CENTRES), zcols


_ENT = ("ent AS (SELECT * FROM (SELECT entity, " + ", ".join(f"avg({c}) AS {c}" for c in FEATS) +
        ", min_by(entity_name, period) AS entity_name FROM features GROUP BY entity) WHERE " +
        " AND ".join(f"{c} IS NOT NULL" for c in FEATS) + ")")
_EZ = ("ez AS (SELECT *, " + ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0 ELSE ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END "
    f"AS {c}_z" for c in FEATS) + " FROM ent)")
_D = [" + ".join(f"({c}_z - ({v}))*({c}_z - ({v}))" for c, v in zip(FEATS, ctr)) for ctr in CENTRES]
_LAB = (f"lab AS (SELECT *, CASE WHEN ({_D[2]}) < LEAST({_D[0]}, {_D[1]}) THEN 2 WHEN ({_D[1]}) < ({_D[0]}) THEN 1 "
        f"ELSE 0 END AS cluster FROM ez)")
_ZC = [f"{c}_z" for c in FEATS]
_XSQ = " + ".join(f"{z} * {z}" for z in _ZC)
_CST = ("cst AS (SELECT cluster, count(*) AS n_c, " + ", ".join(f"avg({z}) AS mu_{j}" for j, z in enumerate(_ZC)) +
        f", avg({_XSQ}) AS msq FROM lab GROUP BY cluster)")
_E = {c: f"(({_XSQ}) - 2.0 * (" + " + ".join(f"{z} * c{c}.mu_{j}" for j, z in enumerate(_ZC)) + f") + c{c}.msq)"
      for c in range(3)}
_SIL = ("sil AS (SELECT entity, cluster, COALESCE(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - a) / NULLIF(GREATEST(a, b), 0) "
        "END, 0.0) AS silhouette FROM (SELECT l.entity, l.cluster, "
        "CASE l.cluster " + " ".join(f"WHEN {c} THEN c{c}.n_c" for c in range(3)) + " END AS own_n, "
        "CASE l.cluster " + " ".join(f"WHEN {c} THEN {_E[c]} * CASE WHEN c{c}.n_c > 1 THEN CAST(c{c}.n_c AS DOUBLE) / "
                                     f"(c{c}.n_c - 1) ELSE 0.0 END" for c in range(3)) + " END AS a, "
        "list_min(list_filter([" + ", ".join(f"CASE WHEN l.cluster <> {c} THEN {_E[c]} END" for c in range(3)) +
        "], lambda v: v IS NOT NULL)) AS b FROM lab l " +
        " ".join(f"LEFT JOIN cst c{c} ON c{c}.cluster = {c}" for c in range(3)) + "))")
_PREFIX = (FEATURES, _ENT, _EZ, _LAB)


@query("u1_assign", rounded(with_panel("SELECT entity, cluster, " + ", ".join(_ZC) + " FROM lab", *_PREFIX),
                            "entity, cluster"))
def u1_assign(spark, d):
    lab, zcols = labelled(spark, d)
    return finish(lab.select("entity", "cluster", *zcols))


@query("u1_kmeans")
def u1_kmeans(spark, d):
    lab, fit = CU.fit_kmeans(entity_table(spark, d), FEATS, 3, 10)
    return finish(lab.select("entity", "cluster", *fit.zcols))


@query("u1_kmeans_customers")
def u1_kmeans_customers(spark, d):
    """k-means over every customer's quarterly means (scale in entity count)."""
    ent = materialize(SM.entity_means(panel_customer(spark, d), PanelSpec(name=None),
                                      ["n_orders", "spend", "urgent_pct"], minimum=3))
    lab, fit = CU.fit_kmeans(ent, ["n_orders", "spend", "urgent_pct"], 3, 3)
    return finish(lab.select("entity", "cluster"))


@query("u2_silhouette", rounded(with_panel("SELECT * FROM sil", *_PREFIX, _CST, _SIL), "entity, cluster"))
def u2_silhouette(spark, d):
    lab, zcols = labelled(spark, d)
    return finish(CU.silhouette(lab, zcols))


@query("u3_calinski", rounded(with_panel(
    "SELECT CAST(count(*) AS BIGINT) AS k, (SELECT count(*) FROM lab) AS n, (sum(bw) / (count(*) - 1)) / "
    "NULLIF(sum(ww) / ((SELECT count(*) FROM lab) - count(*)), 0) AS calinski_harabasz FROM (SELECT "
    "ssq - (" + " + ".join(f"s{j} * s{j}" for j in range(len(_ZC))) + ") / n_c AS ww, n_c * (" +
    " + ".join(f"(s{j} / n_c - g{j}) * (s{j} / n_c - g{j})" for j in range(len(_ZC))) + ") AS bw FROM "
    "(SELECT cluster, count(*) AS n_c, " + ", ".join(f"sum({z}) AS s{j}" for j, z in enumerate(_ZC)) +
    f", sum({_XSQ}) AS ssq FROM lab GROUP BY cluster) CROSS JOIN (SELECT " +
    ", ".join(f"avg({z}) AS g{j}" for j, z in enumerate(_ZC)) + " FROM lab))", *_PREFIX), "k, n"))
def u3_calinski(spark, d):
    lab, zcols = labelled(spark, d)
    return finish(CU.calinski_harabasz(lab, zcols))


_PROF = ("prof AS (SELECT a.*, e.examples, e.example_names FROM (SELECT cluster, count(*) AS n_entities, " +
         ", ".join(f"avg({c}) AS avg_{c}" for c in FEATS) + " FROM lab GROUP BY cluster) a JOIN (SELECT cluster, "
         "list_sort(list(entity)) AS examples, list_sort(list(entity_name)) AS example_names FROM (SELECT *, "
         "row_number() OVER (PARTITION BY cluster ORDER BY entity) AS rn FROM lab) WHERE rn <= 5 GROUP BY cluster) e "
         "USING (cluster))")
_NAMES = ("named AS (SELECT *, CASE WHEN avg_cdi_smooth > 60 AND avg_governance_index < -0.3 THEN 0 "
          "WHEN avg_cdi_smooth > 60 AND avg_governance_index >= -0.3 THEN 1 WHEN avg_cdi_smooth <= 60 AND "
          "avg_gdp_volatility < 2 THEN 2 ELSE 3 END AS ni FROM prof)",
          "named2 AS (SELECT * EXCLUDE (ni), [" + ", ".join(f"'{n}'" for n, _ in CU.LIBRARY_NAMES) +
          "][ni + 1] AS cluster_name, [" + ", ".join(f"'{x}'" for _, x in CU.LIBRARY_NAMES) +
          "][ni + 1] AS description FROM named)")
_PKEEP = "cluster, n_entities, examples, example_names"


def _profiles(spark, d):
    lab, _ = labelled(spark, d)
    return lab, CU.profiles(lab, FEATS)


@query("u4_members", with_panel("SELECT cluster, entity, entity_name FROM lab", *_PREFIX))
def u4_members(spark, d):
    return CU.members(labelled(spark, d)[0])


@query("u4_profiles", rounded(with_panel("SELECT * FROM prof", *_PREFIX, _PROF), _PKEEP))
def u4_profiles(spark, d):
    return finish(_profiles(spark, d)[1])


@query("u5_names", rounded(with_panel("SELECT * FROM named2", *_PREFIX, _PROF, *_NAMES),
                           _PKEEP + ", cluster_name, description"))
def u5_names(spark, d):
    return finish(CU.library_names(_profiles(spark, d)[1]))


@query("u6_names_alt", rounded(with_panel(
    "SELECT *, CASE WHEN avg_cdi_smooth > 60 AND avg_governance_index < -0.3 THEN 'Resource Curse' "
    "WHEN avg_cdi_smooth > 60 AND avg_governance_index >= -0.3 THEN 'Managed Resources' WHEN avg_cdi_smooth <= 40 "
    "THEN 'Diversified Economy' ELSE concat('Cluster ', CAST(cluster + 1 AS VARCHAR)) END AS dashboard_name FROM prof",
    *_PREFIX, _PROF), _PKEEP + ", dashboard_name"))
def u6_names_alt(spark, d):
    return finish(CU.dashboard_names(_profiles(spark, d)[1]))


@query("u7_choose_k")
def u7_choose_k(spark, d):
    return finish(CU.choose_k(entity_table(spark, d), FEATS))


@query("u8_peers", with_panel(
    "SELECT l.entity, l.cluster, n.cluster_name, n.description, n.n_entities - 1 AS n_similar FROM lab l "
    "JOIN named2 n USING (cluster)", *_PREFIX, _PROF, *_NAMES))
def u8_peers(spark, d):
    lab, prof = _profiles(spark, d)
    return CU.peers(lab, CU.library_names(prof))


@query("u8_similar", with_panel(
    "SELECT l.entity, l.cluster FROM lab l JOIN (SELECT cluster, entity AS own FROM lab WHERE entity = (SELECT min(entity) "
    "FROM lab)) o USING (cluster) WHERE l.entity <> o.own", *_PREFIX))
def u8_similar(spark, d):
    """The peers of one entity, here the first by name."""
    lab, _ = labelled(spark, d)
    return CU.similar(lab, lab.agg(F.min("entity")).head()[0])


def _fitted(spark, d):
    lab, _ = CU.fit_kmeans(entity_table(spark, d), FEATS, 3, 10)
    lab = materialize(lab)
    return lab, CU.dashboard_names(CU.library_names(CU.profiles(lab, FEATS)))


@query("u5_fitted_names")
def u5_fitted_names(spark, d):
    """Profiles with both kinds of names of the clusters that k-means found."""
    return finish(_fitted(spark, d)[1])


@query("u8_fitted_peers")
def u8_fitted_peers(spark, d):
    return CU.peers(*_fitted(spark, d))


@query("u12_highlights", with_panel(
    "SELECT t.kind, t.n_entities, e.examples FROM (SELECT kind, count(*) AS n_entities FROM k GROUP BY kind) t JOIN "
    "(SELECT kind, list_sort(list(entity)) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY "
    "entity) AS rn FROM k) WHERE rn <= 5 GROUP BY kind) e USING (kind)", *_PREFIX, _PROF, *_NAMES,
    "k AS (SELECT l.entity, CASE WHEN n.cluster_name LIKE '%Curse%' THEN 'resource_curse' WHEN "
    "regexp_matches(n.cluster_name, 'Diversified|Green') THEN 'escaped_paradox' END AS kind FROM lab l JOIN named2 n "
    "USING (cluster) WHERE kind IS NOT NULL)"))
def u12_highlights(spark, d):
    lab, prof = _profiles(spark, d)
    named = CU.library_names(prof)
    return CU.highlights(lab.join(named.select("cluster", "cluster_name"), "cluster"))


# ---- PCA ------------------------------------------------------------------------------------
_COV = ("SELECT feature_i, feature_j, covariance FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, covar_samp({a}_z, {b}_z) AS covariance FROM ez"
    for i, a in enumerate(FEATS) for j, b in enumerate(FEATS) if j >= i) + ")")


@query("u13_cov_matrix", rounded(with_panel(_COV, FEATURES, _ENT, _EZ), "feature_i, feature_j"))
def u13_cov_matrix(spark, d):
    ent = entity_table(spark, d)
    z, zcols = CU.scaled(ent, FEATS)
    return finish(PC.covariance(z, zcols, FEATS))


def _pca(spark, d):
    return PC.fit(entity_table(spark, d), FEATS, 3)


@query("u13_pca")
def u13_pca(spark, d):
    scores, _ = _pca(spark, d)
    return finish(scores.select("entity", "PC1", "PC2", "PC3"))


@query("u14_scree")
def u14_scree(spark, d):
    _, pf = _pca(spark, d)
    return finish(PC.scree(spark, pf))


@query("u15_loadings")
def u15_loadings(spark, d):
    _, pf = _pca(spark, d)
    return finish(PC.loadings(spark, pf, 3))


@query("u16_pc_interpret")
def u16_pc_interpret(spark, d):
    _, pf = _pca(spark, d)
    return finish(PC.interpret(PC.loadings(spark, pf, 3), PC.scree(spark, pf)))


@query("u10_centroid_distances", rounded(with_panel(
    "SELECT entity, centre, distance FROM (" + " UNION ALL ".join(
        f"SELECT entity, {i} AS centre, sqrt({_D[i]}) AS distance FROM ez" for i in range(3)) + ")",
    FEATURES, _ENT, _EZ), "entity, centre"))
def u10_centroid_distances(spark, d):
    ent = entity_table(spark, d)
    z, zcols = CU.scaled(ent, FEATS)
    return finish(CU.centroid_distances(z, zcols, CENTRES))
