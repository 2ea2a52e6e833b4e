"""Clustering of the entity-level table.

Input is one row per entity (``summary.entity_means``), z-scored with
population statistics.  Nothing here pairs entities with each other:

* k-means runs all restarts (and, for U7, all k) in shared rounds of one scan each
  (``lloyd``); the lowest cost is kept and cluster ids follow the ascending
  first-feature centre so they are reproducible;
* the silhouette uses squared Euclidean distance, whose mean from a point to a
  cluster is exact from the cluster's count, centre and mean squared norm -
  no pair of entities is formed (the Euclidean variant needs every pair and
  is not offered);
* Calinski-Harabasz, profiles and names are per-cluster aggregates.

Hierarchical clustering (U9) is not offered: its linkage needs every pair of entities.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators import lloyd as LL
from cadence.session import materialize
from cadence.spec import first_present, present

# Cluster naming rules of the library (U5) and of the dashboard.
LIBRARY_NAMES = (("Resource Curse", "High commodity dependence + Weak governance = High volatility"),
                 ("Managed Resource Wealth", "High commodity dependence but better governance"),
                 ("Diversified & Stable", "Lower commodity dependence, more stable growth"),
                 ("Transitional", "Mixed characteristics"))


def scaled(df: DataFrame, features: Sequence[str], suffix: str = "_z") -> tuple[DataFrame, list[str]]:
    st = X.one_row(df.agg(*[F.avg(c).alias(f"m{j}") for j, c in enumerate(features)],
                          *[F.stddev_pop(c).alias(f"s{j}") for j, c in enumerate(features)]))
    cols = [f"{c}{suffix}" for c in features]
    return df.select("*", *[X.standardize(c, st[f"m{j}"], st[f"s{j}"]).alias(cols[j])
                            for j, c in enumerate(features)]), cols


@dataclass
class KMeansFit:
    features: list[str]
    zcols: list[str]
    centers: list[list[float]]
    cost: float


def fit_kmeans(ent: DataFrame, features: Sequence[str], k: int = 3, restarts: int = 10, seed: int = 42,
               minimum: int = 3, key: str = "entity") -> tuple[DataFrame, KMeansFit]:
    """K-means on z-scored entity features; best of ``restarts`` starts.  Rows with a null feature take no part."""
    feats = present(ent, features)
    if len(feats) < minimum:
        raise ValueError(f"clustering needs at least {minimum} features, found {feats}")
    z, zcols = scaled(ent, feats)
    z = materialize(z.na.drop("any", subset=zcols))
    found = LL.search(z, key, zcols, [k], restarts, seed)
    if not found:
        raise ValueError("clustering needs at least one row without null features")
    centers = sorted(found[k].centers.tolist())
    return assign(z, zcols, centers), KMeansFit(feats, zcols, centers, found[k].cost)


def assign(ent_z: DataFrame, zcols: Sequence[str], centers: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Nearest centre (squared Euclidean; ties to the lower id) for given centres."""
    d = [X.sum_of([(F.col(c) - F.lit(float(ctr[j]))) ** 2 for j, c in enumerate(zcols)]) for ctr in centers]
    best = F.lit(0)
    best_d = d[0]
    for i in range(1, len(d)):
        best = F.when(d[i] < best_d, F.lit(i)).otherwise(best)
        best_d = F.least(best_d, d[i])
    return ent_z.withColumn(out, best)


def _cluster_stats(labeled: DataFrame, zcols: Sequence[str], label: str) -> DataFrame:
    sq = X.sum_of([F.col(c) * F.col(c) for c in zcols])
    return labeled.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"), *[F.avg(c).alias(f"mu_{j}") for j, c in enumerate(zcols)],
                                      F.avg(sq).alias("msq"))


def silhouette(labeled: DataFrame, zcols: Sequence[str], label: str = "cluster", key: str = "entity") -> DataFrame:
    """Per-entity silhouette with squared Euclidean distance, exact from cluster statistics.

    Mean squared distance from x to cluster C = |x|^2 - 2 x.mu_C + mean_C |y|^2;
    a(x) excludes x itself (factor n_C / (n_C - 1)); singletons score 0.
    """
    stats = _cluster_stats(labeled, zcols, label).collect()  # k rows
    xsq = X.sum_of([F.col(c) * F.col(c) for c in zcols])
    msd = {}
    for r in stats:
        dot = X.sum_of([F.col(c) * F.lit(float(r[f"mu_{j}"])) for j, c in enumerate(zcols)])
        msd[r[label]] = (xsq - F.lit(2.0) * dot + F.lit(float(r["msq"])), int(r["n_c"]))
    own_n = F.create_map(*[x for c, (_, n) in msd.items() for x in (F.lit(c), F.lit(n))])[F.col(label)]
    a = F.lit(None).cast("double")
    for c, (e, n) in msd.items():
        a = F.when(F.col(label) == c, e * F.lit(n / (n - 1) if n > 1 else 0.0)).otherwise(a)
    b = None
    for c, (e, _) in msd.items():
        cand = F.when(F.col(label) != c, e)
        b = cand if b is None else F.least(b, cand)
    s = F.when(own_n <= 1, F.lit(0.0)).otherwise(X.share(F.col("__b") - F.col("__a"), F.greatest("__a", "__b")))
    return (labeled.withColumn("__a", a).withColumn("__b", b).withColumn("silhouette", F.coalesce(s, F.lit(0.0)))
            .select(key, label, "silhouette"))


def silhouette_score(labeled: DataFrame, zcols: Sequence[str], label: str = "cluster", key: str = "entity") -> float:
    return X.one_row(silhouette(labeled, zcols, label, key).agg(F.avg("silhouette").alias("s")))["s"]


def calinski_harabasz(labeled: DataFrame, zcols: Sequence[str], label: str = "cluster") -> DataFrame:
    """(B / (k - 1)) / (W / (n - k)) from per-cluster sums."""
    sq = X.sum_of([F.col(c) * F.col(c) for c in zcols])
    per = labeled.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"), *[F.sum(c).alias(f"s{j}") for j, c in enumerate(zcols)],
                                     F.sum(sq).alias("ssq"))
    tot = labeled.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"g{j}") for j, c in enumerate(zcols)])
    g = X.one_row(tot)
    within = F.col("ssq") - X.sum_of([F.col(f"s{j}") * F.col(f"s{j}") for j in range(len(zcols))]) / F.col("n_c")
    between = F.col("n_c") * X.sum_of([(F.col(f"s{j}") / F.col("n_c") - F.lit(float(g[f"g{j}"]))) ** 2
                                       for j in range(len(zcols))])
    agg = per.agg(F.sum(between).alias("B"), F.sum(within).alias("W"), F.count(F.lit(1)).alias("k"))
    n = int(g["n"])
    return agg.select("k", F.lit(n).cast("long").alias("n"),
                      X.share(F.col("B") / (F.col("k") - 1), F.col("W") / (F.lit(n) - F.col("k"))).alias("calinski_harabasz"))


def members(labeled: DataFrame, label: str = "cluster", key: str = "entity", name: str | None = "entity_name") -> DataFrame:
    """Every member of every cluster, one row each."""
    return labeled.select(label, key, *([name] if name and name in labeled.columns else []))


def profiles(labeled: DataFrame, features: Sequence[str], label: str = "cluster", key: str = "entity",
             name: str | None = "entity_name", examples: int = 5) -> DataFrame:
    """U4: per cluster: entity count, feature means and the first ``examples`` members (a top-k).

    The full membership is the labelled table itself; no unbounded list is built.
    """
    w = Window.partitionBy(label).orderBy(key)
    top = labeled.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= examples)
    ex = top.groupBy(label).agg(F.array_sort(F.collect_list(key)).alias("examples"),
                                *([F.array_sort(F.collect_list(name)).alias("example_names")] if name and name in labeled.columns else []))
    agg = labeled.groupBy(label).agg(F.count(F.lit(1)).alias("n_entities"),
                                     *[F.avg(c).alias(f"avg_{c}") for c in features])
    return agg.join(ex, label)


def library_names(prof: DataFrame) -> DataFrame:
    """Rule-based name and description of each profile (defaults 50 / 0 / 0 when absent)."""
    cdi = F.col(first_present(prof, "avg_cdi_smooth", "avg_cdi_raw")) if first_present(prof, "avg_cdi_smooth", "avg_cdi_raw") else F.lit(50.0)
    volc = first_present(prof, "avg_gdp_volatility", "avg_log_gdp_volatility")
    vol = F.col(volc) if volc else F.lit(0.0)
    gov = F.col("avg_governance_index") if "avg_governance_index" in prof.columns else F.lit(0.0)
    idx = (F.when((cdi > 60) & (gov < -0.3), 0).when((cdi > 60) & (gov >= -0.3), 1)
           .when((cdi <= 60) & (vol < 2), 2).otherwise(3))
    names = F.array(*[F.lit(n) for n, _ in LIBRARY_NAMES])
    descs = F.array(*[F.lit(d) for _, d in LIBRARY_NAMES])
    return prof.withColumn("cluster_name", F.element_at(names, idx + 1)).withColumn(
        "description", F.element_at(descs, idx + 1))


def dashboard_names(prof: DataFrame, label: str = "cluster") -> DataFrame:
    """The dashboard's naming rules (<= 40 is 'Diversified Economy')."""
    cdi = F.col(first_present(prof, "avg_cdi_smooth", "avg_cdi_raw") or "avg_cdi_smooth")
    gov = F.col("avg_governance_index") if "avg_governance_index" in prof.columns else F.lit(0.0)
    return prof.withColumn("dashboard_name", F.when((cdi > 60) & (gov < -0.3), "Resource Curse")
                           .when((cdi > 60) & (gov >= -0.3), "Managed Resources")
                           .when(cdi <= 40, "Diversified Economy")
                           .otherwise(F.concat(F.lit("Cluster "), (F.col(label) + 1).cast("string"))))


def choose_k(ent: DataFrame, features: Sequence[str], max_k: int = 10, restarts: int = 10, seed: int = 42,
             key: str = "entity") -> DataFrame:
    """Inertia and silhouette for k = 2 .. min(max_k, n - 1); flag the best silhouette.

    One scaled table; all k and restarts move in the same rounds of one scan each, then one scan gives the silhouettes."""
    z, zcols = scaled(ent, present(ent, features))
    z = materialize(z.select(key, *zcols).na.drop("any", subset=zcols))
    ks = list(range(2, min(max_k + 1, z.count())))
    fits = LL.search(z, key, zcols, ks, restarts, seed)
    score = LL.silhouettes(z, zcols, fits) if fits else {}
    rows = [(k, f.cost, score[k]) for k, f in fits.items()]
    best = max(rows, key=lambda r: (r[2], -r[0]))[0] if rows else None
    df = ent.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")
    return df.withColumn("is_best", F.col("k") == F.lit(best))


def peers(labeled: DataFrame, named: DataFrame, label: str = "cluster", key: str = "entity") -> DataFrame:
    """U8: each entity's cluster, its name and description, and how many peers share it.

    The peers themselves are the other rows of the labelled table with the same
    label (a join away); they are not materialised as pairs.
    """
    return labeled.select(key, label).join(named.select(label, "cluster_name", "description", "n_entities"), label) \
        .withColumn("n_similar", F.col("n_entities") - 1).drop("n_entities")


def similar(labeled: DataFrame, entity, label: str = "cluster", key: str = "entity") -> DataFrame:
    """U8: the other entities of one entity's cluster, a row each (none for an unknown entity)."""
    own = labeled.filter(F.col(key) == F.lit(entity)).select(label).distinct()
    return labeled.join(own, label, "left_semi").filter(F.col(key) != F.lit(entity)).select(key, label)


def highlights(labeled_named: DataFrame, key: str = "entity", examples: int = 5) -> DataFrame:
    """Entities in 'Curse' clusters and in 'Diversified'/'Green' clusters, count and examples."""
    kinds = F.when(F.col("cluster_name").contains("Curse"), "resource_curse").when(
        F.col("cluster_name").rlike("Diversified|Green"), "escaped_paradox")
    t = labeled_named.withColumn("kind", kinds).filter(F.col("kind").isNotNull())
    w = Window.partitionBy("kind").orderBy(key)
    ex = t.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= examples).groupBy("kind").agg(
        F.array_sort(F.collect_list(key)).alias("examples"))
    return t.groupBy("kind").agg(F.count(F.lit(1)).alias("n_entities")).join(ex, "kind")


def centroid_distances(ent_z: DataFrame, zcols: Sequence[str], centers: Sequence[Sequence[float]],
                       key: str = "entity") -> DataFrame:
    """U10 (re-aimed): Euclidean distance of every entity to every centre, (entity, centre, distance).

    The reference feeds a full entity x entity distance matrix to its linkage;
    that is quadratic in entities, so distances are taken to k centres instead.
    """
    rows = F.array(*[F.struct(F.lit(i).alias("centre"),
                              F.sqrt(X.sum_of([(F.col(c) - F.lit(float(ctr[j]))) ** 2 for j, c in enumerate(zcols)]))
                              .alias("distance")) for i, ctr in enumerate(centers)])
    return ent_z.select(key, F.explode(rows).alias("r")).select(key, "r.centre", "r.distance")
