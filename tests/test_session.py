"""Session helpers: checkpoint folder resolution, materialisation, cluster sizing, centre distances."""

import math

from cadence.operators import cluster as CU
from cadence.session import cluster_conf, ensure_checkpoint_dir, materialize


def test_checkpoint_dir_is_set_and_stable(spark):
    a = ensure_checkpoint_dir(spark)
    assert a and ensure_checkpoint_dir(spark) == a


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS v")
    m = materialize(df.filter("id % 2 = 0"))
    assert m.count() == 50
    assert "ExistingRDD" in m._jdf.queryExecution().executedPlan().toString()


def test_cluster_conf_sizes_from_volume():
    c = cluster_conf(input_tb=100, executors=1000, cores_per_executor=8, shuffle_partition_mb=256)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 * 1024 // 256
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(input_tb=0.001, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # never below 2 x total cores


def test_centroid_distances(spark):
    df = spark.createDataFrame([("A", 0.0, 0.0), ("B", 3.0, 4.0)], "entity string, x double, y double")
    out = {(r["entity"], r["centre"]): r["distance"]
           for r in CU.centroid_distances(df, ["x", "y"], [[0.0, 0.0], [3.0, 0.0]]).collect()}
    assert out[("B", 0)] == 5.0 and out[("A", 1)] == 3.0 and math.isclose(out[("B", 1)], 4.0)
