"""Connected components by smallest labels, hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the smallest node of its component.

    A round takes the smallest label among a node's neighbours for the node and for its label (so whole
    components hook onto smaller ones), then the label's own label; both are pre-aggregated minima, so a node of many
    edges is no hot group.  The rounds grow with the logarithm of the component's size.  Labels only fall, so
    an unchanged sum of them ends it.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    before = labels.agg(total).head()[0]
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        offers = labels.join(near, "node").select(F.explode(F.array(
            F.struct("node", F.least("label", "near").alias("label")), F.struct(F.col("label").alias("node"), F.col("near").alias("label")))).alias("o"))
        hooked = offers.select("o.*").groupBy("node").agg(F.min("label").alias("label"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = materialize(hooked.join(jump, "label").select("node", F.least("label", "next").alias("label")))
        now = labels.agg(total).head()[0]
        if now == before:
            return labels
        before = now
