"""Exact quantiles by distributed selection.

An exact ``percentile`` aggregate gathers every distinct value of a group in one reducer.  Here equal values are counted first
(they combine before they move), the counted values are range-partitioned by (group, column, value), and each slice's
number of rows tells, per group and column, which slices hold the wanted ranks.  Only those slices are searched, and a
quantile is interpolated between its two neighbours.  A group or column of any size spreads over as many
tasks as it needs, all columns and quantiles share one range partitioning, and the driver sees nothing but what callers collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.session import materialize


def quantiles(df: DataFrame, cols: Sequence[str], ps: Sequence[float], by: Sequence[str] = (), partitions: int | None = None,
              discrete: bool = False) -> DataFrame:
    """(``by``..., column, q0, q1, ...): the quantiles ``ps`` of the non-null values of each column, per group.

    Interpolated linearly between neighbouring ranks, or (``discrete``) the value of the lower one.  Groups and columns
    without values have no row."""
    key = [*by, "column"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("__value")) for c in cols])
    values = df.select(*by, F.explode(cells).alias("__x")).select(*by, "__x.column", "__x.__value").where(F.col("__value").isNotNull())
    counted = values.groupBy(*key, "__value").agg(F.count("*").alias("__n"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(counted.repartitionByRange(n, *key, "__value").withColumn("__pid", F.spark_partition_id()))
    group = Window.partitionBy(*key)
    slices = (ranged.groupBy("__pid", *key).agg(F.sum("__n").alias("__rows"))
              .withColumn("__before", _running(F.col("__rows"), group.orderBy("__pid"))).withColumn("__total", F.sum("__rows").over(group)))

    def rank(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    def at(p: float, first: str, rows: str, upper: bool) -> Column:
        place = (F.ceil(rank(p)) if upper else F.floor(rank(p))).cast("long")
        return (place >= F.col(first)) & (place < F.col(first) + F.col(rows))

    wanted = F.lit(False)
    for p in ps:
        wanted = wanted | at(p, "__before", "__rows", False) | at(p, "__before", "__rows", True)
    r, s = ranged.alias("r"), slices.where(wanted).alias("s")
    same = F.col("r.__pid") == F.col("s.__pid")
    for k in key:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    inside = Window.partitionBy("__pid", *key).orderBy("__value")
    found = (r.join(s, same).select("r.*", "s.__before", "s.__total")
             .withColumn("__first", F.col("__before") + _running(F.col("__n"), inside)))
    picked = found.groupBy(*key).agg(F.first("__total").alias("__total"), *[
        F.max(F.when(at(p, "__first", "__n", up), F.col("__value"))).alias(f"__{'hi' if up else 'lo'}{k}") for k, p in enumerate(ps) for up in (False, True)])
    out = []
    for k, p in enumerate(ps):
        lo, hi, h = F.col(f"__lo{k}"), F.col(f"__hi{k}"), rank(p)
        between = F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)
        out.append((lo if discrete else between).alias(f"q{k}"))
    return picked.select(*key, *out)


def _running(rows: Column, w) -> Column:
    """Sum over the rows before."""
    return F.coalesce(F.sum(rows).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def medians(df: DataFrame, cols: Sequence[str], by: Sequence[str], name: str) -> DataFrame:
    """One row per group with a value: the median of each column as ``name`` + column."""
    q = quantiles(df, cols, [0.5], by)
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("q0"))).alias(f"{name}{c}") for c in cols])


def of_columns(df: DataFrame, cols: Sequence[str], ps: Sequence[float], discrete: bool = False) -> dict[str, list[float] | None]:
    """The quantiles of whole columns (None: no values) at the driver: one row per column."""
    rows = {r["column"]: [r[f"q{k}"] for k in range(len(ps))] for r in quantiles(df, cols, ps, discrete=discrete).collect()} if cols else {}
    return {c: rows.get(c) for c in cols}
