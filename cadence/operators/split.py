"""Train/test splits and cross-validation folds (M1-M3).

No split collects rows to the driver or sorts the whole table in one task:
* M1 hashes the row key (``xxhash64``) - a pure projection;
* M2/M3 need a global position in (entity, period) order.  ``global_ordinal``
  builds it the distributed way: per-entity counts, range-partitioned; a
  per-partition running sum plus the (bounded, one per partition) partition
  totals give every entity its offset; rows add their rank inside the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators import quantiles as QU
from cadence.session import materialize
from cadence.spec import PanelSpec


def hash_split(df: DataFrame, spec: PanelSpec, train_fraction: float = 0.8, seed: int = 42,
               key: Column | None = None, out: str = "is_train") -> DataFrame:
    """M1: seeded split by key hash (deterministic, order-free)."""
    bucket = (key if key is not None
              else F.pmod(F.xxhash64(F.col(spec.entity), F.col(spec.period), F.lit(seed)), F.lit(1000)))
    return df.withColumn(out, bucket < F.lit(int(round(train_fraction * 1000))))


def modulo_split(df: DataFrame, expr: Column, modulus: int = 10, train_buckets: int = 8,
                 out: str = "is_train") -> DataFrame:
    """M1 (integer form): ``expr % modulus < train_buckets``; portable to any SQL engine."""
    return df.withColumn(out, F.pmod(expr, F.lit(modulus)) < F.lit(train_buckets))


def global_ordinal(df: DataFrame, spec: PanelSpec, out: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in (entity, period) order, without a single-task sort."""
    return ordinal_and_count(df, spec, out, partitions)[0]


def ordinal_and_count(df: DataFrame, spec: PanelSpec, out: str = "ordinal",
                       partitions: int | None = None) -> tuple[DataFrame, int]:
    """``global_ordinal`` plus the row count, which falls out of the partition totals.

    The range-partitioned counts are materialised once, so partition numbers, local sums and totals are all taken
    from the same rows; the offsets are a table of one row per partition, joined.
    """
    counts = df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("__cnt"))
    nparts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(counts.repartitionByRange(nparts, spec.entity).withColumn("__pid", F.spark_partition_id()))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__pid").agg(F.sum("__cnt").alias("__t"))
    bases = totals.select("__pid", F.coalesce(F.sum("__t").over(before.orderBy("__pid")), F.lit(0)).alias("__base"))
    local = F.coalesce(F.sum("__cnt").over(before.partitionBy("__pid").orderBy(spec.entity)), F.lit(0))
    offsets = (ranged.withColumn("__local", local).join(bases, "__pid")
               .select(spec.entity, (F.col("__base") + F.col("__local")).alias("__offset")))
    rank = F.row_number().over(spec.window()) - 1
    n = ranged.agg(F.coalesce(F.sum("__cnt"), F.lit(0))).head()[0]
    return df.join(offsets, spec.entity).withColumn(out, F.col("__offset") + rank).drop("__offset"), int(n)


def ordered_split(df: DataFrame, spec: PanelSpec, test_size: float = 0.2, out: str = "is_train",
                  by: str = "row") -> DataFrame:
    """M2: first (1 - test_size) of the rows in (entity, period) order train.

    ``by='period'`` splits on a period cut-off instead (a true time split).
    """
    if by == "period":
        cut = QU.of_columns(df, [spec.period], [1.0 - test_size], discrete=True)[spec.period]
        return df.withColumn(out, F.col(spec.period) < F.lit(cut[0] if cut else None))
    o, n = ordinal_and_count(df, spec)
    split_idx = int(n * (1.0 - test_size))
    return o.withColumn(out, F.col("ordinal") < F.lit(split_idx))


def kfold_expr(ordinal: Column, n: int, k: int) -> Column:
    """Contiguous unshuffled K-fold id: the first n % k folds hold one extra row."""
    q, r = n // k, n % k
    big = r * (q + 1)
    return F.when(ordinal < big, (ordinal / (q + 1)).cast("int")).otherwise(
        (F.lit(r) + ((ordinal - big) / F.lit(max(q, 1))).cast("int")))


def kfold_starts(n: int, k: int) -> list[int]:
    """First ordinal of each contiguous fold of ``kfold_expr``, and ``n`` at the end."""
    q, r = n // k, n % k
    return [j * q + min(j, r) for j in range(k)] + [n]


def ts_fold_starts(n: int, k: int) -> list[int]:
    """First ordinal of each test block of ``ts_fold_expr``, and ``n`` at the end; none when there are too few rows."""
    size = n // (k + 1)
    return [n - (k - i) * size for i in range(k)] + [n] if size else []


def ts_fold_expr(ordinal: Column, n: int, k: int) -> Column:
    """Expanding-window test block (0..k-1) of each row; NULL for rows only ever trained on."""
    size = n // (k + 1)
    start = n - k * size
    return F.when(ordinal >= start, ((ordinal - start) / F.lit(max(size, 1))).cast("int"))


def add_folds(df: DataFrame, spec: PanelSpec, k: int = 5) -> DataFrame:
    """M3: ordinal, contiguous K-fold id and expanding time-series fold id."""
    o, n = ordinal_and_count(df, spec)
    return o.withColumn("fold", kfold_expr(F.col("ordinal"), n, k)).withColumn(
        "ts_fold", ts_fold_expr(F.col("ordinal"), n, k))


def entity_positions(df: DataFrame, spec: PanelSpec, out: str = "pos", partitions: int | None = None) -> DataFrame:
    """0-based position of every row inside its entity, with no entity confined to one task.

    Range partitioning on (entity, period) splits even a single huge entity into
    period slices; each task numbers its sorted rows (``monotonically_increasing_id``
    is the record index within the task), and a small (slice, entity) count table
    - about one row per entity plus one per partition boundary - gives every
    slice its offset inside the entity.  Keys must be unique per (entity, period).
    """
    from cadence.session import materialize

    nparts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # materialised once: the range shuffle is not repeated for the two uses
    # below, and the record ids are persisted, so a retried task cannot renumber
    ranged = materialize(df.repartitionByRange(nparts, spec.entity, spec.period)
                         .sortWithinPartitions(spec.entity, spec.period)
                         .withColumn("__pid", F.spark_partition_id())
                         .withColumn("__idx", F.monotonically_increasing_id()))
    slices = ranged.groupBy("__pid", spec.entity).agg(F.min("__idx").alias("__first"),
                                                      F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(spec.entity).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return (ranged.join(slices.select("__pid", spec.entity, "__first", "__offset"), ["__pid", spec.entity])
            .withColumn(out, F.col("__offset") + F.col("__idx") - F.col("__first"))
            .drop("__pid", "__idx", "__first", "__offset"))
