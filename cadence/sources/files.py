"""File sources and sinks (S7, S8), dimension joins.

Sinks write to a folder under the session's shared checkpoint/output
location; nothing is written to a machine-local path on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for stage outputs")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> str:
    """Overwrite sink with a header for CSV; partition by period when large."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.format(fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan with a declared schema (CSV never infers)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV scans need a declared schema")
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def group_filter(df: DataFrame, groups: DataFrame, group: str, default: str = "default",
                 entity: str = "entity") -> DataFrame:
    """Keep the entities of ``group``; a group that does not exist falls
    back to ``default``.  The membership test is a left-semi join."""
    exists = groups.filter(F.col("group_name") == group).limit(1).count() > 0
    chosen = group if exists else default
    members = groups.filter(F.col("group_name") == chosen).select(F.col("entity").alias(entity)).distinct()
    return df.join(members, entity, "left_semi")


def resolve_names(df: DataFrame, static: DataFrame, entity: str = "entity",
                  name: str = "entity_name") -> DataFrame:
    """Entity -> display name with precedence data name > static name > code.

    ``static`` is a dimension (entity, static_name).  Returns one row per
    entity with the chosen name and where it came from.
    """
    data = df.groupBy(entity).agg(F.max(name).alias("__data_name"))
    j = data.join(static, entity, "left")
    chosen = F.coalesce(F.col("__data_name"), F.col("static_name"), F.col(entity))
    source = (F.when(F.col("__data_name").isNotNull(), "data").when(F.col("static_name").isNotNull(), "static")
              .otherwise("code"))
    return j.select(entity, chosen.alias("display_name"), source.alias("name_source"))
