"""Registry of named queries: each key has a Spark builder and, where the
operator is exactly expressible in SQL, the DuckDB text of the same result.

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame.  Every double
output column is rounded (``finish``) and the oracle rounds the same columns,
so the driver's value hash compares like with like.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def query(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


#: Means of numbers of few decimals often lie halfway between two roundings, where the engines' last bits would decide.
#: Both sides of a comparison add this first.
SHIFT = 1.3e-8


def finish(df: DataFrame, digits: int = DIGITS, shift: float = 0.0) -> DataFrame:
    """Round every float/double column (top level) to ``digits`` places after adding ``shift``."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # "+ 0.0" turns a negative zero into 0.0 so both engines print the same value
            out.append((F.round(F.col(f"`{f.name}`") + F.lit(shift), digits) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


MODULES = ("q_features", "q_clean", "q_summary", "q_sources", "q_rules",
           "q_series", "q_models", "q_unsupervised", "q_workflows")


def load_all() -> None:
    """Import every query module so their ``@query`` decorators run."""
    import importlib
    import importlib.util

    for m in MODULES:
        name = f"cadence.plans.{m}"
        if importlib.util.find_spec(name) is not None:
            importlib.import_module(name)
