"""Panel description and column checks.

A panel is any DataFrame with an entity key, an ordered period column and a
set of numeric measures.  ``PanelSpec`` carries those names; every operator
takes one so nothing is hard-wired to a particular table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class PanelSpec:
    entity: str = "entity"
    period: str = "period"
    name: str | None = "entity_name"
    measures: tuple[str, ...] = field(default_factory=tuple)
    slice: str | None = None  # column that cuts long entities (``operators.slices``)

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]

    def window(self, descending: bool = False):
        """The per-entity ordered window every row-based derivation shares."""
        by = [self.entity] if self.slice is None else [self.entity, self.slice]
        return Window.partitionBy(*by).orderBy(F.col(self.period).desc() if descending else F.col(self.period))

    def with_measures(self, measures: Iterable[str]) -> "PanelSpec":
        return replace(self, measures=tuple(measures))


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Keep the listed columns that exist (order kept)."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def first_present(df: DataFrame, *candidates: str) -> str | None:
    """The first candidate column that exists, for 'use B when A is absent'."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def require(df: DataFrame, columns: Sequence[str], minimum: int | None = None,
            what: str = "operator") -> list[str]:
    """Column check: raise when fewer than ``minimum`` of ``columns`` exist."""
    cols = present(df, columns)
    need = len(columns) if minimum is None else minimum
    if len(cols) < need:
        raise ValueError(f"{what} needs at least {need} of {list(columns)}; found {cols}")
    return cols


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def numeric_candidates(df: DataFrame, spec: PanelSpec, min_non_null: int = 5) -> DataFrame:
    """Non-key numeric columns with more than ``min_non_null`` values.

    The dtype scan happens at plan time; one aggregate counts non-nulls.
    Returns ``(column, non_null)`` rows for the qualifying columns.
    """
    cols = numeric_columns(df, exclude=[spec.entity, spec.period, "entity_no"])
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null")) for c in cols]))
    return (counts.select(stack.alias("s")).select("s.column", "s.non_null")
            .filter(F.col("non_null") > min_non_null))
