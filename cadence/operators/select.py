"""Projections, filters, predicates (P1-P9) and the join forms of section 2.6."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators import clean as CL
from cadence.spec import PanelSpec, present

BASE_FEATURES = ("cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1")


def panel_filter(df: DataFrame, spec: PanelSpec, entities: Sequence[str] | None = None,
                 start: int | None = None, end: int | None = None) -> DataFrame:
    """Entity list and period range; both reach the scan as pushed filters."""
    cond = F.lit(True)
    if entities is not None:
        cond = cond & F.col(spec.entity).isin(list(entities))
    if start is not None:
        cond = cond & (F.col(spec.period) >= start)
    if end is not None:
        cond = cond & (F.col(spec.period) <= end)
    return df.filter(cond)


def drop_any(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.na.drop("any", subset=present(df, cols))


def drop_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows only when every one of ``cols`` is null."""
    return df.na.drop("all", subset=present(df, cols))


def fill_const(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Remaining nulls -> constant."""
    return df.na.fill(value, subset=present(df, cols))


def model_frame(df: DataFrame, spec: PanelSpec, target: str = "log_gdp_volatility",
                features: Sequence[str] | None = None, include_governance: bool = True,
                include_exchange_rate: bool = True, impute: bool = True) -> tuple[DataFrame, list[str]]:
    """P5: impute -> pick features (column check) -> drop incomplete rows -> keys, features, label."""
    clean = CL.impute(df, spec, "median") if impute else df
    if features is None:
        features = list(BASE_FEATURES)
        if include_governance and "governance_index_lag1" in clean.columns:
            features.append("governance_index_lag1")
        if include_exchange_rate and "exchange_rate_volatility_lag1" in clean.columns:
            features.append("exchange_rate_volatility_lag1")
    features = present(clean, features)
    out = clean.select(spec.entity, spec.period, *features, target).na.drop("any", subset=features + [target])
    return out, features


def outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer equi-join of already-wide frames on ``keys``.

    For long input prefer ``pivot_wide`` (one shuffle instead of one per frame).
    """
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), frames)
