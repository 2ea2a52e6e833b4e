"""Scoring and business rules (R1-R8), for every entity at once.

The latest row per entity is a ``max_by(struct, period)`` aggregate, which
combines partially per task (a hot entity costs one struct per task, not a
sort of all its rows).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators import quantiles as QU
from cadence.spec import PanelSpec, first_present, present

# Fixed values: (lagged feature, current column, default) of the volatility scorer's fallback chain.
VOLATILITY_FALLBACKS = (
    ("cdi_smooth_lag1", "cdi_smooth", 50.0),
    ("inflation_lag1", "inflation", 5.0),
    ("trade_openness_lag1", "trade_openness", 50.0),
    ("investment_lag1", "investment", 20.0),
    ("governance_index_lag1", "governance_index", 0.0),
    ("exchange_rate_volatility_lag1", "exchange_rate_volatility", 5.0),
)
# Current-value inputs of the growth scorer (fallback: entity median, then 0).
GROWTH_INPUTS = ("cdi_smooth", "inflation", "trade_openness", "investment", "governance_index",
                 "exchange_rate_volatility", "gdp_growth")


def latest(df: DataFrame, spec: PanelSpec, cols: Sequence[str] | None = None) -> DataFrame:
    """The row with the largest period of each entity."""
    cols = [c for c in (cols or df.columns) if c != spec.entity]
    return (df.groupBy(spec.entity).agg(F.max_by(F.struct(*cols), spec.period).alias("__last"))
            .select(spec.entity, "__last.*"))


def fallback_features(df: DataFrame, spec: PanelSpec,
                      chain: Sequence[tuple[str, str, float]] = VOLATILITY_FALLBACKS) -> DataFrame:
    """R2 (first form): per entity, lagged value -> current value -> entity median -> default -> 0.

    One aggregate gives the latest row; the medians come by selection (``quantiles``).
    """
    use = [(lag, cur, dflt) for lag, cur, dflt in chain if lag in df.columns or cur in df.columns]
    last_cols = sorted({c for lag, cur, _ in use for c in (lag, cur) if c in df.columns})
    agg = df.groupBy(spec.entity).agg(
        F.max(spec.period).alias(spec.period),
        F.max_by(F.struct(*last_cols), spec.period).alias("__last"))
    agg = agg.join(QU.medians(df, [cur for _, cur, _ in use if cur in df.columns], [spec.entity], "__med_"), spec.entity, "left")
    out = []
    for lag, cur, dflt in use:
        parts = []
        if lag in df.columns:
            parts.append(F.col(f"__last.{lag}"))
        if cur in df.columns:
            parts += [F.col(f"__last.{cur}"), F.col(f"__med_{cur}")]
        parts += [F.lit(float(dflt)), F.lit(0.0)]
        out.append(F.coalesce(*parts).alias(lag))
    return agg.select(spec.entity, spec.period, *out)


def fallback_current(df: DataFrame, spec: PanelSpec, cols: Sequence[str] = GROWTH_INPUTS) -> DataFrame:
    """R2 (second form): latest value -> entity median -> 0."""
    cols = present(df, cols)
    agg = df.groupBy(spec.entity).agg(F.max(spec.period).alias(spec.period),
                                      F.max_by(F.struct(*cols), spec.period).alias("__last"))
    agg = agg.join(QU.medians(df, cols, [spec.entity], "__med_"), spec.entity, "left")
    return agg.select(spec.entity, spec.period,
                      *[F.coalesce(F.col(f"__last.{c}"), F.col(f"__med_{c}"), F.lit(0.0)).alias(c) for c in cols])


def volatility_level(df: DataFrame, col: str, out: str = "volatility_level") -> DataFrame:
    """> 2 HIGH, > 1 MODERATE, else LOW (NULL stays NULL)."""
    c = F.col(col)
    return df.withColumn(out, F.when(c > 2.0, "HIGH").when(c > 1.0, "MODERATE").when(c.isNotNull(), "LOW"))


def risk_flags(df: DataFrame, out: str = "risk_factors") -> DataFrame:
    """List of risk factors of a row (empty list when none)."""
    cdi = first_present(df, "cdi_smooth", "cdi_raw")
    rules = []
    if cdi:
        rules.append(F.when(F.col(cdi) > 70, F.lit("High commodity dependence")))
    if "inflation" in df.columns:
        rules.append(F.when(F.col("inflation") > 10, F.lit("High inflation")))
    if "investment" in df.columns:
        rules.append(F.when(F.col("investment") < 20, F.lit("Low investment")))
    if "governance_index" in df.columns:
        rules.append(F.when(F.col("governance_index") < -0.5, F.lit("Weak governance")))
    flags = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    return df.withColumn(out, flags)


def outlook(df: DataFrame, col: str, out: str = "outlook") -> DataFrame:
    """Growth outlook class of a predicted value."""
    c = F.col(col)
    return df.withColumn(out, F.when(c > 5, "Strong growth").when(c > 2, "Moderate growth")
                         .when(c > 0, "Slow growth").when(c > -2, "Slight contraction")
                         .when(c.isNotNull(), "Recession risk"))


def versus_history(pred: DataFrame, history: DataFrame, spec: PanelSpec, pred_col: str,
                   col: str = "gdp_growth") -> DataFrame:
    """Prediction minus the entity's historical mean, with above/below."""
    hist = history.groupBy(spec.entity).agg(F.avg(col).alias("historical_mean"))
    j = pred.join(hist, spec.entity, "left")
    diff = F.col(pred_col) - F.col("historical_mean")
    return j.withColumn("difference", diff).withColumn(
        "position", F.when(diff > 0, "above").when(diff.isNotNull(), "below"))
