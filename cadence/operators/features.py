"""Feature derivation (F1-F14): row math and per-entity windows.

Every row-based window here uses the same ``spec.window()`` (partition by
entity, order by period), so a chain of them plans as one Exchange + one
Sort followed by Window nodes; check with ``explain``.  Windows count rows,
not periods, as the reference does (gaps widen a window); ``by_range=True``
switches the rolling frames to a period range.  Entities too long for one task are cut into slices
with a halo (``slices``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators import slices as SC
from cadence.spec import PanelSpec, present

COMMODITY_COLS = ("fuel_exports_pct", "metals_exports_pct", "agri_exports_pct", "food_exports_pct")
GOVERNANCE_COLS = ("control_corruption", "govt_effectiveness", "political_stability",
                   "regulatory_quality", "rule_of_law", "voice_accountability")
# Lagged by the full feature step, and by the smaller staged-run step.
LAG_FEATURES = ("cdi_smooth", "inflation", "trade_openness", "investment",
                "governance_index", "exchange_rate_volatility")
LAG_FEATURES_SHORT = ("cdi_smooth", "inflation", "trade_openness", "investment")
LOG_OFFSET = 0.01


def _frame(spec: PanelSpec, size: int, by_range: bool):
    w = spec.window()
    return w.rangeBetween(-(size - 1), 0) if by_range else w.rowsBetween(-(size - 1), 0)


def capped_sum(df: DataFrame, cols: Sequence[str] = COMMODITY_COLS, out: str = "cdi_raw",
               cap: float = 100.0) -> DataFrame:
    """sum of the present columns with nulls as 0, capped (all missing -> 0)."""
    have = present(df, cols)
    if not have:
        return df.withColumn(out, F.lit(0.0))
    return df.withColumn(out, X.capped_sum(have, cap))


def _rolling(df: DataFrame, spec: PanelSpec, col: str, out: str, size: int, min_periods: int, by_range: bool, fn) -> DataFrame:
    def run(d: DataFrame, s: PanelSpec) -> DataFrame:
        w = _frame(s, size, by_range)
        return d.withColumn(out, F.when(F.count(col).over(w) >= min_periods, fn(col).over(w)))

    return SC.over(df, spec, run, before=size - 1)


def rolling_mean(df: DataFrame, spec: PanelSpec, col: str, out: str, size: int = 3,
                 min_periods: int = 1, by_range: bool = False) -> DataFrame:
    """mean over the last ``size`` rows of the entity, NULL below ``min_periods`` values."""
    return _rolling(df, spec, col, out, size, min_periods, by_range, F.avg)


def rolling_std(df: DataFrame, spec: PanelSpec, col: str, out: str, size: int,
                min_periods: int, by_range: bool = False) -> DataFrame:
    """sample standard deviation over the last ``size`` rows."""
    return _rolling(df, spec, col, out, size, min_periods, by_range, F.stddev_samp)


def row_mean(df: DataFrame, cols: Sequence[str] = GOVERNANCE_COLS, out: str = "governance_index",
             only_if_absent: bool = True) -> DataFrame:
    """mean of the present, non-null columns of each row."""
    if only_if_absent and out in df.columns:
        return df
    have = present(df, cols)
    if not have:
        return df
    return df.withColumn(out, X.row_mean(have))


def pct_change(df: DataFrame, spec: PanelSpec, col: str, out: str, pad: bool = True) -> DataFrame:
    """per-entity percent change x 100 (zero base -> NULL)."""
    def run(d: DataFrame, s: PanelSpec) -> DataFrame:
        if not pad:
            return d.withColumn(out, X.pct_change(col, s.window(), pad=False))
        # the padded series at this row and at the previous row
        return d.withColumn(out, (X.share(SC.last_value(s, col), SC.last_value(s, col, 1)) - F.lit(1.0)) * F.lit(100.0))

    return SC.over(df, spec, run, before=1, carry=[col] if pad else [])


def log_offset(df: DataFrame, col: str = "gdp_volatility", out: str = "log_gdp_volatility",
               offset: float = LOG_OFFSET) -> DataFrame:
    """ln(x + offset); NULL where the argument is not positive."""
    return df.withColumn(out, X.safe_log(F.col(col) + F.lit(offset)))


def exp_back(df: DataFrame, col: str = "log_gdp_volatility", out: str = "gdp_volatility_est") -> DataFrame:
    """F8: exp(x); the offset of F7 is deliberately not subtracted."""
    return df.withColumn(out, F.exp(col))


def add_lags(df: DataFrame, spec: PanelSpec, cols: Sequence[str] = LAG_FEATURES, k: int = 1,
             suffix: str | None = None) -> DataFrame:
    """previous-row value of each present column within the entity."""
    suffix = suffix or f"_lag{k}"
    return SC.over(df, spec, lambda d, s: d.select("*", *[F.lag(c, k).over(s.window()).alias(f"{c}{suffix}") for c in present(df, cols)]), before=k)


def add_lead(df: DataFrame, spec: PanelSpec, col: str = "gdp_growth", out: str = "gdp_growth_next",
             k: int = 1) -> DataFrame:
    """next-row value within the entity (the one-step-ahead target)."""
    return SC.over(df, spec, lambda d, s: d.withColumn(out, F.lead(col, k).over(s.window())), after=k)


def ingest_derivations(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The derived columns made at ingest: cdi_raw, exchange-rate change and
    volatility, governance index (S5 after the pivot)."""
    out = capped_sum(df)
    if "exchange_rate" in df.columns:
        def changes(d: DataFrame, s: PanelSpec) -> DataFrame:
            d = pct_change(d, s, "exchange_rate", "exchange_rate_change", pad=True)
            return rolling_std(d, s, "exchange_rate_change", "exchange_rate_volatility", 3, 2)

        out = SC.over(out, spec, changes, before=3, carry=["exchange_rate"])
    return row_mean(out, only_if_absent=False)


def feature_set(df: DataFrame, spec: PanelSpec, lags: Sequence[str] = LAG_FEATURES) -> DataFrame:
    """smoothed CDI, GDP volatility and its log, governance index, lags.

    All windows share one partition/order spec: one shuffle, one sort.
    """
    def run(out: DataFrame, s: PanelSpec) -> DataFrame:
        if "cdi_raw" in out.columns:
            out = rolling_mean(out, s, "cdi_raw", "cdi_smooth", 3, 1)
        if "gdp_growth" in out.columns:
            out = rolling_std(out, s, "gdp_growth", "gdp_volatility", 5, 3)
            out = log_offset(out)
        return add_lags(row_mean(out, only_if_absent=True), s, lags)

    return SC.over(df, spec, run, before=5)  # a lag of a rolling value


def usable_counts(df: DataFrame, features: Sequence[str], key_features: Sequence[str]) -> DataFrame:
    """non-null count per feature, and rows with every key feature present.

    Returns one row per feature plus an ``__all_key_features__`` row.
    """
    have = present(df, features)
    keys = present(df, key_features)
    all_present = F.count_if(F.lit(True) if not keys else
                             F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in keys)))
    agg = df.agg(*[F.count(c).alias(c) for c in have], all_present.alias("__all_key_features__"),
                 F.count(F.lit(1)).alias("__rows__"))
    names = have + ["__all_key_features__"]
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_null")) for c in names]))
    return agg.select(stack.alias("s"), "__rows__").select("s.feature", "s.non_null", F.col("__rows__").alias("rows"))


def interpolate(df: DataFrame, spec: PanelSpec, col: str, out: str | None = None,
                drop_missing: bool = True) -> DataFrame:
    """linear interpolation by row position within each entity.

    Interior nulls take the straight line between the nearest non-null rows
    before and after; trailing nulls repeat the last value; leading nulls stay
    NULL and, with ``drop_missing``, the row is dropped.
    """
    out = out or col

    def run(d: DataFrame, s: PanelSpec) -> DataFrame:
        t = d.withColumn("__at", SC.position(s).cast("long"))
        t = t.withColumn("__prev", SC.last_pair(s, col, "__at")).withColumn("__next", SC.next_pair(s, col, "__at"))
        p0, v0, p1, v1 = (F.col("__prev.p"), F.col("__prev.v"), F.col("__next.p"), F.col("__next.v"))
        line = v0 + (v1 - v0) * (F.col("__at") - p0).cast("double") / (p1 - p0).cast("double")
        value = (F.when(F.col(col).isNotNull(), F.col(col))
                 .when(F.col("__prev").isNull(), X.null_double())
                 .when(F.col("__next").isNull(), v0)
                 .otherwise(line))
        return t.withColumn(out, value).drop("__at", "__prev", "__next")

    res = SC.over(df, spec, run, carry=[col])
    return res.filter(F.col(out).isNotNull()) if drop_missing else res


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / population std.

    Fit then transform: one global aggregate (partial per task, one row out)
    gives the statistics, which are inlined as literals.  A constant column
    (std 0) scales to 0, as the reference's scaler does.
    """
    stats = X.one_row(df.agg(*[F.avg(c).alias(f"mu_{c}") for c in cols],
                             *[F.stddev_pop(c).alias(f"sd_{c}") for c in cols]))
    return df.select("*", *[X.standardize(c, stats[f"mu_{c}"], stats[f"sd_{c}"]).alias(f"{c}{suffix}")
                            for c in cols])


# ---- skew-safe forms: positions + equi-joins instead of one window partition per entity ----------
def lag_join(df: DataFrame, spec: PanelSpec, cols: Sequence[str], k: int = 1, pos: str = "pos") -> DataFrame:
    """F9 for a panel whose single entity may hold a large share of the rows.

    ``df`` carries positions (``split.entity_positions``); the lag is an equi-join
    on (entity, position - k), which hash-distributes a hot entity over tasks.
    """
    shifted = df.select(spec.entity, (F.col(pos) + k).alias(pos), *[F.col(c).alias(f"{c}_lag{k}") for c in cols])
    return df.join(shifted, [spec.entity, pos], "left")


def rolling_join(df: DataFrame, spec: PanelSpec, col: str, out: str, size: int, min_periods: int,
                 stat: str = "std", pos: str = "pos") -> DataFrame:
    """F2/F5/F6 for a hot entity: every row is copied to the ``size`` positions whose
    window contains it (bounded fan-out), aggregated by (entity, position), joined back."""
    copies = (df.select(spec.entity, F.col(col).alias("__v"), F.col(pos).alias("__p"),
                        F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("__off"))
              .select(spec.entity, "__v", (F.col("__p") + F.col("__off")).alias(pos)))
    fn = F.stddev_samp("__v") if stat == "std" else F.avg("__v")
    agg = copies.groupBy(spec.entity, pos).agg(F.count("__v").alias("__c"), fn.alias("__s"))
    return (df.join(agg, [spec.entity, pos], "left")
            .withColumn(out, F.when(F.col("__c") >= min_periods, F.col("__s"))).drop("__c", "__s"))
