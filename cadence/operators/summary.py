"""Aggregations, grouping, top-k, bucketing.

Aggregates combine partially per task before their shuffle; exact quantiles come by distributed
selection (``quantiles``), with an ``approx`` switch to the bounded ``percentile_approx`` sketch.  Global cut
points (median split, quartiles, histogram range) are fitted by one
aggregate and applied as literals, never by a window over the whole table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators import quantiles as QU
from cadence.spec import PanelSpec, first_present, present

KEY_VARS = ("cdi_smooth", "gdp_growth", "gdp_volatility", "governance_index", "inflation")
CLUSTER_FEATURES = ("cdi_smooth", "gdp_volatility", "governance_index", "inflation", "investment",
                    "trade_openness")
QUARTILE_LABELS = ("Q1 (Low)", "Q2", "Q3", "Q4 (High)")


def overview(df: DataFrame, spec: PanelSpec, approx: bool = False) -> DataFrame:
    """A1: rows, distinct entities, first and last period."""
    distinct = F.approx_count_distinct(spec.entity) if approx else F.count_distinct(spec.entity)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_entities"),
                  F.min(spec.period).alias("first_period"), F.max(spec.period).alias("last_period"))


def _long(agg: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn a one-row wide aggregate (``{field}__{col}``) into one row per column."""
    rows = F.array(*[F.struct(F.lit(c).alias("variable"),
                              *[F.col(f"{f}__{c}").alias(f) for f in fields]) for c in cols])
    return agg.select(F.explode(rows).alias("s")).select("s.*")


def var_stats(df: DataFrame, cols: Sequence[str] = KEY_VARS) -> DataFrame:
    """A2: mean and sample std per present variable."""
    cols = present(df, cols)
    agg = df.agg(*[F.avg(c).alias(f"mean__{c}") for c in cols], *[F.stddev_samp(c).alias(f"std__{c}") for c in cols])
    return _long(agg, cols, ["mean", "std"])


DESCRIBE_FIELDS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
QUARTILES = [0.25, 0.5, 0.75]


def _described(df: DataFrame, by: Sequence[str], cols: Sequence[str], approx: bool) -> DataFrame:
    """(``by``..., variable, count, mean, ... max) of every column per group."""
    rows = []
    for c in cols:
        q = F.percentile_approx(c, QUARTILES, 10000) if approx else None
        rows.append(F.struct(F.lit(c).alias("variable"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                             F.min(c).cast("double").alias("min"), *([q[k].cast("double").alias(f"q{k}") for k in range(3)] if approx else []),
                             F.max(c).cast("double").alias("max")))
    base = df.groupBy(*by).agg(F.array(*rows).alias("s")).select(*by, F.explode("s").alias("s")).select(*by, "s.*")
    if not approx:
        q = QU.quantiles(df, cols, QUARTILES, by).alias("q")
        same = F.col("b.variable") == F.col("q.column")
        for k in by:
            same = same & F.col(f"b.{k}").eqNullSafe(F.col(f"q.{k}"))
        base = base.alias("b").join(q, same, "left").select("b.*", *[f"q.q{k}" for k in range(3)])
    named = base.withColumnsRenamed({"q0": "q25", "q1": "q50", "q2": "q75"})
    return named.select(*by, "variable", *DESCRIBE_FIELDS)


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """A3: count, mean, std, min, quartiles, max per column (exact quartiles by default)."""
    return _described(df, [], present(df, cols), approx)


def grouped_describe(df: DataFrame, by: str, col: str, approx: bool = False) -> DataFrame:
    """A4: ``describe`` of one column per group."""
    return _described(df, [by], [col], approx).drop("variable")


def entity_means(df: DataFrame, spec: PanelSpec, cols: Sequence[str] = CLUSTER_FEATURES,
                 minimum: int | None = None, dropna: bool = True) -> DataFrame:
    """A5: one row per entity with the mean of each feature and its first name.

    'first' is made order-free as the name at the earliest period.
    """
    have = present(df, cols)
    if minimum is not None and len(have) < minimum:
        raise ValueError(f"need at least {minimum} features, found {have}")
    aggs = [F.avg(c).alias(c) for c in have]
    if spec.name and spec.name in df.columns:
        aggs.append(F.min_by(spec.name, spec.period).alias(spec.name))
    out = df.groupBy(spec.entity).agg(*aggs)
    return out.na.drop("any", subset=have) if dropna else out


def top_n(df: DataFrame, spec: PanelSpec, col: str = "cdi_smooth", n: int = 5) -> DataFrame:
    """The n entities with the highest mean (ties by entity); a top-k, so the limit is the feature."""
    means = df.groupBy(spec.entity).agg(F.avg(col).alias(f"mean_{col}"))
    return means.orderBy(F.col(f"mean_{col}").desc_nulls_last(), F.col(spec.entity)).limit(n)


def entity_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows per entity, largest first."""
    return df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.col("n_rows").desc(), spec.entity)


def region_compare(df: DataFrame, spec: PanelSpec, by: str | None = None) -> DataFrame:
    """Means of the available comparison metrics per entity name, rounded to 2 (half-even)."""
    by = by or spec.name
    cdi = first_present(df, "cdi_smooth", "cdi_raw")
    vol = first_present(df, "gdp_volatility", "log_gdp_volatility")
    cols = [c for c in (cdi, vol, "inflation", "investment", "gdp_growth") if c and c in df.columns]
    return df.groupBy(by).agg(*[F.bround(F.avg(c), 2).alias(c) for c in cols])


def entity_kpis(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per-entity mean CDI, volatility level, inflation and investment."""
    aggs = []
    cdi = first_present(df, "cdi_smooth", "cdi_raw")
    if cdi:
        aggs.append(F.avg(cdi).alias("avg_cdi"))
    if "log_gdp_volatility" in df.columns:
        aggs.append(F.exp(F.avg("log_gdp_volatility")).alias("avg_volatility"))
    elif "gdp_volatility" in df.columns:
        aggs.append(F.avg("gdp_volatility").alias("avg_volatility"))
    for c, a in (("inflation", "avg_inflation"), ("investment", "avg_investment")):
        if c in df.columns:
            aggs.append(F.avg(c).alias(a))
    return df.groupBy(spec.entity).agg(*aggs)


def growth_stats(df: DataFrame, spec: PanelSpec, col: str = "gdp_growth") -> DataFrame:
    """A10: mean, max, min and sample std of growth per entity."""
    return df.groupBy(spec.entity).agg(F.avg(col).alias("avg_growth"), F.max(col).alias("max_growth"),
                                       F.min(col).alias("min_growth"), F.stddev_samp(col).alias("std_growth"))


def median_split(df: DataFrame, spec: PanelSpec, split_col: str = "cdi_smooth",
                 outcome: str = "gdp_growth", approx: bool = False) -> DataFrame:
    """Entity means, split at their median (high: >, low: <=); low minus high."""
    em = df.groupBy(spec.entity).agg(F.avg(split_col).alias("s"), F.avg(outcome).alias("o")).na.drop("any")
    if approx:
        med = X.one_row(em.agg(F.percentile_approx("s", 0.5, 10000).alias("m")))["m"]
    else:
        med = (QU.of_columns(em, ["s"], [0.5])["s"] or [None])[0]
    high = F.col("s") > X.lit_d(med)
    out = em.agg(F.count_if(high).alias("n_high"), F.count_if(~high).alias("n_low"),
                 F.avg(F.when(high, F.col("o"))).alias("high_mean"),
                 F.avg(F.when(~high, F.col("o"))).alias("low_mean"))
    return out.select(X.lit_d(med).alias("median_split_value"), "n_high", "n_low", "high_mean", "low_mean",
                      (F.col("low_mean") - F.col("high_mean")).alias("difference"),
                      ((F.col("low_mean") - F.col("high_mean")) > 0).alias("paradox_confirmed"))


def quartile_bucket(df: DataFrame, col: str = "cdi_smooth", out: str = "cdi_quartile",
                    labels: Sequence[str] = QUARTILE_LABELS, approx: bool = False) -> DataFrame:
    """Equal-frequency quartile label (right-closed, lowest included); NULL input dropped."""
    ps = [0.25, 0.5, 0.75]
    q = X.one_row(df.agg(F.percentile_approx(col, ps, 10000).alias("q")))["q"] if approx else QU.of_columns(df, [col], ps)[col]
    if q is None:  # no values: no rows either
        q = [None] * 3
    x = F.col(col)
    label = (F.when(x <= q[0], labels[0]).when(x <= q[1], labels[1]).when(x <= q[2], labels[2])
             .otherwise(labels[3]))
    return df.filter(x.isNotNull()).withColumn(out, label)


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed."""
    st = X.one_row(df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")))
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, bin_low double, bin_high double, n long")
    width = (hi - lo) if hi > lo else 1.0
    b = F.least(F.lit(bins), (F.floor((F.col(col) - F.lit(lo)) / F.lit(width) * F.lit(bins)) + 1).cast("int"))
    return (df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width / bins)).alias("bin_low"),
                    (F.lit(lo) + F.col("bin") * F.lit(width / bins)).alias("bin_high"), "n"))


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares straight line y = slope * x + intercept over complete pairs."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_count(y, x).alias("n"))


def naive_forecast(df: DataFrame, spec: PanelSpec, col: str = "gdp_growth", last: int = 5) -> DataFrame:
    """Mean of the last ``last`` rows per entity (nulls ignored), for the next period."""
    w = Window.partitionBy(spec.entity).orderBy(F.col(spec.period).desc())
    return (df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= last)
            .groupBy(spec.entity).agg(F.avg(col).alias("forecast"), (F.max(spec.period) + 1).alias(spec.period)))


def sort_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """(entity, period) order; only for sinks, windows sort by themselves."""
    return df.orderBy(spec.entity, spec.period)


def distinct_names(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct (entity, name) pairs."""
    return df.select(spec.entity, spec.name).distinct()


def union_forecast(history: DataFrame, forecast: DataFrame, spec: PanelSpec, col: str = "gdp_growth") -> DataFrame:
    """History rows and forecast rows in one table with a type tag."""
    h = history.select(spec.entity, spec.period, F.col(col).alias(col), F.lit("Historical").alias("type"))
    f = forecast.select(spec.entity, spec.period, F.col("forecast").alias(col), F.lit("Forecast").alias("type"))
    return h.unionByName(f)
