"""Data cleaning and quality.

Per-entity statistics are computed with ``groupBy(entity).agg`` and joined
back instead of as a window: the aggregate combines map-side, and the join of
a one-row-per-entity table is either broadcast by AQE (small) or split by AQE's
skew handling when one entity holds a large share of the rows.  Global
statistics are fitted with one aggregate and applied as literals.

Medians and quartiles are exact, by distributed selection (``quantiles``); ``approx=True`` takes
``percentile_approx`` (a bounded sketch) instead.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions import exprs as X
from cadence.operators import quantiles as QU
from cadence.operators import slices as SC
from cadence.spec import PanelSpec, numeric_columns, present

DROP_KEYS = ("cdi_smooth_lag1", "inflation_lag1", "trade_openness_lag1", "investment_lag1",
             "log_gdp_volatility")
TARGET = "log_gdp_volatility"
QUALITY_COLS = ("gdp_growth", "cdi_smooth", "cdi_raw", "inflation", "investment",
                "governance_index", "trade_openness")
AVAILABILITY_COLS = ("gdp_growth", "cdi_smooth", "inflation", "governance_index")


def _impute_cols(df: DataFrame, spec: PanelSpec, cols: Sequence[str] | None) -> list[str]:
    if cols is not None:
        return present(df, cols)
    return numeric_columns(df, exclude=[spec.entity, spec.period, "entity_no"])


def impute(df: DataFrame, spec: PanelSpec, method: str = "median", cols: Sequence[str] | None = None,
           target: str | None = TARGET, approx: bool = False) -> DataFrame:
    """D1a-c, D1f: fill nulls within each entity, then globally; drop rows without target.

    * ``median``/``mean``: entity statistic, then the global statistic of the
      already-filled column.
    * ``forward_fill``: last value forward, then first value backward, per entity.
    """
    cols = _impute_cols(df, spec, cols)
    if method in ("median", "mean"):
        exact = method == "median" and not approx
        stat = (lambda c: F.percentile_approx(c, 0.5, 10000)) if method == "median" else F.avg
        per_entity = QU.medians(df, cols, [spec.entity], "__e_") if exact else df.groupBy(spec.entity).agg(*[stat(c).alias(f"__e_{c}") for c in cols])
        filled = df.join(per_entity, spec.entity, "left").select(
            *[F.coalesce(F.col(c), F.col(f"__e_{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])
        glob = ({c: q and q[0] for c, q in QU.of_columns(filled, cols, [0.5]).items()} if exact
                else X.one_row(filled.agg(*[stat(c).alias(c) for c in cols])))
        out = filled.select(*[F.coalesce(F.col(c), X.lit_d(glob[c])).alias(c) if c in cols else F.col(c)
                              for c in df.columns])
    elif method == "forward_fill":
        out = SC.over(df, spec, lambda d, s: d.select(*[F.coalesce(SC.last_value(s, c), SC.next_value(s, c)).alias(c) if c in cols
                                                        else F.col(c) for c in d.columns]), carry=cols)
    else:
        raise ValueError(f"unknown method {method!r}")
    if target and target in out.columns:
        out = out.na.drop("any", subset=[target])
    return out


def drop_missing(df: DataFrame, keys: Sequence[str] = DROP_KEYS) -> DataFrame:
    """D1d: the drop strategy (rows missing any key feature)."""
    return df.na.drop("any", subset=present(df, keys))


def imputation_report(before: DataFrame, after: DataFrame, spec: PanelSpec,
                      cols: Sequence[str] | None = None) -> DataFrame:
    """D1e: median of each imputed column (columns that had nulls), after filling."""
    cols = _impute_cols(before, spec, cols)
    nulls = X.one_row(before.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]))
    had = [c for c in cols if nulls.get(c)]
    if not had:
        return after.sparkSession.createDataFrame([], "column string, median double")
    med = QU.quantiles(after, had, [0.5]).withColumnRenamed("q0", "median")
    return after.sparkSession.createDataFrame([(c,) for c in had], "column string").join(med, "column", "left")


def iqr_cap(df: DataFrame, cols: Sequence[str], threshold: float = 3.0, approx: bool = False) -> DataFrame:
    """Clip each column to [q1 - t*iqr, q3 + t*iqr] with global quartiles; NULL stays NULL."""
    cols = present(df, cols)
    stats = (X.one_row(df.agg(*[F.percentile_approx(c, [0.25, 0.75], 10000).alias(c) for c in cols])) if approx
             else QU.of_columns(df, cols, [0.25, 0.75]))
    out = []
    for c in df.columns:
        if c in cols and stats[c] is not None:
            q1, q3 = stats[c]
            lo, hi = q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)
            # greatest/least skip NULLs, so guard to keep a NULL input NULL
            out.append(F.when(F.col(c).isNotNull(),
                              F.greatest(F.lit(lo), F.least(F.lit(hi), F.col(c)))).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def zscore_filter(df: DataFrame, cols: Sequence[str], threshold: float = 3.0,
                  sequential: bool = True) -> DataFrame:
    """D3: keep rows with |z| < threshold (sample std); NULL rows drop out.

    ``sequential`` recomputes the statistics after each column's filter, as the
    reference does; otherwise all columns use statistics of the input.
    """
    cols = present(df, cols)
    out = df
    if not sequential:
        st = X.one_row(df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                              *[F.stddev_samp(c).alias(f"s_{c}") for c in cols]))
    for c in cols:
        if sequential:
            st = X.one_row(out.agg(F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")))
        mu, sd = st[f"m_{c}"], st[f"s_{c}"]
        if mu is None or not sd:
            out = out.filter(F.lit(False))
            continue
        out = out.filter(F.abs((F.col(c) - F.lit(mu)) / F.lit(sd)) < threshold)
    return out


def validate(df: DataFrame, spec: PanelSpec, target: str = TARGET) -> DataFrame:
    """(check, passed) rows for the five validation checks.

    Three chained aggregates (by key, by entity, global) answer every check in
    one job: each level combines partially before its shuffle.
    """
    required = [spec.entity, spec.period, target]
    has_required = all(c in df.columns for c in required)
    ranges = []
    if target in df.columns:
        ranges += [F.col(target) > -10, F.col(target) < 10]
    if "cdi_smooth_lag1" in df.columns:
        ranges += [F.col("cdi_smooth_lag1") >= 0, F.col("cdi_smooth_lag1") <= 100]
    cols = df.columns
    by_key = df.groupBy(spec.entity, spec.period).agg(
        F.count(F.lit(1)).alias("k"),
        F.bool_and(F.coalesce(X.all_of(ranges), F.lit(False))).alias("r"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    by_entity = by_key.groupBy(spec.entity).agg(
        F.sum("k").alias("n"), F.max("k").alias("maxk"), F.bool_and("r").alias("r"),
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(cols))])
    total = F.sum("n")
    flat = by_entity.agg(
        F.lit(has_required).alias("has_required_columns"),
        F.coalesce(F.max("maxk") <= 1, F.lit(True)).alias("no_duplicates"),
        F.coalesce(F.bool_and("r"), F.lit(True)).alias("valid_ranges"),
        F.coalesce(F.min("n") >= 3, F.lit(True)).alias("sufficient_data"),
        F.coalesce(X.all_of([F.sum(f"n{i}") * 100 < total * 50 for i in range(len(cols))]),
                   F.lit(True)).alias("acceptable_missing"))
    checks = ["has_required_columns", "no_duplicates", "valid_ranges", "sufficient_data", "acceptable_missing"]
    return flat.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("passed"))
                                           for c in checks])).alias("s")).select("s.check", "s.passed")


def quality_score(df: DataFrame, spec: PanelSpec, caution: DataFrame,
                  cols: Sequence[str] = QUALITY_COLS) -> DataFrame:
    """Per-entity quality score and level.

    missing_pct is the share of null cells over the present key columns;
    score = 100 - max(0, (10 - n) * 5) - missing_pct - 20 * caution, clamped
    to 0..100 and rounded half-even; Good >= 70, Moderate >= 50, else Low.
    ``caution`` is a small dimension (entity, reason), joined left.
    """
    have = present(df, cols)
    nulls = X.sum_of([F.col(c).isNull().cast("int") for c in have]) if have else F.lit(0)
    per = df.groupBy(spec.entity).agg(
        F.count(F.lit(1)).alias("n_years"),
        F.min(spec.period).alias("first_period"), F.max(spec.period).alias("last_period"),
        F.sum(nulls).alias("__nulls"))
    missing = (X.share(F.col("__nulls"), F.col("n_years") * F.lit(max(len(have), 1))) * F.lit(100.0)
               if have else F.lit(0.0))
    j = per.join(caution.select(F.col("entity").alias(spec.entity), "reason"), spec.entity, "left")
    has_caution = F.col("reason").isNotNull()
    raw = (F.lit(100.0) - F.greatest(F.lit(0), (F.lit(10) - F.col("n_years")) * 5).cast("double")
           - F.col("missing_raw") - F.when(has_caution, F.lit(20.0)).otherwise(F.lit(0.0)))
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw))
    return (j.withColumn("missing_raw", missing)
            .withColumn("score_raw", score)
            .select(spec.entity, "n_years",
                    F.concat_ws("-", F.col("first_period").cast("string"), F.col("last_period").cast("string")).alias("period_range"),
                    F.bround("missing_raw", 1).alias("missing_pct"),
                    has_caution.alias("has_caution"),
                    F.coalesce(F.col("reason"), F.lit("")).alias("caution_reason"),
                    F.bround("score_raw", 0).alias("quality_score"),
                    F.when(F.col("score_raw") >= 70, "Good").when(F.col("score_raw") >= 50, "Moderate")
                    .otherwise("Low").alias("quality_level")))


def caution_rows(scores: DataFrame, spec: PanelSpec) -> DataFrame:
    """Every entity with a caution, with its level and the reason."""
    return scores.filter(F.col("has_caution")).select(spec.entity, "quality_level", "caution_reason")


def quality_summary(scores: DataFrame, spec: PanelSpec, examples: int = 5) -> DataFrame:
    """Entities per quality level, how many carry a caution, and the first ``examples``
    caution entities (a top-k; the full list is a filter of the score table)."""
    w = Window.partitionBy("quality_level").orderBy(spec.entity)
    top = (scores.filter(F.col("has_caution")).withColumn("__rn", F.row_number().over(w))
           .filter(F.col("__rn") <= examples).groupBy("quality_level")
           .agg(F.array_sort(F.collect_list(spec.entity)).alias("caution_examples")))
    agg = scores.groupBy("quality_level").agg(
        F.count(F.lit(1)).alias("n_entities"), F.count_if("has_caution").alias("n_caution"),
        F.max("quality_score").alias("best_score"))
    return agg.join(top, "quality_level", "left").withColumn(
        "caution_examples", F.coalesce(F.col("caution_examples"), F.array().cast("array<string>")))


def availability(df: DataFrame, spec: PanelSpec, cols: Sequence[str] = AVAILABILITY_COLS,
                 min_periods: int = 10, max_missing_pct: float = 30.0) -> DataFrame:
    """Per-entity availability notice (few periods or many missing key values)."""
    have = present(df, cols)
    nulls = X.sum_of([F.col(c).isNull().cast("int") for c in have]) if have else F.lit(0)
    per = df.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_periods"), F.sum(nulls).alias("__nulls"),
                                      F.min(spec.period).alias("first_period"), F.max(spec.period).alias("last_period"))
    miss = X.share(F.col("__nulls"), F.col("n_periods") * F.lit(max(len(have), 1))) * F.lit(100.0)
    return per.select(spec.entity, "n_periods", "first_period", "last_period", miss.alias("missing_pct"),
                      ((F.col("n_periods") < min_periods) | (miss > max_missing_pct)).alias("notice"))


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage (1 decimal, half-even) per column, only > 0, sorted desc."""
    cols = list(cols) if cols is not None else df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols], F.count(F.lit(1)).alias("__n"))
    long = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"))
                                          for c in cols])).alias("s"), "__n")
    return (long.select("s.column", "s.missing",
                        F.bround(X.share(F.col("s.missing"), F.col("__n")) * F.lit(100.0), 1).alias("missing_pct"))
            .filter(F.col("missing") > 0)
            .orderBy(F.col("missing").desc(), F.col("column")))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (NULL keys group together)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
