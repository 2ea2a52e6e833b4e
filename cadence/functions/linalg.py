"""Grouped least squares by sufficient statistics.

``gram_sums`` reduces any number of rows per group to the entries of X'X, X'y,
y'y and n with one ``groupBy().agg`` — every entry is a plain ``sum`` that
combines map-side, so a group holding a third of the data costs one partial
row per task.  ``solve_groups`` then solves each group's k x k system in a
``mapInPandas`` task over the aggregated table (one row per group).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.stats import gram_unpack, ols_from_gram


def gram_sums(df: DataFrame, keys: Sequence[str], xcols: Sequence, y, prefix: str = "g",
              where=None) -> DataFrame:
    """Per group: n, sum x_i x_j (i <= j), sum x_i y, sum y y.

    ``xcols`` and ``y`` may be column names or Column expressions; rows with a
    NULL regressor or target are left out (complete cases), as is any row
    failing ``where``.
    """
    xs = [F.col(c) if isinstance(c, str) else c for c in xcols]
    yc = F.col(y) if isinstance(y, str) else y
    ok = yc.isNotNull()
    for x in xs:
        ok = ok & x.isNotNull()
    if where is not None:
        ok = ok & where

    def s(e):
        return F.sum(F.when(ok, e))

    aggs = [F.count_if(ok).alias(f"{prefix}_n")]
    for i, xi in enumerate(xs):
        for j in range(i, len(xs)):
            aggs.append(s(xi * xs[j]).alias(f"{prefix}_{i}_{j}"))
        aggs.append(s(xi * yc).alias(f"{prefix}_{i}_y"))
    aggs.append(s(yc * yc).alias(f"{prefix}_y_y"))
    return df.groupBy(*keys).agg(*aggs)


OLS_SCHEMA = ("coef array<double>, se array<double>, tvalue array<double>, ssr double, n long, "
              "llf double, aic double")


def solve_groups(gram: DataFrame, keys: Sequence[str], k: int, prefix: str = "g",
                 ridge: float = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """Solve every group's normal equations; one output row per input row."""
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in gram.schema.fields
                           if f.name in list(keys) + list(keep))
    out_cols = [c for c in gram.columns if c in list(keys) + list(keep)]

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                xtx, xty, yty, n = gram_unpack(rec, k, prefix)
                if n <= 0:
                    b = se = tv = [None] * k
                    rows.append({**{c: rec[c] for c in out_cols}, "coef": b, "se": se, "tvalue": tv,
                                 "ssr": None, "n": n, "llf": None, "aic": None})
                    continue
                b, ssr, se, tv, llf, aic = ols_from_gram(xtx, xty, yty, n, ridge)
                clean = lambda a: [None if not np.isfinite(v) else float(v) for v in a]
                rows.append({**{c: rec[c] for c in out_cols}, "coef": clean(b), "se": clean(se),
                             "tvalue": clean(tv), "ssr": ssr, "n": n,
                             "llf": llf if np.isfinite(llf) else None, "aic": aic if np.isfinite(aic) else None})
            yield pd.DataFrame(rows, columns=out_cols + ["coef", "se", "tvalue", "ssr", "n", "llf", "aic"])

    return gram.mapInPandas(run, f"{key_schema}, {OLS_SCHEMA}")
