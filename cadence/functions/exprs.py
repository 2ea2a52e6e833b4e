"""Column-expression helpers shared by the operators.

All of these build Catalyst expressions; nothing here runs Python per row.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

def null_double() -> Column:
    return F.lit(None).cast("double")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def share(num, den) -> Column:
    """num / den as doubles; NULL when the denominator is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))


def capped_sum(cols: Sequence[str], cap: float = 100.0) -> Column:
    """nulls count as 0, the sum is capped at ``cap``."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    return F.least(F.lit(float(cap)), total)


def row_mean(cols: Sequence[str]) -> Column:
    """mean of the non-null values of a row; NULL when all are null."""
    s = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return share(s, n)


def pct_change(c, w: WindowSpec, pad: bool = True) -> Column:
    """per-entity percent change x 100 over window ``w`` (ordered, not framed).

    ``pad`` forward-fills the series before differencing, which is what the
    grouped pandas call does by default.  A zero base gives NULL.
    """
    if not pad:
        return (share(col(c), F.lag(col(c), 1).over(w)) - F.lit(1.0)) * F.lit(100.0)
    # padded series at this row and at the previous row: the last non-null
    # value up to here, and up to one row back (no nested window needed)
    upto = F.last(col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (share(upto, before) - F.lit(1.0)) * F.lit(100.0)


def rolling(fn, c, w: WindowSpec, size: int, min_periods: int) -> Column:
    """Row-count window of ``size`` rows ending at this row, NULL below ``min_periods``."""
    frame = w.rowsBetween(-(size - 1), 0)
    return F.when(F.count(col(c)).over(frame) >= min_periods, fn(col(c)).over(frame))


def safe_log(x) -> Column:
    """Natural log, NULL for non-positive input (the oracle guards the same way)."""
    x = col(x)
    return F.when(x > 0, F.ln(x))


def rnd(c, digits: int = 6) -> Column:
    return F.round(col(c), digits)


def one_row(agg_df) -> dict:
    """Collect a one-row aggregate (bounded size) as a dict of Python values."""
    row = agg_df.first()
    return row.asDict() if row is not None else {}


def lit_d(v) -> Column:
    return F.lit(None).cast("double") if v is None else F.lit(float(v))


def standardize(c, mu, sd) -> Column:
    """(x - mu) / sd with literal statistics; sd 0 or NULL gives 0 for non-null x."""
    x = col(c)
    if sd is None or sd == 0 or mu is None:
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(float(mu))) / F.lit(float(sd))


def sum_of(cols) -> Column:
    return reduce(lambda a, b: a + b, list(cols))


def all_of(preds) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)
