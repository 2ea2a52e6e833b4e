"""Row windows over entities of any length.

Window functions keep an entity's rows in one task.  ``over`` runs them so as long as the longest entity, which is counted first,
has at most ``SLICE_ROWS`` rows.  Beyond that every entity is cut into slices of that many rows by position (``split.entity_positions``:
range partitioning, nothing confined to a task); a slice also gets the halo of rows before and after it that the windows
reach, and, for frames without a bound, the state carried over it: the last value before its halo and the first
one after.  The same window expressions then run per (entity, slice), all columns in one exchange, and the halo's rows go.
Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.operators import split as SP
from cadence.spec import PanelSpec

SLICE_ROWS = 1 << 20
SLICE, HALO, POS = "__slice", "__halo", "__pos"


def over(df: DataFrame, spec: PanelSpec, fn: Callable[[DataFrame, PanelSpec], DataFrame], before: int = 0, after: int = 0,
         carry: Sequence[str] = ()) -> DataFrame:
    """``fn(df, spec)``, whose windows ``spec.window()`` reach ``before`` rows back and ``after`` rows ahead; the columns
    ``carry`` may also be looked up without a bound, by ``last_value`` and ``next_value``."""
    if spec.slice is not None:  # within slices already
        return fn(df, spec)
    longest = df.groupBy(spec.entity).count().agg(F.max("count")).first()[0] or 0
    size = max(SLICE_ROWS, before, after)
    if longest <= size:
        return fn(df, spec)
    rows = SP.entity_positions(df, spec, POS)
    own = F.floor(F.col(POS) / size)
    place = F.col(POS) % size
    copies = [F.struct(own.alias("s"), F.lit(False).alias("h"))]
    if before:
        copies.append(F.when(place >= size - before, F.struct((own + 1).alias("s"), F.lit(True).alias("h"))))
    if after:
        copies.append(F.when((place < after) & (own > 0), F.struct((own - 1).alias("s"), F.lit(True).alias("h"))))
    cut = (rows.withColumn("__copy", F.explode(F.array_compact(F.array(*copies))))
           .withColumn(SLICE, F.col("__copy.s")).withColumn(HALO, F.col("__copy.h")).drop("__copy"))
    if carry:
        cut = cut.join(_carried(rows, spec, size, before, after, carry), [spec.entity, SLICE], "left")
    out = fn(cut, replace(spec, slice=SLICE)).where(~F.col(HALO))
    return out.drop(SLICE, HALO, POS, *[f"__{side}_{c}" for c in carry for side in ("in", "out")])


def _carried(rows: DataFrame, spec: PanelSpec, size: int, before: int, after: int, cols: Sequence[str]) -> DataFrame:
    """Per (entity, slice) and column the last value before the slice's halo and the first after it, with their positions."""
    pair = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(POS).alias("p"), F.col(c).alias("v"))) for c in cols}
    sides = [rows.groupBy(spec.entity, F.floor(at / size).alias(SLICE)).agg(*[f(pair[c]).alias(f"__{side}_{c}") for c in cols])
             for side, f, at in (("in", F.max, F.col(POS) + before), ("out", F.min, F.col(POS) - after))]
    grid = rows.select(spec.entity, F.floor(F.col(POS) / size).alias(SLICE)).distinct().withColumn("__own", F.lit(True))
    both = grid.unionByName(sides[0], allowMissingColumns=True).unionByName(sides[1], allowMissingColumns=True)
    w = Window.partitionBy(spec.entity).orderBy(SLICE)  # one row or two per slice
    return both.select(spec.entity, SLICE, "__own",
                       *[F.max(f"__in_{c}").over(w.rangeBetween(Window.unboundedPreceding, -1)).alias(f"__in_{c}") for c in cols],
                       *[F.min(f"__out_{c}").over(w.rangeBetween(1, Window.unboundedFollowing)).alias(f"__out_{c}") for c in cols],
                       ).where("__own").drop("__own")


def position(spec: PanelSpec) -> Column:
    """0-based position of a row within its entity."""
    return F.col(POS) if spec.slice else F.row_number().over(spec.window()) - 1


def last_value(spec: PanelSpec, c: str, back: int = 0) -> Column:
    """The last non-null value of a carried column up to ``back`` rows before this one."""
    found = F.last(F.col(c), ignorenulls=True).over(spec.window().rowsBetween(Window.unboundedPreceding, -back))
    return F.coalesce(found, F.col(f"__in_{c}.v")) if spec.slice else found


def next_value(spec: PanelSpec, c: str) -> Column:
    """The first non-null value of a carried column from this row on."""
    found = F.last(F.col(c), ignorenulls=True).over(spec.window(descending=True).rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(found, F.col(f"__out_{c}.v")) if spec.slice else found


def last_pair(spec: PanelSpec, c: str, pos: str) -> Column:
    """(p, v): position and value of the last non-null value up to this row."""
    pair = F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v")))
    found = F.last(pair, ignorenulls=True).over(spec.window().rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(found, F.col(f"__in_{c}")) if spec.slice else found


def next_pair(spec: PanelSpec, c: str, pos: str) -> Column:
    """(p, v): position and value of the first non-null value from this row on."""
    pair = F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v")))
    # a running frame over the reversed order: O(n) per entity (an unbounded-following frame is evaluated anew per row)
    found = F.last(pair, ignorenulls=True).over(spec.window(descending=True).rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(found, F.col(f"__out_{c}")) if spec.slice else found
