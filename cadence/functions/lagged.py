"""Least squares on the lags of many series at once.

``windows`` gives every row of a series its last values as one array, so a plan has the same width for any number of lags.
``states`` then reduces rows to one state per series: tasks build each series' regression matrix from the arrays and add up
its Gram matrix, per batch, before anything is shuffled; a series' few first rows, which only shorter regressions can
use, go along as plain values.  A finishing function gets the whole states of many series at a time (as many as ``BLOCK_BYTES``
hold), so that it can solve those of one shape together: every order of a search is a block of one
Gram matrix, over one common sample, and the chosen order can be fitted again on all its rows without another pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadence.operators import slices as SC
from cadence.spec import PanelSpec

Gram = tuple[np.ndarray, int]  # products of all columns of [x, y], and the number of rows
State = tuple[dict, Gram, np.ndarray]  # of one series: its meta, Gram matrix and first values
BLOCK_SERIES, BLOCK_BYTES = 2048, 16 << 20  # finished at a time


def windows(prep: DataFrame, spec: PanelSpec, back: int) -> DataFrame:
    """(entity, period, y, n, mean, pos, ys): length and mean of the series, position, and the deviations of the last
    ``back`` + 1 values from the mean, oldest first (fewer at the start)."""
    stats = prep.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"))

    def run(d: DataFrame, s: PanelSpec) -> DataFrame:
        w = s.window().rowsBetween(-back, 0)
        return d.withColumn("pos", SC.position(s)).withColumn("ys", F.collect_list(F.col("y") - F.col("mean")).over(w))

    return SC.over(prep.join(stats, spec.entity), spec, run, before=back)


def gram(x: np.ndarray, y: np.ndarray) -> Gram:
    both = np.column_stack([x, y])
    return both.T @ both, len(y)


def alike(items: Sequence, key: Callable) -> Iterator[tuple[tuple, np.ndarray]]:
    """The items' places by key."""
    groups: dict[tuple, list[int]] = {}
    for i, item in enumerate(items):
        groups.setdefault(key(item), []).append(i)
    for k, at in groups.items():
        yield k, np.array(at)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gram matrices of many series' rows: x (series, rows, regressors), y (series, rows)."""
    both = np.concatenate([x, y[..., None]], axis=-1)
    return np.swapaxes(both, -1, -2) @ both


def of_block(m: np.ndarray, block: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x'x, x'y and y'y of some of the regressors, from many series' Gram matrices."""
    b = np.array(block, int)
    return m[:, b[:, None], b[None, :]], m[:, b, -1], m[:, -1, -1]


def states(rows: DataFrame, spec: PanelSpec, meta: Sequence[str], start: Callable[[dict], int],
           matrix: Callable[[dict, np.ndarray], tuple[np.ndarray, np.ndarray]], finish: Callable[[list[State]], list[list[dict]]],
           schema: str) -> DataFrame:
    """``finish`` gets blocks of series, each with its (meta, gram, head), and gives each one's rows of ``schema`` as dicts.

    ``start(meta)``: the first position of the common sample.  ``matrix(meta, ys)``: regressors and target of rows with
    equally long windows, one per row of ``ys``.  ``head``: the values (deviations) before ``start``.
    """
    key = rows.schema[spec.entity]
    kinds = T.StructType([key, *[rows.schema[c] for c in meta]])
    partial = T.StructType([*kinds.fields, *T._parse_datatype_string("__n long, __gram binary, __pos binary, __head binary").fields])
    cols, sent = [spec.entity, *meta], to_arrow_schema(partial)
    entity, out_type = spec.entity, T._parse_datatype_string(schema)
    arrow = to_arrow_schema(out_type)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            code = b.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            by = np.argsort(code, kind="stable")
            heads = np.flatnonzero(np.diff(code[by], prepend=code[by][0] - 1))
            pos, ys = b.column("pos").to_numpy(zero_copy_only=False), b.column("ys")
            at, flat = ys.offsets.to_numpy(), ys.flatten().to_numpy(zero_copy_only=False)
            made: list[list] = [[] for _ in sent]
            for own in np.split(by, heads[1:]):
                m = {c: b.column(k)[int(own[0])].as_py() for k, c in enumerate(cols)}
                first = start(m)
                late, early = own[pos[own] >= first], own[pos[own] < first]
                g, n = (None, 0)
                if len(late):
                    size = int((at[late + 1] - at[late]).min())
                    g, n = gram(*matrix(m, flat[(at[late + 1] - size)[:, None] + np.arange(size)]))
                cells = [*m.values(), n, None if g is None else g.tobytes(), pos[early].astype("<i8").tobytes(), flat[at[early + 1] - 1].tobytes()]
                for c, v in zip(made, cells):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(sent, made)], schema=sent)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[State]:
        """The series of sorted partial states, one after the other."""
        m, total, n, head = None, None, 0, {}

        def state() -> State:
            side = 0 if total is None else int(round(len(total) ** 0.5))
            return m, (np.zeros((0, 0)) if total is None else total.reshape(side, side), n), np.array([head[k] for k in sorted(head)])

        for b in batches:
            for r in b.to_pylist():
                if m is None or r[entity] != m[entity]:
                    if m is not None:
                        yield state()
                    m, total, n, head = {c: r[c] for c in cols}, None, 0, {}
                n += r["__n"]
                if r["__gram"] is not None:
                    g = np.frombuffer(r["__gram"])
                    total = g if total is None else total + g
                head.update(zip(np.frombuffer(r["__pos"], "<i8").tolist(), np.frombuffer(r["__head"]).tolist()))
        if m is not None:
            yield state()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, size = [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            rows = [{entity: m[entity], **r} for (m, _, _), found in zip(own, finish(own)) for r in found]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow)

        for s in whole(batches):
            own.append(s)
            size += s[1][0].nbytes + s[2].nbytes
            if len(own) >= BLOCK_SERIES or size >= BLOCK_BYTES:
                yield from finished()
                own, size = [], 0
        if own:
            yield from finished()

    # a given number of partitions: the states are small, but finishing them is work, which must not be drawn together in a few tasks
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partials = rows.select(*cols, "pos", "ys").mapInArrow(add_up, partial)
    return partials.repartition(parts, entity).sortWithinPartitions(entity).mapInArrow(merge, out_type)
