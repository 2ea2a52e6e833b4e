"""Hard negatives by slot-decomposed selection (operator 12).

Each anchor's positives (its best rows of the same label) set a window of scores each: from ``low`` % to ``high`` % of the
positive's score.  The windows overlap, so their upper limits split the scores into disjoint slots instead.  One
pass over the rows keeps the top k of every slot: tasks combine what they meet before anything is shuffled, and a
window function keeps the top k of what the tasks send.  As the slots descend, the top k below an upper limit is the
slot's own rows followed by those of the slots under it: merging the suffixes from the lowest slot up answers every window,
whose lower limit then only cuts the end.

Rows and anchors are packed into blocks of vectors.  Blocks meet by an equality join on (kind, group of anchor blocks, slice
of row blocks): row blocks are copied once per group of anchor blocks, anchor blocks once per slice, and neither a label nor an id is a
key, so a hot label or a repeated id makes no hot task.  Both passes (positives, negatives) use that join.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component (also after scaling), take no part; vectors of
different numbers of components never meet; an empty vector scores 0 with the others; an anchor
without positives, or without rows in a window, gives no rows for it, as do positives with a negative
score (their window is empty); rows that repeat an id are rows of their own, but never positives or negatives of an anchor of
that id; an anchor id on several rows gives each row's result; sums are exact, and a score beyond a long counts as the nearest
long; labels are whole numbers; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, kept, shuffle_parts

ROWS, ANCHORS, SCALE = 2048, 1024, 256
ROW_BLOCKS, ANCHOR_BLOCKS = 32, 16  # at most so many blocks of either kind meet in one group
OPEN_BLOCKS = 32  # anchor blocks whose best a task keeps at a time
MOST = 2 ** 63 - 1
PACKED = "dim int, block long, size int, kind string, ids binary, labels binary, vectors binary"
BEST = "dim int, part int, at int, anchor_id long, slot int, score long, vec_id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def whole_rows(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(vec_id, label, v array<double>) of the rows that take part; components scaled, not yet floored."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double") * SCALE)
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fine))


def _block(dim: int, number: int, ids, labels, v) -> dict:
    most = np.abs(v).max(initial=0.0)
    kind = "<i1" if most < 128 else "<i2" if most < 2 ** 15 else "<i4" if most < 2 ** 31 else "<f8"
    return {"dim": dim, "block": number, "size": len(ids), "kind": kind, "ids": ids.astype("<i8").tobytes(),
            "labels": labels.astype("<i8").tobytes(), "vectors": v.astype(kind).tobytes()}


def _columns(t) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels, numbers of components and all floored components of a batch or table."""
    v = t.column("v")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    flat = np.floor(v.flatten().to_numpy(zero_copy_only=False).astype(float))
    return t.column("vec_id").to_numpy(), t.column("label").to_numpy(), np.diff(v.offsets.to_numpy()).astype(int), flat


def pack_rows(rows: DataFrame) -> DataFrame:
    """Blocks of at most ``ROWS`` vectors of one number of components, packed where they are read."""
    schema = pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("size", pa.int32()), ("kind", pa.string()),
                        ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def emit(dim):
            nonlocal number
            number += 1
            ids, labels, v = (np.concatenate(x) for x in zip(*held.pop(dim)))
            return pa.RecordBatch.from_pylist([_block(dim, number, ids, labels, v)], schema)

        for b in batches:
            ids, labels, dims, flat = _columns(b)
            first = np.cumsum(dims) - dims
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                for k in range(0, len(own), ROWS):
                    at = own[k:k + ROWS]
                    held.setdefault(dim, []).append((ids[at], labels[at], flat[first[at][:, None] + np.arange(dim)].reshape(len(at), dim)))
                    if sum(len(x[0]) for x in held[dim]) >= ROWS:
                        yield emit(dim)
            while sum(len(x[0]) for y in held.values() for x in y) > 8 * ROWS:  # many kinds of vectors at a time
                yield emit(max(held, key=lambda d: len(held[d])))
        for dim in list(held):
            yield emit(dim)

    return rows.mapInArrow(run, PACKED)


def pack_anchors(anchors: DataFrame) -> DataFrame:
    """Blocks of about ``ANCHORS`` vectors, numbered ``part`` = 0, 1, ... per number of components.

    The rows are dealt by their running number, so that a repeated id spreads too."""
    numbered = kept(anchors.withColumn("n", F.monotonically_increasing_id()), "anchors")
    counts = kept(numbered.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("parts")), "anchor-counts")
    dealt = numbered.withColumn("dim", F.size("v")).join(counts, "dim").withColumn("part", F.pmod(F.xxhash64("n"), "parts").cast("int"))

    def run(key, group):
        ids, labels, _, flat = _columns(group)
        row = _block(key[0].as_py(), 0, ids, labels, flat.reshape(len(ids), -1))
        return pa.Table.from_pylist([{"dim": row.pop("dim"), "part": key[1].as_py(), "parts": group["parts"][0].as_py(),
                                      **{f"a_{k}": x for k, x in row.items() if k != "block"}}], schema=schema)

    schema = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("parts", pa.int32()), ("a_size", pa.int32()), ("a_kind", pa.string()),
                        ("a_ids", pa.binary()), ("a_labels", pa.binary()), ("a_vectors", pa.binary())])
    return dealt.groupBy("dim", "part").applyInArrow(run, "dim int, part int, parts int, a_size int, a_kind string, a_ids binary, "
                                                          "a_labels binary, a_vectors binary")


def met(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every anchor block with every row block of its kind, by an equality join on (kind, group, slice)."""
    groups = F.ceil(F.col("parts") / ANCHOR_BLOCKS)
    wanted = F.greatest(F.ceil(F.col("n") / ROW_BLOCKS), F.ceil(F.lit(4 * shuffle_parts(blocks.sparkSession)) / groups))
    sizes = kept(blocks.groupBy("dim").agg(F.count("*").alias("n")).join(anchors.groupBy("dim").agg(F.max("parts").alias("parts")), "dim")
                 .select("dim", groups.cast("int").alias("groups"), F.least("n", wanted).cast("int").alias("slices")), "block-counts")
    r = (blocks.join(sizes, "dim").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
         .withColumn("slice", F.pmod(F.xxhash64("block"), "slices").cast("int")).drop("groups", "slices", "block"))
    a = (anchors.join(sizes, "dim").withColumn("group", F.pmod("part", "groups"))
         .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("groups", "slices", "parts"))
    return r.join(a, ["dim", "group", "slice"])


def products(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as floats; beyond a long, the nearest long."""
    heavy_a, heavy_r = np.abs(a).max(1, initial=0.0), np.abs(r).max(1, initial=0.0)
    if heavy_a.max(initial=0.0) * heavy_r.max(initial=0.0) * max(1, a.shape[1]) < 2 ** 53:
        return (a @ r.T).astype(np.int64)
    with np.errstate(all="ignore"):
        unsure = ~(heavy_a[:, None] * heavy_r[None, :] * max(1, a.shape[1]) < 2 ** 53)
        out = np.where(unsure, 0.0, a @ r.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    for i in np.flatnonzero(unsure.any(1)):
        at = np.flatnonzero(unsure[i])
        out[i, at] = [min(MOST, max(-MOST, x)) for x in (whole(r[at]) * whole(a[i])).sum(1)]
    return out


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties by smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        scores, ids = scores[at], ids[at]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores between ``low`` % and ``high`` % of a positive's score."""
    return -(-low * score // 100), high * score // 100


def upper_limits(scores: list[int], low: int, high: int) -> tuple[list[int], int]:
    """The distinct upper limits of the positives' windows, descending, and the least lower limit."""
    both = [w for w in (window(s, low, high) for s in scores) if w[0] <= w[1]]
    return sorted({hi for _, hi in both}, reverse=True), min((lo for lo, _ in both), default=0)


def keep_best(pairs: DataFrame, k: int, low: int | None = None, high: int | None = None) -> DataFrame:
    """Each anchor's k best rows: of its own label, or (limits given) of every slot among the other labels.

    A task combines what its pairs of blocks give before it sends anything."""
    cols = ["dim", "part", "size", "kind", "ids", "labels", "vectors", "a_size", "a_kind", "a_ids", "a_labels", "a_vectors"]
    cols += [] if low is None else ["known"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], dict] = {}
        anchor_ids: dict[tuple[int, int], np.ndarray] = {}

        def emit(key):
            own, ids = best.pop(key), anchor_ids.pop(key)
            rows = [(*key, at, int(ids[at]), slot, s, i) for (at, slot), (ss, ii) in own.items() for s, i in zip(ss.tolist(), ii.tolist())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, TYPES)], names=NAMES)

        for b in batches:
            for row in range(b.num_rows):
                x = {c: b.column(c)[row].as_py() for c in cols}
                key = x["dim"], x["part"]
                ids, labels = np.frombuffer(x["ids"], "<i8"), np.frombuffer(x["labels"], "<i8")
                a_ids, a_labels = np.frombuffer(x["a_ids"], "<i8"), np.frombuffer(x["a_labels"], "<i8")
                r = np.frombuffer(x["vectors"], x["kind"]).reshape(x["size"], -1).astype(float)
                a = np.frombuffer(x["a_vectors"], x["a_kind"]).reshape(x["a_size"], -1).astype(float)
                anchor_ids[key] = a_ids
                own = best.setdefault(key, {})
                scores = products(a, r)
                fits = (a_labels[:, None] == labels) if low is None else (a_labels[:, None] != labels)
                fits &= a_ids[:, None] != ids
                if low is None:
                    for i in np.flatnonzero(fits.any(1)):
                        _combine(own, (int(i), 0), scores[i, fits[i]], ids[fits[i]], k)
                    continue
                positives: dict[int, list[int]] = {}
                for p in x["known"]:
                    positives.setdefault(p["at"], []).append(p["score"])
                for i, known in positives.items():
                    limits, least = upper_limits(known, low, high)
                    if not limits:
                        continue
                    at = np.flatnonzero(fits[i] & (scores[i] >= least) & (scores[i] <= limits[0]))
                    slots = len(limits) - 1 - np.searchsorted(np.array(limits[::-1], np.int64), scores[i, at])
                    for slot in np.unique(slots).tolist():
                        _combine(own, (i, slot), scores[i, at[slots == slot]], ids[at[slots == slot]], k)
            while len(best) > OPEN_BLOCKS:
                yield emit(next(iter(best)))
        for key in list(best):
            yield emit(key)

    found = pairs.select(*cols).mapInArrow(run, BEST)
    w = Window.partitionBy("dim", "part", "at", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


NAMES = ["dim", "part", "at", "anchor_id", "slot", "score", "vec_id"]
TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]


def _combine(own: dict, key: tuple[int, int], scores: np.ndarray, ids: np.ndarray, k: int) -> None:
    if key in own:
        before = own[key]
        if len(before[0]) == k:
            better = scores >= before[0][-1]
            scores, ids = scores[better], ids[better]
        scores, ids = np.concatenate([before[0], scores]), np.concatenate([before[1], ids])
    own[key] = first(scores, ids, k)


def answer(positives: list[tuple[int, int]], slots: dict[int, list[tuple[int, int]]], k: int, low: int, high: int) -> list[tuple[int, int, int, int, int]]:
    """(positive_id, rank, negative_id, positive score, negative score) of one anchor's positives (score, id), by
    merging the slots' rows (score, id) from the lowest slot up."""
    limits, _ = upper_limits([s for s, _ in positives], low, high)
    suffix: list[list[tuple[int, int]]] = [[] for _ in range(len(limits) + 1)]
    for slot in reversed(range(len(limits))):
        own = sorted(slots.get(slot, []), key=lambda x: (-x[0], x[1]))
        suffix[slot] = (own + suffix[slot + 1])[:k]
    out = []
    for score, positive in positives:
        lo, hi = window(score, low, high)
        if lo <= hi:
            inside = [x for x in suffix[limits.index(hi)] if x[0] >= lo]
            out += [(positive, n, i, score, s) for n, (s, i) in enumerate(inside, 1)]
    return out


def mine(rows: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """For every anchor (id divisible by ``anchor_every``) and each of its best rows of the same label, the best rows
    of other labels that score ``low`` % to ``high`` % of it."""
    bounded_batches(rows.sparkSession)
    whole = whole_rows(rows, id_col, vector_col, F.col(label) if isinstance(label, str) else label)
    blocks = kept(pack_rows(whole), "row-blocks")
    anchors = kept(pack_anchors(whole.where(F.col("vec_id") % anchor_every == 0)), "anchor-blocks")
    pos = kept(keep_best(met(blocks, anchors), positives), "positives")
    known = pos.groupBy("dim", "part").agg(F.collect_list(F.struct("at", "score")).alias("known"))  # at most positives x anchors of a block
    neg = keep_best(met(blocks, anchors.join(known, ["dim", "part"])), negatives, low, high)

    def merge(left: pa.Table, right: pa.Table) -> pa.Table:
        mine, slots = {}, {}
        for p in left.sort_by([("at", "ascending"), ("rank", "ascending")]).to_pylist():
            mine.setdefault((p["at"], p["anchor_id"]), []).append((p["score"], p["vec_id"]))
        for n in right.to_pylist():
            slots.setdefault(n["at"], {}).setdefault(n["slot"], []).append((n["score"], n["vec_id"]))
        rows = [(anchor, *x) for (at, anchor), own in mine.items() for x in answer(own, slots.get(at, {}), negatives, low, high)]
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=names)

    neg = neg.select(F.col("dim").alias("kind"), F.col("part").alias("block"), "at", "slot", "score", "vec_id")  # names of its own beside pos
    return pos.groupBy("dim", "part").cogroup(neg.groupBy("kind", "block")).applyInArrow(merge, RESULT)
