"""Exact top-k inner products by norm buckets (operator 5).

Candidates are grouped by number of components and, longest first, into buckets of ``BUCKET`` vectors of similar
length.  A block of queries first meets the bucket of the longest vectors of its kind, which gives each query a
threshold: its k-th score so far.  For every other bucket a query's local cosine threshold is that score over
(its length x the bucket's longest); a query for which it exceeds one leaves the bucket out, and a (block, bucket)
pair that no query needs is not dealt out at all.  Within a pair, at a high cosine threshold the
candidates are pruned by coordinates (the query's heaviest coordinates bound what the rest can add),
else by length alone; what is left is verified by exact integer products.  Ties go to smaller ids.

Buckets and query blocks are rows of packed vectors.  A block is paired with buckets by an equality join on
its number, so no vector is repeated per query.

Edge cases: null vectors and ids, and vectors with null or non-finite components, take no part; vectors of
other numbers of components are never candidates of a query; a query without candidates gives no rows;
an empty vector scores 0 with the others; every finite vector takes part, and products too large for
floats or longs are added exactly; a score beyond a long counts as the nearest long, also when it is ranked; a component
whose scaled value leaves the doubles counts as the nearest double; rows that repeat an id are separate candidates (and
separate queries); columns other than id and vector are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, shuffle_parts

BUCKET, BLOCK, SCALE = 2048, 256, 256
CLASSES = 16  # classes of length in each power of two
HEAVY = 8
LARGEST = float(np.finfo(float).max)
LONG = 2 ** 63 - 1
RESULT = "query_id long, rank int, vec_id long, score long"
PACKED = "dim int, class long, chunk long, size int, longest double, ids binary, vectors binary"
PAIRED = "query_id long, vec_id long, score long"


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, norm, v array<double>): components as floor(256 x), whole numbers that doubles hold exactly, in the JVM."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    scaled = F.transform("v", lambda x: F.least(F.greatest(x * SCALE, F.lit(-LARGEST)), F.lit(LARGEST)))
    # floor() gives longs; beyond 2^52 every double is whole already
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x))
    return (rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & fine & F.col("vec_id").isNotNull())
            .select("vec_id", F.size("v").alias("dim"), whole.alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))))


def pack(rows: DataFrame, size: int) -> DataFrame:
    """Vectors of like length in rows of about ``size``: classes by the logarithm of the length, each split by the
    id's hash into as many parts as its count asks for (the classes, at most some ten thousand, are counted first)."""
    classed = rows.withColumn("class", F.when(F.col("norm") > 0, F.floor(F.log2("norm") * CLASSES)).otherwise(F.lit(-1 << 40)).cast("long"))
    counts = classed.groupBy("dim", "class").agg(F.ceil(F.count("*") / size).alias("chunks"))
    dealt = (classed.join(F.broadcast(counts), ["dim", "class"])
             .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks"))))

    def run(group: pa.Table) -> pa.Table:
        v = np.array(group["v"].to_pylist(), "<f8").reshape(group.num_rows, -1)
        return pa.table({"dim": group["dim"][:1], "class": group["class"][:1], "chunk": group["chunk"][:1],
                         "size": pa.array([group.num_rows], pa.int32()),
                         "longest": pa.array([max(group["norm"].to_pylist())], pa.float64()),
                         "ids": pa.array([group["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([v.tobytes()], pa.binary())})

    return dealt.drop("chunks").groupBy("dim", "class", "chunk").applyInArrow(run, PACKED)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: by floats where they hold every sum, by longs where those do, else by Python's integers."""
    with np.errstate(over="ignore"):
        most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2 ** 53:
        return (q @ c.T).astype(np.int64)
    if most < 2 ** 63:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(c).T, -LONG, LONG).astype(np.int64)


def best(q_ids, q, c_ids, c, k: int, floors: np.ndarray) -> list[tuple[int, int, int]]:
    """Each query's k best candidates of the bucket that reach its floor (its k-th score so far)."""
    out = []
    with np.errstate(over="ignore"):
        q_norm, c_norm = np.sqrt((q ** 2).sum(1)), np.sqrt((c ** 2).sum(1))
    longest = c_norm.max(initial=0.0) * (1 + 1e-9)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        reach = q_norm * longest  # lengths beyond the doubles bound nothing
        local = np.where(np.isfinite(reach) & (reach > 0), floors / reach, np.where((reach == 0) & (floors > 0), np.inf, -np.inf))
    plain = np.flatnonzero(local <= 0.5)  # by length: the scan of all candidates is one matrix product
    scores = products(q[plain], c) if len(plain) else None
    for row, i in enumerate(plain):
        out += _top(q_ids[i], c_ids, scores[row], k, floors[i])
    for i in np.flatnonzero((local > 0.5) & (local <= 1)):  # by coordinates: the heaviest bound what the others can add
        heavy = np.argsort(-np.abs(q[i]))[:HEAVY]
        rest = max(0.0, q_norm[i] ** 2 - float((q[i, heavy] ** 2).sum())) ** 0.5
        part = c[:, heavy] @ q[i, heavy]
        tail = np.sqrt(np.maximum(0.0, c_norm ** 2 - (c[:, heavy] ** 2).sum(1)))
        slack = 1e-6 * q_norm[i] * longest + 1e-3  # more than the differences of squares above can lose
        left = np.flatnonzero(part + rest * tail + slack >= floors[i])
        if len(left):
            out += _top(q_ids[i], c_ids[left], products(q[i:i + 1], c[left])[0], k, floors[i])
    return out


def _top(q_id, ids, scores, k: int, floor: float) -> list[tuple[int, int, int]]:
    own = (scores >= floor) & (ids != q_id)
    ids, scores = ids[own], scores[own]
    order = np.lexsort((ids, ~scores))[:k]
    return [(int(q_id), int(ids[j]), int(scores[j])) for j in order]


def top_k(rows: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` best of all other rows for each row whose id is divisible by ``query_every``."""
    bounded_batches(rows.sparkSession)
    vectors = whole_vectors(rows, id_col, vector_col)
    place = F.struct("class", "chunk").alias("part")
    buckets = materialize(pack(vectors, BUCKET).select("dim", place, "size", "longest", "ids", "vectors"))
    blocks = materialize(pack(vectors.where(F.col("vec_id") % query_every == 0), BLOCK)
                         .select("dim", F.struct("dim", "class", "chunk").alias("block"), F.col("size").alias("q_size"),
                                 F.col("longest").alias("q_longest"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")))
    # the bucket of the longest vectors that fills k places gives the first thresholds
    lead = buckets.where(F.col("size") > k).groupBy("dim").agg(F.max(F.struct("longest", "part")).alias("top")).select("dim", "top.part")
    # one number of components may be that of all rows: its blocks are dealt out over shares, the small side to each
    shares = max(1, min(shuffle_parts(rows.sparkSession), blocks.count()))
    share = F.pmod(F.xxhash64("block"), F.lit(shares)).alias("share")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("share")
    leading = buckets.join(lead, ["dim", "part"], "left_semi").select("*", each)
    first = materialize(_scan(blocks.select("*", share).join(leading, ["dim", "share"]), k, None))
    floor = _ranked(first, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    ids = blocks.select("dim", "block", "q_longest", F.explode(_ids("q_ids")).alias("query_id"))
    known = F.collect_set(F.when(F.col("floor").isNotNull(), F.struct("query_id", "floor")))
    floors = materialize(ids.join(floor, "query_id", "left").groupBy("dim", "block", "q_longest")
                         .agg(F.min(F.coalesce(F.col("floor"), F.lit(-1 << 62))).alias("least"), known.alias("floors")))
    # a block leaves a bucket out when no query's score so far is within the bucket's reach
    reach = F.col("least") <= F.col("q_longest") * F.col("longest") * (1 + 1e-9)
    needed = (buckets.select("dim", "part", "longest").join(lead, ["dim", "part"], "left_anti").select("*", each)
              .join(floors.drop("floors").select("*", share), ["dim", "share"]).where(reach).select("dim", "part", "block"))
    pairs = (needed.join(buckets, ["dim", "part"]).join(blocks.drop("dim", "q_longest"), "block")
             .join(floors.select("block", "floors"), "block"))
    return _ranked(first.unionByName(_scan(pairs, k, "floors")), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _ids(col: str):
    @F.pandas_udf("array<long>")
    def read(b):
        import pandas as pd
        return pd.Series([np.frombuffer(x, "<i8") for x in b])
    return read(F.col(col))


def _scan(pairs: DataFrame, k: int, floors: str | None) -> DataFrame:
    cols = ["q_size", "q_ids", "q_vectors", "size", "ids", "vectors"] + ([floors] if floors else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                q_ids, c_ids = np.frombuffer(r[1], "<i8"), np.frombuffer(r[4], "<i8")
                known = {f["query_id"]: f["floor"] for f in r[6]} if floors else {}
                out = best(q_ids, np.frombuffer(r[2], "<f8").reshape(r[0], -1), c_ids, np.frombuffer(r[5], "<f8").reshape(r[3], -1), k,
                           np.array([known.get(int(i), -np.inf) for i in q_ids], float))
                yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

    return pairs.select(*cols).mapInArrow(run, PAIRED)


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
