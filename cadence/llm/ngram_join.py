"""N-gram Jaccard self-join with rare-first prefix filtering (operator 1).

Texts with equal shingle sets are one node, known by a 64-bit signature of the set.  Two nodes with similarity of at least 3/4
share a shingle among the rarest quarter (and one) of each, whatever fixed order "rarest" means, so:

1. one pass over the texts makes signatures and a count sketch of all shingles (2^24 counters, added up over
   tasks in two steps); its logarithms, 16 MB whatever the data, are the order, ties by hash;
2. a second pass puts out each text's prefix as postings (shingle, node, set size, position), shuffled by shingle;
3. first round: within a shingle's postings, sorted by set size, the smallest set is a candidate with every other one, and of its
   neighbours each set's best.  Most of a group's shingles have the same smallest set, so a group of n copies has a
   few pairs per copy.  Pairs that pass the filters are verified on the whole sets, once per pair, and linked;
4. full round: postings whose shingle still joins several components are gathered by their shingle's smallest set.  Groups
   of few nodes are joined pair by pair across components, filtered and verified the same way.  Of larger
   groups, tasks take blocks (two chunks of bounded size; all nodes of the largest component stay apart, since a pair inside one
   component needs no check): first with the counts by range of hashes, which tell the nodes that can still link with
   one of another component, then, of those alone, with the whole sets, whose overlaps are one matrix product.  A block
   puts out a spanning forest of its links, so a group of n near-copies gives about n rows, whatever its pairs are, and no link
   between components is lost.

Filters (sizes a, b; needed overlap at least 3 (a + b) / 7): length 4 min(a, b) >= 3 max(a, b); positional: of a linked pair's first
common shingle, at places i and j, a - i + 1 and b - j + 1 are at least the needed overlap; suffix: sets divided into ranges of
hashes share at most the sum of the smaller counts.

Edge cases: a null text, an empty one and one without words have size 0 and are linked with nothing; a text of fewer
words than a shingle has one; rows that share an id are one document (each row is returned); a null id links with
nothing and has a null component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, doc_text, forget, kept, pressed, read, shuffle_parts, steps, utf8_buffer
from .components import components
from .shingles import mix, sets

WORDS = 5
COUNTERS, CHUNKS = 1 << 24, 128
COUNTER_SHIFT = np.uint64(40)
RANGE_BITS = 7, 12  # of the suffix filter: 128 to 4096 ranges
BLOOM_BITS = 1 << 23
FEW = 8  # nodes of a group that is joined pair by pair
CHUNK, NODE = 1 << 18, 500  # shingles in a chunk of a larger group, a node counting as so many more
SIGNED = "doc_id long, node long, n int, chunk int, task long, data binary, more binary"
POSTS = "token long, node long, n int, pos int"


def prefix_length(n):
    return n - (3 * n + 3) // 4 + 1


def signature(h: np.ndarray) -> int:
    """Of a set: the sum of its mixed hashes, mixed with the size."""
    total = np.uint64((int(mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) + len(h) * 0x2545F4914F6CDD1D) % (1 << 64))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def sign(docs: DataFrame) -> DataFrame:
    """A row (doc_id, node, n, data: counts of the set's hashes by range) per document, and per task rows (chunk, task, data,
    more) of its share of the sketch: places and counts of its counters that are not 0."""
    names = [c.split()[0] for c in SIGNED.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint16)  # of a task: more than 65535 texts with a shingle count as that
        for b in batches:
            data, off = utf8_buffer(b.column(1))
            ids, rows = b.column(0).to_pylist(), []
            for a, cuts, h in sets(data, off, WORDS):
                at, times = np.unique(h >> COUNTER_SHIFT, return_counts=True)
                counts[at] = np.minimum(counts[at] + times, 65535)
                for i in range(len(cuts) - 1):
                    own = h[cuts[i]:cuts[i + 1]]
                    rows.append((ids[a + i], signature(own), len(own), None, None, pressed(ranges(own)), None) if len(own)
                                else (ids[a + i], None, 0, None, None, None, None))
            yield batch(rows)
        task, size = TaskContext.get().partitionId(), COUNTERS // CHUNKS
        for c in range(CHUNKS):
            own = counts[c * size:(c + 1) * size]
            at = np.flatnonzero(own)
            if len(at):
                yield batch([(None, None, None, c, task, pressed(steps(at).astype("<u4")), pressed(own[at]))])

    return doc_text(docs).mapInArrow(run, SIGNED)


def ranges(h: np.ndarray) -> np.ndarray:
    """Counts of a set's hashes by range, of which there are enough for about 4 in each: fuller ones tell no large sets apart."""
    low, high = RANGE_BITS
    bits = min(high, max(low, (len(h) - 1).bit_length() - 2))
    return np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u4")


def folded(counts: np.ndarray, width: int) -> np.ndarray:
    """The counts of fewer, wider ranges."""
    return counts.reshape(width, -1).sum(1, dtype=np.int64)


def rarity(rows: DataFrame) -> np.ndarray:
    """Level of each counter: twice the logarithm of the shingles counted there.  Added up in two steps, so a group holds
    about the square root of the tasks."""
    size = COUNTERS // CHUNKS

    def add(t: pa.Table) -> np.ndarray:
        total = np.zeros(size, np.uint64)
        for at, count in zip(t["data"], t["more"]):
            total[np.cumsum(read(at.as_py()))] += read(count.as_py())
        return total

    def once(t: pa.Table) -> pa.Table:
        total = add(t)
        at = np.flatnonzero(total)
        return pa.table({"chunk": t["chunk"][:1], "data": pa.array([pressed(steps(at).astype("<u4"))], pa.binary()),
                         "more": pa.array([pressed(total[at])], pa.binary())})

    def level(t: pa.Table) -> pa.Table:
        return pa.table({"chunk": t["chunk"][:1], "levels": pa.array([np.floor(2 * np.log2(add(t) + 1.0)).astype(np.uint8).tobytes()], pa.binary())})

    tasks = rows.agg(F.max("task")).head()[0] or 0
    width = max(1, int((tasks + 1) ** 0.5))
    added = (rows.select("chunk", "data", "more", (F.col("task") % width).alias("share"))
             .groupBy("chunk", "share").applyInArrow(once, "chunk int, data binary, more binary"))
    levels = np.zeros(COUNTERS, np.uint8)
    for r in added.groupBy("chunk").applyInArrow(level, "chunk int, levels binary").collect():
        levels[r.chunk * size:(r.chunk + 1) * size] = np.frombuffer(r.levels, np.uint8)
    return levels


def postings(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(token, node, n, pos) of every text's prefix, rarest first; pos counts from 1."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8_buffer(b.column(1))
            for _, cuts, h in sets(data, off, WORDS):
                count = np.diff(cuts)
                text = np.repeat(np.arange(len(count)), count)
                rare = shared.value[h >> COUNTER_SHIFT]
                order = np.lexsort((h, rare, text))
                pos = np.arange(len(h)) - np.repeat(cuts[:-1], count) + 1
                prefix = pos <= prefix_length(count)[text]
                nodes = np.array([signature(h[cuts[i]:cuts[i + 1]]) if count[i] else 0 for i in range(len(count))], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[order][prefix].view(np.int64)), pa.array(nodes[text[prefix]]), pa.array(count[text[prefix]].astype(np.int32)),
                     pa.array(pos[prefix].astype(np.int32))], names=["token", "node", "n", "pos"])

    return doc_text(docs).mapInArrow(run, POSTS)


def may_link(n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Length filter, and positional filter of a common shingle that may be a pair's first: from it on, each set must still hold
    the needed overlap.  Every linked pair's first common shingle passes."""
    low, high, need = F.least(n1, n2).cast("long"), F.greatest(n1, n2).cast("long"), 3 * (n1.cast("long") + n2)
    return (4 * low >= 3 * high) & (7 * (n1 - p1 + 1).cast("long") >= need) & (7 * (n2 - p2 + 1).cast("long") >= need)


def bloom_filter(ids: DataFrame) -> np.ndarray:
    """Bits of the ids' hashes: 2^23 of them, packed in 1 MB, whatever the data."""
    width = 1 << 13

    def pack(t: pa.Table) -> pa.Table:
        bits = np.zeros(width, bool)
        bits[t["bit"].to_numpy() % width] = True
        return pa.table({"word": t["word"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    bit = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(BLOOM_BITS)).alias("bit")).distinct()
    words = bit.withColumn("word", (F.col("bit") / width).cast("long")).groupBy("word").applyInArrow(pack, "word long, bits binary").collect()
    out = np.zeros(BLOOM_BITS // 8, np.uint8)
    for r in words:
        out[r.word * width // 8:(r.word + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def whole_sets(docs: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """(node, hashes) of the nodes asked for, each from one of its texts.

    A Bloom filter of these texts' ids keeps the other texts out of the shuffle.
    """
    spark = docs.sparkSession
    asked = kept(asked.join(nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "node"), "asked")
    shared = spark.sparkContext.broadcast(bloom_filter(asked))

    @F.pandas_udf("boolean")
    def may_be(bit):
        import pandas as pd
        b = bit.to_numpy()
        return pd.Series((shared.value[b >> 3] >> (7 - (b & 7)) & 1).astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()  # rows that repeat an id meet in one task
        for b in batches:
            data, off = utf8_buffer(b.column(1))
            wanted = b.column(0).to_pylist()
            for a, cuts, h in sets(data, off, WORDS):
                out = []
                for i in range(len(cuts) - 1):
                    own, node = h[cuts[i]:cuts[i + 1]], wanted[a + i]
                    if node not in done and len(own) and signature(own) == node:  # an id may have other texts
                        done.add(node)
                        out.append((node, own.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["node", "hashes"])

    # never by broadcast: the filter above and the sets below in one task would keep two Python workers for each core
    texts = doc_text(docs).where(F.col("doc_id").isNotNull()).where(may_be(F.pmod(F.xxhash64("doc_id"), F.lit(BLOOM_BITS))))
    own = kept(texts.join(asked.hint("merge"), "doc_id").select("node", "text").mapInArrow(run, "node long, hashes binary"), "sets")
    forget(asked)
    return own


def with_part(pairs: DataFrame, parts: DataFrame, part: str, *more: str) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(parts.select(F.col("node").alias(end), F.col(part).alias(f"{part}_{end}")), end)
    return pairs.select("a", "b", *more, f"{part}_a", f"{part}_b")


def suffix_filtered(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b, shared) whose sets may overlap enough by their counts in each range of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                x, y = read(x), read(y)
                width = min(len(x), len(y))
                x, y = folded(x, width), folded(y, width)
                keep.append(bool(7 * np.minimum(x, y).sum() >= 3 * (x.sum() + y.sum())))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(k).filter(keep) for k in range(3)], names=["a", "b", "shared"])

    by_node = nodes.groupBy("node").agg(F.first("data").alias("data"))
    return kept(with_part(pairs, by_node, "data", "shared").mapInArrow(run, "a long, b long, shared long"), "filtered")


def verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough; each pair is checked once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column(2), b.column(3)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort(kind="stable")  # two sorted runs: a merge
                same = int((both[1:] == both[:-1]).sum())
                linked.append(100 * same >= 75 * (len(p) + len(q) - same))
            linked = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(linked), b.column(1).filter(linked)], names=["a", "b"])

    return with_part(pairs, whole, "hashes").mapInArrow(run, "a long, b long")


def ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def join_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    signed = kept(sign(docs), "signed")
    rows = signed.where("chunk IS NULL").select("doc_id", "node", "n", "data")
    nodes = rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    posts = postings(docs.where(F.col("doc_id").isNotNull()), rarity(signed.where("chunk IS NOT NULL")))
    # by set size within a shingle; equal sets are one node and stand together
    whole = Window.partitionBy("token")
    near = whole.orderBy("n", "node")
    beside = (posts.repartition(shuffle_parts(spark), "token")
              .select("*", F.lag(F.struct("node", "n", "pos")).over(near).alias("before"), F.first(F.struct("node", "n", "pos")).over(near).alias("first"),
                      F.min("node").over(whole).alias("low"), F.max("node").over(whole).alias("high"))
              .where("low <> high AND (before IS NULL OR before.node <> node)").drop("low", "high"))
    shared = kept(beside, "posts")
    star, near = (shared_with(shared, other) for other in ("first", "before"))
    # of its neighbours, each node's with the most shared shingles
    own = near.select(F.explode(F.array("a", "b")).alias("node"), F.struct("shared", "a", "b").alias("pair"))
    near = own.groupBy("node").agg(F.max("pair").alias("pair")).select("pair.a", "pair.b", "pair.shared")
    some = suffix_filtered(star.union(near).distinct(), nodes)
    own = whole_sets(docs, nodes, ends(some).distinct())
    links = kept(verified(some.select("a", "b"), own), "links")
    forget(own)
    labels = components(links)
    # what still joins several components, by the smallest set of each shingle
    rest = (shared.select("token", "node", "n", "pos", F.coalesce("first.node", "node").alias("hub")).join(labels, "node", "left")
            .select("token", "node", "n", "pos", "hub", F.coalesce("label", "node").alias("label"))
            .select("*", F.min("label").over(whole).alias("low"), F.max("label").over(whole).alias("high")))
    rest = kept(rest.where("low <> high").drop("low", "high"), "rest")
    forget(shared, some)
    members = kept(rest.groupBy("hub", "node").agg(F.first("label").alias("label"), F.first("n").alias("n")), "members")
    large = members.groupBy("hub").count().where(F.col("count") > FEW).select("hub")
    x, y = (rest.join(large, "hub", "left_anti").select("token", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "pos", "label"))) for k in "xy")
    across = (x.join(y, "token").where(F.col("label_x") < F.col("label_y"))
              .where(may_link(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y")))
              .groupBy(*ordered("node_x", "node_y")).agg(F.count("*").alias("shared")))
    across = suffix_filtered(across, nodes)
    members = members.join(large, "hub", "left_semi")
    near = kept(in_blocks(members, nodes.groupBy("node").agg(F.first("data").alias("data")), may_reach, "node long").distinct(), "near")
    own = whole_sets(docs, nodes, ends(across).union(near).distinct())
    in_large = in_blocks(members.join(near, "node", "left_semi"), own.withColumnRenamed("hashes", "data"), forest, "a long, b long")
    links = kept(links.union(verified(across.select("a", "b"), own)).union(in_large).distinct(), "links")
    forget(rest, across, near, own)
    return with_components(rows, links)


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def in_blocks(members: DataFrame, of_node: DataFrame, work, schema: str) -> DataFrame:
    """What ``work`` makes of blocks of rows (label, n, node, data), in which all pairs of a hub's members
    meet that have different labels.

    Members are dealt over chunks of bounded size, those of the hub's largest label over chunks of their own, of which no two meet.
    A hub whose members all fit in a chunk is one block.
    """
    weight = F.sum(F.col("n").cast("long") + NODE)
    by_label = members.groupBy("hub", "label").agg(F.count("*").alias("k"), weight.alias("w"))
    by_hub = (by_label.groupBy("hub").agg(F.max_by(F.struct("label", "w"), F.struct("k", "label")).alias("main"), F.sum("w").alias("w"),
                                          F.count("*").alias("labels")).where("labels > 1"))
    chunks = (by_hub.withColumn("whole", F.col("w") <= CHUNK)
              .select("hub", F.when(~F.col("whole"), F.col("main.label")).alias("main"),
                      F.when(F.col("whole"), F.lit(1)).otherwise(F.ceil((F.col("w") - F.col("main.w")) / CHUNK)).cast("int").alias("others"),
                      F.when(F.col("whole"), F.lit(0)).otherwise(F.ceil(F.col("main.w") / CHUNK)).cast("int").alias("mains")))
    is_main, hashed = F.coalesce(F.col("label") == F.col("main"), F.lit(False)), F.xxhash64("node")
    dealt = (members.join(chunks, "hub")
             .withColumn("chunk", F.when(is_main, F.col("others") + F.pmod(hashed, F.col("mains"))).otherwise(F.pmod(hashed, F.col("others"))).cast("int"))
             .withColumn("last", F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)
             .select("hub", "node", "label", "n", "chunk", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
             .select("hub", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "node", "label", "n"))

    def run(t: pa.Table) -> pa.Table:
        return work(t["label"].to_numpy(), t["n"].to_numpy(), t["node"].to_numpy(), t["data"].to_pylist())

    return dealt.join(of_node, "node").groupBy("hub", "i", "j").applyInArrow(run, schema)


def may_reach(labels: np.ndarray, n: np.ndarray, nodes: np.ndarray, data: list[bytes]) -> pa.Table:
    """The nodes of a block that may link with one of another label, by length and the counts in each range of hashes."""
    counts, n = [read(d) for d in data], n.astype(np.int64)
    width, reach = np.array([len(c) for c in counts]), np.zeros(len(nodes), bool)
    for w in np.unique(width):
        at = np.flatnonzero((width == w) | (width == 2 * w))  # sets of other widths differ too much in size
        own, size, label = np.array([folded(counts[i], w) for i in at]), n[at], labels[at]
        for i in np.flatnonzero(width[at] == w):
            other = np.flatnonzero((label != label[i]) & (4 * np.minimum(size, size[i]) >= 3 * np.maximum(size, size[i])))
            near = other[7 * np.minimum(own[other], own[i]).sum(1) >= 3 * (size[other] + size[i])]
            if len(near):
                reach[at[near]] = reach[at[i]] = True
    return pa.table({"node": pa.array(nodes[reach], pa.int64())})


def forest(labels: np.ndarray, n: np.ndarray, nodes: np.ndarray, data: list[bytes]) -> pa.Table:
    """Links that join all of a block's nodes that links join, nodes of one label taken as joined."""
    n = n.astype(np.int64)
    same = overlaps([np.frombuffer(d, np.uint64) for d in data])
    linked = 100 * same >= 75 * (n[:, None] + n - same)
    alike = labels[:, None] == labels
    joined, left, pairs = linked | alike, np.ones(len(nodes), bool), []
    for root in range(len(nodes)):
        todo = [root] if left[root] else []
        left[root] = False
        while todo:
            i = todo.pop()
            found = np.flatnonzero(joined[i] & left)
            left[found] = False
            todo += found.tolist()
            pairs += [(i, j) for j in found[~alike[i, found]].tolist()]
    a, b = nodes[[i for i, _ in pairs]], nodes[[j for _, j in pairs]]
    return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Number of hashes that each two of the sets share: products of 0-1 matrices for hashes of many sets, pair by pair for those of few."""
    k = len(sets)
    h, at = np.concatenate(sets), np.repeat(np.arange(k), [len(s) for s in sets])
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    times = np.diff(start, append=len(h))
    out, few = np.zeros((k, k), np.int64), max(8, k // 8)
    rare = np.repeat(times <= few, times)
    x, rank = at[rare], (np.arange(len(h)) - np.repeat(start, times))[rare]
    for d in range(1, few):  # a hash's sets stand together, in rising order
        low, high = x[:-d][rank[d:] >= d], x[d:][rank[d:] >= d]
        if not len(low):
            break
        out += np.bincount(low * k + high, minlength=k * k).reshape(k, k)
    often, number = at[~rare], np.repeat(np.arange((times > few).sum()), times[times > few])
    for c in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        lo, hi = np.searchsorted(number, [c, c + 4096])
        there = np.zeros((k, 4096), np.float32)
        there[often[lo:hi], number[lo:hi] - c] = 1
        out += np.triu(there @ there.T, 1).astype(np.int64)  # sums of at most 4096 ones are exact
    return out + out.T


def shared_with(posts: DataFrame, other: str) -> DataFrame:
    """Pairs (a, b, shared: shingles) of postings with the one in column ``other`` that may link."""
    with_other = posts.where(f"{other}.node <> node").where(may_link(F.col("n"), F.col("pos"), F.col(f"{other}.n"), F.col(f"{other}.pos")))
    return (with_other.withColumn("of", F.col(f"{other}.node")).groupBy(*ordered("node", "of")).agg(F.count("*").alias("shared")))


def with_components(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Smallest document of each row's component: nodes joined by links, and by ids that have several texts."""
    own = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "node").distinct()
    twice = own.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("doc_id", "a")
    by_id = own.join(twice, "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    labels = components(links.union(by_id).distinct())
    least = own.groupBy("node").agg(F.min("doc_id").alias("least")).join(labels, "node", "left")
    label = F.coalesce("label", "node")
    of_label = least.groupBy(label.alias("label")).agg(F.min("least").alias("component_id"))
    of_node = least.select("node", label.alias("label")).join(of_label, "label").select("node", "component_id")
    rows = rows.select("doc_id", "node", "n")
    # rows without words have no node: they stay where they are instead of meeting in one task
    named = (rows.where("node IS NOT NULL").join(of_node, "node", "left")
             .unionByName(rows.where("node IS NULL").withColumn("component_id", F.lit(None).cast("long"))))
    return (named.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns (of any names), of each component's smallest document; of rows that repeat its id
    the one with the smallest text.  Rows with a null id stay."""
    own = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("body"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    stay = join_documents(docs).where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    # of rows that repeat an id the smallest text, by an aggregate that combines in the tasks
    smallest = own.where("id IS NOT NULL").join(stay, "id", "left_semi").groupBy("id").agg(F.min_by("row", F.struct("body", "row")).alias("row"))
    return smallest.select("row.*").unionByName(own.where("id IS NULL").select("row.*"))
