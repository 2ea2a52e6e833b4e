"""Document fingerprints from closed syncmers (operator 7).

A k-mer of a text's UTF-8 bytes is an anchor when the smallest hash among its inner s-mers stands at its first or last
place.  Whether it does depends on the k-mer alone, so an edit changes only anchors that touch
it.  A fingerprint keeps every anchor, repeats too, in the order of the text: its 32-bit hash and its byte offset, as the
step from the anchor before (successive anchors overlap, at most K - S bytes apart, so a step is one byte).  It grows with
the text.  Of a text of at least 2 K - S bytes, all but at most K - S - 1 at either end lie in an anchor.
A text without an anchor (all below K bytes, some up to 2 K - S - 2) is one anchor itself; the empty text has an empty
fingerprint.  ``shown`` writes it as base64: all hashes (4 bytes each, least first), then all steps.

``likeness`` compares fingerprints by position: the longest chain of common anchors that stand in the same order
in both (exactly, see ``chain``), as a share of the anchors of both with the chain counted once.  Equal fingerprints: 1.

Edge cases: a null text is empty; a null id comes before all others; rows with one id are ordered
by text, so ties and repeated rows have a defined next row; a single row is its own next; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, doc_text, shuffle_parts

K, S = 16, 8
WINDOW = 1 << 19  # bytes hashed at a time, which bounds memory for texts of any length
STRIP = 1 << 12  # anchors compared at a time as the bits of a number
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
LEAST = -(1 << 63)


class Fingerprint(NamedTuple):
    hashes: bytes  # 32 bits of each anchor, in the order of the text
    steps: bytes  # a byte each: its offset less that of the anchor before, the first one's from 0


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hash, offset) of every closed syncmer of the bytes."""
    if len(data) < K:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    word = data.astype(np.uint64)
    for step in (1, 2, 4):  # eight bytes to a word
        word = word[:-step] | (word[step:] << np.uint64(8 * step))
    h = mix(word)
    least = h
    for step in (1, 2, 4, 1):  # smallest of K - S + 1 = 9 neighbours
        least = np.minimum(least[:-step], least[step:])
    at = np.flatnonzero((h[:len(least)] == least) | (h[K - S:] == least))
    return (mix(h[at] * np.uint64(3) + h[at + K - S]) >> np.uint64(32)).astype(np.uint32), at


def fingerprints(texts: list[bytes]) -> list[Fingerprint]:
    """All anchors of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes, places = [], []
    for a in range(0, len(data), WINDOW):
        h, at = anchors(data[a:a + WINDOW + K - 1])
        hashes.append(h)
        places.append(at + a)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint32)
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    text = np.searchsorted(ends, at, "right")
    inside = at + K <= ends[text] if len(at) else np.zeros(0, bool)
    h, at = h[inside], at[inside]
    cuts = np.searchsorted(at, np.concatenate([[0], ends]))
    out = []
    for i, t in enumerate(texts):
        own, place = h[cuts[i]:cuts[i + 1]], at[cuts[i]:cuts[i + 1]] - (ends[i] - lengths[i])
        if t and not len(own):
            out.append(Fingerprint(hashlib.sha256(t).digest()[3::-1], b"\0"))
        else:
            out.append(Fingerprint(own.astype("<u4").tobytes(), np.diff(place, prepend=0).astype("u1").tobytes()))
    return out


def chain(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence, exactly.

    Common ends and what stands in one alone are put aside.  Of the rest, either all pairs of equal places are listed and the
    longest increasing run taken, or, where repeats make too many pairs, ``x`` is compared in strips of ``STRIP`` bits
    with all of ``y``, each strip handing its carries to the next.  Memory stays in proportion to the input.
    """
    common = 0
    for _ in range(2):  # from the front, then from the back
        n = min(len(x), len(y))
        differ = x[:n] != y[:n]
        same = int(differ.argmax()) if differ.any() else n
        common, x, y = common + same, x[same:][::-1], y[same:][::-1]
    x, y = x[np.isin(x, y)], y[np.isin(y, x)]
    if not len(x):
        return common
    values, y = np.unique(y, return_inverse=True)
    x, counts = np.searchsorted(values, x), np.bincount(y)
    if counts[x].sum() <= 2 * len(y) * -(-len(x) // STRIP):
        order, last = np.argsort(y, kind="stable"), np.cumsum(counts) - 1
        run: list[int] = []
        for a in range(0, len(x), STRIP):
            own = x[a:a + STRIP]
            n = counts[own]
            back = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            for at in order[np.repeat(last[own], n) - back].tolist():  # a place's pairs from the last on, so it counts once
                k = bisect_left(run, at)
                run[k:k + 1] = [at]
        return common + len(run)
    carry, codes = bytearray(len(y)), y.tolist()
    for a in range(0, len(x), STRIP):
        places: dict[int, int] = {}
        own = x[a:a + STRIP].tolist()
        for j, c in enumerate(own):
            places[c] = places.get(c, 0) | 1 << j
        free = full = (1 << len(own)) - 1
        for i, c in enumerate(codes):
            hit = free & places.get(c, 0)
            total = free + hit + carry[i]
            carry[i] = total >> len(own)
            free = total & full | free - hit
        common += len(own) - free.bit_count()
    return common


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    if a == b:
        return 1.0
    x, y = np.frombuffer(a.hashes, "<u4"), np.frombuffer(b.hashes, "<u4")
    common = chain(x, y)
    return common / (len(x) + len(y) - common)


def shown(f: Fingerprint) -> str:
    return base64.b64encode(f.hashes + f.steps).decode()


def edited_text(text: str, after: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit by the next document, by ascending id.

    One pass over the ids alone cuts them into ranges (their bounds and each range's first id go to the driver, one value
    per shuffle partition).  Each range's first document is also sent to the range before it,
    so every task sees its rows and the one that follows: texts are shuffled once.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = doc_text(docs).withColumn("key", F.coalesce("doc_id", F.lit(LEAST)))
    parts = shuffle_parts(spark)
    cuts = (rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10_000)).head()[0]) or []
    bounds = spark.sparkContext.broadcast(np.unique(np.array(cuts, np.int64)))

    @F.pandas_udf("int")
    def part_of(key):
        import pandas as pd
        return pd.Series(np.searchsorted(bounds.value, key.to_numpy(), "right").astype("i4"))

    firsts = sorted(tuple(r) for r in rows.select("key").withColumn("part", part_of("key")).groupBy("part").agg(F.min("key")).collect())
    before = spark.sparkContext.broadcast({key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)})

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def parts_of(key):
        """The own range and, for a range's first id, -1 less the range before it."""
        import pandas as pd
        own = np.searchsorted(bounds.value, key.to_numpy(), "right").tolist()
        return pd.Series([[p, -1 - before.value[k]] if k in before.value else [p] for k, p in zip(key.tolist(), own)])

    dealt = (rows.withColumn("to", F.explode(parts_of("key")))
             .select("doc_id", "text", "key", (F.col("to") < 0).alias("follows"),
                     F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("part"))
             .repartitionById(len(bounds.value) + 1, "part").sortWithinPartitions("part", "follows", "key", "text")
             .select("doc_id", "text", "follows", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, with its fingerprint
        for b in batches:
            new = list(zip(*(c.to_pylist() for c in b.columns)))
            own = [r + (f,) for r, f in zip(new, fingerprints([r[1].encode() for r in new]))]
            line = ([held] if held else []) + own
            pairs = [(a, z) for a, z in zip(line, line[1:]) if not a[2] and a[3] == z[3]]
            held = line[-1] if line else None
            edits = [edited_text(a[1], z[1]).encode() for a, z in pairs]
            made = fingerprints(edits)
            out = [(a[0], len(a[1]), hashlib.sha256(e).hexdigest(), shown(a[4]), shown(f), likeness(a[4], f), likeness(a[4], z[4]))
                   for (a, z), e, f in zip(pairs, edits, made)]
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                             names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return dealt.mapInArrow(run, SCHEMA)
