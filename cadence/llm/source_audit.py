"""Source divergence audit by chunk factorization (operator 11).

A chunk is what stands between ASCII white space; no term (a run of letters and non-ASCII characters) spans two.  Tasks
count the chunks of every document in blocks of documents.  Each globally distinct chunk is tokenised once, where all
blocks' chunks of its slice (by the chunk's hash) meet, and its terms are joined back to the blocks that hold it.  A document
lies in one block, so a block knows how many distinct documents have a term, in whichever chunks, and how often it occurs;
sums over blocks, in slices by the term's hash, give both per (lang, source, term).

What moves, all as compressed Arrow data: a block's distinct chunks, a row for each slice; their terms back; a block's chunk
counts; a block's sums, a row for each slice.  A block sends a chunk or term once, however often it occurs, so no hot one weighs
more than an entry a block; a hot lang or source is no key on its own.  A task holds one block, or one slice's distinct chunks or
sums; there are as many slices as the session has shuffle partitions.

Shares are whole billionths, exact at any count.  Distances between sources add up over slices of the kept terms, in
which a source's absent terms have one common share.  Sources of a lang are compared pair by pair, which is the result's size.

Edge cases: null text, lang and source are ''; empty texts count as documents; rows that repeat an id are documents of their
own; a group without terms has the share of count 0 for every term; a lang without kept terms has pairs of value 0 and no terms; ties go
to the smaller item by UTF-8 bytes; other columns, whatever their names, are not read; an empty table gives no rows.  A text is
held whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, kept, shuffle_parts

BLOCK_BYTES = 12 << 20
MERGE_ROWS = 1 << 20
LEAST_DOCS, SMOOTH, ONE, TOP = 30, 5, 1_000_000_000, 50
MOST = 9_000_000_000  # counts up to here times ONE fit a long
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
BLOCKS = "block long, slice int, data binary"
COUNTS = "lang string, source string, term string, n long, lang_n long, lead boolean"
RESULT = ["lang", "source", "part", "item", "value", "rank"]


def _packed(**columns: pa.Array) -> bytes:
    """Arrow columns of one length as compressed bytes."""
    batch, sink = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def _slices(texts: pa.Array, slices: int) -> np.ndarray:
    return (pd.util.hash_array(np.array(texts.to_pylist(), object), categorize=False) % np.uint64(slices)).astype(np.int64)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers of a sorted array begins."""
    return np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``starts``, end to end."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def count_chunks(docs: DataFrame, slices: int) -> DataFrame:
    """Per block of documents a row for each slice of its distinct chunks, and one row (slice null) with its groups and
    chunk counts.  A block numbers its chunks in the order of their slices."""
    schema = pa.schema([("block", pa.int64()), ("slice", pa.int32()), ("data", pa.binary())])

    def block(number: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        parts = pc.ascii_split_whitespace(t["text"].combine_chunks().cast(pa.large_string()))
        per_doc, coded = np.diff(parts.offsets.to_numpy()), parts.flatten().dictionary_encode()
        del parts
        at = _slices(coded.dictionary, slices)
        order = np.argsort(at, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        chunks, at = coded.dictionary.take(pa.array(order)).cast(pa.string()), at[order]
        keys = np.repeat(np.arange(len(per_doc)), per_doc) * max(1, len(rank)) + rank[coded.indices.to_numpy(zero_copy_only=False)]
        keys.sort()
        heads = _runs(keys)
        doc, codes = np.divmod(keys[heads], max(1, len(rank)))
        pairs = list(zip(t["lang"].to_pylist(), t["source"].to_pylist()))
        named = {p: k for k, p in enumerate(dict.fromkeys(pairs))}
        state = {"lang": [p[0] for p in named], "source": [p[1] for p in named], "group": [named[p] for p in pairs],
                 "distinct": np.bincount(doc, minlength=len(pairs)).astype(np.int32), "codes": codes.astype(np.int32),
                 "counts": np.diff(heads, append=len(keys)).astype(np.int32)}
        yield pa.RecordBatch.from_pylist([{"block": number, "data": _packed(**{k: pa.array([x]) for k, x in state.items()})}], schema)
        first = _runs(at)
        for lo, hi in zip(first, [*first[1:], len(at)]):
            yield pa.RecordBatch.from_pylist([{"block": number, "slice": int(at[lo]), "data": _packed(chunk=chunks.slice(lo, hi - lo))}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            held.append(b)
            size += b.column(0).nbytes
            if size >= BLOCK_BYTES:
                yield from block(number, held)
                number, held, size = number + 1, [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield from block(number, held)

    return docs.select("text", "lang", "source").mapInArrow(run, BLOCKS)


def tokenize(chunks: pa.Array) -> pa.Array:
    """The terms of each chunk: runs of letters and non-ASCII characters, A-Z in lower case."""
    parts = pc.split_pattern_regex(pc.ascii_lower(chunks), NO_TERM)
    real = pc.not_equal(parts.flatten(), "")
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(before[parts.offsets.to_numpy()]), parts.flatten().filter(real))


def tokenize_slice(t: pa.Table) -> pa.Table:
    """Each distinct chunk of a slice is tokenised once; its terms go to the row of every block that has it."""
    own = [_unpacked(x).column("chunk").cast(pa.large_string()) for x in t["data"].to_pylist()]
    coded = pa.concat_arrays(own).dictionary_encode()
    terms = tokenize(coded.dictionary)
    first, flat = terms.offsets.to_numpy().astype(np.int64), terms.flatten().cast(pa.string())
    codes, data, at = coded.indices.to_numpy(zero_copy_only=False), [], 0
    for x in own:
        mine, at = codes[at:at + len(x)], at + len(x)
        sizes = first[mine + 1] - first[mine]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        data.append(_packed(terms=pa.ListArray.from_arrays(pa.array(offsets), flat.take(pa.array(_gather(first[mine], sizes))))))
    return pa.table([t["block"], t["slice"], pa.array(data, pa.binary())], names=["block", "slice", "data"])


def block_sums(left: pa.Table, right: pa.Table, slices: int) -> pa.Table:
    """Distinct documents and occurrences per (lang, source, term) of one block, a row for each slice of the terms:
    ``left`` has the terms of its chunks by slice, ``right`` its counts."""
    out = pa.schema([("slice", pa.int32()), ("data", pa.binary())])
    if not left.num_rows or not right.num_rows:
        return out.empty_table()
    counted = _unpacked(right["counted"][0].as_py())
    group, distinct, codes, counts = (counted.column(c)[0].values.to_numpy().astype(np.int64) for c in ("group", "distinct", "codes", "counts"))
    langs, sources = (counted.column(c)[0].values for c in ("lang", "source"))
    terms = pa.concat_arrays([_unpacked(x).column("terms") for x in left.sort_by("slice")["data"].to_pylist()])
    first, flat = terms.offsets.to_numpy().astype(np.int64), terms.flatten().dictionary_encode()
    width, term_of = len(flat.dictionary), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    many = first[codes + 1] - first[codes]
    if not many.sum():
        return out.empty_table()
    at = _slices(flat.dictionary, slices)
    order = np.argsort(at, kind="stable")
    rank = np.empty(width, np.int64)
    rank[order] = np.arange(width)
    keys = np.repeat(np.repeat(np.arange(len(group)), distinct), many) * width + rank[term_of][_gather(first[codes], many)]
    keys, n = _summed(keys, np.repeat(counts, many))
    doc, term = np.divmod(keys, width)  # one entry for each document that has the term
    keys = term * len(langs) + group[doc]
    docs, (keys, n) = np.diff(_runs(np.sort(keys)), append=len(keys)), _summed(keys, n)
    term, group = np.divmod(keys, len(langs))
    ordered, at = flat.dictionary.take(pa.array(order)), at[order]
    cuts, rows = _runs(at), []
    for lo, hi in zip(cuts, [*cuts[1:], width]):
        i, j = np.searchsorted(term, [lo, hi])
        of = pa.array(group[i:j].astype(np.int32))
        rows.append({"slice": int(at[lo]), "data": _packed(
            lang=pa.DictionaryArray.from_arrays(of, langs), source=pa.DictionaryArray.from_arrays(of, sources),
            term=pa.DictionaryArray.from_arrays(pa.array((term[i:j] - lo).astype(np.int32)), ordered.slice(lo, hi - lo)),
            docs=pa.array(docs[i:j]), n=pa.array(n[i:j]))})
    return pa.Table.from_pylist(rows, out)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    heads = _runs(keys)
    return keys[heads], np.add.reduceat(n, heads)


def merged(tables: list[pa.Table]) -> pa.Table:
    sums = pa.TableGroupBy(pa.concat_tables(tables), ["lang", "source", "term"], use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return sums.rename_columns({"docs_sum": "docs", "n_sum": "n"})


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n, lang_n, lead): occurrences of the terms in at least ``least`` documents of the lang, in the source and in
    the whole lang; ``lead`` marks one row of each (lang, term)."""
    slices = shuffle_parts(docs.sparkSession)
    blocks = kept(count_chunks(docs, slices), "chunks")
    terms = blocks.where(F.col("slice").isNotNull()).groupBy("slice").applyInArrow(tokenize_slice, BLOCKS)
    states = blocks.where(F.col("slice").isNull()).select(F.col("block").alias("of"), F.col("data").alias("counted"))
    sums = (terms.groupBy("block").cogroup(states.groupBy("of"))
            .applyInArrow(lambda left, right: block_sums(left, right, slices), "slice int, data binary"))
    text = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("n", pa.int64())])

    def over_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # these hints choose the form that streams
        held, rows = [], 0
        for b in batches:
            for data in b.column("data").to_pylist():
                held.append(pa.Table.from_batches([_unpacked(data)]).cast(text))
                rows += held[-1].num_rows
                if rows >= 2 * held[0].num_rows + MERGE_ROWS:
                    held = [merged(held)]
                    rows = held[0].num_rows
        t = merged(held)
        lang, term = (t[c].combine_chunks().dictionary_encode() for c in ("lang", "term"))
        key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(term.dictionary) + term.indices.to_numpy(zero_copy_only=False)
        t, key = t.take(pa.array(order := np.argsort(key, kind="stable"))), key[order]
        heads = _runs(key)
        sizes = np.diff(heads, append=len(key))
        of_lang = [np.repeat(np.add.reduceat(t[c].to_numpy(), heads), sizes) for c in ("docs", "n")]
        lead = np.zeros(len(key), bool)
        lead[heads] = True
        stay = pa.array(of_lang[0] >= least)
        out = t.select(["lang", "source", "term", "n"]).append_column("lang_n", pa.array(of_lang[1])).append_column("lead", pa.array(lead))
        yield from out.filter(stay).to_batches(max_chunksize=1 << 16)

    return sums.groupBy("slice").applyInArrow(over_blocks, COUNTS)


def share(count: Column | str, total: Column | str, kinds: Column | str) -> Column:
    """1 + floor(ONE (count + SMOOTH) / (total + SMOOTH kinds)), in decimals where a long could not hold the product."""
    c, n, v = (F.col(x) if isinstance(x, str) else x for x in (count, total, kinds))
    over, under = c + SMOOTH, n + SMOOTH * v
    wide = F.call_function("div", (over * F.lit(ONE).cast("decimal(10,0)")).cast("decimal(38,0)"), under.cast("decimal(38,0)"))
    return F.lit(1) + F.when(c < MOST, F.call_function("div", F.least(over, F.lit(MOST)) * ONE, under)).otherwise(wide)


def distances(shares: DataFrame, groups: DataFrame, slices: int) -> DataFrame:
    """(lang, source, item, value): the sum over kept terms of the difference of the shares of two sources of a lang.

    ``shares`` (lang, source, term, p) has the terms that occur; ``groups`` (lang, source, absent) the others' share.  Each slice of
    the terms adds up its part; a slice knows all groups of its lang."""
    number = F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int")
    known = groups.where(F.col("kinds") > 0).select(F.col("lang").alias("in_lang"), "source", "absent", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = sorted(right["source"].to_pylist())
        place = {s: k for k, s in enumerate(names)}
        absent = np.zeros(len(names), np.int64)
        absent[[place[s] for s in right["source"].to_pylist()]] = right["absent"].to_numpy()
        total = np.zeros((len(names), len(names)), np.int64)
        source = np.array([place[s] for s in left["source"].to_pylist()], np.int64)
        coded = left["term"].combine_chunks().dictionary_encode()
        term, p = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), left["p"].to_numpy()
        order = np.argsort(term, kind="stable")
        source, term, p = source[order], term[order], p[order]
        step = max(1, (1 << 21) // len(names))
        for k in range(0, len(coded.dictionary), step):
            lo, hi = np.searchsorted(term, [k, k + step])
            table = np.repeat(absent[:, None], min(step, len(coded.dictionary) - k), 1)
            table[source[lo:hi], term[lo:hi] - k] = p[lo:hi]
            for a in range(len(names)):
                total[a] += np.abs(table - table[a]).sum(1)
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        lang = right["in_lang"][0].as_py()
        both = pa.array(names, pa.string())
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": both.take(pa.array(a)), "item": both.take(pa.array(b)),
                         "value": pa.array(total[a, b])})

    return (shares.withColumn("slice", number).groupBy("lang", "slice").cogroup(known.groupBy("in_lang", "part"))
            .applyInArrow(run, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """How the sources of each lang differ: distances between them, and the terms each has more of than its lang."""
    bounded_batches(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    counts = kept(kept_terms(read, least_docs), "kept-terms")
    per_lang = counts.where("lead").groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("lang_n").alias("lang_total"))
    per_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = kept(read.select("lang", "source").distinct().join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
                  .na.fill(0, ["total", "kinds", "lang_total"])
                  .withColumn("absent", F.when(F.col("kinds") > 0, share(F.lit(0), "total", "kinds"))), "groups")
    shares = (counts.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kinds"))
              .withColumn("q", share("lang_n", "lang_total", "kinds")))
    value = distances(shares.select("lang", "source", "term", "p"), groups, max(1, shuffle_parts(docs.sparkSession) // 4))
    both = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = (both.join(value, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")))
    more = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(w)).unionByName(more.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top))
    return ranked.select(*RESULT)
