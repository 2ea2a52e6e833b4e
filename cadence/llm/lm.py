"""N-gram language model scores from an Elias-Fano trie (operator 3).

Words are lower-cased (A-Z) runs of non-space bytes, known by 64-bit hashes; each text ends in one end token.  The model is
interpolated: a word's probability after a context is its discounted share there plus the context's weight times the
lower order's, down to smoothed single words (the base).

The texts are read once, into blocks of about ``BLOCK`` tokens (the words of a block, and its tokens as numbers of them).  Then each
order takes one exchange there and one back: every block sends its distinct n-grams with their counts in the training texts,
already added up, to the shard that the context's number falls in; the shard merges the blocks' counts,
builds its part of the trie level (see ``elias_fano``) and answers each block by searching that level: places, counts and
what the contexts' shares are made of.  The discounts come from the counts of counts of all shards, so scores do not
depend on their number.  Answers go back to the blocks, which number the next order's contexts by them and send only n-grams
whose context was learnt; at last they sum up their documents.  An order's answers are written to the shared
folder, and its exchange is given up before the next.  So an n-gram that stands everywhere is one entry per block, a shard holds a fixed share of the distinct n-grams (their number follows
``spark.sql.shuffle.partitions``), and nothing of the corpus passes the driver but two totals per shard, and five for each order.

Word numbers grow in the order of the words' hashes over all shards, and an n-gram's number is its place in its level after
those of the shards before, so contexts and successors are monotone without another sort.  A text's first word has
the text's start as its only context, its second one the start and the first.  The query learns ``ORDER`` orders; ``score`` takes any
from 1.  ``levels`` writes an order of the trie itself as a table of shards, each a byte string to be mapped.

Edge cases: a null or empty text is the end token alone; a null id counts as an empty text for its remainder;
without training texts N and V are 0 and every score is 0; rows that repeat an id are scored each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, doc_text, kept, pressed, read, shuffle_parts, steps, utf8_buffer
from .elias_fano import ALPHA, LAMBDA, TrieLevel, alpha_code, discounts, spread, weight_code
from .shingles import BATCH, words

ORDER = 3
BLOCK = 1 << 20
END = np.uint64(0x454E440000000001)
HELD_OUT = (5, 1)  # texts whose id's crc32 leaves this remainder are not learnt from
#: One table for all that moves. kind 0: a block's documents and tokens; 10 k: n-grams of order k sent to shards; 10 k + 1: answers.
ROWS = "kind int, block long, shard int, ids array<long>, a binary, b binary, c binary, d binary"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
FIELDS = ["kind", "block", "shard", "ids", "a", "b", "c", "d"]
TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


def rows_of(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array([r[i] if i < len(r) else None for r in rows], t) for i, t in enumerate(TYPES)]


def held_out(doc: int | None) -> bool:
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % HELD_OUT[0] == HELD_OUT[1]


def blocks(docs: DataFrame) -> DataFrame:
    """Kind 0: ids, token counts of the documents (a), distinct word hashes (b), tokens as places among these (c)."""
    def flush(block: int, ids: list, n: list, tokens: list) -> pa.RecordBatch:
        own, place = np.unique(np.concatenate(tokens), return_inverse=True)
        row = (0, block, None, ids, pressed(np.array(n, "<i8")), pressed(own), pressed(place.astype("<u4")))
        return pa.RecordBatch.from_arrays(rows_of([row]), names=FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, n, tokens, held = [], [], [], 0
        for b in batches:
            data, off = utf8_buffer(b.column(1))
            doc, a = b.column(0).to_pylist(), 0
            while a < len(doc):
                z = max(a + 1, int(np.searchsorted(off, off[a] + BATCH, "right")) - 1)
                h, first = words(data[off[a]:off[z]], off[a:z + 1] - off[a])
                tokens.append(np.insert(h, first[1:], END))
                n += (np.diff(first) + 1).tolist()
                ids += doc[a:z]
                held += len(tokens[-1])
                a = z
                if held >= BLOCK:
                    yield flush(block, ids, n, tokens)
                    block, ids, n, tokens, held = block + 1, [], [], [], 0
        if ids:
            yield flush(block, ids, n, tokens)

    return doc_text(docs).mapInArrow(run, ROWS)


class Block:
    """A block's tokens and, order by order, what the shards have answered."""

    def __init__(self, row: dict):
        self.ids, self.n = row["ids"], read(row["a"])
        self.words = None if row["b"] is None else read(row["b"])  # the hashes are only needed for the first order
        self.tokens = read(row["c"]).astype(np.int64)
        self.size = int(self.tokens.max()) + 1
        self.train = np.repeat(~np.array([held_out(i) for i in self.ids], bool), self.n)
        self.first = np.zeros(len(self.tokens), bool)
        self.first[np.concatenate([[0], np.cumsum(self.n)[:-1]])] = True

    def numbered(self, answers: list[dict], base: np.ndarray) -> None:
        """Numbers (-1 if not learnt) and training counts of the block's words."""
        answers = sorted(answers, key=lambda r: r["shard"])
        rank = np.concatenate([np.cumsum(read(r["a"])) for r in answers])
        self.counts = np.concatenate([read(r["b"]).astype(np.int64) for r in answers])
        shard = np.repeat([r["shard"] for r in answers], [len(read(r["b"])) for r in answers])
        # ranks were sent as those of the next learnt word; an unlearnt word has none of its own
        self.number = np.where(self.counts > 0, rank + base[shard], -1)

    def ngrams(self, context: np.ndarray, learnt: int) -> Ngrams:
        """Distinct (context, word) pairs by the number of each token's context (-1: not learnt).  With ``learnt`` words,
        ``learnt + 1`` is the number of every unlearnt word."""
        word = np.where(self.number[self.tokens] >= 0, self.tokens, self.size)
        own, bits = context >= 0, self.size.bit_length()
        contexts, at = None, context[own]
        if len(at) and int(at.max()) >> (63 - bits):  # context and word in one key, if need be by the context's place in the block
            contexts, at = np.unique(at, return_inverse=True)
        key, place = np.unique(at << bits | word[own], return_inverse=True)
        token = np.full(len(self.tokens), -1, np.int64)
        token[own] = place
        context = key >> bits
        return Ngrams(context if contexts is None else contexts[context], np.append(self.number, learnt + 1)[key & (1 << bits) - 1], token,
                      np.bincount(place[self.train[own]], minlength=len(key)))

    def contexts(self, number: np.ndarray, start: int) -> np.ndarray:
        """Each token's context from the numbers at the tokens: the one before, ``start`` for a text's first."""
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[self.first] = start
        return before


class Ngrams(NamedTuple):
    context: np.ndarray
    word: np.ndarray
    token: np.ndarray  # the place of each token's n-gram among these, -1 if its context was not learnt
    counts: np.ndarray  # in the block's training texts

    def to_shards(self, shards: int) -> list[tuple[int, np.ndarray]]:
        """The n-grams of each shard, by a mix of the context's number."""
        shard = ((self.context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        return [(s, order[cuts[s]:cuts[s + 1]]) for s in range(shards) if cuts[s] < cuts[s + 1]]


def starts(context: np.ndarray) -> np.ndarray:
    """Where a new context begins among n-grams sorted by context."""
    new = np.ones(len(context), bool)
    new[1:] = context[1:] != context[:-1]
    return new


def send_words(df: DataFrame, shards: int) -> DataFrame:
    """Order 1: differences of word hashes (a) and training counts (b), cut at the shards' bounds of the hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row)
                counts = np.bincount(b.tokens[b.train], minlength=len(b.words)).astype("<u4")
                shard = ((b.words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                yield pa.RecordBatch.from_arrays(rows_of([
                    (10, row["block"], s, None, pressed(steps(b.words[cuts[s]:cuts[s + 1]].astype("<u8"))), pressed(counts[cuts[s]:cuts[s + 1]]))
                    for s in range(shards) if cuts[s] < cuts[s + 1]]), names=FIELDS)

    return df.mapInArrow(run, ROWS)


def answer_words(t: pa.Table) -> pa.Table:
    """Order 1 at a shard: differences of ranks (a) and counts (b) for each block; and a row for the shard
    with block -1: learnt words and tokens (ids)."""
    rows = t.to_pylist()
    keys = [np.cumsum(read(r["a"])) for r in rows]
    own, place = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.bincount(place, np.concatenate([read(r["b"]) for r in rows]), len(own)).astype(np.int64)
    rank = np.cumsum(counts > 0) - (counts > 0)
    out, at = [(11, -1, rows[0]["shard"], [int((counts > 0).sum()), int(counts.sum())])], 0
    for r, k in zip(rows, keys):
        p = place[at:at + len(k)]
        out.append((11, r["block"], r["shard"], None, pressed(steps(rank[p])), pressed(counts[p])))
        at += len(k)
    return pa.Table.from_arrays(rows_of(out), names=FIELDS)


def by_kind(t: pa.Table) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for r in t.to_pylist():
        out.setdefault(r["kind"], []).append(r)
    return out


def answer_ngrams(order: int, numbers: bool) -> Callable[[pa.Table], pa.Table]:
    """Order ``order`` at a shard: merge the counts, build the level and search it once for each n-gram asked about.  Each block gets the n-grams' counts (a), for each of
    its contexts the training count and how many successors have the counts 1, 2 and more (b), and with ``numbers``
    differences of the places (c; that of an unlearnt n-gram says nothing); a row with block -1 has the level's size and counts of counts (ids)."""
    def answer(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        context, word, count, asked = distinct(rows)
        learnt = count > 0
        level, known = TrieLevel.index(context[learnt], word[learnt]), count[learnt]
        at = np.flatnonzero(starts(context[learnt]))
        shares = np.stack([np.add.reduceat(x, at) if len(at) else x for x in (known, *((np.minimum(known, 3) == c).astype(np.int64) for c in (1, 2, 3)))])
        place, owner = level.locate(context, word)
        found = np.where(place >= 0, known[place], 0) if len(known) else np.zeros(len(place), np.int64)
        out = [(10 * order + 1, -1, rows[0]["shard"], [len(known), *spread(known).tolist()])]
        for r, own in zip(rows, asked):
            o = owner[own[starts(context[own])]]
            share = np.where(o >= 0, shares[:, o], 0) if len(at) else np.zeros((4, len(o)), np.int64)
            out.append((10 * order + 1, r["block"], r["shard"], None, pressed(small(found[own])), pressed(small(share.reshape(-1))),
                        pressed(small(steps(np.maximum.accumulate(np.maximum(place[own], 0))))) if numbers else None))
        return pa.Table.from_arrays(rows_of(out), names=FIELDS)

    return answer


def small(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in 32 bits if they fit."""
    return x.astype("<u4" if not len(x) or x.max() < 1 << 32 else "<u8")


def distinct(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """The n-grams that the blocks ask a shard about, sorted, with their training counts; and each row's places among them."""
    parts = [np.cumsum(read(r["a"])) for r in rows]
    context, word, count = np.concatenate(parts), *(np.concatenate([read(r[c]).astype(np.int64) for r in rows]) for c in "bc")
    low, bits = context - context.min(), int(word.max()).bit_length()
    whole = not int(low.max()) >> (63 - bits)
    order = np.argsort(low << bits | word, kind="stable") if whole else np.lexsort((word, context))  # merges the rows, each in order
    new = starts(context[order]) | starts(word[order])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return context[order[at]], word[order[at]], np.add.reduceat(count[order], at), np.split(place, np.cumsum([len(x) for x in parts])[:-1])


def merged(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The learnt n-grams of a shard, sorted, with their training counts."""
    context, word, count, _ = distinct(rows)
    return context[count > 0], word[count > 0], count[count > 0]


class Model:
    """Blocks, word numbers and totals; then, order by order, the shards' answers."""

    def __init__(self, docs: DataFrame, order: int = 2):
        self.order, self.answers, self.bases, self.spread = order, {}, {}, {}
        spark = docs.sparkSession
        bounded_batches(spark)
        self.shards = shuffle_parts(spark)
        self.blocks = kept(blocks(docs), "lm-blocks")
        self.words = kept(send_words(self.blocks, self.shards).groupBy("shard").applyInArrow(answer_words, ROWS), "lm-words")
        totals = np.zeros((self.shards, 2), np.int64)
        for r in self.words.where("block = -1").select("shard", "ids").collect():
            totals[r.shard] = r.ids
        self.base = np.cumsum(totals[:, 0]) - totals[:, 0]
        self.vocabulary, self.tokens = (int(x) for x in totals.sum(0))

    def known(self, order: int) -> DataFrame:
        """The blocks, without their words' hashes, and all answers to them up to an order."""
        df = self.blocks.withColumn("b", F.lit(None).cast("binary")).unionByName(self.words.where("block >= 0"))
        for k in range(2, order + 1):
            df = df.unionByName(self.answers[k].where("block >= 0"))
        return df

    def learn(self, order: int) -> None:
        """The answers of every order from the second to this one."""
        for k in range(2, order + 1):
            if k in self.answers:
                continue
            self.answers[k] = kept(self.sent(k).groupBy("shard").applyInArrow(answer_ngrams(k, k < self.order), ROWS), f"lm-{k}")
            totals = np.zeros((self.shards, 5), np.int64)
            for r in self.answers[k].where("block = -1").select("shard", "ids").collect():
                totals[r.shard] = r.ids
            self.bases[k], self.spread[k] = np.cumsum(totals[:, 0]) - totals[:, 0], totals[:, 1:].sum(0)
            gc.collect()
            self.blocks.sparkSession.sparkContext._jvm.System.gc()  # frees the files of the exchanges that are no longer referred to

    def unfolder(self) -> Callable[[pa.Table, int], tuple]:
        """What turns a block's rows into the block, and the n-grams, counts and context shares (rows: training count, successors of count
        1, 2 and more) of the orders from the second to a given one, the last without answers if it has none."""
        shards, base, bases, learnt = self.shards, self.base, dict(self.bases), self.vocabulary

        def unfold(t: pa.Table, last: int) -> tuple[Block, int, list[tuple[Ngrams, np.ndarray, np.ndarray]]]:
            got = by_kind(t)
            b = Block(got[0][0])
            b.numbered(got.get(11, []), base)
            context, out = b.contexts(b.number[b.tokens], learnt), []
            for k in range(2, last + 1):
                n = b.ngrams(context, learnt)
                size = len(n.context)
                count, share, number = np.zeros(size, np.int64), np.zeros((4, size), np.int64), np.full(size + 1, -1, np.int64)
                said = {r["shard"]: r for r in got.get(10 * k + 1, [])}
                for s, own in n.to_shards(shards) if said else []:
                    count[own] = read(said[s]["a"])
                    share[:, own] = read(said[s]["b"]).reshape(4, -1)[:, np.cumsum(starts(n.context[own])) - 1]
                    if said[s]["c"] is not None:
                        number[own] = np.where(count[own] > 0, bases[k][s] + np.cumsum(read(said[s]["c"]).astype(np.int64)), -1)
                out.append((n, count, share))
                context = b.contexts(number[n.token], -1)
            return b, got[0][0]["block"], out

        return unfold

    def sent(self, order: int) -> DataFrame:
        """The n-grams of an order: differences of contexts (a), words (b), training counts (c)."""
        self.learn(order - 1)
        unfold, shards, wide = self.unfolder(), self.shards, self.vocabulary >= (1 << 32) - 1

        def send(t: pa.Table) -> pa.Table:
            _, block, orders = unfold(t, order)
            n = orders[-1][0]
            return pa.Table.from_arrays(rows_of([
                (10 * order, block, s, None, pressed(steps(n.context[own])), pressed(n.word[own].astype("<u8" if wide else "<u4")),
                 pressed(n.counts[own].astype("<u4"))) for s, own in n.to_shards(shards)]), names=FIELDS)

        return self.known(order - 1).groupBy("block").applyInArrow(send, ROWS)

    def levels(self, order: int = 2) -> DataFrame:
        """An order's trie level, a row (shard, level) for each shard."""
        self.learn(order)
        counts_of_counts = self.spread[order]

        def build(t: pa.Table) -> pa.Table:
            rows = t.to_pylist()
            level = TrieLevel.build(*merged(rows), counts_of_counts).to_bytes()
            return pa.table({"shard": pa.array([rows[0]["shard"]], pa.int32()), "level": pa.array([level], pa.binary())})

        return self.sent(order).groupBy("shard").applyInArrow(build, "shard int, level binary")


def score(docs: DataFrame, order: int = 2) -> DataFrame:
    """Fit ``order`` orders on the documents that are not held out and score all, with the levels' quantised probabilities."""
    m = Model(docs, order)
    m.learn(order)
    unfold, total, size = m.unfolder(), m.tokens, m.vocabulary
    discount = {k: discounts(m.spread[k]) for k in range(2, order + 1)}

    def sum_up(t: pa.Table) -> pa.Table:
        b, _, orders = unfold(t, order)
        count = b.counts[b.tokens]
        one = (count + 0.5) / (total + 0.5 * (size + 1))
        best = one.copy()
        for k, (n, seen, share) in enumerate(orders, 2):
            off, of = discount[k], np.maximum(share[0], 1)
            alpha = np.where(seen > 0, ALPHA[alpha_code((seen - off[np.minimum(seen, 3)]) / of)], 0.0)
            weight = np.where(share[0] > 0, LAMBDA[weight_code(off[1:] @ share[1:] / of)], 1.0)
            has = n.token >= 0
            at = n.token[has]
            best[has] = np.minimum(1.0, alpha[at] + weight[at] * best[has])
        at = np.concatenate([[0], np.cumsum(b.n)])[:-1]
        add = lambda x: np.add.reduceat(x, at)
        return pa.table({
            "doc_id": pa.array(b.ids, pa.int64()), "held_out": pa.array([held_out(i) for i in b.ids]), "n_tokens": pa.array(b.n),
            "n_known": pa.array(add((count > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(b.n), total)),
            "base_score": pa.array(add(np.log10(one))), "score": pa.array(add(np.log10(best)))})

    return m.known(order).groupBy("block").applyInArrow(sum_up, SCORES)
