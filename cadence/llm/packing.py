"""Bounded-space online best-fit packing of token sequences (operator 9).

Every partition packs its own pieces in one pass.  At most ``open_bins`` bins are
open; a bitset keyed by free space says which fills exist, so the fullest bin that still
takes a piece is the lowest set bit at or above its length.  When a new bin is
needed and all are open, the fullest closes.  A piece's place is final when it
is put down, so nothing is buffered and memory is bounded by ``open_bins``.

Documents longer than a sequence are cut into whole sequences after a first, shorter
piece.  Pieces of one Arrow batch are placed longest first.

Edge cases: the tokenizer file's added tokens (here <|endoftext|>) in a text are their own ids; a null or empty text is the end token alone; a null id stays null; equal rows are
packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import ChunkCache, bounded_batches, doc_text

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
OPEN_BINS = 2048


class BestFit:
    """Open bins by free space; ``place`` returns the bin number and the offset in it."""

    def __init__(self, size: int, open_bins: int, first: int = 0):
        self.size, self.open_bins, self.next = size, open_bins, first
        self.bits, self.open, self.bins = 0, 0, [[] for _ in range(size + 1)]

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.size, self.next
            self.next += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.size - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def pieces(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document of ``n`` tokens: whole sequences after a shorter first piece."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, n, size)]


_caches: dict = {}


def byte_ranks(data: str) -> dict[bytes, int]:
    """Ids by bytes of a byte-level tokenizer file, whose vocabulary shows each byte as a printable
    character: those of Latin-1 as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    content = json.loads(data)
    special = {t["content"] for t in content["added_tokens"]}
    return {bytes(shown[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special}


def tokenizer_cache(data: str, pattern: str) -> ChunkCache:
    """Encodes text without added tokens by the tokenizer file's vocabulary and merges: its ids grow in the order of its merges, so
    they serve as ranks, which tiktoken merges faster than the tokenizers library does (a test holds the
    ids equal)."""
    if data not in _caches:
        import tiktoken

        t = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=byte_ranks(data), special_tokens={})
        _caches[data] = ChunkCache(lambda chunks: [np.array(t.encode_ordinary(c), "<u4").tobytes() for c in chunks])
    return _caches[data]


def encoder(data: str, pattern: str) -> Callable[[str], bytes]:
    """As the tokenizers library does, texts are first split at the file's added tokens (the leftmost, of these the longest),
    which become their ids; what stands between them is encoded apart."""
    cache, added = tokenizer_cache(data, pattern), {}
    for t in json.loads(data)["added_tokens"]:
        if any(t[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {t['content']!r} is not matched literally")
        added[t["content"]] = np.array([t["id"]], "<u4").tobytes()
    if not added:
        return cache
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode(text: str) -> bytes:
        first, *parts = cut.split(text)
        if not parts:
            return cache(first)
        return cache(first) + b"".join(added[token] + cache(after) for token, after in zip(parts[::2], parts[1::2]))

    return encode


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, size: int = 1024, end_id: int = 2,
         open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """One row per piece with its place; ``with_ids`` adds the piece's token ids.

    ``sequence_id`` joins the partition's number and a running number.  The tokenizer (a fixed file)
    is broadcast; there is no shuffle.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, pattern)
        bins = BestFit(size, open_bins, TaskContext.get().partitionId() << 40)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode(text) + end
                for k, (start, length) in enumerate(pieces(len(ids) // 4, size)):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((doc, k, start, length, zlib.crc32(part), part if with_ids else None))
            rows.sort(key=lambda r: -r[3])
            places = [bins.place(r[3]) for r in rows]
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            cols += [pa.array([p[i] for p in places], pa.int64()) for i in range(2)]
            if with_ids:
                cols.append(pa.array([np.frombuffer(r[5], "<u4").astype("i4") for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"][:len(cols)])

    return doc_text(docs).mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
