"""Byte-level BPE by prefix dynamic programming (operator 2).

For a rank vocabulary every byte prefix of a piece has exactly one BPE encoding,
so the id of its last token describes the prefix.  ``last[i]`` is the one token
that ends at byte ``i`` and may follow ``last[i - len(token)]``; two tokens may
follow one another when merging their bytes would end in just these two.  The
table gives exact appends (only new bytes are computed) and re-encoding near an
edit (entries before it stand, entries after it are computed until they meet the
old ones again).

Edge cases: a null or empty text has no ids; a text may be of any length (its
pieces are encoded one by one); equal rows give equal rows; an empty table an
empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import ChunkCache, bounded_batches, doc_text

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
PAIRS_KEPT = 400_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64(token) rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class PrefixBpe:
    """Encoder and decoder over one rank vocabulary and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.vocab = {i: b for b, i in ranks.items()}
        self._spines: dict[int, tuple | None] = {}
        self._pairs: dict[int, bool] = {}
        # an automaton over bytes: a state is the longest ending of the prefix that begins some token; states are
        # numbered when first met, with the tokens that end there, the longest first
        self._begin = {b[:k] for b in ranks for k in range(len(b) + 1)}
        self._states: list[bytes] = [b""]
        self._number: dict[bytes, int] = {b"": 0}
        self._ends: list[tuple] = [()]
        self._step: dict[int, int] = {}
        self.longest = max(map(len, ranks), default=1)
        self._offsets = np.zeros(max(self.vocab, default=0) + 2, np.int64)
        for i, b in self.vocab.items():
            self._offsets[i + 1] = len(b)
        np.cumsum(self._offsets, out=self._offsets)
        self._bytes = np.frombuffer(b"".join(self.vocab[i] for i in sorted(self.vocab)), np.uint8)

    # -- which tokens exist, and which may follow one another

    def spines(self, token: int) -> tuple[list[int], list[int]] | None:
        """Symbols that stand at the left and the right end while the token is built from its bytes,
        in order of time; None if merging its bytes does not end in the token."""
        if token not in self._spines:
            sym = [self.vocab[token][i:i + 1] for i in range(len(self.vocab[token]))]
            left, right = [self.ranks.get(sym[0], -1)], [self.ranks.get(sym[-1], -1)]
            while len(sym) > 1:
                rank, at = min((self.ranks.get(sym[i] + sym[i + 1], 1 << 60), i) for i in range(len(sym) - 1))
                if rank == 1 << 60:
                    break
                if at == 0:
                    left.append(rank)
                if at == len(sym) - 2:
                    right.append(rank)
                sym[at:at + 2] = [sym[at] + sym[at + 1]]
            self._spines[token] = (left, right) if len(sym) == 1 else None
        return self._spines[token]

    def follows(self, a: int, b: int) -> bool:
        """True if the bytes of ``a`` and ``b`` merge to exactly these two tokens."""
        got = self._pairs.get(a << 32 | b)
        if got is None:
            if len(self._pairs) > PAIRS_KEPT:
                self._pairs.clear()
            got = self._pairs[a << 32 | b] = self._follows(a, b)
        return got

    def _follows(self, a: int, b: int) -> bool:
        right, left = self.spines(a)[1], self.spines(b)[0]
        i = j = 0
        while True:
            over = self.ranks.get(self.vocab[right[i]] + self.vocab[left[j]], 1 << 60)
            next_a = right[i + 1] if i + 1 < len(right) else 1 << 59
            next_b = left[j + 1] if j + 1 < len(left) else 1 << 59
            if over < next_a and over <= next_b:  # of equal ranks the leftmost merges first
                return False
            if next_a == next_b == 1 << 59:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    # -- the table

    def step(self, state: int, byte: int) -> int:
        to = self._step.get(state << 8 | byte)
        if to is None:
            ending = self._states[state] + bytes((byte,))
            while ending not in self._begin:
                ending = ending[1:]
            to = self._number.get(ending)
            if to is None:
                to = self._number[ending] = len(self._states)
                self._states.append(ending)
                tokens = ((len(ending) - k, self.ranks.get(ending[k:])) for k in range(len(ending)))
                self._ends.append(tuple((n, t) for n, t in tokens if t is not None and self.spines(t) is not None))
            self._step[state << 8 | byte] = to
        return to

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Append to ``last`` the last token of each further prefix of ``data``."""
        steps, pairs, ends, state = self._step.get, self._pairs.get, self._ends, 0
        i = len(last)
        for byte in data[max(0, i - self.longest):i]:
            state = self.step(state, byte)
        for byte in data[i:] if i else data:
            to = steps(state << 8 | byte)
            state = self.step(state, byte) if to is None else to
            i += 1
            for size, t in ends[state]:
                if size == i:
                    break
                ok = pairs(last[i - size - 1] << 32 | t)
                if ok or ok is None and self.follows(last[i - size - 1], t):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(t)
        return last

    def tokens(self, data: bytes, last: list[int]) -> list[int]:
        out, i = [], len(data)
        while i:
            out.append(last[i - 1])
            i -= len(self.vocab[last[i - 1]])
        return out[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)  # a piece that is itself in the vocabulary is that token
        return [whole] if whole is not None else self.tokens(data, self.extend(data, []))

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        find, piece = self.pattern.findall, self.encode_piece
        return [array("I", [t for m in find(c) for t in piece(m.encode())]).tobytes() for c in chunks]

    def encode(self, text: str) -> list[int]:
        return [t for m in self.pattern.findall(text) for t in self.encode_piece(m.encode())]

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        start, size = self._offsets[ids], self._offsets[ids + 1] - self._offsets[ids]
        return self._bytes[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()


class EditableEncoding:
    """The encoding of one text that follows edits of it.

    Per piece it keeps the bytes and their prefix table.  ``replace`` splits anew from the piece
    before the edit until a piece boundary meets an old one, and inside the piece that the
    edit begins in keeps the table up to the edit.
    """

    def __init__(self, bpe: PrefixBpe, text: str = ""):
        self.bpe, self.text, self.pieces, self.computed = bpe, "", [], 0
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``end``."""
        text = self.text[:start] + new + self.text[end:]
        shift = len(text) - len(self.text)
        at, keep = 0, 0
        while keep < len(self.pieces) and at + len(self.pieces[keep][0]) < start:
            at += len(self.pieces[keep][0])
            keep += 1
        if keep:  # the pattern looks ahead, so the piece before may end elsewhere now
            keep -= 1
            at -= len(self.pieces[keep][0])
        old, place = {}, at
        for k in range(keep, len(self.pieces)):
            old[place + shift] = k
            place += len(self.pieces[k][0])
        made, rest = [], []
        for m in self.bpe.pattern.finditer(text, at):
            if m.start() >= start + len(new) and m.start() in old:
                rest = self.pieces[old[m.start()]:]
                break
            made.append(self._piece(m.group(), self.pieces[keep + len(made)] if keep + len(made) < len(self.pieces) else None))
        self.text, self.pieces = text, self.pieces[:keep] + made + rest

    def _piece(self, text: str, before) -> tuple[str, list[int], list[int]]:
        data, last = text.encode(), []
        if before is not None:
            was, n = before[0].encode(), 0
            while n < min(len(was), len(data), len(before[1])) and was[n] == data[n]:
                n += 1
            last = before[1][:n]
        self.computed += len(data) - len(last)
        self.bpe.extend(data, last)
        whole = self.bpe.ranks.get(data)
        return text, last, [whole] if whole is not None else self.bpe.tokens(data, last)

    @property
    def ids(self) -> list[int]:
        return [t for p in self.pieces for t in p[2]]


_encoders: dict = {}


def encoder(data: bytes, pattern: str) -> tuple[PrefixBpe, ChunkCache]:
    """One encoder and chunk cache for each Python worker and vocabulary."""
    key = hashlib.sha256(data + pattern.encode()).digest()
    if key not in _encoders:
        bpe = PrefixBpe(read_ranks(data), pattern)
        _encoders[key] = bpe, ChunkCache(bpe.encode_chunks)
    return _encoders[key]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per document the ids' count and digest and the decoded text's digest; ``with_ids`` adds ``ids``.

    A narrow job: the vocabulary (a fixed file, under 1 MB here) is broadcast and nothing is shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(ranks_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = encoder(shared.value, pattern)
        for b in batches:
            n, sha, back, all_ids = [], [], [], []
            for text in b.column(1).to_pylist():
                ids = cache(text)
                n.append(len(ids) // 4)
                sha.append(hashlib.sha256(ids).hexdigest())
                listed = np.frombuffer(ids, "<u4")
                back.append(hashlib.sha256(bpe.decode(listed)).hexdigest())
                if with_ids:
                    all_ids.append(listed.astype("i4"))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])

    return doc_text(docs).mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
