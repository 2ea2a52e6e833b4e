"""SentencePiece BPE encoding and decoding by vectorised merge rounds (operator 13).

A batch of texts is cut into words, its distinct words are laid out as one flat array of symbols, and
rounds of numpy merges run over all of them at once.  Characters that stand side by side in no piece part a
word into segments that can't influence one another.  In each round every segment finds its best pair (the
minimum rank over the segment) and merges that pair's occurrences from the left, at once as long as no merge makes a
pair as good as the one being merged, because that one would be next.  Segments without a
pair leave the arrays (compaction), until none is left.  Symbols outside the vocabulary become byte pieces.

Words begin at a space mark that follows something else, which no piece spans; a longer run of marks is cut where
the vocabulary's longest mark piece ends, as merging from the left would (both are checked
against the vocabulary, which is refused otherwise).

A narrow job: the model file (under 1 MB here) is broadcast, nothing is shuffled, a worker holds one Arrow batch (bounded
by bytes) and the arrays of its distinct words.

Edge cases: null and empty texts give the begin and end ids alone and decode to the empty text; texts of any
length are encoded whole; repeated rows and ids, and null ids, give a row each; columns other than id and text are not read; an
empty table gives no rows.  A model with a normaliser table, with user-defined or unused pieces or without byte pieces is refused.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, doc_text

MARK = "▁"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# fixed values of the model file: kinds of pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NEVER, OPEN = np.int32(2 ** 31 - 1), np.int32(-2)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message's fields."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield number, data[i:i + size]
        i += size


def _one_per_byte(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("one_mark_per_byte", _one_per_byte)


class PieceBpe:
    """The vocabulary as arrays: ranks and results of pairs, characters, and the bytes of every piece."""

    def __init__(self, model: bytes):
        pieces, trainer, spec = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = dict(_fields(value))
        kinds = {k for _, _, k in pieces}
        if trainer.get(3) != 2 or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or sum(k == BYTE for _, _, k in pieces) != 256:
            raise ValueError("not a BPE model of plain pieces with byte pieces")
        if spec.get(2) or spec.get(4, 1) or not spec.get(3, 1) or not spec.get(5, 1) or trainer.get(24):
            raise ValueError("the model's normaliser changes more than spaces")
        self.pieces = pieces
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.begin = next(i for i, (p, _, k) in enumerate(pieces) if p == "<s>")
        self.end = next(i for i, (p, _, k) in enumerate(pieces) if p == "</s>")
        self.byte_ids = np.zeros(256, np.int64)
        for i, (p, _, k) in enumerate(pieces):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self._pairs()
        self._words()
        raw = [b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else " ⁇ ".encode() if k == UNKNOWN
               else p.replace(MARK, " ").encode() for p, _, k in pieces]
        self._bytes = np.frombuffer(b"".join(raw), np.uint8)
        self._starts = np.concatenate([[0], np.cumsum([len(x) for x in raw])])

    def _words(self) -> None:
        """Where texts are cut: before marks that follow something else, and after the longest piece of marks alone."""
        runs = {len(p) for p in self.ids if not p.strip(MARK)}
        longest = max(runs, default=1)
        lowest = min((s for _, s, k in self.pieces if k == NORMAL), default=0.0)
        last = all(self.pieces[self.ids[MARK * n]][1] == lowest for n in runs if n > 1)  # so they are merged after all others
        if not last or any(re.search(f"[^{MARK}]{MARK}|{MARK}{MARK}[^{MARK}]", p) for p in self.ids):
            raise ValueError("pieces span the places where words are cut")
        self.word = re.compile(f"{MARK}{{{longest}}}(?={MARK})|{MARK}{{0,{longest}}}[^{MARK}]+|{MARK}{{1,{longest}}}")
        whole = [MARK * (longest + n) for n in range(1, 2 * longest)]
        for w in whole:
            if self.encode_words([w])[0].tolist() != self.encode_words(self.word.findall(w))[0].tolist():
                raise ValueError("runs of marks can't be cut")

    def _pairs(self) -> None:
        """Symbols are pieces, or characters (numbered after the pieces) that only occur inside of pieces."""
        symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                symbols.setdefault(c, len(self.pieces) + len(symbols))
        order = {s: r for r, s in enumerate(sorted({s for _, s, k in self.pieces if k == NORMAL}, reverse=True))}
        self._width = np.int64(max(symbols.values()) + 2)
        pairs = sorted((symbols[p[:i]] * int(self._width) + symbols[p[i:]], order[self.pieces[n][1]], n)
                       for p, n in self.ids.items() for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols)
        self._keys, self._ranks, self._made = (np.array(x, t) for x, t in zip(zip(*pairs), ("i8", "i4", "i4")))
        chars = sorted((ord(c), n) for c, n in symbols.items() if len(c) == 1)
        self._chars, self._char_symbols = (np.array(x, t) for x, t in zip(zip(*chars), ("i8", "i4")))
        self._beside = np.unique(np.array([ord(a) << 32 | ord(b) for p in self.ids for a, b in zip(p, p[1:])], np.int64))

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NEVER``: none) and result of pairs of symbols."""
        at, there = self._find(self._keys, left.astype(np.int64) * self._width + right)
        there &= (left >= 0) & (right >= 0)
        return np.where(there, self._ranks[at], NEVER), self._made[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and where each word's begin (one more entry than words)."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
        out = self._rounds(chars, starts)
        own = out != OPEN
        at = np.flatnonzero(own)
        symbols, points = out[own], chars[own]
        plain = (symbols >= 0) & (symbols < len(self.pieces))
        size = np.where(plain, 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        ends = np.cumsum(size)
        ids = np.repeat(symbols, size)
        if not plain.all():  # symbols without a piece: one byte piece for each of their bytes
            odd = np.flatnonzero(~plain)
            data = np.frombuffer("".join(map(chr, points[odd].tolist())).encode(), np.uint8)
            ids[np.repeat(~plain, size)] = self.byte_ids[data]
        return ids, np.concatenate([[0], ends])[np.searchsorted(at, starts)]

    def _rounds(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The symbol that begins at each character (``OPEN``: none does) once no pair is left."""
        out = np.full(len(chars), OPEN, np.int32)
        if not len(chars):
            return out
        at, there = self._find(self._chars, chars)
        symbols = np.where(there, self._char_symbols[at], np.int32(-1))
        joined = self._find(self._beside, chars[:-1] << 32 | chars[1:])[1]  # character k with k + 1
        joined[starts[1:-1] - 1] = False
        segment = np.concatenate([[0], np.cumsum(~joined)]).astype(np.int32)
        place = np.arange(len(chars), dtype=np.int32)
        rank, made = np.full(len(chars), NEVER), np.zeros(len(chars), np.int32)
        first = np.flatnonzero(joined)
        rank[first], made[first] = self._pair(symbols[first], symbols[first + 1])
        while len(place):
            heads = np.flatnonzero(np.diff(segment, prepend=-1))
            sizes = np.diff(heads, append=len(segment))
            least = np.minimum.reduceat(rank, heads)
            if (done := least == NEVER).any():
                gone = np.repeat(done, sizes)
                out[place[gone]] = symbols[gone]
                place, symbols, segment, rank, made = (x[~gone] for x in (place, symbols, segment, rank, made))
                least, sizes = least[~done], sizes[~done]
                if not len(place):
                    break
            least = np.repeat(least, sizes)
            chosen = self._from_left(np.flatnonzero(rank == least))
            chosen = chosen[self._in_turn(chosen, symbols, segment, made, least)]
            symbols[chosen] = made[chosen]
            stay = np.ones(len(place), bool)
            stay[chosen + 1] = False
            chosen -= np.arange(len(chosen))  # one symbol before each has gone by then
            place, symbols, segment, rank, made = (x[stay] for x in (place, symbols, segment, rank, made))
            changed = np.zeros(len(place) + 1, bool)
            changed[chosen] = changed[chosen - 1] = True  # (of place 0 the one before is the last, which is no place)
            left = np.flatnonzero(changed[:-1])
            rank[left] = NEVER
            left = left[left + 1 < len(place)]
            left = left[segment[left] == segment[left + 1]]
            rank[left], made[left] = self._pair(symbols[left], symbols[left + 1])
        return out

    @staticmethod
    def _from_left(at: np.ndarray) -> np.ndarray:
        """Of pairs that overlap (neighbouring places) every other one, from the left."""
        new = np.diff(at, prepend=-2) != 1
        return at[(np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]) % 2 == 0]

    def _in_turn(self, chosen, symbols, segment, made, least) -> np.ndarray:
        """The merges up to each segment's first that makes a pair at least as good as the one being merged."""
        own, n = segment[chosen], len(symbols)
        before, after = chosen - 1, chosen + 2
        merged_before = np.diff(chosen, prepend=-9) == 2
        left = np.where(merged_before, np.roll(made[chosen], 1), symbols[np.maximum(before, 0)])
        left = np.where((before >= 0) & (segment[np.maximum(before, 0)] == own), left, np.int32(-1))
        right = np.where((after < n) & (segment[np.minimum(after, n - 1)] == own), symbols[np.minimum(after, n - 1)], np.int32(-1))
        better = np.minimum(self._pair(left, made[chosen])[0], self._pair(made[chosen], right)[0]) <= least[chosen]
        so_far = np.cumsum(better) - better
        return so_far == so_far[np.searchsorted(own, own)]

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, begin and end ids included, and where each text's begin."""
        words, counts = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                own = self.word.findall(MARK + text.replace(" ", MARK))
                counts[k] = len(own)
                words += own
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        ids, starts = self.encode_words(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy(zero_copy_only=False)
        size = (starts[1:] - starts[:-1])[at]
        before = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(starts[at] - before[:-1], size) + np.arange(before[-1])]
        ends = before[np.cumsum(counts)]
        begins = np.concatenate([[0], ends[:-1]])[:len(texts)]
        flat = np.insert(flat, np.stack([begins, ends], 1).ravel(), np.tile([self.begin, self.end], len(texts)))
        return flat.astype("<u4"), np.concatenate([[0], ends + 2 * np.arange(1, len(texts) + 1)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes: marks are spaces, the first piece's first mark goes, bytes that form no character are each U+FFFD."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("no such id")
        size = self._starts[ids + 1] - self._starts[ids]
        data = self._bytes[np.repeat(self._starts[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()
        shown = np.flatnonzero(size)
        if len(shown):
            piece, _, kind = self.pieces[ids[shown[0]]]
            if kind == NORMAL and piece.startswith(MARK):
                data = data[1:]
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "one_mark_per_byte").encode()
        return data


_models: dict[bytes, PieceBpe] = {}


def loaded(model: bytes) -> PieceBpe:
    """One vocabulary for each Python worker and model."""
    key = hashlib.sha256(model).digest()
    if key not in _models:
        _models[key] = PieceBpe(model)
    return _models[key]


def encode_decode(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """Per document the ids' count and digest and the decoded text's digest; ``with_ids`` adds ``ids``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(model_path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(shared.value)
        for b in batches:
            ids, at = bpe.encode_texts(b.column(1).to_pylist())
            each = [ids[s:e] for s, e in zip(at, at[1:])]
            cols = [b.column(0), pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in each], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in each], pa.string())]
            if with_ids:
                cols.append(pa.array([x.astype("i4") for x in each], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(cols)])

    return doc_text(docs).mapInArrow(run, RESULT + (", ids array<int>" if with_ids else ""))
