"""Elias-Fano sequences and n-gram trie levels, read in place from bytes or a memory map."""

from __future__ import annotations

import numpy as np

ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)
#: Place of the k-th one in a byte.
PLACE = np.array([[([j for j in range(8) if i >> j & 1] + [0] * 8)[k] for k in range(8)] for i in range(256)], np.int64)


class EliasFano:
    """A non-decreasing sequence: low bits in whole bytes, high bits in unary, about 2 bits more for each value.

    ``to_bytes`` and ``open`` exchange the compact form; opening copies nothing and adds a directory of one
    number for every 64 bits of the unary part.
    """

    def __init__(self, n: int, low_bytes: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bytes, self.low, self.high = n, low_bytes, low, high
        ones = ONES[self.high.view(np.uint8)].reshape(-1, 8).sum(1) if len(high) else np.zeros(0, np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @staticmethod
    def build(values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low_bytes = max(0, -(-((top // max(1, n)).bit_length() - 1) // 8)) if n else 0
        high = (v >> np.uint64(8 * low_bytes)).astype(np.int64)
        bits = np.zeros(-(-((int(high[-1]) if n else 0) + n + 2) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        low = v.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low_bytes]
        return EliasFano(n, low_bytes, np.ascontiguousarray(low).reshape(-1), np.packbits(bits, bitorder="little").view("<u8"))

    def to_bytes(self) -> bytes:
        return np.array([self.n, self.low_bytes, len(self.high)], "<i8").tobytes() + self.high.astype("<u8").tobytes() + self.low.tobytes()

    @staticmethod
    def open(data, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that begins at ``at`` and where it ends."""
        n, low_bytes, words = np.frombuffer(data, "<i8", 3, at).tolist()
        high = np.frombuffer(data, "<u8", words, at + 24)
        low = np.frombuffer(data, np.uint8, n * low_bytes, at + 24 + 8 * words)
        return EliasFano(n, low_bytes, low, high), at + 24 + 8 * words + n * low_bytes

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Places of the k-th ones or zeros (from 0) of the unary part."""
        counts = self.ones if one else self.zeros
        w = np.searchsorted(counts, k, "right") - 1
        rest = k - counts[w]
        word = self.high[w] if one else ~self.high[w]
        place = w * 64
        for bits in (32, 16, 8):  # the half that holds the bit, down to a byte
            low = word & np.uint64((1 << bits) - 1)
            c = np.bitwise_count(low).astype(np.int64)
            on = rest >= c
            rest = np.where(on, rest - c, rest)
            word = np.where(on, word >> np.uint64(bits), low)
            place = place + bits * on
        return place + PLACE[word.astype(np.int64), rest]

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for b in range(self.low_bytes):
            out |= self.low[i * self.low_bytes + b].astype(np.int64) << (8 * b)
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        i = np.asarray(i, np.int64)
        return ((self._select(i, True) - i) << (8 * self.low_bytes)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """For each ``x`` the place of the first value that is at least ``x`` (``n`` if there is none)."""
        x = np.asarray(x, np.int64)
        high = x >> (8 * self.low_bytes)
        most = int(self.zeros[-1]) - 1  # there is a zero for every high part up to this
        inside = high < most
        h = np.where(inside, high, 0)
        begin = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - h + 1, 0)
        end = self._select(h, False) - h
        low, at = x & ((1 << (8 * self.low_bytes)) - 1), begin.copy()
        if self.low_bytes:
            left, right = begin, end.copy()
            active = np.flatnonzero(left < right)
            left, right = left.copy(), right
            while len(active):  # halve each bucket
                mid = (left[active] + right[active]) >> 1
                less = self._low(mid) < low[active]
                left[active[less]] = mid[less] + 1
                right[active[~less]] = mid[~less]
                active = active[left[active] < right[active]]
            at = left
        return np.where(inside, at, self.n)


ALPHA_DECADES = 7.0


def alpha_code(p: np.ndarray) -> np.ndarray:
    """Eight bits on a logarithmic scale; 0 is for what is absent."""
    return (1 + np.round(254 * np.clip(1 + np.log10(np.maximum(p, 1e-300)) / ALPHA_DECADES, 0, 1))).astype(np.uint8)


ALPHA = np.concatenate([[0.0], 10 ** (ALPHA_DECADES * (np.arange(255) / 254 - 1))])
LAMBDA = np.arange(256) / 255


def spread(count: np.ndarray) -> np.ndarray:
    """How many n-grams have the counts 1, 2, 3 and 4."""
    return np.array([(count == c).sum() for c in (1, 2, 3, 4)], np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """What absolute discounting takes from the counts 0, 1, 2 and more, estimated from the counts of counts ``n``."""
    n1, n2, n3, n4 = (max(1, int(c)) for c in n)
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.1, 0.2, 0.3], [0, 0.95, 1.5, 2.0])


def weight_code(left: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.round(left * 255)).astype(np.uint8)


class TrieLevel:
    """Contexts, pointers to their ranges of successors, and quantised probabilities.

    The successors of all contexts are one monotone sequence: a context's successors are added to the
    last value before them, so finding (context, word) is one successor search from that base.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, alpha: np.ndarray, weight: np.ndarray):
        self.contexts, self.pointers, self.successors, self.alpha, self.weight = contexts, pointers, successors, alpha, weight

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, count: np.ndarray, counts_of_counts: np.ndarray | None = None) -> TrieLevel:
        """From distinct (context, word) pairs sorted by both, with positive counts; probabilities by absolute discounting with
        a discount for each of the counts 1, 2 and more, estimated from the counts of counts (of all shards; if
        not given, of these pairs)."""
        first = np.unique(context, return_index=True)[1]
        size = np.diff(np.append(first, len(context)))
        discount = discounts(spread(count) if counts_of_counts is None else counts_of_counts)
        off = discount[np.minimum(count, 3)]
        total = np.add.reduceat(count, first).astype(float) if len(first) else np.zeros(0)
        left = np.add.reduceat(off, first) / total if len(first) else np.zeros(0)
        alpha = (count - off) / np.repeat(total, size)
        level = TrieLevel.index(context, word)
        level.alpha, level.weight = alpha_code(alpha), weight_code(left)
        return level

    @staticmethod
    def index(context: np.ndarray, word: np.ndarray) -> TrieLevel:
        """The searchable part alone, from distinct pairs sorted by both."""
        ids, first = np.unique(context, return_index=True)
        last = word[np.append(first[1:], len(word)) - 1].astype(np.int64) if len(word) else np.zeros(0, np.int64)
        base = np.concatenate([[0], np.cumsum(last + 1)])[:len(ids)]
        none = np.zeros(0, np.uint8)
        return TrieLevel(EliasFano.build(ids), EliasFano.build(np.append(first, len(context))),
                         EliasFano.build(word.astype(np.int64) + np.repeat(base, np.diff(np.append(first, len(context))))), none, none)

    def to_bytes(self) -> bytes:
        return self.contexts.to_bytes() + self.pointers.to_bytes() + self.successors.to_bytes() + self.alpha.tobytes() + self.weight.tobytes()

    @staticmethod
    def open(data) -> TrieLevel:
        """From bytes or a memory map; nothing is copied."""
        contexts, at = EliasFano.open(data)
        pointers, at = EliasFano.open(data, at)
        successors, at = EliasFano.open(data, at)
        return TrieLevel(contexts, pointers, successors, np.frombuffer(data, np.uint8, successors.n, at),
                         np.frombuffer(data, np.uint8, contexts.n, at + successors.n))

    def locate(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair: its place among the pairs and its context's among the contexts (-1 if absent)."""
        place, owner = np.full(len(context), -1, np.int64), np.full(len(context), -1, np.int64)
        if not len(context) or not self.contexts.n:
            return place, owner
        new = np.append(True, context[1:] != context[:-1])  # a context that is asked for in a row is searched for once
        asked, group = context[new], np.cumsum(new) - 1
        c = self.contexts.successor(asked)
        inside = np.flatnonzero(c < self.contexts.n)
        inside = inside[self.contexts.get(c[inside]) == asked[inside]]
        own, end, base = np.full(len(asked), -1, np.int64), *np.zeros((2, len(asked)), np.int64)
        own[inside] = c = c[inside]
        first, end[inside] = self.pointers.get(c), self.pointers.get(c + 1)
        base[inside] = np.where(first > 0, self.successors.get(np.maximum(first - 1, 0)) + 1, 0)
        owner = own[group]
        known = np.flatnonzero(owner >= 0)
        group = group[known]
        wanted = base[group] + word[known]
        at = self.successors.successor(wanted)
        hit = np.flatnonzero(at < end[group])
        hit = hit[self.successors.get(at[hit]) == wanted[hit]]
        place[known[hit]] = at[hit]
        return place, owner

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair: its place among the pairs (-1 if absent), the code of its probability (0 if absent) and the code of its
        context's weight for the lower order (255, that is 1, if the context is absent)."""
        place, owner = self.locate(context, word)
        alpha, weight = np.zeros(len(place), np.uint8), np.full(len(place), 255, np.uint8)
        alpha[place >= 0] = self.alpha[place[place >= 0]]
        weight[owner >= 0] = self.weight[owner[owner >= 0]]
        return place, alpha, weight
