"""Word shingles of whole texts as sorted sets of 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = 0x9E3779B97F4A7C15
CHAIN = np.uint64(0xD6E8FEB86659FD93)
BATCH = 1 << 20  # bytes worked on at a time; one longer text is worked on alone
SETS_BATCH = 1 << 18  # for sets, whose sorting takes more memory a byte


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased, and each text's first word (offsets).

    A word's hash is its bytes' polynomial, taken from running sums, then mixed.
    """
    d = LOWER[data]
    inside = ~SPACE[d]
    n = len(d)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    start = np.flatnonzero(begin)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    stop = np.flatnonzero(last) + 1
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    power = np.full(n, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((d.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
    back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    h = mix((total[stop] - total[start]) * back[start] + (stop - start).astype(np.uint64) * CHAIN)
    return h, np.searchsorted(start, off)


def shingles(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every shingle; a text of fewer words is one shingle."""
    h, first = words(data, off)
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(h))
    whole = at + size <= first[1:][text] if len(h) else np.zeros(0, bool)
    own = at[whole]
    full = np.full(len(own), size, np.uint64)
    for j in range(size):
        full = full * CHAIN + h[own + j]
    texts, out = [text[own]], [mix(full)]
    for few in range(1, size):
        short = np.flatnonzero(count == few)
        if len(short):
            one = np.full(len(short), few, np.uint64)
            for j in range(few):
                one = one * CHAIN + h[first[short] + j]
            texts.append(short)
            out.append(mix(one))
    return np.concatenate(texts), np.concatenate(out)


def sets(data: np.ndarray, off: np.ndarray, size: int):
    """Yields (number of the first text, cuts, hashes): sorted distinct shingle hashes of consecutive texts,
    text ``first + i`` having ``hashes[cuts[i]:cuts[i + 1]]``."""
    a = 0
    while a < len(off) - 1:
        b = max(a + 1, int(np.searchsorted(off, off[a] + SETS_BATCH, "right")) - 1)
        text, h = shingles(data[off[a]:off[b]], off[a:b + 1] - off[a], size)
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        text, h = text[keep], h[keep]
        yield a, np.searchsorted(text, np.arange(b - a + 1)), h
        a = b
