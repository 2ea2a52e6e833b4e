import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from cadence.llm import bpe, packing

ALPHABET = "ab eést  \n\t.1é'sll日—! "


@pytest.fixture(scope="module")
def multi():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return bpe.PrefixBpe(ranks, P.PATTERN), tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_text(rng, most=40):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def test_read_ranks():
    assert bpe.read_ranks(base64.b64encode(b"ab") + b" 7\n\n") == {b"ab": 7}


def test_encoding_equals_the_library(multi):
    own, library = multi
    rng = random.Random(1)
    cache = bpe.ChunkCache(own.encode_chunks, limit=50)
    for _ in range(3000):
        t = some_text(rng)
        ids = library.encode_ordinary(t)
        assert own.encode(t) == ids
        assert np.frombuffer(cache(t), "<u4").tolist() == ids
        assert own.decode(ids) == t.encode()


def test_long_words_and_runs(multi):
    own, library = multi
    for t in ("a" * 3000, " " * 999, "ab" * 700 + "é" * 500, "!?" * 800, "\n" * 77 + "x"):
        assert own.encode(t) == library.encode_ordinary(t)


def test_edits_and_appends(multi):
    own, library = multi
    rng = random.Random(2)
    e = bpe.EditableEncoding(own, "The quick brown fox jumps over the lazy dog. " * 5)
    for _ in range(200):
        i = rng.randint(0, len(e.text))
        e.replace(i, min(len(e.text), i + rng.randint(0, 6)), some_text(rng, 6))
        assert e.ids == library.encode_ordinary(e.text)
    before = e.computed
    e.append("z")
    assert e.ids == library.encode_ordinary(e.text)
    assert e.computed - before <= 2 * 40  # only near the end


def test_encode_decode_on_odd_rows(multi, odd_docs, no_docs):
    _, library = multi
    path = P.path("byte_bpe_multi_50k.tiktoken")
    got = bpe.encode_decode(odd_docs, path, P.PATTERN, with_ids=True).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    expect = []
    for doc, t in texts:
        ids = library.encode_ordinary(t)
        expect.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), ids))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expect))
    assert bpe.encode_decode(no_docs, path, P.PATTERN).collect() == []


def test_byte_ranks_equal_the_rank_file():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(P.path("byte_bpe_50k.tiktoken"), "rb") as g:
        assert packing.byte_ranks(f.read()) == bpe.read_ranks(g.read())


def test_cache_equals_the_tokenizers_library():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        data = f.read()
    cache, t = packing.tokenizer_cache(data, P.PATTERN), Tokenizer.from_str(data)
    t.encode_special_tokens = True
    rng = random.Random(3)
    for text in ["<|endoftext|> x", " <|endoftext|>", *(some_text(rng) for _ in range(2000))]:
        assert np.frombuffer(cache(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_pieces():
    assert packing.pieces(10, 10) == [(0, 10)]
    assert packing.pieces(25, 10) == [(0, 5), (5, 10), (15, 10)]
    assert packing.pieces(30, 10) == [(0, 10), (10, 10), (20, 10)]


@pytest.mark.parametrize("bins", [1, 3, 100])
def test_best_fit_against_a_plain_search(bins):
    rng = random.Random(bins)
    own, plain, number = packing.BestFit(50, bins), {}, 0
    for _ in range(500):
        n = rng.randint(1, 50)
        got, offset = own.place(n)
        fits = [free for free in plain.values() if free >= n]
        if fits:
            assert plain[got] == min(fits)  # the fullest that takes it
        else:
            if len(plain) == bins:
                closed = min(plain, key=lambda b: plain[b])
                full = plain[closed]
                open_now = {b for k in range(51) for b in own.bins[k]} | {got}
                gone = [b for b in plain if b not in open_now]
                assert len(gone) == 1 and plain.pop(gone[0]) == full
            assert got == number
            number += 1
            plain[got] = 50
        assert offset == 50 - plain[got]
        plain[got] -= n
        if not plain[got]:
            del plain[got]


def test_pack_rows(odd_docs, no_docs):
    path = P.path("byte_bpe_50k.json")
    rows = packing.pack(odd_docs, path, P.PATTERN, size=64, with_ids=True).collect()
    t = Tokenizer.from_file(path)
    expect = sorted(repr((r.doc_id, t.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in odd_docs.collect() if r.doc_id not in (3, None))
    own = {}
    for r in sorted(rows, key=lambda r: r.piece):
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        if r.doc_id not in (3, None):
            assert len(own.setdefault(r.doc_id, [])) == r.start
            own[r.doc_id] += r.ids
    assert sorted(repr(x) for x in own.items()) == expect
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(no_docs, path, P.PATTERN).collect() == []


def test_added_tokens_are_ids_as_in_the_library(spark):
    path, end = P.path("byte_bpe_50k.json"), "<|endoftext|>"
    t, rng = Tokenizer.from_file(path), random.Random(4)
    with open(path, encoding="utf-8") as f:
        encode = packing.encoder(f.read(), P.PATTERN)
    assert np.frombuffer(encode(f"a {end} b"), "<u4").tolist() == [64, 220, 50256, 275]
    texts = ["", end, end * 3, f" {end} ", f"x{end[:-1]}{end}{end[1:]}", end.upper(),
             *("".join(rng.choice([end, end[:5], some_text(rng, 8), " "]) for _ in range(rng.randint(0, 9))) for _ in range(1000))]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, P.PATTERN).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {
        i: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in
        ((i, t.encode(text, add_special_tokens=False).ids + [2]) for i, text in enumerate(texts))}
