"""Encoding and decoding equal the sentencepiece library's, for any text and for any ids."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cadence.llm.piece_bpe import PieceBpe, encode_decode

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
with open(PATH, "rb") as f:
    BPE = PieceBpe(f.read())


def hold(texts):
    ids, at = BPE.encode_texts(texts)
    want = LIBRARY.encode(texts, num_threads=1, add_bos=True, add_eos=True)
    for k, text in enumerate(texts):
        got = ids[at[k]:at[k + 1]].tolist()
        assert got == want[k], text[:200]
        assert BPE.decode(got).decode() == LIBRARY.decode(want[k])


def test_chosen_texts():
    hold(["", " ", "  ", "a", " a", "a ", " " * 15, " " * 16, " " * 17, " " * 33 + "x", "x" + " " * 40, "▁", "▁▁a ▁", "\n\n\t\r\0 a",
          "aaaaaaa", "abababababab", "é日本　x 🤗🤗", "<s>[INST] </s><unk>", "�﻿", "the the  the   the"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abcdeinorstABC01 ▁\n.,'"), st.characters(exclude_categories=["Cs"])), max_size=80), max_size=6))
def test_any_text(texts):
    hold(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=40))
def test_any_ids_decode_alike(ids):
    assert BPE.decode(np.array(ids, np.int64)).decode() == LIBRARY.decode(ids)


def test_long_words():
    r = random.Random(3)
    hold(["".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(60_000)), "日本語中文字" * 5_000, "ab" * 30_000])
    ids, _ = BPE.encode_texts([" " * 100_000])
    assert BPE.decode(ids) == b" " * 100_000 and len(ids) < 7_000


def test_other_models_are_refused():
    with open(PATH, "rb") as f:
        data = f.read()
    with pytest.raises(ValueError):
        PieceBpe(data[:len(data) // 2])  # cut before the settings


def test_rows(spark, odd_docs, no_docs):
    got = sorted(map(tuple, encode_decode(odd_docs, PATH).collect()), key=repr)
    want = []
    for r in odd_docs.collect():
        ids = LIBRARY.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert encode_decode(no_docs, PATH).collect() == []
    (row,) = encode_decode(odd_docs.where("doc_id = 6"), PATH, with_ids=True).collect()
    assert row.ids == LIBRARY.encode("two words", add_bos=True, add_eos=True)
