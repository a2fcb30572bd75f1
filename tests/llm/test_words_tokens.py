"""Words, n-grams and ids of the batch helpers against plain regular expressions and the tokenizer itself."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import brute

from refnet.llm import words as W
from refnet.llm.tokens import Encoder, tokenizer_path

PARTS = [*"aAzZ09éñß日€ \t\n\r\x0b\x85\xa0\u2003'.,!-_<>|", "<|endoftext|>", "'s", "  ", " the", "word"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=40).map("".join)


def binary(texts):
    return pa.array([None if t is None else t.encode() for t in texts], pa.binary())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
@pytest.mark.parametrize("pattern,members", [(brute.ALNUM, W.ALNUM), (brute.SPACED, W.NON_SPACE)])
def test_words(pattern, members, texts):
    hashes, at = W.word_hashes(binary(texts), members)
    expected = [brute.words(t, pattern) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    by = {}
    for w, h in zip(flat, hashes.tolist(), strict=True):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_ids_are_the_tokenizers(texts):
    encoder = Encoder.of(tokenizer_path())
    ids, at = encoder.encode(binary(texts))
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_of_real_texts_and_a_small_table():
    import duckdb

    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for encoder in (Encoder.of(tokenizer_path()), Encoder(tokenizer_path(), max_known=64)):
        for a in range(0, len(texts), 50):
            ids, at = encoder.encode(binary(texts[a : a + 50]))
            expected = encoder.tokenizer.encode_batch([t or "" for t in texts[a : a + 50]], add_special_tokens=False)
            assert ids.tolist() == [x for e in expected for x in e.ids]
            assert np.diff(at).tolist() == [len(e.ids) for e in expected]


def test_long_words_and_slices():
    long = "x" * 3_000_000 + " y"
    array = binary(["skip me", long, None, "a b"]).slice(1)
    hashes, at = W.word_hashes(array, W.ALNUM)
    assert np.diff(at).tolist() == [2, 0, 2]
    assert len(set(hashes.tolist())) == 4


def test_ngrams():
    h, _ = W.word_hashes(binary(["a b c a b c"]), W.ALNUM)
    g = W.ngram_hashes(h, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 3 and not len(W.ngram_hashes(h, 7))
