from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airq.llm import bpe

FILE = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def both():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(FILE), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.encoder(FILE)


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("theandor' \n.!0éß"), st.characters(codec="utf-8")), max_size=60))
def test_ids_equal_the_library(both, text):
    want, own = both
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == want.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(word=st.binary(min_size=1, max_size=64))
def test_many_and_one_agree(both, word):
    ranks = both[1].ranks
    width = max(2, 1 << (len(word) - 1).bit_length())
    many = bpe.merge_many(ranks, [word, word[:1], b"aaaaaaaaaaaaaaaa"[:width]], width)
    assert many[0].tolist() == bpe.merge_one(ranks, word).tolist()
    assert b"".join(ranks.text[i] for i in many[0]) == word


def test_very_long_words(both):
    want, own = both
    rng = random.Random(2)
    for t in ("a" * 20_000, "".join(rng.choice("thean") for _ in range(5_000)), "ab" * 3000 + " " * 500 + "x"):
        assert np.frombuffer(own.encode([t])[0], "<u4").tolist() == want.encode_ordinary(t)


def test_round_trip_table(docs, both):
    want, _ = both
    rows = [(1, None), (2, ""), (3, "Über  den \n Wolken. "), (4, "b" * 3000), (4, "again"), (None, "no id"), (5, "word " * 5000), (6, "日本語 😀 <|endoftext|>")]
    got = {(r["doc_id"], r["decoded_sha256"]): r for r in bpe.round_trip(docs(rows)).collect()}
    for i, t in rows:
        ids = want.encode_ordinary(t or "")
        r = got[i, hashlib.sha256((t or "").encode()).hexdigest()]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_empty_table(docs):
    assert bpe.round_trip(docs([])).collect() == []
