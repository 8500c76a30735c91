from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airq.llm import packing
from airq.llm.words import Tokenizer, tokenizer

ROWS = [(1, "hello world"), (2, None), (3, ""), (4, "word " * 3000), (5, "a  b \n c\t d "), (6, " lead"), (7, "naïve Ünïcode 北京 👍🏽 <|endoftext|>"), (7, "again"), (8, "x" * 5000), (9, "\x1c a\x1c b   c"), (None, "no id")]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=5), st.integers(0, 60))
def test_fill_is_closest_to_capacity(counts, room):
    used = packing.fill(counts, room)
    assert all(n <= counts[x] for x, n in used.items())
    best = max(s for t in itertools.product(*[range(n + 1) for n in counts.values()]) if (s := sum(x * k for x, k in zip(counts, t, strict=True))) <= room)
    assert sum(x * n for x, n in used.items()) == best


def test_windows_use_every_length_once():
    rng = random.Random(3)
    hist = {n: rng.randrange(1, 50) for n in rng.sample(range(1, 1024), 300)}
    plan = packing.windows(hist, 1024)
    spent = {}
    for used, times in plan:
        assert sum(x * n for x, n in used.items()) <= 1024
        for x, n in used.items():
            spent[x] = spent.get(x, 0) + n * times
    assert spent == hist
    total = sum(x * n for x, n in hist.items())
    assert sum(times for _, times in plan) <= total / 1024 * 1.06 + 1  # few distinct lengths


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tokenizers

    def load(file):
        t = tokenizers.Tokenizer.from_file(public_tokenizers.path(file))
        t.encode_special_tokens = True
        return lambda text: t.encode(text or "", add_special_tokens=False).ids

    return load


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_cache_equals_tokenizer(reference, file):
    texts = [t or "" for _, t in ROWS] + ["it's we'll 'S IT'S x'rea", "end. \nStart", "İstanbul ΣΑΣ Éa", "a" * 100, "1234 5 six7", "--!! ??.", "  two  ", "\n\n a"]
    want = reference(file)
    for own in (Tokenizer(file), tokenizer(file)):
        for t, g in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(g, "<u4").tolist() == want(t), t


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'sl .,!\n\t 1\x1c\x85 é"), st.characters(codec="utf-8")), max_size=40))
def test_word_cache_on_any_text(text):
    import public_tokenizers
    import tokenizers

    for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        if file not in CACHED:
            t = tokenizers.Tokenizer.from_file(public_tokenizers.path(file))
            t.encode_special_tokens = True
            CACHED[file] = (t, Tokenizer(file), tokenizer(file))
        t, *both = CACHED[file]
        for own in both:
            assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


CACHED: dict = {}


def test_pieces_cover_each_document_and_sequences_have_no_gaps(docs, reference):
    encode = reference("byte_bpe_50k.json")
    rows = packing.pack(docs(ROWS)).toPandas()
    whole = sorted((i if i is not None else -1, len(encode(t)) + 1) for i, t in ROWS)
    first = rows[rows["start"] == 0]
    assert sorted((int(i) if i == i else -1, n) for i, n in zip(first["doc_id"], first["doc_tokens"], strict=True)) == whole
    for i, t in ROWS:
        if i in (7, None):
            continue
        ids = np.array([*encode(t), 0], dtype="<u4")
        own = rows[rows["doc_id"] == i].sort_values("start")
        assert own["length"].sum() == len(ids) and (own["start"] == own["length"].cumsum() - own["length"]).all()
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own["start"], own["length"], strict=True)] == own["ids_crc32"].tolist()
    rows = rows.sort_values(["sequence_id", "offset"])
    ends = rows.groupby("sequence_id")["length"].cumsum()
    assert (ends - rows["length"] == rows["offset"]).all() and ends.max() <= 1024
    assert sorted(rows["sequence_id"].unique()) == list(range(rows["sequence_id"].nunique()))


def test_empty_table(docs):
    assert packing.pack(docs([])).collect() == []
