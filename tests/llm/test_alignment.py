"""Alignment against a version that walks each text's bytes and counts pairs in a dictionary."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airq.llm import alignment
from airq.llm.tables import table


@pytest.fixture(scope="module")
def spell():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate([b for b in range(256) if b not in keep])}

    def both(text):
        ids = t.encode(" " + text, add_special_tokens=False).ids
        a = [(i, bytes(back[c] for c in t.id_to_token(i))) for i in ids]
        b = []
        for i in sp.encode(text):
            p = sp.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()))
        return a, b

    return both


def brute(rows, spell):
    found, links_of = [], []
    for i, text in rows:
        a, b = spell(text) if text else ([], [])
        want = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            found.append([i, 0, 0, 0, 0, 0, 0, ""])
            links_of.append(Counter())
            continue
        groups, ga, gb, x, y, k, m = [], [], [], 0, 0, 0, 0
        while k < len(a) or m < len(b):
            if x <= y and k < len(a):
                ga.append(a[k][0])
                x += len(a[k][1])
                k += 1
            else:
                gb.append(b[m][0])
                y += len(b[m][1])
                m += 1
            if x == y:
                groups.append((ga, gb))
                ga, gb = [], []
        links = Counter()
        for ga, gb in groups:
            for p in ga:
                for q in gb:
                    links[p, q] += 1
        text_of = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        found.append([i, len(a), len(b), len(groups), links.total(), 0, 0, hashlib.sha256(text_of.encode()).hexdigest()])
        links_of.append(links)
    counts = Counter(pair for links in links_of for pair in links)
    top = {}
    for (p, _), n in counts.items():
        top[p] = max(top.get(p, 0), n)
    for row, links in zip(found, links_of):
        row[5] = sum(n for pair, n in links.items() if counts[pair] == top[pair[0]])
        row[6] = sum(n * counts[pair] for pair, n in links.items())
    return sorted(map(tuple, found), key=str)


def test_all_documents_against_brute_force(spark, spell):
    d = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()]
    assert sorted(map(tuple, alignment.align_documents(d).collect()), key=str) == brute(rows, spell)


def test_edge_cases(docs, spell):
    rng = random.Random(4)
    letters = "theandor' \n.!0éß日😀▁​"
    rows = [
        (1, None), (2, ""), (3, " "), (4, "  two  spaces \n\n and lines\t"), (5, "▁ stands for a space"), (6, "<|endoftext|> <s> </s> <unk> <0x41>"),
        (7, "same words again"), (7, "same words again"), (None, "no id"), (8, "x" * 3000), (9, "long text of many words " * 3000), (10, "Ünïcode 日本語 😀 ﬁ é"), (11, "\x00﻿"),
        *[(100 + k, "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))) for k in range(80)],
    ]
    want = brute(rows, spell)
    for docs_in, pairs_in in ((2048, 1_000_000), (5, 60)):
        assert sorted(map(tuple, alignment.align_documents(docs(rows), block_docs=docs_in, block_pairs=pairs_in).collect()), key=str) == want


def same(one, other):
    return all(x[:3] == y[:3] and (x[3] == y[3]).all() and (x[4] == y[4]).all() for x, y in zip(one, other, strict=True))


def test_windows_in_slices(spell, monkeypatch):
    both = alignment.aligner()
    texts = ["Grüße an alle, die  hier lesen;\nand to everyone unbelievably far away. " * 20, "x", "one two", "one two " * 30]
    tokens = both.tokens(texts)
    whole = both.aligned(tokens)
    assert both.aligned([]) == [] and same(whole, [both.aligned([t])[0] for t in tokens])
    for k, t in enumerate(texts):
        assert (0, len(tokens[k][0]), len(tokens[k][1]), *whole[k][:2]) == brute([(0, t)], spell)[0][:5]
    monkeypatch.setattr(alignment, "SLICE", 3)
    assert same(whole, both.aligned(tokens))


def test_tuples_that_share_a_hash_stay_apart(monkeypatch):
    both = alignment.aligner()
    tokens = both.tokens(["several words of one text, several words", "and some of another"])
    whole = both.aligned(tokens)
    monkeypatch.setattr(alignment, "mixed", lambda h: h * alignment.np.uint64(0))
    assert same(whole, both.aligned(tokens))


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("theandor' \n.!0éß"), st.characters(codec="utf-8")), max_size=50))
def test_both_ways_to_the_ids_agree(text):
    both, plain = alignment.aligner(), alignment.aligner(ranks_a=None)
    assert both.ids_of_a(" " + text).tolist() == plain.ids_of_a(" " + text).tolist()


def test_big_groups(monkeypatch):
    both = alignment.aligner()
    tokens = both.tokens(["Zürich" * 40 + " end", "x y"])
    whole = both.aligned(tokens)
    monkeypatch.setattr(alignment.Windows, "ROOMY", 0)
    assert same(whole, both.aligned(tokens))


def test_empty_table(docs):
    assert alignment.align_documents(docs([])).collect() == []
