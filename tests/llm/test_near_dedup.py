from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airq.llm import near_dedup
from airq.llm.components import components
from airq.llm.shingles import shingle_lists
from airq.llm.tables import scratch

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def brute(rows, width=3, part=85, whole=100):
    rows = [(i, sets(t, width)) for i, t in rows if i is not None]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if a and b and whole * len(a & b) >= part * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i), find(i) == i) for i, s in rows}


def corpus(seed, families=12, members=9):
    rng = random.Random(seed)
    vocabulary = ["w" + str(k) for k in range(400)]
    rows, i = [], 0
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 40, 150, 400]))]
        for _ in range(members):
            own = list(base)
            for _ in range(int(len(own) * rng.choice([0, 0.01, 0.02, 0.05, 0.1]))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((i, " ".join(own) if rng.random() < 0.8 else "\n".join(own).upper()))
            i += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(docs):
    rows = corpus(1) + [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one two three"), (907, "word " * 5000), (908, "word " * 4000), (900, None)]
    out = near_dedup.near_groups(docs(rows + [(None, "one")]))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows) + 1 and (None, 1, None, True) in got
    assert {r for r in got if r[0] is not None} == brute(rows)


def test_a_bucket_larger_than_a_block(docs, monkeypatch):
    """Copies of one base that are near the base but not near one another, over several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(9)
    base = ["b" + str(k) for k in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        own = list(base)
        for _ in range(rng.choice([1, 2, 3, 5, 8, 12])):
            own[rng.randrange(120)] = "x" + str(rng.randrange(10**6))
        rows.append((i, " ".join(own)))
    rng.shuffle(rows)
    assert {tuple(r) for r in near_dedup.near_groups(docs(rows)).collect()} == brute(rows)


def test_five_words_and_eighty_percent(docs):
    rows = corpus(4, 6, 6)
    assert {tuple(r) for r in near_dedup.near_groups(docs(rows), 5, 80, 100).collect()} == brute(rows, 5, 80, 100)


def test_empty_table(docs):
    assert near_dedup.near_groups(docs([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 2 * near_dedup.CHUNKS - 1))
def test_signatures_within_the_threshold_share_a_key(seed, errors):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 65536, near_dedup.SYMBOLS).astype(np.uint16)
    b = a.copy()
    b[rng.choice(near_dedup.SYMBOLS, errors, replace=False)] ^= 1
    keys = near_dedup.chunk_keys(np.stack([a, b]))
    assert set(keys[0]) & set(keys[1])


def test_farthest_bounds_the_miss():
    rng = np.random.default_rng(1)
    draws = rng.binomial(near_dedup.SYMBOLS + near_dedup.MORE, 0.15, 400_000)
    assert (draws > near_dedup.farthest(0.85)).mean() < 1e-5


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \t\n\x0b", max_size=30), min_size=1, max_size=5), st.integers(1, 5))
def test_shingles_equal_as_the_words_do(texts, width):
    lists = shingle_lists(texts, width)
    for s, t in zip(lists, texts, strict=True):
        assert len(set(s.tolist())) == len(sets(t, width))
    both = [set(x.tolist()) for x in lists]
    for a, t in zip(both, texts, strict=True):
        for b, u in zip(both, texts, strict=True):
            assert len(a & b) == len(sets(t, width) & sets(u, width))


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 52), (50, 52), (7, 7)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    with scratch(spark) as keep:
        got = {r["node"]: r["component"] for r in components(df, keep).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, {a}), root.setdefault(b, {b})
        if root[a] is not root[b]:
            root[a] |= root[b]
            for x in root[b]:
                root[x] = root[a]
    assert {n: got.get(n, n) for n in root} == {n: min(s) for n, s in root.items()}


def roots(n, edges):
    root = list(range(n))
    for a, b in edges:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    return root


CHAIN = (6, [(0, 5), (1, 4), (2, 3), (2, 5), (3, 4)])


def sparse(seed):
    rng = random.Random(seed)
    n = rng.randrange(2, 60)
    return n, sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(rng.randrange(1, 2 * n))})


def test_added_links_lose_no_earlier_one():
    for n, edges in [CHAIN] + [sparse(seed) for seed in range(1000)]:
        for at_once in (1, 3, 1000):
            label = np.arange(n)
            for i in range(0, len(edges), at_once):
                a, b = np.array(edges[i : i + at_once]).T
                label = near_dedup.joined(label, a, b)
            assert label.tolist() == roots(n, edges)


def test_links_within_buckets_join_as_all_close_pairs_do(spark):
    """One bucket per graph: two documents share a further value for their link, so close pairs are the links."""
    graphs = [CHAIN] + [sparse(seed) for seed in range(200)]
    rows = []
    for g, (n, edges) in enumerate(graphs):
        for i in range(n):
            more = [0] * near_dedup.MORE
            for slot in range(near_dedup.MORE):
                more[slot] = 1 if slot < len(edges) and i in edges[slot] else i + 2
            rows.append((g, n, 1000 * g + i, 1000 * g + i, bytearray(bytes(2 * near_dedup.SYMBOLS) + bytes(more))))
    df = spark.createDataFrame(rows, "key long, n long, node long, component long, signature binary")
    got = {}
    for r in near_dedup.close_by_block(df, near_dedup.MORE - 1).collect():
        got.setdefault(r["a"] // 1000, []).append((r["a"] % 1000, r["b"] % 1000))
    for g, (n, edges) in enumerate(graphs):
        assert roots(n, got.get(g, [])) == roots(n, edges), g
