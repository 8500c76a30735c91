from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airq.llm import cover_tree as T
from airq.llm import embedding_dedup as E
from airq.llm.tables import table


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cloud(seed, n, dims, spread):
    """Points around a few centres, some very close, some spread out."""
    rng = np.random.default_rng(seed)
    centres = unit(rng.normal(size=(5, dims)))
    return unit(centres[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, dims)) * rng.choice([0.01, 0.3, 1], size=(n, 1)))


@settings(max_examples=40, deadline=None)
@given(seed=st.integers(0, 10**6), n=st.integers(1, 400), m=st.integers(1, 300), dims=st.integers(1, 12), spread=st.sampled_from([0.02, 0.1, 0.3]))
def test_traversal_finds_every_pair(seed, n, m, dims, spread):
    x, y = cloud(seed, n, dims, spread), cloud(seed, m, dims, spread)
    wx, wy = np.arange(1, n + 1), np.arange(2, m + 2)
    p, q = T.CoverTree(x, wx), T.CoverTree(y, wy)
    hit = x @ y.T >= 0.98
    found = T.traverse(p, q, 0.98)
    assert (found.left == hit @ wy).all() and (found.right == wx @ hit).all()
    s, t = np.nonzero(hit)
    assert (T.roots(n + m, *found.spanning()) == T.roots(n + m, s, t + n)).all()
    inside = (x @ x.T >= 0.98) & ~np.eye(n, dtype=bool)
    found = T.traverse(p, p, 0.98)
    assert (found.left == inside @ wx).all()
    assert (T.roots(n, *found.spanning()) == T.roots(n, *np.nonzero(inside))).all()


def test_tree_is_nested_and_covers():
    x = cloud(3, 2000, 6, 0.3)
    t = T.CoverTree(x, np.ones(len(x), np.int64))
    assert sorted(t.rows) == list(range(len(x)))
    for k, children in enumerate(t.children):
        own = t.rows[t.first[k] : t.end[k]]
        assert T.distances(x[t.centre[k]][None], x[own]).max() <= t.radius[k] + 1e-6
        if len(children):
            assert t.centre[k] in t.centre[children] and sum(t.end[c] - t.first[c] for c in children) == len(own)
            assert t.radius[children].max() < t.radius[k]
            far = T.distances(x[t.centre[children]], x[t.centre[children]]) + 9 * np.eye(len(children))
            assert far.min() > t.radius[children].max() - 1e-6


def brute(rows):
    def fits(r):
        i, x, label = r
        return i is not None and label is not None and x is not None and all(y is not None and math.isfinite(y) for y in x) and any(x)

    n = len(rows)
    links = [[] for _ in rows]
    units = [unit(np.array([r[1]], dtype=np.float64) / max(map(abs, r[1])))[0] if fits(r) else None for r in rows]
    for a in range(n):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98:
                links[a].append(b)
                links[b].append(a)
    out = []
    for k in range(n):
        seen, todo = {k}, [k]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen.update(new)
            todo.extend(new)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[k][0], len(links[k]), least, rows[k][0] == least))
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links int, key string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    x = np.concatenate([cloud(8, 260, 5, 0.1), cloud(9, 60, 5, 0.02)]).astype(np.float32)
    rows = [(i, [float(y) for y in v], rng.choice([0, 0, 0, 1, 2])) for i, v in enumerate(x)]
    rows += [(900 + k, rows[3][1], 0) for k in range(40)] + [(3, rows[3][1], 0), (4, [-y for y in rows[4][1]], 0)]
    rows += [(1000, None, 1), (1001, [None] * 5, 1), (1002, [float("nan")] * 5, 1), (1003, [float("inf")] * 5, 1), (1004, [0.1] * 5, None), (None, [0.1] * 5, 1)]
    rows += [(1005, [0.0] * 5, 1), (1006, [-0.0, 0.0, 0.0, 0.0, 1.0], 2), (1007, [0.0, 0.0, 0.0, 0.0, 3e38], 2), (1008, [], 1), (1009, [1.0, 2.0], 2), (1010, [2.0, 4.0], 2)]
    return rows


def test_against_brute_force_in_pieces(spark, rows):
    want = brute(rows)
    assert sum(r[1] for r in want) > 1000
    for piece in (8192, 40, 9):
        assert sorted(map(tuple, E.near_vectors(vectors(spark, rows), piece=piece).collect()), key=str) == want


def test_hot_vectors_take_the_other_join(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "HOT", 5)
    assert sorted(map(tuple, E.near_vectors(vectors(spark, rows)).collect()), key=str) == brute(rows)


def test_sql_twin(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    assert sorted(map(tuple, E.near_vectors(table(spark, "/root/testdata/sf0.01", "embeddings")).collect())) == sorted(con.sql(E.ORACLE).fetchall())


def test_empty_table(spark):
    assert E.near_vectors(vectors(spark, [])).collect() == []
