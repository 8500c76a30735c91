from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airq.llm import exact_dedup

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(FOLD)].append(i)
    out = []
    for i, t in rows:
        n = (t or "").translate(FOLD)
        ids = [x for x in groups[n] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


LONG = "Line of text. " * 900
ROWS = [
    (1, "Same Text"), (2, "same text"), (3, None), (4, ""), (5, "ÉTÉ"), (6, "été"), (7, "Été"), (8, LONG), (9, LONG.upper()), (10, LONG + "x"),
    (11, "x" * 9000), (12, "X" * 9000), (13, "x" * 8999), (2, "same text"), (None, "alone"), (None, "ALONE"), (14, "a\n" * 400), (15, "a\n" * 400), (16, " "),
]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_groups_equal_brute_force(docs):
    out = exact_dedup.exact_groups(docs(ROWS))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got(out) == brute(ROWS)


def test_identifiers_of_several_chunks_do_not_join_texts(docs):
    rows = [(i, t) for i, t in ROWS if i is not None]
    assert got(exact_dedup.exact_groups(docs(rows), lambda c: F.length(c).cast("long"))) == brute(rows)


def test_empty_table(docs):
    assert exact_dedup.exact_groups(docs([])).collect() == []


@settings(max_examples=5, deadline=None)
@given(text=st.text(alphabet="ab .\n", min_size=0, max_size=300))
def test_chunks_join_to_the_text(spark, text):
    df = spark.createDataFrame([(text * 9,)], "t string").select(exact_dedup.chunks(F.col("t"), 16, 64).alias("c"))
    parts = df.first()["c"]
    assert "".join(parts) == text * 9 and all(len(p) <= 64 for p in parts)
