from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from airq.llm.tables import kept_table, table

from .conftest import SF
from .test_exact_dedup import FOLD
from .test_near_dedup import brute as near_groups
from .test_near_dedup import sets
from .test_quality import counts

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

DIR = str(SF / "sf0.001")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after each stage but the last, and the last one's rows."""
    docs = table(spark, DIR, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = kept_table(stage(spark, docs, DIR), "test-" + name.replace(" ", "-"))
        out.append(docs)
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_before_packing_return_the_columns_of_documents(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "substring dedup", "packing"]


def test_few_labels_leave_the_base_rules(steps):
    want = {i for i, t in rows(steps[0]) if (c := counts(t))[0] >= 20 and 100 * c[4] <= 30 * c[0]}
    assert {i for i, _ in rows(steps[1])} == want


def test_one_exact_copy_stays(steps):
    groups = defaultdict(list)
    for i, t in rows(steps[1]):
        groups[t.translate(FOLD)].append(i)
    assert {i for i, _ in rows(steps[2])} == {max(g) for g in groups.values()}


def test_one_document_of_each_near_group_stays(steps):
    assert {i for i, _ in rows(steps[3])} == {r[0] for r in near_groups(rows(steps[2]), 5, 80, 100) if r[3]}


def test_long_passages_stay_once(steps):
    before, after = dict(rows(steps[3])), dict(rows(steps[4]))
    assert set(before) == set(after)
    seen = Counter(w for t in after.values() for w in {tuple(words(t)[k : k + 50]) for k in range(len(words(t)) - 49)})
    assert max(seen.values()) == 1
    shingles = {i: sets(t, 5) for i, t in before.items()}
    spread = Counter(s for own in shingles.values() for s in own)
    for i, own in shingles.items():
        if sum(spread[s] > 1 for s in own) < 30:  # less than a passage's share of 46 shingles is found elsewhere
            assert after[i] == before[i]
    changed = [i for i in before if before[i] != after[i]]
    assert all(len(words(after[i])) <= len(words(before[i])) - 50 for i in changed)
    lengths = {r["doc_id"]: r["n_chars"] for r in steps[4].collect()}
    assert all(lengths[i] == len(after[i]) for i in changed)


def test_all_that_is_left_is_packed(steps):
    import public_tokenizers
    import tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got = defaultdict(int)
    for r in steps[5].collect():
        got[r["doc_id"]] += r["length"]
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in rows(steps[4])}


def through(spark, data):
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", True) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long, kept string, _kept_id boolean")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(kept_table(stage(spark, out[-1], DIR), "edge-" + name.replace(" ", "-")))
        assert name == "packing" or out[-1].columns == docs.columns
    return out


def test_edge_cases_pass_through_every_stage(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    data = [(1, None), (2, ""), (3, clean), (3, clean), (4, clean.upper()), (None, clean + " more"), (5, " ".join(f"v{i}" for i in range(20_000)))]
    *_, left, packed = through(spark, data)
    # equal texts: the largest id; the row without id comes first in order, so it stays where near copies meet
    assert sorted(rows(left), key=str) == sorted([(None, clean + " more"), data[6]], key=str)
    assert {r["doc_id"] for r in packed.collect()} == {None, 5}
    *_, left, packed = through(spark, [])
    assert left.collect() == [] and packed.collect() == []


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    text = lambda p, n=60: " ".join(f"{p}{k}" for k in range(n))
    passage = text("passage")
    data = [(0, passage), (1, passage + " " + text("left")), (1, passage + " " + text("right")), (2, text("low", 5)), (2, text("high")), (3, text("same")), (3, text("same")), (3, text("SAME")), (None, text("a")), (None, text("b"))]
    *_, left, packed = through(spark, data)
    want = [(0, passage), (1, text("left")), (1, text("right")), (2, text("high")), (None, text("a")), (None, text("b"))]
    got = [(i, t.strip()) for i, t in rows(left) if i != 3]
    assert sorted(got, key=str) == sorted(want, key=str)
    same = [t for i, t in rows(left) if i == 3]
    assert len(same) == 1 and same[0].lower() == text("same")
    tokens = defaultdict(int)
    for r in packed.collect():
        tokens[r["doc_id"]] += r["length"]
    import public_tokenizers
    import tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    size = defaultdict(int)
    for i, x in rows(left):
        size[i] += len(t.encode(x, add_special_tokens=False).ids) + 1
    assert tokens == size
