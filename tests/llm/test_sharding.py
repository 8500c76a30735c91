from __future__ import annotations

import heapq
import random
import zlib
from collections import defaultdict

from airq.llm import sharding


def plain(sizes, shards):
    heap = [(0, s) for s in range(shards)]
    for x in sorted(sizes, reverse=True):
        load, s = heapq.heappop(heap)
        heapq.heappush(heap, (load + x, s))
    return sorted(load for load, _ in heap)


def test_schedule_is_as_even_as_the_plain_heap():
    rng = random.Random(5)
    sizes = [rng.choice([3, 70, 900, 4000]) for _ in range(3000)] + [50_000]
    count = defaultdict(int)
    for x in sizes:
        count[x] += 1
    given = sharding.schedule([(x, n, x * n) for x, n in count.items()], 16)
    assert all(sum(given[x]) == n for x, n in count.items())
    loads = sorted(sum(x * g[s] for x, g in given.items()) for s in range(16))
    want = plain(sizes, 16)
    assert loads[-1] <= want[-1] and max(loads[:-1]) - min(loads[:-1]) <= max(want[:-1]) - min(want[:-1]) + 3


def test_size_class_keeps_four_digits(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1,), (9999,), (10001,), (123456,), (99999999,)], "n long").select(sharding.size_class(F.col("n")).alias("c"))
    assert [r[0] for r in df.collect()] == [1, 9999, 10000, 123400, 99990000]


def test_groups_stay_together_and_slots_have_no_gaps(docs):
    rng = random.Random(1)
    rows = [(i, "t" * rng.randrange(1, 400) + str(i % 97)) for i in range(3000)] + [(4000 + i, "copy of one text") for i in range(1500)] + [(9000, None), (9001, ""), (9002, "é"), (9000, None), (None, "z")]
    out = sharding.shard_documents(docs(rows)).toPandas()
    assert len(out) == len(rows) and set(out["law"]) == {"bytes"} and out["grown_shard"].isna().all()
    for _, own in out.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    text = defaultdict(set)
    by_id = {i: t for i, t in rows}
    for r in out.itertuples():
        t = (by_id[int(r.doc_id)] if r.doc_id == r.doc_id else "z") or ""
        assert r.size == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode())
        text[t].add(r.shard)
    assert all(len(s) == 1 for s in text.values())
    loads = out.groupby("shard")["size"].sum()
    assert len(loads) == 16 and loads.max() / loads.mean() < 1.03


def test_empty_table(docs):
    assert sharding.shard_documents(docs([])).collect() == []
