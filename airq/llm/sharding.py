"""Shards of nearly equal bytes by longest-processing-time scheduling.

Groups that must stay together are sorted by size and go to the least-loaded
shard of a heap. Groups of one size class are interchangeable, so the heap runs on
the driver over classes (sizes kept to four digits: at most 9,000 classes per power
of ten, however many groups there are) and Spark deals the groups of a class out by
their rank.
"""

from __future__ import annotations

import heapq
from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq.llm.tables import kept_table, number

DIGITS = 4


def size_class(size):
    """The size with all but its first four digits set to zero."""
    step = F.pow(F.lit(10.0), F.greatest(F.length(size.cast("string")) - DIGITS, F.lit(0)))
    return (F.floor(size / step) * step).cast("long")


def schedule(classes: list[tuple[int, int, int]], shards: int) -> dict[int, list[int]]:
    """How many groups of each class go to each shard.

    ``classes``: (class, groups, bytes in all). Classes come largest first. As long as a
    class has many more groups than shards, the heap's steps are taken together: all
    shards are filled up to one level, then single groups follow.
    """
    heap = [(0.0, s) for s in range(shards)]
    out = {}
    for cls, n, total in sorted(classes, reverse=True):
        each, given, left = total / n, [0] * shards, n
        if n > 2 * shards:
            loads = sorted(heap)
            level, filled = 0.0, total
            for k in range(1, shards + 1):  # the level that the class's bytes reach over the k lowest shards
                level = (filled + sum(x for x, _ in loads[:k])) / k
                if k == shards or level <= loads[k][0]:
                    break
            heap = []
            for load, s in loads:
                k = min(left, max(0, floor((level - load) / each)))
                given[s], left = k, left - k
                heap.append((load + k * each, s))
        heapq.heapify(heap)
        for _ in range(left):
            load, s = heapq.heappop(heap)
            given[s] += 1
            heapq.heappush(heap, (load + each, s))
        out[cls] = given
    return out


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: equal texts stay in one shard, and the shards' bytes are as
    equal as whole groups allow (a group larger than a fair share fills a shard of its
    own). NULL and empty texts are one group of size 1 each row; ``slot`` runs from 0
    within a shard; ``grown_shard`` is NULL. An empty table gives no rows.
    """
    spark = docs.sparkSession
    t = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = kept_table(
        docs.select("doc_id", (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t).alias("text_crc32"), F.unhex(F.sha2(t, 256)).alias("key")),
        "shard-rows",
    )
    groups = kept_table(rows.groupBy("key").agg(F.sum("size").alias("bytes")).withColumn("cls", size_class(F.col("bytes"))), "shard-groups")
    classes = [tuple(r) for r in groups.groupBy("cls").agg(F.count(F.lit(1)), F.sum("bytes")).collect()]
    ends = []
    for cls, given in schedule(classes, shards).items():
        ends.append((cls, [sum(given[: k + 1]) for k in range(shards)]))
    plan = spark.createDataFrame(ends, T.StructType([T.StructField("_cls", T.LongType()), T.StructField("ends", T.ArrayType(T.LongType()))]))
    ranked = number(groups, ["cls"], "key", groups.count(), "rank")
    where = ranked.join(F.broadcast(plan), F.col("cls") == F.col("_cls")).select(F.col("key").alias("_key"), F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"))
    placed = kept_table(rows.join(where, F.col("key") == F.col("_key")).drop("key", "_key"), "shard-placed")
    out = number(placed, ["shard"], "doc_id", placed.count(), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
