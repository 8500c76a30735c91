"""Near-duplicate documents: MinHash signatures met by a multi-index Hamming join, links confirmed on full sets.

Every document has a signature of SYMBOLS + MORE values of its shingle set. The first
SYMBOLS values (16 bits each) are split into CHUNKS; two signatures that differ in at most
``CHUNKS * 2 - 1`` of them differ, by the pigeonhole principle, in at most one value of some chunk, so
enumerating each chunk with any one value left out gives at least one key in common. The
further values (8 bits each) only narrow pairs down before they are confirmed.

No bucket is opened into all its pairs: equal sets count once; a bucket's members are first
compared with its leader, the member whose buckets are fullest; what is linked by then is
one component. Members of buckets that still hold several components are compared by their
signatures, block by block within a task, and only say which documents are close to which
cluster. The clusters are then compared on full sets, again block by block; a task gives out
no more links than join its components.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.components import components
from airq.llm.shingles import mix, seeds, shingle_lists
from airq.llm.tables import kept_table, scratch
from airq.llm.words import slices

CHUNKS, PER_CHUNK, MORE = 10, 4, 160
SYMBOLS = CHUNKS * PER_CHUNK
BLOCK = 256
PAIRS_AT_ONCE = 100_000
MISS = 1e-6
SIGNED = "doc_id long, n_shingles long, fingerprint binary, signature binary, keys array<long>"


def farthest(similarity: float, values: int = SYMBOLS + MORE, miss: float = MISS) -> int:
    """The number of differing values that a pair of this similarity exceeds with chance at most ``miss``."""
    q, tail, k = 1 - similarity, 0.0, values
    while k > 0 and tail + (t := comb(values, k) * q**k * similarity ** (values - k)) <= miss:
        tail, k = tail + t, k - 1
    return k


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The low bits of the least of each hash over the set."""
    low = np.full(len(a), np.uint64(2**64 - 1))
    for i in range(0, len(shingles), 4096):
        part = shingles[i : i + 4096]
        np.minimum(low, ((part[None, :] ^ a[:, None]) * b[:, None]).min(axis=1), out=low)
    return mix(low)


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """For each chunk, one key per value left out: chunk and place in the top bits, then the other values."""
    s = symbols.reshape(-1, CHUNKS, PER_CHUNK).astype(np.int64)
    keys = np.empty((len(s), CHUNKS, PER_CHUNK), dtype=np.int64)
    for v in range(PER_CHUNK):
        key = np.arange(CHUNKS, dtype=np.int64) * PER_CHUNK + v
        for w in range(PER_CHUNK):
            if w != v:
                key = (key << 16) | s[:, :, w]
        keys[:, :, v] = key
    return keys.reshape(len(s), -1)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Set size, fingerprint of the whole set, signature and keys of every document, in one pass over the texts."""

    def run(batches):
        import pyarrow as pa

        a, b = seeds(SYMBOLS + MORE, 2), seeds(SYMBOLS + MORE, 3)
        for batch in batches:
            for at, texts in slices(batch):
                n, prints, sigs, firsts = [], [], [], np.zeros((len(texts), SYMBOLS), np.uint16)
                for i, sh in enumerate(shingle_lists(texts, width)):
                    sh = np.unique(sh)
                    s = signature(sh, a, b)
                    firsts[i] = s[:SYMBOLS] & np.uint64(0xFFFF)
                    n.append(len(sh))
                    prints.append(hashlib.blake2b(sh.tobytes(), digest_size=16).digest())
                    sigs.append(firsts[i].tobytes() + (s[SYMBOLS:] & np.uint64(0xFF)).astype(np.uint8).tobytes())
                keys = chunk_keys(firsts)
                arrays = [batch.column("doc_id").slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.binary())]
                arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel())))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "fingerprint", "signature", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, SIGNED)


def unpacked(signatures: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(signatures), dtype=np.uint8).reshape(len(signatures), -1)
    return np.ascontiguousarray(raw[:, : 2 * SYMBOLS]).view(np.uint16), raw[:, 2 * SYMBOLS :]


def distance(first: np.ndarray, more: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (first[i] != first[j]).sum(axis=1) + (more[i] != more[j]).sum(axis=1)


def close_pairs(pairs: DataFrame, signatures: DataFrame, most: int) -> DataFrame:
    """Pairs ``a, b`` whose signatures differ in at most ``most`` values."""
    s1 = signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    s2 = signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            n = b.num_rows
            if n:
                f, m = unpacked(b.column("sa").to_pylist() + b.column("sb").to_pylist())
                d = np.concatenate([distance(f, m, np.arange(i, min(n, i + 10_000)), np.arange(i, min(n, i + 10_000)) + n) for i in range(0, n, 10_000)])
                yield b.select(["a", "b"]).filter(pa.array(d <= most))

    return pairs.join(s1, "a").join(s2, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, texts: DataFrame, width: int, part: int, whole: int) -> DataFrame:
    """Pairs whose full shingle sets have ``whole`` x intersection >= ``part`` x union."""
    t1 = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    t2 = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            left, right, keep = batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), []
            for i in range(0, len(left), 64):
                x, y = left[i : i + 64], right[i : i + 64]
                sets = [np.unique(s) for s in shingle_lists(x + y, width)]
                for p, q in zip(sets[: len(x)], sets[len(x) :], strict=True):
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(whole * both >= part * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(t1, "a").join(t2, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def in_blocks(rows: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """Rows of each group dealt to pairs of blocks: ``key, i, j, own`` and ``payload``, sorted by group within tasks.

    ``rows`` has the group's size ``n``. A group of n rows has n / BLOCK blocks; a pair of rows
    with own blocks i <= j meets in (i, j) alone, so no task holds more than two blocks at once.
    """
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    dealt = rows.withColumn("_blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.select(key, F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"), "own", *payload)
    return dealt.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node")


def whole_groups(frames, key: str):
    """Pandas frames of whole groups (key, i, j) from a sorted partition, each with its rows' counts of later rows in their group."""
    import pandas as pd

    def ready(f):
        f = f.reset_index(drop=True)
        k, i, j = (f[c].to_numpy() for c in (key, "i", "j"))
        edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        size = np.diff(np.append(edge, len(f)))
        return f, np.repeat(edge + size, size) - np.arange(len(f)) - 1

    rest = None
    for f in frames:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if len(f):
            tail = (f[key] == f[key].iloc[-1]) & (f["i"] == f["i"].iloc[-1]) & (f["j"] == f["j"].iloc[-1])
            rest, f = f[tail], f[~tail]
            if len(f):
                yield ready(f)
    if rest is not None and len(rest):
        yield ready(rest)


def pairs_within(reach: np.ndarray):
    """Places (a, b), a before b in one group, some at a time; ``reach`` as from ``whole_groups``."""
    ends = np.cumsum(reach)
    at = 0
    while at < len(reach):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, side="right")))
        n = reach[at:upto]
        a = np.repeat(np.arange(at, upto), n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(ends[at:upto] - n - before, n)
        at = upto


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Root of every place once the links ``a, b`` are added; ``label`` holds the roots before.

    Only roots are hooked, each to the least root it meets in a round, and a link goes only when both
    ends have one root: no link, and none to an earlier root, is lost.
    """
    label = label.copy()
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (up := label[label]).tobytes() != label.tobytes():
            label = up


def close_by_block(rows: DataFrame, most: int) -> DataFrame:
    """Links ``a, b`` that connect all documents of different components which meet in a bucket at most ``most`` values apart.

    ``rows``: ``key, n, node, component, signature``. A pair counts in the first bucket it shares;
    a task gives out at most one link per document it holds, not the pairs themselves.
    """

    def compare(f, reach):
        first, more = unpacked(f["signature"].tolist())
        key, i, j, own, node, comp = (f[c].to_numpy() for c in ("key", "i", "j", "own", "node", "component"))
        label = np.arange(len(f))
        for a, b in pairs_within(reach):
            ok = (comp[a] != comp[b]) & ((i[a] == j[a]) | (own[a] != own[b]))
            a, b = a[ok], b[ok]
            ok = distance(first, more, a, b) <= most
            a, b = a[ok], b[ok]
            same = (first[a] == first[b]).reshape(-1, CHUNKS, PER_CHUNK)
            chunk = (same.sum(axis=2) >= PER_CHUNK - 1).argmax(axis=1)
            place = (~same[np.arange(len(a)), chunk]).argmax(axis=1)  # 0 if none differs
            ok = key[a] >> 48 == chunk * PER_CHUNK + place
            a, b = a[ok], b[ok]
            label = joined(label, a, b)
        some = label != np.arange(len(f))
        return node[some], node[label[some]]

    def run(frames):
        import pandas as pd

        for f, reach in whole_groups(frames, "key"):
            a, b = compare(f, reach)
            yield pd.DataFrame({"a": a, "b": b})

    return in_blocks(rows, "key", ["node", "component", "signature"]).mapInPandas(run, "a long, b long")


def linked_by_block(rows: DataFrame, width: int, part: int, whole: int, most: int) -> DataFrame:
    """Links ``a, b`` on full sets that join the components of each cluster, no more than a task needs to join those it holds.

    ``rows``: ``cluster, n, node, component, signature, text``.
    """

    def compare(f, reach):
        first, more = unpacked(f["signature"].tolist())
        i, j, own, node, comp = (f[c].to_numpy() for c in ("i", "j", "own", "node", "component"))
        texts, sets, root, out = f["text"].tolist(), {}, {}, []

        def find(x):
            while x in root:
                x = root[x]
            return x

        for a, b in pairs_within(reach):
            ok = (comp[a] != comp[b]) & ((i[a] == j[a]) | (own[a] != own[b]))
            a, b = a[ok], b[ok]
            d = distance(first, more, a, b)
            ok = np.flatnonzero(d <= most)
            for k in ok[np.argsort(d[ok], kind="stable")]:  # the closest first: most others are joined by then
                x, y = int(a[k]), int(b[k])
                u, v = find(int(comp[x])), find(int(comp[y]))
                if u == v:
                    continue
                for z in (x, y):
                    if z not in sets:
                        sets[z] = np.unique(shingle_lists([texts[z]], width)[0])
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if whole * both >= part * (len(sets[x]) + len(sets[y]) - both):
                    root[max(u, v)] = min(u, v)
                    out.append((int(node[x]), int(node[y])))
        return out

    def run(frames):
        import pandas as pd

        for f, reach in whole_groups(frames, "cluster"):
            yield pd.DataFrame(compare(f, reach), columns=["a", "b"], dtype="int64")

    return in_blocks(rows, "cluster", ["node", "component", "signature", "text"]).mapInPandas(run, "a long, b long")


def near_groups(docs: DataFrame, width: int = 3, part: int = 85, whole: int = 100) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``whole`` x intersection >= ``part`` x union of their sets of ``width``-word
    shingles. A shorter text is one shingle of all its words; a text without words (or NULL)
    has an empty set and is linked with nothing. ``component_id`` is the least doc_id reachable, and
    the document of that id is kept. A row without doc_id is linked with nothing, has no
    component and is kept. Repeated rows share a component and a decision.
    """
    most = farthest(part / whole)
    sign = kept_table(signed(docs, width), "signatures")
    named = sign.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    first = named.groupBy(F.col("fingerprint").alias("_print")).agg(F.min("doc_id").alias("node"))
    with scratch(docs.sparkSession) as keep:
        nodes = keep(named.join(first, (F.col("fingerprint") == F.col("_print")) & (F.col("doc_id") == F.col("node"))).select("node", "signature", "keys"), "nodes")
        signatures = nodes.select("node", "signature").dropDuplicates(["node"])
        opened = nodes.select("node", F.explode("keys").alias("key"))
        shared = opened.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key", "n")
        met = keep(opened.join(shared, "key"), "met")
        fullness = met.groupBy("node").agg(F.sum("n").alias("fullness"))
        leaders = met.join(fullness, "node").groupBy("key").agg(F.max_by("node", "fullness").alias("leader"))
        some = met.select("node").distinct()
        texts = keep(docs.select(F.col("doc_id").cast("long").alias("node"), F.coalesce("text", F.lit("")).alias("text")).join(some, "node", "left_semi").dropDuplicates(["node"]), "met-texts")
        starred = met.join(leaders, "key").filter("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        tried = keep(close_pairs(starred, signatures, most), "tried")
        links = keep(linked(tried, texts, width, part, whole), "links")
        labels = components(links, keep)
        placed = met.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
        open_keys = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key", "n")
        left = placed.join(open_keys, "key").join(signatures, "node")
        close = keep(close_by_block(left, most), "close")
        stars = components(close, keep, "clusters")
        clusters = stars.union(stars.select("component", "component").distinct()).toDF("node", "cluster")
        sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
        held = clusters.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        more = linked_by_block(held.join(sizes, "cluster").join(signatures, "node").join(texts, "node"), width, part, whole, most)
        links = keep(links.union(more), "all-links")
        labels = kept_table(components(links, keep), "components")
    out = sign.join(first, (F.col("fingerprint") == F.col("_print")) & F.col("doc_id").isNotNull(), "left").join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    component = F.coalesce("component", "node", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
