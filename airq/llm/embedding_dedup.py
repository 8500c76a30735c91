"""Exact pairs of embeddings above a cosine, by cover trees in pieces of bounded size.

Equal vectors of one label are one vector with a weight. A bounded sample of vectors (``pivots``) is the top
level: each vector belongs to the nearest pivot of its label, whose covering radius is measured.
A vector is sent to another cell only where that radius and the threshold let it have a
partner, cells within the threshold are linked as a whole, and large cells are cut into
pieces. For every pair of pieces one task builds the cover trees below and traverses them
together; it gives out one count per vector and links that connect the same vectors, not the pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.components import components
from airq.llm.cover_tree import SLACK, CoverTree, distances, traverse
from airq.llm.tables import kept_table, scratch

#: Vectors of a piece, about; bytes of all pivots together, at most about this; rows of one vector that are met by a join.
PIECE, PIVOT_BYTES, HOT = 8192, 64 << 20, 50_000
_KEY = ["label", "dims", "key"]
_MET = "label long, dims int, low int, high int, i int, j int, side int, cls long, weight long, unit binary"
_FOUND = "u long, v long, n long"


def split(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can link and rows that can't."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    can = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False))
    return rows.filter(can), rows.filter(~can)


def keyed(rows: DataFrame) -> DataFrame:
    """``vec_id, label, dims, v, key``: ``key`` is a digest of the components."""
    v = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))  # no negative zero
    return rows.select("vec_id", "label", F.size("embedding").alias("dims"), v.alias("v")).withColumn("key", F.unhex(F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256)))


def unit_classes(rows: DataFrame) -> DataFrame:
    """Distinct vectors of a label: ``cls`` (their number), ``weight`` (rows), ``least`` (smallest vec_id), ``unit`` (double precision, packed)."""

    def scale(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for v in b.column("v").to_pylist():
                x = np.array(v, dtype=np.float64)
                x = x / np.abs(x).max()
                out.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (*_KEY, "weight", "least")], pa.array(out, pa.binary())], [*_KEY, "weight", "least", "unit"])

    one = rows.groupBy(*_KEY).agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least"))
    return one.mapInArrow(scale, "label long, dims int, key binary, weight long, least long, unit binary").withColumn("cls", F.monotonically_increasing_id())


class Cells:
    """Pivots by (label, dims), their cells' radii, weights and sizes; and sizes of large cells without a pivot."""

    def __init__(self, pivots: list, sizes: list, piece: int):
        self.units, self.numbers, self.ids, self.piece = {}, {}, {}, piece
        for k, r in enumerate(sorted(pivots, key=lambda r: r["cls"])):
            space = r["label"], r["dims"]
            self.units.setdefault(space, []).append(np.frombuffer(r["unit"], np.float64))
            self.numbers.setdefault(space, []).append(k)
            self.ids[k] = r["cls"]
        self.units = {s: np.array(u) for s, u in self.units.items()}
        self.stats = {(r["label"], r["dims"], r["cell"]): (r["radius"], r["weight"], r["rows"]) for r in sizes}

    def radii(self, space) -> tuple[np.ndarray, np.ndarray]:
        got = [self.stats.get((*space, k), (0.0, 0, 0)) for k in self.numbers[space]]
        return np.array([g[0] for g in got]), np.array([g[1] for g in got])

    def pieces(self, space, cell: int) -> int:
        return max(1, -(-self.stats.get((*space, cell), (0, 0, 0))[2] // self.piece))


def by_space(batch) -> list:
    """(space, row numbers, units) of a batch."""
    label, dims = batch.column("label").to_numpy(), batch.column("dims").to_numpy()
    raw, order = batch.column("unit").to_pylist(), np.lexsort([dims, label])
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(label[order]) != 0) | (np.diff(dims[order]) != 0)])) if len(order) else []
    return [((int(label[r[0]]), int(dims[r[0]])), r, np.frombuffer(b"".join([raw[k] for k in r]), np.float64).reshape(len(r), -1)) for r in np.split(order, cuts[1:])] if len(order) else []


def in_cells(classes: DataFrame, shared) -> DataFrame:
    """Adds ``cell`` (-1 for a label without a pivot) and ``away``, the distance to its pivot."""

    def run(batches):
        import pyarrow as pa

        cells = shared.value
        for b in batches:
            cell, away = np.full(b.num_rows, -1, np.int32), np.full(b.num_rows, 2.0)
            for space, rows, x in by_space(b):
                if space in cells.units:
                    d = distances(x, cells.units[space])
                    at = d.argmin(axis=1)
                    cell[rows], away[rows] = np.array(cells.numbers[space])[at], d[np.arange(len(rows)), at]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(away)], [*b.schema.names, "cell", "away"])

    return classes.select("label", "dims", "cls", "weight", "unit").mapInArrow(run, "label long, dims int, cls long, weight long, unit binary, cell int, away double")


def meetings(placed: DataFrame, shared, reach: float) -> DataFrame:
    """Each vector once per pair of pieces that it takes part in; links to cells that are near as a whole have ``side`` 2, with the pivot as ``i`` and its cell's weight as ``weight``."""

    def run(batches):
        cells = shared.value
        for b in batches:
            cls, weight, unit, own = b.column("cls").to_numpy(), b.column("weight").to_numpy(), b.column("unit").to_pylist(), b.column("cell").to_numpy()
            deal = (cls.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            out = []

            def send(space, k, mine, other):
                n, m = cells.pieces(space, mine), cells.pieces(space, other)
                i = int(deal[k]) % n
                for j in range(m):
                    if mine == other:
                        pair, side = (min(i, j), max(i, j)), int(i > j)
                    else:
                        pair, side = ((i, j), 0) if mine < other else ((j, i), 1)
                    out.append((*space, min(mine, other), max(mine, other), *pair, side, cls[k], weight[k], unit[k]))

            for space, rows, x in by_space(b):
                if space not in cells.units:
                    for k in rows:
                        send(space, k, -1, -1)
                    continue
                numbers, pivots = cells.numbers[space], cells.units[space]
                radii, weights = cells.radii(space)
                place = {n: k for k, n in enumerate(numbers)}
                at = np.array([place[c] for c in own[rows]])
                near = distances(x, pivots) <= radii + (reach + SLACK)
                near[np.arange(len(rows)), at] = True
                homes, back = np.unique(at, return_inverse=True)
                d = distances(pivots[homes], pivots)
                d[np.arange(len(homes)), homes] = 0.0
                inside = (d + radii[homes][:, None] + radii <= reach - SLACK)[back]
                for r, c in zip(*np.nonzero(inside)):
                    k, total = rows[r], int(weights[c]) - (int(weight[rows[r]]) if c == at[r] else 0)
                    out.append((*space, numbers[c], 0, 0, 0, 2, cls[k], total, np.int64(cells.ids[numbers[c]]).tobytes()))
                for r, c in zip(*np.nonzero(near & ~inside)):
                    send(space, rows[r], int(own[rows[r]]), numbers[c])
                    if len(out) > 20_000:
                        yield batch_of(out)
            if out:
                yield batch_of(out)

    def batch_of(out):
        import pyarrow as pa

        kinds = [pa.int64(), *[pa.int32()] * 6, pa.int64(), pa.int64(), pa.binary()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [c.split()[0] for c in _MET.split(", ")])
        out.clear()
        return made

    return placed.mapInArrow(run, _MET)


def linked_pieces(met: DataFrame, cosine: float) -> DataFrame:
    """``u, v, n``: per vector the weight of its partners in a pair of pieces (``v`` NULL), and links (``n`` 0)."""

    def run(table):
        import pyarrow as pa

        side, cls, weight = table.column("side").to_numpy(), table.column("cls").to_numpy(), table.column("weight").to_numpy()
        x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(cls), -1)
        self_pair = all(table.column(a)[0].as_py() == table.column(b)[0].as_py() for a, b in (("low", "high"), ("i", "j")))
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if self_pair:
            tree = CoverTree(x[a], weight[a])
            found, ids = traverse(tree, tree, cosine), cls[a]
            n = found.left
        elif len(a) and len(b):
            found = traverse(CoverTree(x[a], weight[a]), CoverTree(x[b], weight[b]), cosine)
            ids, n = cls[np.concatenate([a, b])], np.concatenate([found.left, found.right])
        else:
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        u, v = found.spanning()
        some = np.flatnonzero(n)
        return pa.table({
            "u": pa.array(np.concatenate([ids[some], ids[u]])), "v": pa.array([None] * len(some) + ids[v].tolist(), pa.int64()),
            "n": pa.array(np.concatenate([n[some], np.zeros(len(u), np.int64)])),
        })

    pairs = met.filter("side < 2").groupBy("label", "dims", "low", "high", "i", "j").applyInArrow(run, _FOUND)
    direct = met.filter("side = 2").select(F.col("cls").alias("u"), F.conv(F.hex(F.reverse("unit")), 16, 10).cast("long").alias("v"), F.col("weight").alias("n"))
    return pairs.unionByName(direct)


def near_vectors(vectors: DataFrame, cosine: float = 0.98, piece: int = PIECE) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id, embedding, label``): ``vec_id, n_links, component_id, kept``.

    Rows link when their labels are equal, their vectors equally long and their cosine, in double precision, is at least
    ``cosine``. Rows that repeat (a vector or even an id) are rows of their own and link with each other. A
    row with a NULL label or vector, a zero vector, or a component that is NULL or not finite
    links with nothing; so does a row with a NULL id, which has a NULL component and is kept.
    """
    spark, reach = vectors.sparkSession, float(np.sqrt(2 - 2 * cosine))
    can, alone = split(vectors)
    rows = keyed(can)
    classes = kept_table(unit_classes(rows), "vectors")
    n, widest = classes.agg(F.count(F.lit(1)), F.coalesce(F.max("dims"), F.lit(1))).first()
    rate = min(1.0 / piece, PIVOT_BYTES / (8 * max(1, widest) * max(1, n)))
    pivots = classes.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < rate * (1 << 40)).select("label", "dims", "cls", "unit").collect()
    with scratch(spark) as keep:
        placed = keep(in_cells(classes, spark.sparkContext.broadcast(Cells(pivots, [], piece))), "placed")
        # pivots' cells and cells of more than a piece: as many as pivots and n / piece, at most
        sizes = placed.groupBy("label", "dims", "cell").agg(F.max("away").alias("radius"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows"))
        sizes = sizes.filter((F.col("cell") >= 0) | (F.col("rows") > piece)).collect()
        met = keep(meetings(placed, spark.sparkContext.broadcast(Cells(pivots, sizes, piece)), reach), "meetings")
        found = keep(linked_pieces(met, cosine), "links")
        links = found.groupBy("u").agg(F.sum("n").alias("n"))
        reached = components(found.filter("v IS NOT NULL").select(F.col("u").alias("a"), F.col("v").alias("b")), keep)
        of = classes.join(links, classes["cls"] == links["u"], "left").join(reached, classes["cls"] == reached["node"], "left")
        of = of.select(*_KEY, "weight", "least", F.coalesce("component", "cls").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
        of = keep(of, "class-links")
        least = of.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("many"))
        # a component's least id moves only to components of several vectors
        several = of.join(least.filter("many > 1").select("component", "component_id"), "component", "left")
        result = kept_table(several.select(*_KEY, "weight", "n_links", F.coalesce("component_id", "least").alias("component_id")), "vector-classes")
    hot = F.broadcast(result.filter(F.col("weight") > HOT))  # at most one class per HOT rows
    some = rows.select("vec_id", *_KEY)
    linked = some.join(hot, _KEY).unionByName(some.join(hot.select(*_KEY), _KEY, "left_anti").join(result.filter(F.col("weight") <= HOT), _KEY))
    out = linked.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id").unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
least AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.u = e.vec_id LEFT JOIN counts c ON c.u = e.vec_id"""
