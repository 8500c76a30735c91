"""Packing into sequences by minimum bin slack over a histogram of lengths.

A document is cut into full sequences and one remainder. For each window the largest
remaining length is taken, and a bitset subset-sum over the remaining lengths (with
their counts, as bounded multiples) finds the multiset that fills it closest to
capacity; the counts come from backtracking through the bitsets. Equal windows are
filled together, so the search depends on the capacity, not on the rows. Spark ranks
the pieces of each length and deals them to the windows.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.tables import kept_table, number
from airq.llm.words import slices, tokenizer

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, whose sum is the largest not above ``room``; among those, long lengths first."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + k
            total -= length * k
    return used


def windows(hist: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths in a window with their counts, number of such windows), until no length is left."""
    counts, out = {k: v for k, v in hist.items() if v}, []
    while counts:
        largest = max(counts)
        counts[largest] -= 1
        used = fill(counts, capacity - largest)
        counts[largest] += 1
        used[largest] = used.get(largest, 0) + 1
        times = min(counts[x] // n for x, n in used.items())
        for x, n in used.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        out.append((used, times))
    return out


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, pieces per sequence, offset of the first) by rank."""
    seen: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for used, times in plan:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            out.setdefault(length, []).append((seen.get(length, 0), sequence, n, offset))
            seen[length] = seen.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def tokenized_pieces(docs: DataFrame, file: str, capacity: int, end: int) -> DataFrame:
    """Pieces of at most ``capacity`` ids: each document's ids and then ``end``, cut from the front."""
    last = np.array([end], dtype="<u4").tobytes()

    def cut(batches):
        import pyarrow as pa

        tok = tokenizer(file)
        for b in batches:
            keys = b.column("doc_id")
            for at, texts in slices(b):
                rows, start, length, crc, total = [], [], [], [], []
                for i, ids in enumerate(tok.encode(texts)):
                    ids += last
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        piece = ids[4 * s : 4 * (s + capacity)]
                        rows.append(at + i)
                        start.append(s)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces. The histogram has at most ``capacity`` rows."""
    hist = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    table = places(windows(hist, capacity))
    ranked = number(pieces.withColumn("_piece", F.struct("doc_id", "start")), ["length"], "_piece", sum(hist.values()), "_rank")

    def place(frames):
        for f in frames:
            seq, off = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            lengths, ranks = f["length"].to_numpy(), f["_rank"].to_numpy()
            for length in np.unique(lengths):
                t, own = table[int(length)], lengths == length
                row = t[np.searchsorted(t[:, 0], ranks[own], side="right") - 1]
                done = ranks[own] - row[:, 0]
                seq[own] = row[:, 1] + done // row[:, 2]
                off[own] = row[:, 3] + done % row[:, 2] * length
            yield f.drop(columns="_rank").assign(sequence_id=seq, offset=off)

    return ranked.drop("_piece").mapInPandas(place, PLACED)


def pack(docs: DataFrame, file: str = "byte_bpe_50k.json", capacity: int = 1024, end: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    NULL and empty texts have the end id alone. Documents longer than ``capacity`` fill
    sequences of their own; only the last piece of each is packed with others. Rows that
    share a ``doc_id`` are packed each for itself; an empty table gives no rows.
    """
    return pack_pieces(kept_table(tokenized_pieces(docs, file, capacity, end), "pieces"), capacity)
