"""Byte-level BPE by a segment tree over byte positions.

Every live position holds the rank of the pair it forms with its live right neighbour; a
segment tree over the positions keeps the minimum, so its root gives the lowest rank and a
walk towards the left child finds the leftmost pair of that rank. A merge changes three
leaves (the pair itself, the one before it, the swallowed position) and updates their paths,
logarithmic in the length. Short words are merged many at a time, one numpy row of trees each;
long ones alone.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.words import LONGEST, Tokenizer, slices

NONE = np.int32(2**31 - 1)
ROWS = 4096


class Ranks:
    """Byte ids, the rank of each mergeable pair of ids, and the bytes of each id."""

    def __init__(self, tokens: dict[bytes, int]):
        self.size = max(tokens.values()) + 1
        self.bytes = np.array([tokens[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs: dict[int, int] = {}
        for word, rank in tokens.items():
            for k in range(1, len(word)):
                a, b = tokens.get(word[:k]), tokens.get(word[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int32)
        self.text = [b""] * self.size
        for word, rank in tokens.items():
            self.text[rank] = word
        self.blob = joined(self.text)
        self.decimal = joined([b"%d," % i for i in range(self.size)])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


def spelled(ids: np.ndarray, table) -> bytes:
    """The table's strings of these ids, one after the other."""
    data, starts, sizes = table
    n = sizes[ids]
    ends = np.cumsum(n)
    return data[np.repeat(starts[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


def merge_many(ranks: Ranks, words: list[bytes], width: int) -> list[np.ndarray]:
    """Ids of words of at most ``width`` bytes, a power of two from 2; one tree per row."""
    n, levels = len(words), width.bit_length() - 1
    lengths = np.array([len(w) for w in words])
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
    ids = np.concatenate([ranks.bytes[raw], np.zeros((n, 1), np.int32)], axis=1)
    right = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
    left = right - 2
    live = np.arange(width) < lengths[:, None]
    tree = np.full((n, 2 * width), NONE, dtype=np.int32)
    paired = live[:, 1:]
    tree[:, width : 2 * width - 1] = np.where(paired, ranks.of(ids[:, : width - 1], ids[:, 1:width]), NONE)
    for k in range(levels - 1, -1, -1):
        tree[:, 1 << k : 2 << k] = np.minimum(tree[:, 2 << k : 4 << k : 2], tree[:, (2 << k) + 1 : 4 << k : 2])
    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        low = tree[rows, 1]
        node = np.ones(len(rows), dtype=np.int64)
        for _ in range(levels):
            node = 2 * node
            node += tree[rows, node] != low
        i = node - width
        j = right[rows, i]
        after, before = right[rows, j], left[rows, i]
        ids[rows, i] = low
        live[rows, j] = False
        right[rows, i] = after
        left[rows, np.minimum(after, width)] = i
        more = after < lengths[rows]
        tree[rows, width + j] = NONE
        tree[rows, width + i] = np.where(more, ranks.of(low, ids[rows, np.minimum(after, width)]), NONE)
        first = before < 0
        p = np.where(first, i, before)
        tree[rows, width + p] = np.where(first, tree[rows, width + i], ranks.of(ids[rows, p], low))
        a, b, c = width + i, width + j, width + p
        for _ in range(levels):
            a, b, c = a >> 1, b >> 1, c >> 1
            for x in (b, a, c):
                tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])
        rows = rows[tree[rows, 1] < NONE]
    return [ids[r, :width][live[r]] for r in range(n)]


def merge_one(ranks: Ranks, word: bytes) -> np.ndarray:
    """The same for one word of any length."""
    n = len(word)
    width = 1 << max(1, (n - 1).bit_length())
    ids = [int(ranks.bytes[b]) for b in word]
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    none, get, size = int(NONE), ranks.pairs.get, ranks.size
    tree = [none] * (2 * width)
    for i in range(n - 1):
        tree[width + i] = get(ids[i] * size + ids[i + 1], none)
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i, rank):
        k = width + i
        tree[k] = rank
        k >>= 1
        while k:
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                break  # nothing changes above
            tree[k] = low
            k >>= 1

    live = [True] * n
    while tree[1] < none:
        low, k = tree[1], 1
        while k < width:
            k *= 2
            k += tree[k] != low
        i = k - width
        j = right[i]
        after, before = right[j], left[i]
        ids[i], live[j], right[i] = low, False, after
        if after < n:
            left[after] = i
        put(j, none)
        put(i, get(low * size + ids[after], none) if after < n else none)
        if before >= 0:
            put(before, get(ids[before] * size + low, none))
    return np.array([x for x, a in zip(ids, live, strict=True) if a], dtype=np.int32)


class SegmentTreeBPE(Tokenizer):
    """``encode`` as for other tokenizers, with ids by the trees above."""

    def __init__(self, file: str):
        import public_tokenizers
        import regex

        with open(public_tokenizers.path(file), "rb") as f:
            self.ranks = Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
        self.pattern, self.spaces = regex.compile(public_tokenizers.PATTERN), True
        self.first, self.later, self.tokens = {}, {}, {}

    def _split(self, piece: str) -> list[str]:
        return [piece] if piece.isascii() and piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()) else self.pattern.findall(piece)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        return self._joined(pieces, [self._split(p) for p in pieces])

    def _new(self, tokens: list[str]) -> list[bytes]:
        raw = [t.encode("utf-8", "surrogatepass") for t in tokens]
        out: list[bytes] = [b""] * len(raw)
        by_width: dict[int, list[int]] = {}
        for k, b in enumerate(raw):
            if len(b) > LONGEST:
                out[k] = merge_one(self.ranks, b).astype("<u4").tobytes()
            else:
                by_width.setdefault(max(2, 1 << (len(b) - 1).bit_length()), []).append(k)
        for width, own in by_width.items():
            for i in range(0, len(own), ROWS):
                part = own[i : i + ROWS]
                for k, ids in zip(part, merge_many(self.ranks, [raw[k] for k in part], width), strict=True):
                    out[k] = ids.astype("<u4").tobytes()
        return out


_ENCODERS: dict[str, SegmentTreeBPE] = {}


def encoder(file: str) -> SegmentTreeBPE:
    if file not in _ENCODERS:
        _ENCODERS[file] = SegmentTreeBPE(file)
    return _ENCODERS[file]


def round_trip(docs: DataFrame, file: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Encodes every whole text and decodes its ids: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    NULL counts as empty: no ids, digests of the empty string. One row per row of ``docs``,
    in one pass without a shuffle.
    """

    def run(batches):
        import pyarrow as pa

        bpe = encoder(file)
        for b in batches:
            for at, texts in slices(b):
                n, ids_hash, text_hash = [], [], []
                for packed in bpe.encode(texts):
                    ids = np.frombuffer(packed, dtype="<u4")
                    n.append(len(ids))
                    ids_hash.append(hashlib.sha256(spelled(ids, bpe.ranks.decimal)[:-1]).hexdigest())
                    text_hash.append(hashlib.sha256(spelled(ids, bpe.ranks.blob)).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
