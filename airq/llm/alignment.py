"""Two tokenizers' ids over the same text, aligned by shared byte ends.

A text is tokenised whole by both. Where a space-marked token of A and one of B start at the
same byte, both have an end just before it: these verified places cut the text into windows,
each a pair of id tuples. The groups of a window (runs of tokens between bytes where both
have an end) depend on its ids alone, so of a batch of texts every distinct pair of tuples is aligned
once, all of them together, and each window takes its tuples' alignment.

Counts of linked id pairs over the corpus come from blocks of documents: a block lists each
of its pairs once with the number of its documents that hold it, and receives one count per
pair back, so that a frequent pair has one row per block and not one per document.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.llm.bpe import joined, spelled
from airq.llm.tables import kept_table
from airq.llm.words import byte_letters, slices

#: Windows handled at a time.
SLICE = 400_000
#: Texts that go to A's library whole: letters that another Unicode table may class differently, runs that a merge by rank takes long for.
ODD = re.compile("[^\x00-\u024f]|\\S{5000}|\\s{5000}")
#: Documents and listed pairs of a block, about.
BLOCK_DOCS, BLOCK_PAIRS = 2048, 1_000_000
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_STAGED = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs array<bigint>, found array<int>"


def group_edges(end: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which of the ends are also ends of the other side."""
    marks = np.zeros(int(end[-1]) + 1, dtype=bool)
    marks[other] = True
    return marks[end]


class Windows:
    """Alignments of some windows, given as token ids one window after the other: ``text`` (bytes, starts, sizes; with a
    semicolon after each group), ``groups`` and ``links`` per window, ``pairs`` and ``times`` from ``cut`` to ``cut``.

    A group's linked pairs are all its A ids with all its B ids; where that is more than ROOMY, equal ids are
    counted first.
    """

    ROOMY = 4096

    def __init__(self, a, at_a, b, at_b, size_a, size_b, decimal):
        shift = len(size_a)  # decimals of B ids follow those of A ids
        end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        last_a, last_b = group_edges(end_a, end_b), group_edges(end_b, end_a)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        stop_a, stop_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        first = group_a[at_a[:-1]]  # of each window's groups
        window = np.repeat(np.arange(len(first)), np.diff(first, append=len(n_a)))
        self.groups = np.diff(first, append=len(n_a))
        self.links = np.add.reduceat(n_a * n_b, first)
        # the groups' tokens in the order of the text form, each with its decimal and a separator
        spot_a = np.arange(len(a)) + (stop_b - n_b)[group_a]
        spot_b = np.arange(len(b)) + stop_a[group_b]
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[spot_a], order[spot_b] = a, b + shift
        text = np.frombuffer(spelled(order, decimal), np.uint8).copy()
        ends = np.cumsum(decimal[2][order])
        text[ends[spot_a[last_a]] - 1], text[ends[spot_b[last_b]] - 1] = ord("|"), ord(";")
        stop = ends[spot_b[last_b]][np.append(first[1:], len(n_a)) - 1]
        start = np.append(0, stop[:-1])
        self.text = text, start, stop - start
        pairs, many = n_a * n_b, n_a * n_b > self.ROOMY
        few = np.where(many, 0, pairs)
        step = places_in(np.cumsum(few) - few, int(few.sum())) if few.any() else np.empty(0, np.int64)
        k = np.repeat(np.arange(len(few)), few)
        code = [(window[k] << 42) | (a[(stop_a - n_a)[k] + step // n_b[k]].astype(np.int64) << 21) | b[(stop_b - n_b)[k] + step % n_b[k]]]
        times = [np.ones(len(k), np.int64)]
        for g in np.flatnonzero(many):
            x, n = np.unique(a[stop_a[g] - n_a[g] : stop_a[g]], return_counts=True)
            y, m = np.unique(b[stop_b[g] - n_b[g] : stop_b[g]], return_counts=True)
            code.append(((window[g] << 42) | (x.astype(np.int64) << 21)[:, None] | y).ravel())
            times.append(np.outer(n, m).ravel())
        code, times = summed(np.concatenate(code), np.concatenate(times))
        self.cut = np.searchsorted(code >> 42, np.arange(len(first) + 1))
        self.pairs, self.times = ((code >> 21 & (1 << 21) - 1) << 32) | (code & (1 << 21) - 1), times


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def places_in(starts: np.ndarray, n: int) -> np.ndarray:
    """0, 1, 2, ... from each start on."""
    return np.arange(n) - np.repeat(starts, np.diff(starts, append=n))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, values, len(distinct)).astype(np.int64)


class Aligner:
    """Both tokenizers of a worker and the bytes of their tokens."""

    def __init__(self, file_a: str, ranks_a: str | None, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(file_a))
        self.whole.encode_special_tokens = True
        self.fast = None
        if ranks_a:
            with open(public_tokenizers.path(ranks_a), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file_b))
        byte_of = {ord(c): b for b, c in byte_letters().items()}
        spell_a = [b""] * self.whole.get_vocab_size()
        for token, i in self.whole.get_vocab().items():
            spell_a[i] = token.translate(byte_of).encode("latin-1") if all(ord(c) in byte_of for c in token) else token.encode()
        spell_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            spell_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.spell_a, self.spell_b = joined(spell_a), joined(spell_b)
        self.size_a, self.size_b = self.spell_a[2], self.spell_b[2]
        if max(len(spell_a), len(spell_b)) > 1 << 21:
            raise ValueError("vocabularies of more than 2,097,152 tokens are not supported")
        self.decimal = joined([b"%d," % i for n in (len(spell_a), len(spell_b)) for i in range(n)])
        self.space_a = np.array([t[:1] == b" " for t in spell_a])
        self.space_b = np.array([self.b.id_to_piece(i)[:1] == "▁" for i in range(self.b.get_piece_size())])

    def ids_of_a(self, text: str) -> np.ndarray:
        """A's ids of a whole text: by the ranks of the same vocabulary, or by its library where those may differ."""
        if self.fast is None or ODD.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each whole text; None for texts that have no tokens by definition."""
        full = [t for t in texts if t]
        ids_a = [self.ids_of_a(" " + t) for t in full]
        ids_b = [np.array(x, dtype=np.int32) for x in self.b.encode(full, num_threads=1)]
        want = [(" " + t).encode() for t in full]
        none = np.empty(0, np.int32)
        whole = all(spelled(np.concatenate([none, *ids]), table) == b"".join(want) for ids, table in ((ids_a, self.spell_a), (ids_b, self.spell_b)))
        if whole and all(int(self.size_a[a].sum()) == len(w) == int(self.size_b[b].sum()) for a, b, w in zip(ids_a, ids_b, want)):
            good = iter(zip(ids_a, ids_b))
        else:
            good = iter([(a, b) if spelled(a, self.spell_a) == w == spelled(b, self.spell_b) else None for a, b, w in zip(ids_a, ids_b, want)])
        return [next(good) if t else None for t in texts]

    def aligned(self, tokens: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
        """(groups, links, digest of the groups, linked pairs, times each is linked) of each text, all of them together."""
        if not tokens:
            return []
        a, b = (np.concatenate(x) for x in zip(*tokens))
        size_a, size_b = self.size_a[a], self.size_b[b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        first = np.cumsum([0, *[len(x) for x, _ in tokens]])
        # texts lie one after the other, in bytes alike for both; a text's first byte is a place to cut
        texts = np.concatenate([[0], end_a])[first[:-1]]
        marks = np.zeros(int(end_a[-1]) + 1, dtype=np.uint8)
        marks[(end_a - size_a)[self.space_a[a]]] = 1
        marks[(end_b - size_b)[self.space_b[b]]] += 2
        marks[texts] = 3
        cuts = np.flatnonzero(marks == 3)
        at_a, at_b = np.searchsorted(end_a - size_a, cuts), np.searchsorted(end_b - size_b, cuts)
        doc = np.searchsorted(texts, cuts, side="right") - 1
        at_a, at_b = np.append(at_a, len(a)), np.append(at_b, len(b))
        groups, links = np.zeros(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        digests, found = [None] * len(tokens), []
        for low in range(0, len(cuts), SLICE):
            high = min(low + SLICE, len(cuts))
            which, window = self._windows(a[at_a[low] : at_a[high]], at_a[low : high + 1] - at_a[low], b[at_b[low] : at_b[high]], at_b[low : high + 1] - at_b[low])
            own = doc[low:high]
            np.add.at(groups, own, window.groups[which])
            np.add.at(links, own, window.links[which])
            text = memoryview(spelled(which, window.text))
            spans = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
            places = np.append(0, np.cumsum(window.text[2][which]))[spans].tolist()
            for d, s, e in zip(own[spans[:-1]].tolist(), places, places[1:]):
                if digests[d] is None:
                    digests[d] = hashlib.sha256(text[s : e - 1])
                else:  # a text that goes on
                    digests[d].update(b";")
                    digests[d].update(text[s : e - 1])
            found.append(pairs_of(own, which, window))
        docs, pairs, times = (np.concatenate(x) for x in zip(*found))
        if len(found) > 1:  # a text that goes on in the next slice
            distinct, pair = np.unique(pairs, return_inverse=True)
            code, times = summed(docs * len(distinct) + pair, times)
            docs, pairs = code // len(distinct), distinct[code % len(distinct)]
        ends = np.searchsorted(docs, np.arange(len(tokens) + 1))
        return [(int(g), int(n), d.hexdigest(), pairs[s:e], times[s:e]) for g, n, d, s, e in zip(groups, links, digests, ends, ends[1:])]

    def _windows(self, a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, Windows]:
        """(number of each window's id tuple among the distinct ones, the alignment of each of those)."""
        with np.errstate(over="ignore"):
            def tuple_hash(x, at):
                step = places_in(at[:-1], len(x)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                return np.add.reduceat(mixed(x.astype(np.uint64) + step + np.uint64(1)), at[:-1])

            code = mixed(tuple_hash(a, at_a)) + tuple_hash(b, at_b)
        _, first, which = np.unique(code, return_index=True, return_inverse=True)

        def same(x, at):
            """Is every window's tuple that of the first window with its hash."""
            size = np.diff(at)
            if (size != size[first][which]).any():
                return False
            return bool((x == x[np.repeat(at[:-1][first][which] - at[:-1], size) + np.arange(len(x))]).all())

        if not (same(a, at_a) and same(b, at_b)):  # two tuples with one hash: every window stands for itself
            first = which = np.arange(len(code))

        def picked(x, at):
            start, size = at[:-1][first], np.diff(at)[first]
            cut = np.append(0, np.cumsum(size))
            return x[np.repeat(start - cut[:-1], size) + np.arange(cut[-1])], cut

        return which, Windows(*picked(a, at_a), *picked(b, at_b), self.size_a, self.size_b, self.decimal)


def pairs_of(doc: np.ndarray, which: np.ndarray, window: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, linked pair, times) in order, from the number of each document's windows among the distinct ones."""
    n = len(window.groups)
    code, often = np.unique(doc * n + which, return_counts=True)
    of, at = code // n, code % n
    distinct, number = np.unique(window.pairs, return_inverse=True)
    start, size = window.cut[at], np.diff(window.cut)[at]
    place = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    code, total = summed(np.repeat(of, size) * len(distinct) + number[place], window.times[place] * np.repeat(often, size))
    return code // len(distinct), distinct[code % len(distinct)], total


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(file_a: str = "byte_bpe_50k.json", ranks_a: str | None = "byte_bpe_50k.tiktoken", file_b: str = "piece_bpe_32k.model") -> Aligner:
    """One per worker process."""
    key = file_a, ranks_a, file_b
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def staged(docs: DataFrame, files: tuple, block_docs: int = BLOCK_DOCS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Per document its own figures and pairs (as places in its block's list), and per block one row with that list.

    A block ends with the document that takes it to ``block_docs`` documents or ``block_pairs`` listed pairs.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        both, block = aligner(*files), TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        lists: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            nonlocal block
            sizes = [len(p) for p, _ in lists]
            pairs, places, found = np.unique(np.concatenate([p for p, _ in lists]), return_inverse=True, return_counts=True)
            ends = np.cumsum(sizes)
            cut = [places[e - n : e].astype(np.int32).tobytes() for e, n in zip(ends, sizes)]
            n = len(rows)
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 5 + (pa.string(),))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), *cols, pa.array(cut, pa.binary()), pa.array([t.tobytes() for _, t in lists], pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], names)
            if len(pairs):
                none = [pa.nulls(1, t) for t in (pa.int64(),) * 5 + (pa.string(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *none, pa.array([pairs], pa.list_(pa.int64())), pa.array([found.astype(np.int32)], pa.list_(pa.int32()))], names)
            block += 1
            rows.clear()
            lists.clear()

        names, held = [c.split()[0] for c in _STAGED.split(", ")], 0
        for batch in batches:
            for at, texts in slices(batch):
                ids = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                tokens = both.tokens(texts)
                done = iter(both.aligned([x for x in tokens if x is not None]))
                for doc, got in zip(ids, tokens):
                    if got is None:
                        rows.append((doc, 0, 0, 0, 0, ""))
                        lists.append((np.empty(0, np.int64), np.empty(0, np.int64)))
                    else:
                        groups, links, digest, pairs, times = next(done)
                        rows.append((doc, len(got[0]), len(got[1]), groups, links, digest))
                        lists.append((pairs, times))
                        held += len(pairs)
                    if len(rows) >= block_docs or held >= block_pairs:
                        yield from flush()
                        held = 0
        if rows:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, _STAGED)


def pair_counts(staged_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, place, pair) of every block's list, and per pair the number of documents that hold it (``n``) and whether no other pair of its A id has more (``best``)."""
    listed = staged_rows.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "found")).alias("place", "_x"))
    listed = listed.select("block", "place", F.col("_x.pairs").alias("pair"), F.col("_x.found").alias("found"))
    counts = listed.groupBy("pair").agg(F.sum("found").alias("n")).withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return listed.drop("found"), counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align_documents(docs: DataFrame, file_a: str = "byte_bpe_50k.json", ranks_a: str | None = "byte_bpe_50k.tiktoken", file_b: str = "piece_bpe_32k.model", block_docs: int = BLOCK_DOCS, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A text that is NULL or empty, or whose tokens do not spell a space and the text, has no
    tokens: zeros and an empty digest. Rows that repeat (same id or same text) count as documents
    of their own; pairs tied for the highest count of an A id are all best. A NULL ``doc_id`` is
    passed on. Texts of any length are tokenised whole; their windows are handled in slices. ``ranks_a`` names
    the ranks of A's own vocabulary, a faster way to the same ids (None: A's library alone).
    """
    kept = kept_table(staged(docs, (file_a, ranks_a, file_b), block_docs, block_pairs), "aligned")
    listed, counts = pair_counts(kept)
    back = listed.join(counts, "pair").select("block", "place", "n", "best")

    def score(left, right):
        import pyarrow as pa

        size = right.num_rows
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = right.column("place").to_numpy()
        n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for places, times in zip(left.column("places").to_pylist(), left.column("times").to_pylist()):
            p, t = np.frombuffer(places, np.int32), np.frombuffer(times, np.int64)
            n_best.append(int((best[p] * t).sum()))
            count_sum.append(int((n[p] * t).sum()))
        cols = {c: left.column(c) for c in _DOC} | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        order = [c.split()[0] for c in OUT.split(", ")]
        return pa.table([cols[c] for c in order], names=order)

    rows = kept.filter("pairs IS NULL").select(F.col("block").alias("home"), *_DOC, "places", "times")
    return rows.groupBy("home").cogroup(back.groupBy("block")).applyInArrow(score, OUT)
