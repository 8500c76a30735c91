"""Token ids of whole texts with a public tokenizer, each distinct word once per worker.

A text is cut before every space that follows a character other than white space.
No pre-token of either vocabulary spans such a cut, so ids of the pieces, in order,
are the ids of the text. Texts where a space follows white space take the general cut.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

GENERAL_CUT = re.compile(r"(?<=\S)(?= )")
#: Letters beyond this range may be classed differently by other Unicode tables; words with them go to the tokenizer whole.
BEYOND = re.compile("[^\x00-\u024f]")
MARKS = frozenset(".,;:!?")
#: Entries a worker keeps per table; a full table is emptied.
ROOM = 600_000
LONGEST = 64


def byte_letters() -> dict[int, str]:
    """Latin-1 code points to the letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Tokenizer:
    """``encode(texts)``: for each text its ids as packed unsigned 32-bit integers."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(file))
        self.whole.encode_special_tokens = True
        self.merges, self.letters = self.whole.model, byte_letters()
        self.spaces = not file.startswith("word")  # a space belongs to the word after it
        self.pattern = regex.compile(public_tokenizers.PATTERN if self.spaces else r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.first: dict[str, bytes | None] = {}
        self.later: dict[str, bytes | None] = {}
        self.tokens: dict[str, bytes] = {}

    def _split(self, piece: str) -> list[str]:
        """The piece's pre-tokens."""
        word = piece[1:] if piece[:1] == " " else piece
        if not self.spaces:
            word = piece = piece.lower()
        if word.isalpha():
            return [piece]
        if word and word[-1] in MARKS and word[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.pattern.findall(piece)

    def _new(self, tokens: list[str]) -> list[bytes]:
        """Ids of pre-tokens not seen before."""
        out = []
        for t in tokens:
            spelled = t.encode("utf-8").decode("latin-1").translate(self.letters)
            out.append(array("I", [x.id for x in self.merges.tokenize(spelled)]).tobytes())
        return out

    def _unsplit(self, piece: str) -> bytes:
        """Ids of a piece that the tokenizer splits by its own tables."""
        return np.array(self.whole.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, pieces: list[str]) -> list[bytes]:
        return self._joined(pieces, [None if BEYOND.search(p) else self._split(p) for p in pieces])

    def _joined(self, pieces: list[str], split: list[list[str] | None]) -> list[bytes]:
        if len(self.tokens) > ROOM:
            self.tokens.clear()
        new = list({t for s in split if s for t in s if t not in self.tokens})
        fresh = dict(zip(new, self._new(new), strict=True))
        self.tokens.update((t, v) for t, v in fresh.items() if len(t) <= LONGEST)
        get = self.tokens.get
        return [self._unsplit(p) if s is None else b"".join([fresh[t] if t in fresh else get(t) for t in s]) for p, s in zip(pieces, split, strict=True)]

    def _learn(self, table: dict, wanted: list[str], lead: str) -> None:
        if len(table) > ROOM:
            table.clear()
        # a space after white space doesn't cut: None sends the text to the general cut
        bad = {w for w in wanted if lead and (not w or w[-1].isspace())}
        good = [w for w in wanted if w not in bad]
        table.update(zip(good, self._ids([lead + w for w in good]), strict=True))
        table.update(dict.fromkeys(bad))

    def encode(self, texts: list[str]) -> list[bytes]:
        lead = " " if self.spaces else ""
        cut = [t.split(" ") for t in texts]
        first, later = self.first, self.later
        if self.spaces:
            self._learn(first, [w for w in {c[0] for c in cut} if w not in first], "")
            self._learn(later, [w for w in set().union(*[c[1:] for c in cut]) if w not in later], lead)
        else:
            self._learn(first, [w for w in set().union(*cut) if w not in first], "")
        out = []
        for t, c in zip(texts, cut, strict=True):
            try:
                if self.spaces:
                    if len(c) > 1 and (not c[0] or c[0][-1].isspace()):
                        raise TypeError  # a head that ends in white space doesn't cut
                    out.append(first[c[0]] + b"".join([later[w] for w in c[1:]]))
                else:
                    out.append(b"".join([first[w] for w in c]))
            except (TypeError, KeyError):
                out.append(b"".join(self._ids(GENERAL_CUT.split(t))) if t else b"")
        return out


class RankedTokenizer:
    """The same by the ranks of the same vocabulary, whole texts at a time.

    Texts with letters beyond BEYOND's range, or with a run that a merge by rank takes long for, go to the
    tokenizer itself.
    """

    ODD = re.compile(BEYOND.pattern + r"|\S{5000}|\s{5000}")

    def __init__(self, file: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import base64

        import public_tokenizers
        import tiktoken
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(public_tokenizers.path(file))
        self.whole.encode_special_tokens = True
        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(self.whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() if self.ODD.search(t) else self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes()
            for t in texts
        ]


#: Vocabularies that also come as ranks.
RANKS = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}
_TOKENIZERS: dict[str, Tokenizer | RankedTokenizer] = {}


def tokenizer(file: str) -> Tokenizer | RankedTokenizer:
    """One per worker process."""
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = RankedTokenizer(file, RANKS[file]) if file in RANKS else Tokenizer(file)
    return _TOKENIZERS[file]


def slices(batch, rows: int = 256, chars: int = 1_000_000):
    """(first row, texts) of a batch's rows in pieces of bounded size; NULL counts as empty. A single long text is a piece of its own."""
    texts = batch.column("text").to_pylist()
    part, size, at = [], 0, 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if len(part) >= rows or size >= chars:
            yield at, part
            part, size, at = [], 0, i + 1
    if part:
        yield at, part
