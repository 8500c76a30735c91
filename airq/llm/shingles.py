"""Hashes of words and word shingles of whole texts, in numpy over the texts' bytes.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. All separators are ASCII, so UTF-8
bytes are cut without decoding.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240131)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(steps)
        if size > 1 << 22:
            _powers.pop(int(base))  # a very long text's table isn't kept
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, in order, and the end of each text's words."""
    raw = [t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    gap = _SPACE[data]
    edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=1, append=1))
    start, stop = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * _power(_BASE, len(data)), dtype=np.uint64)])
    h = (sums[stop] - sums[start]) * _power(_INVERSE, len(data))[start]
    return mix(h + (stop - start).astype(np.uint64)), np.searchsorted(start, ends)


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one byte places of each word of one text."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    edge = np.flatnonzero(np.diff(_SPACE[data].astype(np.int8), prepend=1, append=1))
    return edge[0::2], edge[1::2]


def shingles_of(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; a shorter text is one run; no words, none."""
    if not len(words):
        return words
    w = min(width, len(words))
    m = len(words) - w + 1
    h = np.full(m, np.uint64(w))
    for k in range(w):
        h = h * _BASE + words[k : k + m]
    return mix(h)


def shingle_lists(texts: list[str], width: int) -> list[np.ndarray]:
    """Shingle hashes by place, for each text."""
    words, ends = words_of(texts)
    out, at = [], 0
    for end in ends:
        out.append(shingles_of(words[at:end], width))
        at = end
    return out


def seeds(n: int, salt: int = 1) -> np.ndarray:
    return np.random.default_rng(977 * salt).integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
