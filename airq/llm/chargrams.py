"""Hashed character n-gram counts of whole texts, in numpy."""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np

_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def hashed(points: np.ndarray, n: int, dims: int) -> np.ndarray:
    """A bucket below ``dims`` (a power of two) for each run of ``n`` code points, 1 to 3."""
    if len(points) < n:
        return np.empty(0, dtype=np.uint32)
    m = len(points) - n + 1
    h = points[:m] * _MIX[0]
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * _MIX[k] + points[k : k + m]
    h ^= h >> np.uint32(13)
    h *= _MIX[2]
    return h >> np.uint32(33 - dims.bit_length())


def counted(parts: list[np.ndarray], dims: int) -> np.ndarray:
    """One row of bucket counts per part."""
    out = np.empty((len(parts), dims), dtype=np.float32)
    for k, p in enumerate(parts):
        out[k] = np.bincount(p, minlength=dims)
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
