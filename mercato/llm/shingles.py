"""Sets of hashed word shingles of a text."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np

# A-Z lower-cased, ASCII white space as a space, other bytes as they are.
_LOWER = bytes(
    32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_U = np.uint64
SLAB = 1 << 19  # bytes whose words are hashed at a time
_BASE = 0xD1342543DE82EF95
_BYTE = np.random.default_rng(64).integers(1, 1 << 62, 256, dtype=np.uint64) * _U(2) + _U(1)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, base, _U)]))


_UP, _DOWN = (_powers(b, SLAB) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def _slabs(data: bytes) -> list[bytes]:
    """Pieces of about SLAB bytes, cut at spaces only."""
    out, at = [], 0
    while len(data) - at > SLAB:
        cut = data.rfind(b" ", at, at + SLAB)
        if cut <= at:
            cut = data.find(b" ", at + SLAB)
            if cut < 0:
                break
        out.append(data[at:cut])
        at = cut
    out.append(data[at:])
    return out


def runs_of(
    slab: bytes, breaks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """Start and end of each run of bytes that aren't ``breaks`` (a mask by byte), and a hash.

    The hash of stretches (starts, ends) comes from prefix sums over the bytes, without a
    loop over them.
    """
    codes = np.frombuffer(slab, np.uint8)
    n = len(codes)
    up, down = (_UP, _DOWN) if n <= SLAB else (
        _powers(b, n) for b in (_BASE, pow(_BASE, -1, 1 << 64))
    )
    letter = np.zeros(n + 2, np.int8)
    letter[1:-1] = ~breaks[codes]
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    sums = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[codes] * up[:n], out=sums[1:])
    return edges[::2], edges[1::2], lambda start, end: mix((sums[end] - sums[start]) * down[start])


def words_of(slab: bytes, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each run of bytes that aren't ``breaks``."""
    start, end, sums = runs_of(slab, breaks)
    return start, end, sums(start, end)


def break_mask(breaks: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(breaks)] = True
    return mask


_SPACE = break_mask(b" ")


def word_hashes(text: str) -> np.ndarray:
    slabs = _slabs(text.encode().translate(_LOWER))
    return np.concatenate([words_of(slab, _SPACE)[2] for slab in slabs])


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def factors(words: int) -> np.ndarray:
    return np.random.default_rng(words).integers(1, 1 << 62, words, dtype=np.uint64) * _U(2) + _U(1)


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``words``-word shingles.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    hashes = word_hashes(text)
    n = len(hashes)
    weights = factors(words)
    if n < words:
        if not n:
            return hashes
        return mix((hashes * weights[:n]).sum(keepdims=True) + _U(n))
    total = hashes[: n - words + 1] * weights[0]
    for j in range(1, words):
        total += hashes[j : n - words + 1 + j] * weights[j]
    total = mix(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def class_id(tokens: np.ndarray) -> int:
    """A signed 64-bit hash of the set, its size included."""
    total = mix(tokens).sum(keepdims=True) + np.array([len(tokens)], _U) * _U(0x9E3779B97F4A7C15)
    return int(mix(total).view(np.int64)[0])
