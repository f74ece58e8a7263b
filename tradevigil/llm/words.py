"""Words of whole texts as bytes and numpy arrays.

Two kinds of words: runs of letters and digits, where every character outside ASCII
counts as a letter (`ALNUM`), and runs of anything but white space (`SPACED`). Only A-Z is
lower-cased. Both work on UTF-8, where bytes below 0x80 stand for themselves alone.
"""

from __future__ import annotations

import numpy as np

_FOLDED = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
ALNUM = bytes(
    f if f >= 0x80 or 0x30 <= f <= 0x39 or 0x61 <= f <= 0x7A else 0x20 for f in _FOLDED
)
SPACED = bytes(0x20 if f == 0x20 or 0x09 <= f <= 0x0D else f for f in _FOLDED)

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def fold(text: str | None, kind: bytes) -> bytes:
    """UTF-8 of the text, A-Z lower-cased, every separator a space; NULL is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(kind)


def split(text: str | None, kind: bytes) -> list[bytes]:
    return fold(text, kind).split()


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word of folded bytes."""
    filled = np.zeros(len(data) + 2, dtype=np.int8)
    filled[1:-1] = np.frombuffer(data, dtype=np.uint8) != 0x20
    step = np.diff(filled)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: polynomial in its bytes, from differences of prefix sums."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(data)
    values = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_BASE, n), out=sums[1:])
    down = _powers(_BASE_INVERSE, n)[starts]
    return mix((sums[ends] - sums[starts]) * down)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash per run of `n` words (none if there are fewer words)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for j in range(n):
        total = total * _GRAM + hashes[j : j + count]
    return mix(total)
