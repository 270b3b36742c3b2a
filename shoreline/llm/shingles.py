"""Hashed word shingles of a text, in plain numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

_BLOCK_WORDS = 1 << 15


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a fixed invertible mix)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, grown to the longest block seen."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(2 * size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def byte_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums whose differences, times the inverse power of their start, hash any span of bytes."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], out=sums[1:])
    return sums, inverse


def lowered_words(text: str | None) -> list[bytes]:
    """Words of a text between ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all windows of ``width`` words.

    A text with fewer words has one window, the whole; without words it has none. Long
    texts are hashed in overlapping blocks, so memory follows the block.
    """
    words = lowered_words(text)
    width = min(width, len(words))
    parts = []
    for at in range(0, len(words) - width + 1 if words else 0, _BLOCK_WORDS):
        block = words[at:at + _BLOCK_WORDS + width - 1]
        data = np.frombuffer(b" ".join(block), np.uint8)
        spaces = np.flatnonzero(data == 32)
        sums, inverse = byte_sums(data)
        first = np.concatenate(([0], spaces + 1))[:len(block) - width + 1]
        last = np.concatenate((spaces, [len(data)]))[width - 1:]
        parts.append(mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)))
    if not parts:
        return np.empty(0, np.uint64)
    tokens = np.sort(np.concatenate(parts))
    return tokens[run_starts(tokens)]


def run_starts(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it; the first does."""
    starts = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=starts[1:])
    return starts
