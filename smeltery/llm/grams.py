"""Hashed character n-grams and words of texts, by whole arrays."""

from __future__ import annotations

import numpy as np

_STEP, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    """The code points of a text, lower-cased, each run of white space one blank, blanks around it."""
    return np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, size: int, bits: int) -> np.ndarray:
    """The n-grams of one size in order, each as a number below ``2 ** bits``."""
    count = len(points) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint32)
    mixed = np.full(count, np.uint64(size), np.uint64)
    for i in range(size):
        mixed = mixed * _STEP + points[i : i + count]
    mixed ^= mixed >> np.uint64(31)
    return ((mixed * _SPREAD) >> np.uint64(64 - bits)).astype(np.uint32)


def word_hashes(words: list[str], bits: int) -> np.ndarray:
    """Each word as a number below ``2 ** bits``, the same in every process."""
    if not words:
        return np.zeros(0, np.uint32)
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    lengths = np.array([len(r) for r in raw], np.int64)
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    # A sum over spread (position, byte) pairs, so that no word needs a loop of its own.
    spread = (flat + np.uint64(1)) * _SPREAD + (place.astype(np.uint64) + np.uint64(1)) * _STEP
    spread ^= spread >> np.uint64(29)
    spread *= np.uint64(0xBF58476D1CE4E5B9)
    spread ^= spread >> np.uint64(32)
    sums = np.zeros(len(raw), np.uint64)
    some = lengths > 0
    sums[some] = np.add.reduceat(spread, starts[some]) if some.any() else 0
    return ((sums * _SPREAD) >> np.uint64(64 - bits)).astype(np.uint32)
