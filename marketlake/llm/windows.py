"""Fingerprints of all fixed-length byte windows of a text, doubled from one byte up, and their minima."""

from __future__ import annotations

import numpy as np

GRAM = 32
_SEED = np.random.default_rng(5)
_BYTE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_STEP = _SEED.integers(0, 1 << 63, 64, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def pair(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """Name of two neighbouring names."""
    h = a * _STEP[step]
    h += b
    h ^= h >> np.uint64(29)
    h *= _STEP[step + 32]
    return h


def window_names(raw: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all ``GRAM``-byte and all ``width``-byte windows; raw holds at least ``width`` bytes."""
    h, span, level, gram = _BYTE[raw], 1, 0, None
    while 2 * span <= width:
        h = pair(h[:-span], h[span:], level)
        span, level = 2 * span, level + 1
        if span == GRAM:
            gram = h
    if span < width:  # two overlapping windows cover the rest
        h = pair(h[:len(h) - (width - span)], h[width - span:], level)
    return gram, h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])
