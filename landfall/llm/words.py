"""Words of a text as hashes, by vector operations on its bytes."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse modulo 2**64, to the powers 0 to n - 1 at least."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = tuple(
            np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, np.uint64)))) for b in (_BASE, inverse)
        )
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit depends on every bit; different values stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans_hash(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of the values that doesn't depend on where the span stands."""
    up, down = powers(len(values) + 1)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(values * up[: len(values)])))
    return mixed((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends, in bytes."""
    blank = np.concatenate(([True], _BLANK[np.frombuffer(text, np.uint8)], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """64 bits for each word, equal for equal words."""
    begins, ends = word_spans(text)
    values = np.frombuffer(text, np.uint8)
    out, at = [], 0
    while at < len(begins):  # whole words at a time, so that the powers stay few
        to = max(at + 1, int(np.searchsorted(ends, begins[at] + _PIECE, side="right")))
        low = begins[at]
        piece = values[low : ends[to - 1]].astype(np.uint64) + np.uint64(1)
        out.append(spans_hash(piece, begins[at:to] - low, ends[at:to] - low))
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.uint64)
