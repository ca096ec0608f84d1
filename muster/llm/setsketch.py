"""SetSketch registers: mergeable, locality-sensitive minima on an exponential scale.

Each element has an exponentially distributed value for each register, drawn
from its hash; a register keeps the least, as the truncated logarithm
floor(1 - log_b(value)).  An element's values are drawn in increasing order,
each for another register, so drawing stops once a value exceeds all minima so
far.  The union of two sets has the larger register of each pair.  (Ertl,
"SetSketch: Filling the Gap between MinHash and HyperLogLog", VLDB 2021.)
"""

from __future__ import annotations

import numpy as np

from muster.llm.shingles import mixed, odd_numbers

REGISTERS = 256  # a power of two
BASE = 1.001
RATE = 20.0
LARGEST = (1 << 16) - 1
BAND = 5  # registers

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOG_BASE = np.log(BASE)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers (unsigned 16-bit) for each set of hashes, none empty."""
    m = REGISTERS
    least = np.full(len(sets) * m, np.inf)
    hashes = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)) * m, [len(s) for s in sets])
    spread = mixed(hashes ^ _STEP)
    first, step = spread & np.uint64(m - 1), (spread >> np.uint64(32)) | np.uint64(1)
    value = np.zeros(len(hashes))
    offsets = np.arange(1, m + 1, dtype=np.uint64) * _STEP
    for j in range(m):
        drawn = mixed(hashes + offsets[j])
        uniform = ((drawn >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        value -= np.log(uniform) / (RATE * (m - j))
        # An odd step visits every register once.
        register = ((first + np.uint64(j) * step) & np.uint64(m - 1)).astype(np.int64)
        np.minimum.at(least, row + register, value)
        most = least.reshape(-1, m).max(axis=1)
        going = value < most[row // m]
        if not going.any():
            break
        hashes, row, first, step, value = (x[going] for x in (hashes, row, first, step, value))
    scale = np.floor(1 - np.log(least) / _LOG_BASE)
    return np.clip(scale, 0, LARGEST).astype(np.uint16).reshape(-1, m)


_PLACES = odd_numbers(BAND, 2)


def bands(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key for each whole band of each sketch."""
    n = REGISTERS // BAND
    parts = sketches[:, : n * BAND].reshape(len(sketches), n, BAND).astype(np.uint64) + np.uint64(1)
    totals = (parts * _PLACES).sum(axis=2, dtype=np.uint64)
    return mixed(totals + np.arange(1, n + 1, dtype=np.uint64) * _STEP).view(np.int64)


def _larger(x: np.ndarray) -> np.ndarray:
    """Probability that a register is larger, from the difference it is about."""
    return -np.log1p(-x * (BASE - 1) / BASE) / _LOG_BASE


def unlikely(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray, least: float, ratio: float = 30.0) -> np.ndarray:
    """Pairs of sketches that a similarity of ``least`` or more cannot explain.

    The counts of registers that are larger in the one, in the other and equal
    have a joint likelihood in the similarity, given the sets' sizes.  A pair is
    ruled out if its most likely similarity is smaller and e^ratio times as
    likely as any from ``least`` on.
    """
    above, below = (one > other).sum(axis=1), (one < other).sum(axis=1)
    equal = one.shape[1] - above - below
    u = (n_one / (n_one + n_other))[:, None]
    v = 1 - u
    highest = np.minimum(u / v, v / u)
    steps = np.linspace(0, 1, 65)
    low = np.minimum(least, highest) * steps  # up to the least allowed
    high = np.minimum(least, highest) + (highest - np.minimum(least, highest)) * steps

    def likelihood(similarity: np.ndarray) -> np.ndarray:
        larger = np.maximum(_larger(u - v * similarity), 1e-300)
        smaller = np.maximum(_larger(v - u * similarity), 1e-300)
        same = np.maximum(1 - larger - smaller, 1e-300)
        counts = (c[:, None] for c in (above, below, equal))
        return sum(c * np.log(p) for c, p in zip(counts, (larger, smaller, same))).max(axis=1)

    return likelihood(low) - likelihood(high) > ratio
