"""Resampling by a windowed sinc in phases, so that tones above the new half rate don't fold back."""

from __future__ import annotations

from functools import lru_cache
from math import gcd

import numpy as np

#: Zero crossings of the sinc on either side, and the shape of its Kaiser window: some 100 dB.
CROSSINGS, BETA = 48, 10.0
#: The filter's edge as a share of the lower half rate.
EDGE = 0.94
#: Values that are held at a time.
CHUNK = 65_536
#: New samples of a block, at least, and the most phases that a block may have: beyond, a matrix of them would be large.
BLOCK, PHASES = 128, 1_024


@lru_cache(maxsize=4)
def phases(old: int, new: int) -> np.ndarray:
    """Weights of the old samples around a new one: a row for each place that it can have between two of them."""
    up = new // gcd(old, new)
    scale = min(1.0, new / old) * EDGE
    half = int(np.ceil(CROSSINGS / scale))
    at = np.arange(-half + 1, half + 1) - np.arange(up)[:, None] / up
    weights = np.sinc(at * scale) * np.i0(BETA * np.sqrt(np.clip(1 - (at / half) ** 2, 0, None)))
    return weights / weights.sum(1, keepdims=True)


@lru_cache(maxsize=4)
def block(old: int, new: int) -> tuple[np.ndarray, int]:
    """The phases of a block of new samples as a matrix, from the old samples around the block; and how many old ones a block takes."""
    table, common = phases(old, new), gcd(old, new)
    up, down, width = new // common, old // common, table.shape[1]
    times = -(-BLOCK // up)
    matrix = np.zeros((times * down + width, times * up))
    for k in range(times * up):
        at = k * down // up
        matrix[at : at + width, k] = table[k * down % up]
    return matrix, times * down


def resample(samples: np.ndarray, old: int, new: int) -> np.ndarray:
    """The samples at the rate `new`: ceil(n * new / old) of them; the first and last one go on beyond the ends."""
    if old == new or not len(samples):
        return samples.astype(np.float64)
    n = -(-len(samples) * new // old)
    out = np.empty(n)
    near = lambda low, high: samples[np.clip(np.arange(low, high), 0, len(samples) - 1)].astype(np.float64)
    up, down = new // gcd(old, new), old // gcd(old, new)
    if up > PHASES:  # rates without a large common measure
        table = phases(old, new)
        half, step = table.shape[1] // 2, max(1, CHUNK // table.shape[1])
        for low in range(0, n, step):
            place = np.arange(low, min(low + step, n), dtype=np.int64) * down
            first = int(place[0] // up) - half + 1
            around = near(first, int(place[-1] // up) + half + 1)[(place // up - half + 1 - first)[:, None] + np.arange(2 * half)]
            out[low : low + step] = (around * table[place % up]).sum(1)
        return out
    matrix, taken = block(old, new)
    width, size = matrix.shape
    half, step = phases(old, new).shape[1] // 2, max(1, CHUNK // width)
    for low in range(0, -(-n // size), step):
        high = min(low + step, -(-n // size))
        rows = np.lib.stride_tricks.sliding_window_view(near(low * taken - half + 1, (high - 1) * taken - half + 1 + width), width)[::taken]
        out[low * size : high * size] = (np.ascontiguousarray(rows) @ matrix).ravel()[: n - low * size]
    return out
