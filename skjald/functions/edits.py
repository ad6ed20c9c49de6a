"""Edit distances of two sequences by bit vectors: a column of the table of distances is a few whole numbers.

A column holds where distances rise and where they fall from one row to the next, a bit a row;
the next column follows from it by an addition and some bit operations. The rows are taken in
strips of STRIP, each of which hands its last row's steps to the one below, so that
neither the length of a sequence nor the number of its different symbols has a limit and
memory grows with the sum of both lengths. Symbols are whatever Python can hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

STRIP = 4096
#: Bits of a table up to which its columns are kept to walk back; larger ones are halved.
KEPT = 1 << 25


def _strip(part: Sequence, b: Sequence, steps: list[int], kept: list | None = None) -> tuple[list[int], int, int]:
    """The steps of the last row of a strip, and where its last column rises and falls; `steps` are those of the row above."""
    places: dict = {}
    for i, x in enumerate(part):
        places[x] = places.get(x, 0) | 1 << i
    full, last = (1 << len(part)) - 1, 1 << len(part) - 1
    rise, fall, out = full, 0, []
    for x, step in zip(b, steps, strict=True):
        same = places.get(x, 0)
        either = same | fall
        if step < 0:
            same |= 1
        path = (((same & rise) + rise) ^ rise) | same
        up, down = fall | full & ~(path | rise), rise & path
        out.append(1 if up & last else -1 if down & last else 0)
        above_up, above_down = up << 1 | (step > 0), down << 1 | (step < 0)
        rise, fall = (above_down | ~(either | above_up)) & full, above_up & either & full
        if kept is not None:
            kept.append((rise, fall, above_up, above_down))
    return out, rise, fall


def _last_column(a: Sequence, b: Sequence) -> np.ndarray:
    """Distances of all beginnings of `a` from the whole of `b`."""
    steps, column = [1] * len(b), [np.array([len(b)])]
    for low in range(0, len(a), STRIP):
        part = a[low : low + STRIP]
        steps, rise, fall = _strip(part, b, steps)
        bits = [np.unpackbits(np.frombuffer(x.to_bytes(-(-len(part) // 8), "little"), np.uint8), bitorder="little")[: len(part)].astype(np.int64) for x in (rise, fall)]
        column.append(bits[0] - bits[1])
    return np.cumsum(np.concatenate(column))


def _trimmed(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """Without what both begin and end with, which a cheapest alignment leaves alone."""
    n = min(len(a), len(b))
    k = next((i for i in range(n) if a[i] != b[i]), n)
    a, b, n = a[k:], b[k:], n - k
    k = next((i for i in range(n) if a[-1 - i] != b[-1 - i]), n)
    return a[: len(a) - k], b[: len(b) - k]


def distance(a: Sequence, b: Sequence) -> int:
    a, b = _trimmed(a, b)
    steps = [1] * len(b)
    for low in range(0, len(a), STRIP):
        steps, _, _ = _strip(a[low : low + STRIP], b, steps)
    return len(a) + sum(steps)


def _walked(a: Sequence, b: Sequence) -> tuple[int, int, int]:
    """counts() by the way back through all columns: matches first, then substitutions, deletions and insertions."""
    kept: list = []
    _strip(a, b, [1] * len(b), kept)
    i, j, swapped, added, gone = len(a), len(b), 0, 0, 0
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            continue
        rise, fall, up, down = kept[j - 1]
        bit = 1 << i - 1
        down_here = bool(rise & bit) - bool(fall & bit)  # from the row above
        across = bool(up & bit) - bool(down & bit)  # along the row above
        if down_here + across == 1:
            i, j, swapped = i - 1, j - 1, swapped + 1
        elif down_here == 1:
            i, gone = i - 1, gone + 1
        else:
            j, added = j - 1, added + 1
    return swapped, added + j, gone + i


def counts(a: Sequence, b: Sequence) -> tuple[int, int, int]:
    """Substitutions, insertions and deletions of a cheapest alignment that makes `a` into `b`."""
    a, b = _trimmed(a, b)
    if not a or not b:
        return 0, len(b), len(a)
    if len(a) <= STRIP and len(a) * len(b) <= KEPT:
        return _walked(a, b)
    if len(a) == 1:
        return int(a[0] not in b), len(b) - 1, 0
    if len(b) == 1:
        return int(b[0] not in a), 0, len(a) - 1
    middle = len(b) // 2
    at = int((_last_column(a, b[:middle]) + _last_column(a[::-1], b[middle:][::-1])[::-1]).argmin())
    left, right = counts(a[:at], b[:middle]), counts(a[at:], b[middle:])
    return left[0] + right[0], left[1] + right[1], left[2] + right[2]
