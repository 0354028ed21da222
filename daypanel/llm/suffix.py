"""Sorting suffixes by comparing hashes.

Prefix sums of a polynomial hash give the hash of any stretch of a buffer in one
step, so the longest common extension of two suffixes is found by binary search
over its length: a comparison costs the logarithm of the length. A bottom-up
mergesort ranks each element in the run next to its own by such comparisons; all
elements of all groups take a step at once. Neighbours of the sorted order are
then compared byte by byte, and a group in which hashes misled is sorted by its
bytes instead."""

from __future__ import annotations

from functools import cache

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    return tuple(np.r_[np.uint64(1), np.cumprod(np.full(n - 1, b, np.uint64), dtype=np.uint64)]
                 for b in (BASE, _INVERSE))


@cache
def letters() -> np.ndarray:
    """A random number for each byte."""
    return np.random.default_rng(1).integers(1, 1 << 64, 256, dtype=np.uint64)


def mixed(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


class Hashes:
    """Hashes of stretches of a buffer."""

    def __init__(self, buffer: np.ndarray):
        size = 1 << max(10, int(len(buffer) + 1).bit_length())
        up, self.down = powers(size)
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(letters()[buffer] * up[:len(buffer)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.down[start]

    def every(self, length: int) -> np.ndarray:
        """Of all stretches of one length."""
        n = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The longest common extension of the suffixes at a and b, at most ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def sort_suffixes(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the elements by group and, within a group, by the bytes
    [start, start + length); and how many bytes each has in common with the one
    before it, -1 at the first of a group. ``group`` must not decrease."""
    n, hashes = len(start), Hashes(buffer)
    order = np.arange(n)
    first = np.searchsorted(group, group, "left")
    last = np.searchsorted(group, group, "right")

    def compare(a, b):
        """Below 0 where suffix a sorts before b, 0 where they are equal."""
        most = np.minimum(length[a], length[b])
        same = hashes.extension(start[a], start[b], most)
        ends = same == most
        at_a, at_b = start[a] + np.where(ends, 0, same), start[b] + np.where(ends, 0, same)
        return np.where(ends, length[a] - length[b], buffer[at_a].astype(np.int64) - buffer[at_b])

    # A byte at the end keeps empty elements inside the buffer.
    buffer = np.r_[buffer, np.uint8(0)]
    width, largest = 1, int((last - first).max()) if n else 0
    while width < largest:
        inside = np.arange(n) - first
        run = inside // width
        beside = first + (run ^ 1) * width
        at = np.flatnonzero((beside < last) & (last - first > width))
        low, high = beside[at].copy(), np.minimum(beside[at] + width, last[at])
        left = run[at] % 2 == 0
        own = order[at]
        open_ = np.arange(len(at))
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            sign = compare(order[middle], own[open_])
            # Equal elements of the left run come first.
            before = np.where(left[open_], sign < 0, sign <= 0)
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        merged = order.copy()
        merged[first[at] + (run[at] // 2 * 2) * width + (inside[at] - run[at] * width) + (low - beside[at])] = own
        order, width = merged, 2 * width

    common = np.full(n, -1, np.int64)
    for _ in range(2):
        pair = np.flatnonzero(group[1:] == group[:-1]) + 1
        a, b = order[pair - 1], order[pair]
        most = np.minimum(length[a], length[b])
        common[pair] = hashes.extension(start[a], start[b], most)
        wrong = _misled(buffer, start[a], start[b], length[a], length[b], common[pair])
        if not wrong.any():
            return order, common
        for g in np.unique(group[pair[wrong]]):
            own = np.flatnonzero(group == g)
            order[own] = sorted(own.tolist(), key=lambda i: buffer[start[i]:start[i] + length[i]].tobytes())
        common[pair] = [_common(buffer[start[x]:start[x] + length[x]], buffer[start[y]:start[y] + length[y]])
                        for x, y in zip(order[pair - 1].tolist(), order[pair].tolist(), strict=True)]
        return order, common
    return order, common


def _misled(buffer, a, b, length_a, length_b, common) -> np.ndarray:
    """Pairs whose first ``common`` bytes differ, whose next bytes agree, or
    which are out of order."""
    wrong = np.zeros(len(a), bool)
    for at in range(0, len(a), 4096):
        part = slice(at, at + 4096)
        width = int(common[part].max(initial=0))
        steps = np.arange(width)[None, :]
        inside = steps < common[part][:, None]
        left = np.where(inside, buffer[np.minimum(a[part][:, None] + steps, len(buffer) - 1)], 0)
        right = np.where(inside, buffer[np.minimum(b[part][:, None] + steps, len(buffer) - 1)], 0)
        wrong[part] = (left != right).any(axis=1)
    ends = (common == length_a) | (common == length_b)
    after_a, after_b = buffer[np.where(ends, a, a + common)], buffer[np.where(ends, b, b + common)]
    return wrong | np.where(ends, length_a > length_b, after_a >= after_b)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n
