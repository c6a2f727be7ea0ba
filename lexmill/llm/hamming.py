"""Bit-sliced comparison of 64-bit codes: one machine word holds the same bit of 64 codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITS, CHUNK, STEP = 64, 1 << 15, 8
ALL = ~np.uint64(0)


def _planes(codes: np.ndarray, lanes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Plane b, word w, bit i: bit b of the code in lane 64 w + i; and which lanes hold a code."""
    planes, lane = np.empty((BITS, words), np.uint64), np.zeros(words * 64, np.uint8)
    for b in range(BITS):
        lane[lanes] = (codes >> np.uint64(b)).astype(np.uint8) & 1
        planes[b] = np.packbits(lane, bitorder="little").view(np.uint64)
    lane[lanes] = 1
    return planes, np.packbits(lane, bitorder="little").view(np.uint64)


def _add(counter: list[np.ndarray], bit: np.ndarray, place: int, over: np.ndarray) -> None:
    """Add 2^place where ``bit`` is set; what no longer fits goes to ``over``."""
    for k in range(place, len(counter)):
        counter[k], bit = counter[k] ^ bit, counter[k] & bit
    over |= bit


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counter is above ``radius``."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], ALL)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            same = same & counter[k]
        else:
            more, same = more | (same & counter[k]), same & ~counter[k]
    return more


def close(codes: np.ndarray, groups: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j, of codes of one group that differ in at most ``radius`` bits, in chunks.

    ``groups`` is sorted. Each group has lanes of its own. A query's planes are all ones or all zeros, so a XOR
    gives one bit of 64 distances at once; three planes go through a carry-save adder into vertical counters. A block whose
    64 lanes are all above the radius is dropped from the rest.
    """
    if len(codes) == 0:
        return
    codes = np.ascontiguousarray(codes, np.uint64)
    first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    sizes = np.diff(np.append(first, len(codes)))
    wide = -(-sizes // 64)
    word_of_group = np.cumsum(wide) - wide
    place = np.arange(len(codes)) - np.repeat(first, sizes)
    lanes = np.repeat(word_of_group, sizes) * 64 + place
    words = int(wide.sum())
    planes, taken = _planes(codes, lanes, words)
    of_lane = np.zeros(words * 64, np.int64)
    of_lane[lanes] = np.arange(len(codes))
    own = lanes // 64
    count = np.repeat(word_of_group + wide, sizes) - own
    ends = np.cumsum(count)
    start = 0
    while start < len(codes):
        base = ends[start] - count[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        query = np.repeat(np.arange(start, stop), count[start:stop])
        word = own[query] + np.arange(len(query)) - np.repeat(ends[start:stop] - count[start:stop] - base, count[start:stop])
        start = stop
        counter = [np.zeros(len(query), np.uint64) for _ in range(max(1, int(radius).bit_length()))]
        over = ~taken[word]
        pending: list[np.ndarray] = []
        for b in range(BITS):
            asked = np.uint64(0) - ((codes[query] >> np.uint64(b)) & np.uint64(1))
            pending.append(planes[b, word] ^ asked)
            if len(pending) == 3:
                x, y, z = pending
                half = x ^ y
                _add(counter, half ^ z, 0, over)
                carry = (x & y) | (half & z)
                if len(counter) > 1:
                    _add(counter, carry, 1, over)
                else:
                    over |= carry
                pending = []
            if b % STEP == STEP - 1 and not pending:
                alive = (over | _above(counter, radius)) != ALL
                if not alive.all():
                    query, word, over = query[alive], word[alive], over[alive]
                    counter = [c[alive] for c in counter]
        for x in pending:
            _add(counter, x, 0, over)
        within = ~(over | _above(counter, radius))
        found = np.flatnonzero(within)
        if len(found):
            bits = np.unpackbits(np.ascontiguousarray(within[found]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(bits)
            i, j = query[found[row]], of_lane[word[found[row]] * 64 + lane]
            yield i[i < j], j[i < j]


def labels(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest position reachable from each of n positions by the pairs."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    return label
