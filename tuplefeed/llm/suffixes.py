"""Suffix arrays and common prefixes in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes, and the rank of each, by Larsson-Sadakane refinement.

    Suffixes start sorted by as many symbols as fit a word. Each round doubles the sorted
    length, but only suffixes that still share their rank with others are sorted again. An end
    of the text sorts before every symbol. ``symbols`` are integers from 0.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = int(symbols.max() + 1).bit_length()
    width = max(1, 62 // bits)
    padded = np.zeros(n + width, np.int64)
    padded[:n] = symbols
    padded[:n] += 1
    key = np.zeros(n, np.int64)
    for j in range(width):
        key <<= bits
        key |= padded[j : j + n]
    order = np.argsort(key, kind="stable")
    changes = np.empty(n, bool)
    changes[0] = True
    np.not_equal(key[order[1:]], key[order[:-1]], out=changes[1:])
    first = np.maximum.accumulate(np.where(changes, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order] = first
    rank[n] = -1
    alone = changes & np.append(changes[1:], True)
    open_at = np.flatnonzero(~alone)
    sorted_to = width
    while len(open_at):
        suffix = order[open_at]
        group, then = rank[suffix], rank[np.minimum(suffix + sorted_to, n)]
        by = np.argsort(group * (n + 1) + then + 1, kind="stable")
        suffix, group, then = suffix[by], group[by], then[by]
        order[open_at] = suffix
        changes = np.empty(len(suffix), bool)
        changes[0] = True
        changes[1:] = (group[1:] != group[:-1]) | (then[1:] != then[:-1])
        rank[suffix] = np.maximum.accumulate(np.where(changes, open_at, 0))
        open_at = open_at[~(changes & np.append(changes[1:], True))]
        sorted_to *= 2
    return order, rank[:n]


def common_prefixes(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int) -> np.ndarray:
    """Kasai's lengths, up to ``most``: what the suffix at each place of the order shares with the
    one before it.

    Kasai walks the text and keeps the length less one for the next suffix. Here every suffix is
    a lane of its own, extended symbol by symbol only while it still matches; a lane starts from
    the bound that the walk gives, taken over strides of the text that are doubled.
    """
    n = len(symbols)
    lcp = np.zeros(n, np.int64)  # by text position
    if n < 2:
        return lcp
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([symbols, np.zeros(1, symbols.dtype)])

    def extend(lanes: np.ndarray) -> None:
        lanes = lanes[before[lanes] >= 0]
        while len(lanes):
            a, b = lanes + lcp[lanes], before[lanes] + lcp[lanes]
            same = (a < n) & (b < n) & (lcp[lanes] < most)
            same &= padded[np.minimum(a, n)] == padded[np.minimum(b, n)]
            lanes = lanes[same]
            lcp[lanes] += 1

    stride = 1 << max(0, int(most).bit_length() - 1)
    extend(np.arange(0, n, stride))
    while stride > 1:
        half = stride // 2
        lanes = np.arange(half, n, stride)
        lcp[lanes] = np.where(before[lanes] >= 0, np.maximum(lcp[lanes - half] - half, 0), 0)
        extend(lanes)
        stride = half
    return lcp[order]
