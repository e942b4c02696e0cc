"""Hamming search among sets of 64-bit codes by a hierarchy over their Gray order.

Codes are sorted by the rank they have in the Gray order, where neighbours tend to share
most bits. Runs of ``FAN`` neighbours form a node that holds the bits all of them share,
as a mask and a pattern; runs of nodes form nodes above, up to one root per set. The
bits in which the masked patterns of two nodes differ are differences of every pair of
codes below them; going down, masks widen and these differences add up. A pair of nodes
is dropped as a whole once they exceed the limit, and taken as a whole once all bits
that are not shared could not lift them above it.
"""

from __future__ import annotations

import numpy as np

FAN = 16
_PAIRS_AT_ONCE = 1 << 18


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Level:
    def __init__(self, mask: np.ndarray, pattern: np.ndarray, group: np.ndarray):
        self.mask, self.pattern, self.group = mask, pattern, group


def _above(level: _Level) -> tuple[_Level, np.ndarray]:
    """The nodes over runs of a level, and where their children begin."""
    n = len(level.group)
    begins = np.flatnonzero(np.concatenate([[True], level.group[1:] != level.group[:-1]]))
    sizes = np.diff(np.append(begins, n))
    within = np.arange(n) - np.repeat(begins, sizes)
    first = np.flatnonzero(within % FAN == 0)
    ones = np.bitwise_and.reduceat(level.pattern, first)
    some = np.bitwise_or.reduceat(level.pattern, first)
    mask = np.bitwise_and.reduceat(level.mask, first) & ~(ones ^ some)
    return _Level(mask, ones & mask, level.group[first]), np.append(first, n)


def _expand(a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of pairs of nodes; of a node with itself, each pair once."""
    na, nb = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
    each = na * nb
    row = np.repeat(np.arange(len(a)), each)
    at = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    x, y = starts[a][row] + at // nb[row], starts[b][row] + at % nb[row]
    keep = (a[row] != b[row]) | (x <= y)
    return x[keep], y[keep]


def linked(codes: np.ndarray, group: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indexes that link, within each group, all codes at ``limit`` bits or fewer.

    Every pair within the limit ends up connected, directly or through others; pairs taken
    as a whole give a chain instead of all pairs.
    """
    order = np.lexsort((gray_rank(codes), group))
    codes, group = codes[order], group[order]
    if len(codes) < 2:
        return order[:0], order[:0]
    full = np.full(len(codes), np.uint64(2**64 - 1))
    levels, starts = [_Level(full, codes, group)], []
    while len(levels[-1].group) > len(np.unique(levels[-1].group)):
        upper, begins = _above(levels[-1])
        levels.append(upper)
        starts.append(begins)
    # The first code below each node of each level.
    firsts = [np.arange(len(codes))]
    for begins in starts:
        firsts.append(firsts[-1][begins[:-1]])
    ends = [np.append(f[1:], len(codes)) for f in firsts]
    root = np.arange(len(levels[-1].group))
    todo = [(len(levels) - 1, root, root)]
    out_a, out_b = [], []
    while todo:
        depth, a, b = todo.pop()
        if len(a) > _PAIRS_AT_ONCE:
            half = len(a) // 2
            todo += [(depth, a[:half], b[:half]), (depth, a[half:], b[half:])]
            continue
        level = levels[depth]
        shared = level.mask[a] & level.mask[b]
        sure = np.bitwise_count((level.pattern[a] ^ level.pattern[b]) & shared)
        near = sure <= limit
        whole = near & (sure + np.bitwise_count(~shared) <= limit)
        x, y = a[whole], b[whole]
        apart = x != y
        out_a.append(firsts[depth][x[apart]])
        out_b.append(firsts[depth][y[apart]])
        if depth:
            for node in x[~apart].tolist():
                chain = np.arange(firsts[depth][node], ends[depth][node])
                out_a.append(chain[:-1])
                out_b.append(chain[1:])
            near &= ~whole
            step = max(1, _PAIRS_AT_ONCE // FAN**2)
            a, b = a[near], b[near]
            for at in range(0, len(a), step):
                todo.append((depth - 1, *_expand(a[at : at + step], b[at : at + step], starts[depth - 1])))
    return order[np.concatenate(out_a)], order[np.concatenate(out_b)]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` indexes reaches through the links."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
