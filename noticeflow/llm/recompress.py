"""Recompression of word sequences: runs and pairs of symbols are named, round by round.

After Jeż ("Recompression: a simple and powerful technique for word equations", 2013).
The symbols of round 0 are words. A run round names every maximal run of one symbol; a
pair round splits the symbols in a left and a right half by a coin that depends on the
symbol alone, and names every left symbol that is followed by a right one together with
it. A name is a hash of what it names. So every task of every round gives the same names
without asking the others, and equal word sequences get equal symbols, but for a margin
at their ends, where neighbours outside decide.

``lo`` and ``hi`` bound the words that decided a symbol: wherever these words occur, the
symbol occurs. A symbol is *interior* to a window when all words that decided it lie in
the window. Equal windows have equal interior symbols, so a window with an interior
symbol that occurs once in the corpus is unique.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import mixed

# Order of rounds: r names runs, p pairs. A symbol of the top round stands for some four
# words and was decided by some thirteen, so that a window of twenty has two inside.
ROUNDS = "rppppp"
_GAP = 64


@dataclass
class Symbols:
    """Symbols in order, by words: deciding words are lo (inclusive) to hi (exclusive)."""

    name: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    edge: np.ndarray  # the next symbol belongs to another document


def _name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))))


def _neighbours(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """The lo of the symbol to the left and the hi of the one to the right.

    Where a document ends, that there is no neighbour is itself something to know: the
    bound lies one word outside.
    """
    lo = np.concatenate([s.lo[:1] - 1, s.lo[:-1]])
    hi = np.concatenate([s.hi[1:], s.hi[-1:] + 1])
    starts = np.concatenate([[True], s.edge[:-1]])[: len(lo)]
    return np.where(starts, s.lo - 1, lo), np.where(s.edge, s.hi + 1, hi)


def name_runs(s: Symbols) -> Symbols:
    same = np.concatenate([(s.name[1:] == s.name[:-1]) & ~s.edge[:-1], [False]])
    left, right = _neighbours(s)
    first = np.flatnonzero(~np.concatenate([[False], same[:-1]]))
    last = np.flatnonzero(~same)
    length = (last - first + 1).astype(np.uint64)
    name = s.name[first]
    name = np.where(length > 1, _name(name, length), name)
    return Symbols(name, left[first], right[last], s.edge[last])


def name_pairs(s: Symbols, number: int) -> Symbols:
    coin = mixed(s.name + np.uint64(number + 1)) & np.uint64(1) == 1
    joins = np.concatenate([coin[:-1] & ~coin[1:] & ~s.edge[:-1], [False]])
    second = np.concatenate([[False], joins[:-1]])
    left, right = _neighbours(s)
    # A left symbol that stays alone looked to its right, a right one to its left.
    lo = np.where(coin, s.lo, left)
    hi = np.where(coin, right, s.hi)
    first = np.flatnonzero(~second)
    joined = joins[first]
    ends = first + joined
    name = np.where(joined, _name(s.name[first], s.name[ends]), s.name[first])
    return Symbols(name, lo[first], np.where(joined, s.hi[ends], hi[first]), s.edge[ends])


class Recompressed:
    """The rounds over documents laid end to end, and what they say about windows.

    ``hashes`` are word hashes, ``lengths`` the words of each document. An *entry* is
    what a window is tested by: each interior symbol of the top round, or, where there
    is none, the rightmost interior symbol of the highest round that has one. Entries
    have a name, a document number and a place in it (word times two, odd for the
    second kind).
    """

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray, window: int):
        self.window = window
        lengths = lengths.astype(np.int64)
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        self.begins = np.cumsum(lengths) - lengths
        at = np.arange(len(hashes)) + self.document * _GAP
        last = np.zeros(len(hashes), bool)
        full = lengths > 0
        last[(self.begins + lengths - 1)[full]] = True
        levels = [Symbols(hashes, at, at + 1, last)]
        if len(hashes):
            for number, kind in enumerate(ROUNDS):
                below = levels[-1]
                levels.append(name_runs(below) if kind == "r" else name_pairs(below, number))
        ends = (self.begins + lengths)[self.document]
        self.starts = np.flatnonzero(np.arange(len(hashes)) + window <= ends)
        self.at = at[self.starts]
        self._top_entries(levels[-1])
        self._other_entries(levels)

    def _interior(self, s: Symbols, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last symbol interior to the windows at ``at``; none if last < first."""
        last = np.searchsorted(s.hi, at + self.window, side="right") - 1
        return np.searchsorted(s.lo, at, side="left"), last

    def _top_entries(self, top: Symbols) -> None:
        fits = top.hi - top.lo <= self.window
        self.top = Symbols(top.name[fits], top.lo[fits], top.hi[fits], top.edge[fits])
        self.first, self.last = self._interior(self.top, self.at)
        used = np.zeros(len(self.top.name) + 1, np.int64)
        has = self.last >= self.first
        np.add.at(used, self.first[has], 1)
        np.add.at(used, self.last[has] + 1, -1)
        self.used = np.flatnonzero(np.cumsum(used)[:-1] > 0)
        self.has = has

    def _other_entries(self, levels: list[Symbols]) -> None:
        open_ = np.flatnonzero(~self.has)
        name, mark = np.zeros(len(open_), np.uint64), np.zeros(len(open_), np.int64)
        todo = np.arange(len(open_))
        for depth in range(len(levels) - 2, -1, -1):
            if not len(todo):
                break
            first, last = self._interior(levels[depth], self.at[open_[todo]])
            good = last >= first
            name[todo[good]] = levels[depth].name[last[good]]
            mark[todo[good]] = last[good] * len(levels) + depth
            todo = todo[~good]
        run = np.concatenate([[True], (mark[1:] != mark[:-1]) | (np.diff(open_) != 1)])[: len(open_)]
        self.open, self.run = open_, np.cumsum(run) - 1
        self.run_first = open_[np.flatnonzero(run)]
        self.run_name = name[np.flatnonzero(run)] ^ np.uint64(0x5555555555555555)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Name, document number and place of every entry."""
        word = self.top.lo[self.used]
        number = np.searchsorted(self.begins + np.arange(len(self.begins)) * _GAP, word, "right") - 1
        place = (word - self.begins[number] - number * _GAP) * 2
        start = self.starts[self.run_first]
        other = self.document[start]
        return (
            np.concatenate([self.top.name[self.used], self.run_name]),
            np.concatenate([number, other]),
            np.concatenate([place, (start - self.begins[other]) * 2 + 1]),
        )

    def windows(self, shared: np.ndarray) -> np.ndarray:
        """First words of the windows of which all entries are shared (one flag per entry)."""
        top = np.zeros(len(self.top.name) + 1, np.int64)
        top[self.used + 1] = ~shared[: len(self.used)]
        alone = np.cumsum(top)
        kept = np.zeros(len(self.starts), bool)
        has = np.flatnonzero(self.has)
        kept[has] = alone[self.last[has] + 1] == alone[self.first[has]]
        kept[self.open] = shared[len(self.used) :][self.run]
        return self.starts[kept]
