"""A run-length index (r-index) of one block of text, and matching statistics streamed against it.

The index keeps the Burrows-Wheeler transform as runs (one symbol and one start each) with the text positions
of the suffixes at both ends of every run. A pattern is streamed from right to left: while its next symbol
continues the match, the row moves by the LF mapping over the runs; where it does not, the match is restarted at
the nearest run end of that symbol, above or below, whose sampled position gives the longer extension.
"""

from __future__ import annotations

import numpy as np

from tradewind.llm.common import prefix_hashes, substring_hashes


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling from three symbols; ``text`` holds integers from 0 to 2**20."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(3, np.int64)])
    key, step = (padded[:-3] << 42) | (padded[1:-2] << 21) | padded[2:-1], 3
    while n:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if new[-1] == n - 1 or step >= n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key, step = rank * (n + 1) + second, 2 * step
    return np.zeros(0, np.int64)


class RunLengthIndex:
    """``pieces`` are arrays of symbols from 1 on; each is closed by the separator 0, which no pattern contains."""

    def __init__(self, pieces: list[np.ndarray]):
        text = np.concatenate([x for p in pieces for x in (p.astype(np.int64), np.zeros(1, np.int64))])
        order = suffix_array(text)
        bwt = text[order - 1]
        self.n, self.sums = len(text), prefix_hashes(text)
        self.starts = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.ends = np.concatenate([self.starts[1:], [self.n]]) - 1
        self.symbols = bwt[self.starts]
        # the suffixes at both ends of every run
        self.at_start, self.at_end = order[self.starts], order[self.ends]
        # runs by symbol and place; their rows in that order are the rows of the suffixes one symbol longer
        self.by_symbol = np.argsort(self.symbols, kind="stable")
        self.keys = self.symbols[self.by_symbol] * (self.n + 1) + self.starts[self.by_symbol]
        width = (self.ends - self.starts + 1)[self.by_symbol]
        self.to = np.empty(len(width), np.int64)
        self.to[self.by_symbol] = np.cumsum(width) - width

    def matching_statistics(self, patterns: list[np.ndarray]) -> list[np.ndarray]:
        """For every position of every pattern, the length of the longest match with the text that starts there."""
        m = len(patterns)
        lengths = np.array([len(p) for p in patterns])
        longest = int(lengths.max(initial=0))
        padded = np.zeros((m, longest), np.int64)  # aligned at their right ends
        for k, p in enumerate(patterns):
            padded[k, longest - len(p) :] = p
        pattern_sums = prefix_hashes(padded.ravel())
        row = np.zeros(m, np.int64)  # a row of the transform whose suffix starts with the match
        place = np.full(m, -1, np.int64)  # where that suffix stands in the text, -1 without a match
        match = np.zeros(m, np.int64)
        out = np.zeros((m, longest), np.int64)
        for t in range(longest - 1, -1, -1):
            live = np.flatnonzero(longest - lengths <= t)
            symbol = padded[live, t]
            run = np.searchsorted(self.starts, row[live], "right") - 1
            goes_on = (self.symbols[run] == symbol) & (place[live] >= 0)
            same = live[goes_on]
            row[same] += self.to[run[goes_on]] - self.starts[run[goes_on]]
            place[same] -= 1
            match[same] += 1
            who = live[~goes_on]
            if len(who):
                row[who], place[who], match[who] = self._restart(symbol[~goes_on], row[who], match[who], pattern_sums, who * longest + t + 1)
            out[live, t] = match[live]
        return [out[k, longest - lengths[k] :] for k in range(m)]

    def _restart(self, symbol: np.ndarray, row: np.ndarray, most: np.ndarray, sums: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, place, length) of the match that starts with ``symbol`` at the run end of it above or below the row,
        whichever agrees longer with the pattern from ``at`` on."""
        after = np.searchsorted(self.keys, symbol * (self.n + 1) + row, "right")
        best = [np.zeros(len(row), np.int64), np.full(len(row), -1, np.int64), np.zeros(len(row), np.int64)]
        for k, ends, sample in ((after, self.starts, self.at_start), (after - 1, self.ends, self.at_end)):
            run = self.by_symbol[np.clip(k, 0, len(self.by_symbol) - 1)]
            own = np.flatnonzero((k >= 0) & (k < len(self.by_symbol)) & (self.symbols[run] == symbol))
            run = run[own]
            suffix = sample[run]
            length = 1 + self._agreement(suffix, sums, at[own], most[own])
            better = length > best[2][own]
            own, run = own[better], run[better]
            best[0][own] = self.to[run] + ends[run] - self.starts[run]
            best[1][own], best[2][own] = suffix[better] - 1, length[better]
        return tuple(best)

    def _agreement(self, suffix: np.ndarray, sums: np.ndarray, at: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How far the text from ``suffix`` equals the pattern from ``at``, up to ``most``: by halving, with hashes."""
        low, high = np.zeros(len(suffix), np.int64), np.minimum(most, self.n - suffix)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = substring_hashes(self.sums, suffix, suffix + middle) == substring_hashes(sums, at, at + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low
