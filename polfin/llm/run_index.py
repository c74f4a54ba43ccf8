"""A run-length index of many short texts: run-compressed Burrows-Wheeler transform with sampled run ends.

For texts that repeat each other, equal contexts stand together and the transform has
few runs. Kept are, per run, its first row, its symbol, where it maps to, and the text
places of its first and last row; the suffix array itself is only used to build them.
Rows whose suffixes agree in their first ``length`` bytes form a class; only the first
row of each class is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def _ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Dense ranks, given the sorting permutation of the keys."""
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([x[by:], np.full(min(by, len(x)), -1, x.dtype)])[: len(x)]


class RunIndex:
    """Index of ``texts``; each ends in a mark of its own, smaller than any byte, in order of the texts."""

    def __init__(self, texts: Sequence[bytes], length: int):
        self.count, self.length = len(texts), length
        sizes = np.fromiter(map(len, texts), np.int64, self.count)
        self.ends = np.cumsum(sizes + 1) - 1  # places of the marks
        self.starts = self.ends - sizes
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        symbols = joined.astype(np.int64) + self.count
        symbols[self.ends] = np.arange(self.count)
        order, agree = self._suffixes(symbols, int(sizes.max(initial=0)))

        before = np.where(order > 0, order - 1, len(symbols) - 1)
        bwt = symbols[before]
        bwt[bwt < self.count] = -1
        new = np.concatenate([[True], bwt[1:] != bwt[:-1]]) | (bwt == -1)  # marks differ, so none joins a run
        self.heads = np.flatnonzero(new)
        self.symbols = bwt[self.heads]
        self.first_samples = order[self.heads]
        self.last_samples = order[np.append(self.heads[1:], len(bwt)) - 1]
        # Where a run maps to: rows of smaller symbols, plus rows of its symbol in runs before.
        sizes_of_runs = np.diff(np.append(self.heads, len(bwt)))
        by_symbol = np.argsort(self.symbols, kind="stable")
        self.maps_to = np.empty(len(self.heads), np.int64)
        self.maps_to[by_symbol] = np.cumsum(sizes_of_runs[by_symbol]) - sizes_of_runs[by_symbol]
        self.classes = np.flatnonzero(np.concatenate([[True], ~agree]))
        self.rows = len(bwt)

    def _suffixes(self, symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, by doubling; and which neighbours agree in ``length`` bytes.

        Every suffix differs from every other at the mark that ends its text, or before.
        """
        base = int(symbols.max()) + 2
        width, key = 1, symbols + 1
        while width < 4 and 2 * width <= self.length and base**2 < 1 << 62:
            key = key * base + (_shifted(key, width) + 0).clip(0)
            base, width = base**2, 2 * width
        order = np.argsort(key)
        rank = _ranks(order, key)
        half = None
        while width <= longest:
            if width <= self.length < 2 * width:
                half = (rank, width)
            nxt = _shifted(rank, width)
            order = np.argsort(rank * (len(rank) + 1) + nxt + 1)
            rank = _ranks(order, rank, nxt)
            width *= 2
        if half is None and width <= self.length < 2 * width:
            half = (rank, width)
        if half is None:
            return order, np.zeros(max(0, len(order) - 1), bool)
        known, w = half
        rest = _shifted(known, self.length - w)
        same = (known[order[1:]] == known[order[:-1]]) & (rest[order[1:]] == rest[order[:-1]])
        return order, same

    def back(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes one byte longer, and the bytes (-1: there is none, the text starts here)."""
        run = np.searchsorted(self.heads, rows, "right") - 1
        symbol = self.symbols[run]
        return self.maps_to[run] + rows - self.heads[run], np.where(symbol < 0, -1, symbol - self.count)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows, by walking back to a sampled end of a run or the start of a text."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            at = rows[todo]
            run = np.searchsorted(self.heads, at, "right") - 1
            last = np.append(self.heads[1:], self.rows)[run] - 1
            first_hit, last_hit = at == self.heads[run], at == last
            place = np.where(first_hit, self.first_samples[run], self.last_samples[run])
            hit = first_hit | last_hit
            out[todo[hit]] = place[hit] + steps[todo[hit]]
            todo = todo[~hit]
            rows[todo] = self.maps_to[run[~hit]] + at[~hit] - self.heads[run[~hit]]
            steps[todo] += 1
        return out

    def repeated(self) -> list[np.ndarray]:
        """Of each text, at which starts its matching statistic against earlier texts reaches ``length``.

        All texts are streamed through the index from their ends, a byte per step: the row of
        each suffix follows from the row of the next by the runs alone. A class that an
        earlier text visits too is a match. Texts must not repeat a string of ``length``
        bytes within themselves.
        """
        sizes = self.ends - self.starts
        visits_text, visits_start, visits_class = [], [], []
        text = np.arange(self.count)
        row = text.copy()  # marks come first, in order of their texts
        step = 0
        while True:
            live = sizes > step
            if not live.all():
                text, row, sizes = text[live], row[live], sizes[live]
            if not len(text):
                break
            row, _ = self.back(row)
            step += 1
            if step >= self.length:
                visits_text.append(text)
                visits_start.append(sizes - step)
                visits_class.append(np.searchsorted(self.classes, row, "right") - 1)
        if not visits_text:
            return [np.empty(0, np.int64)] * self.count
        t, s, c = (np.concatenate(x) for x in (visits_text, visits_start, visits_class))
        earliest = np.full(len(self.classes), self.count, np.int64)
        np.minimum.at(earliest, c, t)
        hit = earliest[c] < t
        t, s = t[hit], s[hit]
        order = np.lexsort((s, t))
        return np.split(s[order], np.searchsorted(t[order], np.arange(1, self.count)))
