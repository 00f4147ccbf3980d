"""A compressed full-text index over sequences of words.

The Burrows-Wheeler transform of all sequences is kept in a wavelet matrix of packed
bits with popcount directories: about (1 + 1/2) bits a level and word, log2(distinct
words) levels. Backward search gives the interval of suffixes that begin with a pattern;
all searches of one call advance together, a word a step.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Symbols below ``2**levels``, with rank by one walk down the levels."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.n, self.levels = len(symbols), levels
        self.bits, self.counts, self.zeros = [], [], []
        for level in range(levels - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.bits.append(words)
            self.counts.append(ones[:-1].astype(np.int32))
            self.zeros.append(self.n - int(ones[-1]))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``at`` symbols equal to ``symbol`` end in the lowest order."""
        for k in range(self.levels):
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.bits[k][word] & below)
            bit = (symbol >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at


def _suffix_order(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order, by prefix doubling. Each end marker is a symbol of its own,
    so suffixes differ within ``depth`` symbols and the order is total."""
    n = len(text)
    rank = text + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (n + len(ends) + 2) + ahead if step > 1 else rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key)
        ranked = key[order]
        new = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step > 2 * depth:
            return order


class FMIndex:
    """Sequences of symbols 1..n; symbol 0 occurs nowhere and matches nothing."""

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray, copies: np.ndarray | None = None):
        """``sequences`` holds the symbols of all sequences one after the other; ``copies``
        says how often each is there. The suffixes of a copy stand beside those of the
        sequence itself and have the same symbols before them, so they are not sorted."""
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = sequences
        order = _suffix_order(text, ends, int(lengths.max()) + 1)
        last = text[order - 1]  # the text ends with a marker, so it may wrap around
        if copies is not None:
            last = np.repeat(last, np.repeat(copies, lengths + 1)[order])
        top = int(text.max()) + 1
        self.wavelet = WaveletMatrix(last, max(1, int(top).bit_length()))
        below = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=top))))[:-1]
        symbols = np.arange(top)
        self.shift = below - self.wavelet.walk(symbols, np.zeros(top, np.int64))
        self.size = len(last)

    def extend(
        self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put in front."""
        both = np.concatenate((symbol, symbol))
        out = self.wavelet.walk(both, np.concatenate((low, high))) + self.shift[both]
        dead = symbol == 0
        low, high = out[: len(symbol)], out[len(symbol) :]
        return np.where(dead, 0, low), np.where(dead, 0, high)


def repeated_runs(
    index: FMIndex, symbols: np.ndarray, lengths: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of at least ``least`` words that occur twice or more in the index.

    Streams every sequence against the index from its right end, extending leftwards
    while the interval holds two suffixes. Where it stops, no window that holds the
    failed run can repeat, so the search goes on from the last end that avoids it. That
    end is narrowed by short probes of 1, 2, 4, ... words from the place of failure.
    Returns (sequence number, first word, past-the-end word) of each run.
    """
    base = np.cumsum(lengths) - lengths
    n = len(lengths)
    end = lengths.astype(np.int64).copy()  # right end of the current search
    at = end.copy()  # words at:end are matched
    low, high = np.zeros(n, np.int64), np.full(n, index.size, np.int64)
    stop = np.full(n, -1, np.int64)  # a probe succeeds when it has matched this word
    width = np.zeros(n, np.int64)  # words in the probe
    limit = np.zeros(n, np.int64)  # where the search goes on if no probe fails
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    active = np.flatnonzero(end >= least)
    while len(active):
        a = active
        lo, hi = index.extend(symbols[base[a] + at[a] - 1], low[a], high[a])
        good = hi - lo >= 2
        ok, bad = a[good], a[~good]
        low[ok], high[ok] = lo[good], hi[good]
        at[ok] -= 1

        scanning = stop[ok] < 0
        reached = ok[scanning & (at[ok] == 0)]
        if len(reached):
            found.append((reached, at[reached].copy(), end[reached].copy()))
            end[reached] = 0
        passed = ok[~scanning & (at[ok] == stop[ok])]

        probing = stop[bad] >= 0
        narrowed = bad[probing]  # words at-1:end fail, so ends must lie before this one
        failed = bad[~probing]
        if len(failed):
            long = failed[end[failed] - at[failed] >= least]
            if len(long):
                found.append((long, at[long].copy(), end[long].copy()))
            limit[failed] = np.minimum(end[failed] - 1, at[failed] - 1 + least)
            stop[failed] = at[failed] - 1
            width[failed] = 1
        width[passed] *= 2
        wide = passed[stop[passed] + width[passed] > limit[passed]]
        again = np.concatenate((narrowed, wide))
        if len(again):
            end[narrowed] = end[narrowed] - 1
            end[wide] = limit[wide]
            stop[again] = -1
        probe = np.concatenate((failed, np.setdiff1d(passed, wide, assume_unique=True)))
        if len(probe):
            end[probe] = stop[probe] + width[probe]
            over = probe[end[probe] > limit[probe]]
            end[over] = limit[over]
            stop[over] = -1
            again = np.concatenate((again, over))
        fresh = np.concatenate((again, probe))
        at[fresh] = end[fresh]
        low[fresh], high[fresh] = 0, index.size
        done = np.concatenate((reached, again))
        done = done[end[done] < least]
        end[done] = 0
        active = active[end[active] > 0]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))
