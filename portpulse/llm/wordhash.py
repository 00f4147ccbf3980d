"""Hashes of words, word n-grams and windows, computed on whole buffers with numpy.

All hashes are 64-bit, deterministic and the same on every executor. A word is a run
of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text; UTF-8 never uses those bytes
inside a longer sequence, so the split is that of the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A random value per byte, so that the polynomial does not act on the bytes themselves.
_BYTE = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) for b in range(256)], np.uint64)
_ODD = pow(int(MULTIPLIER), -1, 1 << 64)
#: Bytes hashed at once; the arrays take about 40 bytes for each.
CHUNK = 1 << 20
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier, and of its inverse, modulo 2**64."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", MULTIPLIER), ("down", np.uint64(_ODD))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"][:n], _tables["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values without visible structure (a splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word."""
    edge = np.diff(np.concatenate(([1], _SPACE[data], [1])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


@dataclass
class Words:
    """The words of some texts: ``hashes`` of all, of which text i has first[i]:first[i + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    #: First and past-the-end byte of each word, and first byte of each text, in one buffer.
    begin: np.ndarray
    end: np.ndarray
    text_begin: np.ndarray

    def __post_init__(self) -> None:
        up, _ = _powers(len(self.hashes) + 1)
        total = np.cumsum(self.hashes * up[: len(self.hashes)], dtype=np.uint64)
        self._sum = np.concatenate((np.zeros(1, np.uint64), total))

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def spans(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """A hash of the words start:start + length, equal for equal sequences of words."""
        _, down = _powers(len(self.hashes) + 1)
        raw = (self._sum[start + length] - self._sum[start]) * down[start]
        return mix(raw + np.asarray(length).astype(np.uint64) * MULTIPLIER)

    def starts(self, length: int) -> np.ndarray:
        """Where a run of ``length`` words within one text begins."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.hashes))
        return np.flatnonzero(left >= length)


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and past-the-end byte of each word of one buffer."""
    begin, end = _spans(data)
    up, down = _powers(len(data) + 1)
    total = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64))
    )
    raw = (total[end] - total[begin]) * down[begin]
    return mix(raw + (end - begin).astype(np.uint64) * MULTIPLIER), begin, end


def words_of(texts: Iterable[str | None]) -> Words:
    """Words of the texts in their order; a null text has none."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    parts, at = [], 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        if to < len(data):  # cut after white space; a longer word makes a longer chunk
            back = np.flatnonzero(_SPACE[data[at:to]])
            if len(back):
                to = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(_SPACE[data[to:]])
                to += int(ahead[0]) + 1
        h, b, e = _hash_words(data[at:to])
        parts.append((h, b + at, e + at))
        at = to
    hashes, begin, end = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(hashes, np.searchsorted(begin, bounds), begin, end, bounds[:-1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` neighbours, the leftmost one of equals."""
    if len(x) < width:
        return np.zeros(0, np.int64)
    have, least, place = 1, x, np.arange(len(x))
    while have < width:
        step = min(have, width - have)
        right = least[step:] < least[: len(least) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        least = x[place]
        have += step
    return place


def slices(texts: list, limit: int = CHUNK) -> Iterator[slice]:
    """Neighbouring texts of about ``limit`` characters together; a longer text is alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") + 1
        if size and size + n > limit:
            yield slice(at, i)
            at, size = i, 0
        size += n
    if at < len(texts):
        yield slice(at, len(texts))
