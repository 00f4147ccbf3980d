"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

The vocabulary file is one of the ``tokenizers`` library with a BPE model on byte-level
symbols and word ends; its path is a parameter.

Encoding of one word: merges go by rank, leftmost first. What follows a token can change
it only through a chain of merges of rising rank: a merge takes the last common symbol
``a`` away, and only a later merge whose right part begins with ``a`` can reach
further to the left. The longest such chain of the merge list (``lookahead``), in
symbols, is therefore enough: once so many symbols are known after a token's end, the
token is stable and is given out, and what follows it is encoded as if it began there.
So a word of any length needs a buffer of a few times that length.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

WORD_END = "</w>"
#: Pieces and their bytes remembered by one task; beyond, those not met again are forgotten.
REMEMBERED, REMEMBERED_BYTES = 200_000, 1 << 23
#: Bytes up to which the ends of many words are merged side by side.
SHORT = 64
#: Words whose ends are merged side by side.
LANES = 1 << 13
_ID_BITS = 24
_ID_MASK = (1 << _ID_BITS) - 1
_NO_PAIR = 1 << 60
_RARE = re.compile("[\x1c-\x1f\x85\xa0]")  # engines differ on whether these are white space


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Longest chain of influence to the left, in symbols."""
    reach: dict[str, int] = {}
    most = 0
    for left, right in merges:
        right = right.removesuffix(WORD_END)
        behind = max((reach.get(right[:k], 0) for k in range(1, len(right) + 1)), default=0)
        far = len(left) + behind
        reach[left] = max(far, reach.get(left, 0))
        most = max(most, far)
    return most


class Vocabulary:
    """Tables of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        ids = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = [ids[s] for s in symbols]
        self.final = [ids[s + WORD_END] for s in symbols]
        self.size = {i: len(t.removesuffix(WORD_END)) for t, i in ids.items()}
        # rank and result of a pair in one number, so that the smallest is the next merge
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            self.pairs.setdefault((ids[a], ids[b]), rank << _ID_BITS | ids[a + b])
        self.lookahead = sufficient_lookahead(merges)
        self.inner_of, self.final_of = np.array(self.inner), np.array(self.final)
        self._fill_table()

    def merged(self, symbols: list[int]) -> list[int]:
        """All merges of a short run of symbols."""
        if len(symbols) > 48:
            return self._merged_long(symbols)
        get = self.pairs.get
        found = list(map(get, zip(symbols, symbols[1:]), repeat(_NO_PAIR)))
        while found and (best := min(found)) != _NO_PAIR:
            i = found.index(best)
            new = best & _ID_MASK
            symbols[i : i + 2] = [new]
            del found[i]
            if i:
                found[i - 1] = get((symbols[i - 1], new), _NO_PAIR)
            if i < len(found):
                found[i] = get((new, symbols[i + 1]), _NO_PAIR)
        return symbols

    def merged_many(self, words: list[bytes]) -> list[bytes]:
        """All merges of many short whole words at once; ids as bytes."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(size.max())
        flat = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(width) < size[:, None]
        grid = np.full((len(words), width), -1, np.int64)
        grid[place] = self.inner_of[flat]
        last = np.cumsum(size) - 1
        grid[np.arange(len(words)), size - 1] = self.final_of[flat[last]]
        if width > 1:
            found = self._look_up(grid[:, :-1], grid[:, 1:])
            todo = np.arange(len(words))
            live, ranks = grid, found
            column = np.arange(width)
            while True:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(todo)), at]
                on = best != _NO_PAIR
                if not on.all():
                    grid[todo] = live
                    todo, live, ranks, at, best = todo[on], live[on], ranks[on], at[on], best[on]
                    if not len(todo):
                        break
                row = np.arange(len(todo))
                source = np.minimum(column + (column > at[:, None]), width - 1)
                live = np.take_along_axis(live, source, 1)
                live[:, -1] = -1
                live[row, at] = best & _ID_MASK
                if width == 2:
                    ranks = np.full((len(todo), 1), _NO_PAIR)
                    continue
                ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], width - 2), 1)
                ranks[:, -1] = _NO_PAIR
                ranks[row, at] = self._look_up(live[row, at], live[row, np.minimum(at + 1, width - 1)])
                ranks[row[at + 1 >= width], at[at + 1 >= width]] = _NO_PAIR
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self._look_up(live[left, at[left] - 1], live[left, at[left]])
        left = grid >= 0
        ids = grid[left].astype("<u4").tobytes()
        ends = np.cumsum(left.sum(1)) * 4
        return [ids[a:b] for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist())]

    def _look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and result of pairs, from an open hash table; -1 pairs with nothing."""
        key = (a << _ID_BITS) | b
        slot = self._slot(key)
        out = np.full(key.shape, _NO_PAIR)
        asked = np.nonzero((a >= 0) & (b >= 0))
        key, slot = key[asked], slot[asked]
        value = np.full(len(key), _NO_PAIR)
        rest = np.arange(len(key))
        while len(rest):
            there = self.table_key[slot[rest]]
            hit = there == key[rest]
            value[rest[hit]] = self.table_value[slot[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
            slot[rest] = (slot[rest] + 1) & (len(self.table_key) - 1)
        out[asked] = value
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def _fill_table(self) -> None:
        self.table_bits = max(8, (4 * len(self.pairs)).bit_length())
        self.table_key = np.full(1 << self.table_bits, -1, np.int64)
        self.table_value = np.full(1 << self.table_bits, _NO_PAIR)
        keys = np.array([a << _ID_BITS | b for a, b in self.pairs], np.int64)
        for key, slot, value in zip(keys.tolist(), self._slot(keys).tolist(), self.pairs.values()):
            while self.table_key[slot] >= 0:
                slot = (slot + 1) & (len(self.table_key) - 1)
            self.table_key[slot], self.table_value[slot] = key, value

    def _merged_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap: n log n for n symbols."""
        pairs, n = self.pairs, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (hit := pairs.get((symbols[i], symbols[j]))) is not None:
                heapq.heappush(heap, (hit >> _ID_BITS, i, symbols[i], symbols[j], hit & _ID_MASK))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            if symbols[i] != a or (j := after[i]) >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s >= 0]


class Transducer:
    """Takes the bytes of many words bit by bit and gives out tokens once they are stable.

    Each word has a lane, whose state is the bytes held back: at most ``limit``, however
    long the word is.
    """

    def __init__(self, vocabulary: Vocabulary, lanes: int):
        self.v = vocabulary
        self.held = [b""] * lanes
        self.limit = 4 * vocabulary.lookahead + 64

    def feed(self, portions: Iterable[bytes]) -> dict[int, list[int]]:
        """A portion for every lane, of any length; by lane, the tokens that are stable now."""
        given = {}
        held = list(portions)
        for lane, (before, raw) in enumerate(zip(self.held, held, strict=True)):
            if len(before) + len(raw) > self.limit:
                given[lane] = list(self._fed(lane, raw))
                held[lane] = self.held[lane]
            elif before:
                held[lane] = before + raw
        self.held = held
        return given

    def _fed(self, lane: int, raw: bytes) -> Iterator[int]:
        for at in range(0, len(raw), self.limit):
            self.held[lane] += raw[at : at + self.limit]
            if len(self.held[lane]) > self.limit:
                yield from self._stable(lane)

    def _stable(self, lane: int) -> Iterator[int]:
        # The last byte may be the word's last, which is another symbol: it stays out.
        held = self.held[lane]
        known = len(held) - 1
        at = 0
        for t in self.v.merged([self.v.inner[b] for b in held[:known]]):
            if at + self.v.size[t] > known - self.v.lookahead:
                break
            at += self.v.size[t]
            yield t
        self.held[lane] = held[at:]

    def close(self) -> list[bytes]:
        """The rest of every lane, at its word's end, as bytes of ids."""
        out = [b""] * len(self.held)
        short = sorted((k for k, raw in enumerate(self.held) if 0 < len(raw) <= SHORT), key=lambda k: len(self.held[k]))
        for at in range(0, len(short), LANES):
            lanes = short[at : at + LANES]
            for lane, ids in zip(lanes, self.v.merged_many([self.held[k] for k in lanes]), strict=True):
                out[lane] = ids
        for lane, raw in enumerate(self.held):
            if len(raw) > SHORT:
                symbols = [self.v.inner[b] for b in raw[:-1]] + [self.v.final[raw[-1]]]
                out[lane] = np.array(self.v.merged(symbols), "<u4").tobytes()
        self.held = [b""] * len(self.held)
        return out


def transduced(vocabulary: Vocabulary, words: list[bytes], portion: int = 1 << 16) -> list[bytes]:
    """Ids of many words, all fed to one transducer portion by portion."""
    machine = Transducer(vocabulary, len(words))
    given: dict[int, list[int]] = {}
    for at in range(0, max(map(len, words), default=0), portion):
        for lane, ids in machine.feed([w[at : at + portion] for w in words]).items():
            given.setdefault(lane, []).extend(ids)
    out = machine.close()
    for lane, ids in given.items():
        out[lane] = np.array(ids, "<u4").tobytes() + out[lane]
    return out


_OTHER, _LETTER, _NUMBER, _BLANK = range(4)


def _character_classes() -> np.ndarray:
    """What the file's split pattern takes the characters below 256 for."""
    kinds = np.full(256, _OTHER, np.uint8)
    for c in map(chr, range(256)):
        kind = unicodedata.category(c)[0]
        kinds[ord(c)] = _BLANK if c.isspace() else {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    return kinds


_CLASS = _character_classes()
#: The endings that the split pattern takes together with the apostrophe before them.
_ONE, _TWO = np.frombuffer(b"stmd", np.uint8), (b"re", b"ve", b"ll")
_APOSTROPHE = ord("'")


def piece_starts(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pieces begin in lower-case characters below 256: at each run of letters, each
    number and each run of other characters; an apostrophe that is such a run by itself takes
    the ending along that follows it. The last character must be a blank."""
    begins = np.ones(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
    begins &= kind != _BLANK
    at = np.flatnonzero((data == _APOSTROPHE) & begins)
    at = at[kind[at + 1] == _LETTER] + 1
    two = np.zeros(len(at), bool)
    for a, b in _TWO:
        two |= (data[at] == a) & (data[at + 1] == b)
    some = two | np.isin(data[at], _ONE)
    at, length = at[some], np.where(two[some], 2, 1)
    begins[at] = False
    after = at + length
    begins[after] |= kind[after] == _LETTER
    return begins


class Encoder:
    """Texts to ids, as the library does for this file, as little-endian unsigned 32-bit bytes.

    The pieces of many texts are put into one dictionary; those that are not remembered
    go through the transducer, and the texts' ids are gathered from the dictionary's.
    """

    def __init__(self, path: str):
        self.path, self.v = path, Vocabulary(path)
        self.specials = re.compile(
            "(" + "|".join(map(re.escape, self.v.special)) + ")" if self.v.special else "(?!)()"
        )
        # pieces, how many ids each has, all ids in that order, and which pieces were met lately
        self.known = pa.array([], pa.large_binary())
        self.size, self.ids, self.met = np.zeros(0, np.int64), np.zeros(0, "<u4"), np.zeros(0, bool)

    @cached_property
    def library(self) -> Tokenizer:
        """For the normaliser and the split of texts that are not plain; loaded with the first one."""
        return Tokenizer.from_file(self.path)

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where distinct pieces are in the memory; new ones go through the transducer first."""
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        self.met[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        if len(new):
            some = pieces.take(pa.array(new))
            told = transduced(self.v, some.to_pylist())
            at[new] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, some])
            self.size = np.concatenate((self.size, np.fromiter(map(len, told), np.int64, len(told)) >> 2))
            self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(told), "<u4")))
            self.met = np.concatenate((self.met, np.zeros(len(new), bool)))
        return at

    def _forget(self) -> None:
        many = len(self.known) > REMEMBERED
        if not many and self.known.nbytes <= REMEMBERED_BYTES:
            return
        keep = self.met & (pc.binary_length(self.known).to_numpy() <= SHORT)
        if keep.sum() > REMEMBERED // 2:
            keep[:] = False
        self.ids = self.ids[np.repeat(keep, self.size)]
        self.known = self.known.filter(pa.array(keep))
        self.size, self.met = self.size[keep], np.zeros(int(keep.sum()), bool)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; give some hundred thousand characters at a time or more."""
        # the parts in order: plain texts (to be split together), pieces, ids of special tokens
        plain: list[bytes] = []
        parts: list[list[tuple[int, object]]] = []
        for text in texts:
            parts.append(list(self._parts(text or "", plain)))
        pieces, bounds = _split(plain)
        listed = [p for text in parts for kind, some in text if kind == _PIECES for p in some]
        coded = pa.concat_arrays([pieces, pa.array(listed, pa.large_binary())]).dictionary_encode()
        at = self._places(coded.dictionary)
        begin = np.cumsum(self.size) - self.size
        which = at[coded.indices.to_numpy()]
        many = self.size[which]
        end = np.concatenate((np.zeros(1, np.int64), np.cumsum(many)))
        flat = self.ids[np.arange(end[-1]) + np.repeat(begin[which] - end[:-1], many)].tobytes()
        self._forget()

        out, at_listed = [], len(pieces)
        for text in parts:
            given = []
            for kind, some in text:
                if kind == _IDS:
                    given.append(some)
                    continue
                if kind == _PLAIN:
                    lo, hi = bounds[some], bounds[some + 1]
                else:
                    lo, hi = at_listed, at_listed + len(some)
                    at_listed = hi
                given.append(flat[4 * end[lo] : 4 * end[hi]])
            out.append(b"".join(given))
        return out

    def _parts(self, text: str, plain: list[bytes]) -> Iterator[tuple[int, object]]:
        """The number of a plain text, the pieces of one split by the library's rules, or ids."""
        for part in self.specials.split(text):
            if part in self.v.special:
                yield _IDS, np.array([self.v.special[part]], "<u4").tobytes()
            elif part and self._simple(part):
                plain.append(part.lower().encode("latin-1"))
                yield _PLAIN, len(plain) - 1
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                code = self.v.byte_of
                split = self.library.pre_tokenizer.pre_tokenize_str(normal)
                yield _PIECES, [bytes(map(code.__getitem__, p)) for p, _ in split]

    def _simple(self, text: str) -> bool:
        """Whether plain string methods give what the library's normaliser does."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not _RARE.search(text)


_PLAIN, _PIECES, _IDS = range(3)


def _split(plain: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts of characters below 256, in UTF-8, and where each text's begin."""
    data = np.frombuffer(b" ".join([*plain, b""]) if plain else b" ", np.uint8)
    kind = _CLASS[data]
    begins = piece_starts(data, kind)
    text = np.cumsum([0, *(len(t) + 1 for t in plain)])
    first = np.flatnonzero(begins)
    bounds = np.searchsorted(first, text)
    used = kind != _BLANK
    # characters from 128 on take two bytes of UTF-8
    width = used.astype(np.int64) + (used & (data >= 128))
    place = np.cumsum(width) - width
    size = int(width.sum())
    raw = data[used]
    if size > len(raw):
        raw = np.frombuffer(raw.tobytes().decode("latin-1").encode(), np.uint8)
    offsets = np.concatenate((place[first], [size])).astype(np.int64)
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))]
    )
    return pieces, bounds


class TokenJoiner:
    """Ids to text as the library's decode does for a file without a decoder: the tokens
    themselves, joined by one blank. State: whether a token came before."""

    def __init__(self, vocabulary: Vocabulary):
        self.tokens = vocabulary.tokens
        self.begun = False

    def feed(self, ids: list[int]) -> str:
        text = " ".join(map(self.tokens.__getitem__, ids))
        if ids and self.begun:
            text = " " + text
        self.begun = self.begun or bool(ids)
        return text


class TextDecoder:
    """Ids to readable text, incrementally: bytes of a character may come in several
    tokens, and a word's end becomes one blank before the next word."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.blank = False

    def feed(self, ids: Iterable[int]) -> str:
        raw, special, byte_of = [], set(self.v.special.values()), self.v.byte_of
        for i in ids:
            token = self.v.tokens[i]
            if self.blank:
                raw.append(b" ")
            if i in special:
                raw.append(token.encode())
                self.blank = True
                continue
            self.blank = token.endswith(WORD_END)
            raw.append(bytes(byte_of[c] for c in token.removesuffix(WORD_END)))
        return self.utf8.decode(b"".join(raw))

    def close(self) -> str:
        return self.utf8.decode(b"", True)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
