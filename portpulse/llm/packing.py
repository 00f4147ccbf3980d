"""Packing token sequences of unequal length into as few sequences of one length as possible.

The lengths form a histogram of at most ``capacity`` bins, whatever the number of
documents; only the histogram reaches the driver. It is packed as the configuration
linear program: patterns (multisets of lengths that fit a sequence), each used a number
of times. Multiplicative weights hold a price per length, raised where demand is left and
lowered where it is met; a knapsack dynamic program under these prices gives the best
pattern around each of the longest lengths left. First only patterns without waste are
taken, each for a share of what demand allows. Where that does not reach the bound by
total length, the program is solved fractionally: the patterns worth most under the
prices, wasteful or not, are used in small steps, the steps are averaged, and prices
against the best pattern's worth bound the number of sequences from below. Rounding takes
uses down to whole numbers and packs the rest best fit, longest first, also into the room
that patterns leave; the plan with the fewest sequences is kept. All of this depends on
the capacity, not on the number of documents.

The plan says for each length which of its pieces, by their number, go where. Pieces are
numbered on the cluster: inside each written part, then shifted by the counts of earlier
parts, so the most common length is never gathered in one place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.bpe import CHARACTERS
from portpulse.llm.common import Batches, batch, mapped, table
from portpulse.llm.tokens import encoder
from portpulse.llm.wordhash import slices

CAPACITY = 2048
#: Rounds of pricing, learning rate of the prices, and share of the possible uses taken.
ROUNDS = 300
#: Pieces left over that are packed best fit in any case.
FEW = 64
RATE = 0.5
SHARE = 0.9
#: Shares of the program's solution that are tried in rounding; best fit packs the rest.
ROUNDING = (1.0, 0.9, 0.75, 0.5, 0.25)
#: Accuracies of the fractional program, one after the other, and steps for one pricing.
ACCURACY = (0.2, 0.1, 0.05, 0.02, 0.01)
STEPS = 20
#: A plan this close to the bound is kept without further rounds.
CLOSE = 0.002

Pattern = tuple[tuple[int, ...], int]  # lengths, longest first, and the number of uses


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Which length to take at each room left, for the most valuable filling."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    worth = prices[lengths]
    ascending = lengths  # longest last, so that ties prefer the longest by the reversed argmax
    for room in range(1, capacity + 1):
        n = np.searchsorted(ascending, room, "right")
        best[room], take[room] = best[room - 1], -1
        if n:
            value = worth[:n] + best[room - ascending[:n]]
            at = n - 1 - int(value[::-1].argmax())
            if value[at] > best[room] + 1e-12:
                best[room], take[room] = value[at], ascending[at]
    return take


def _filling(take: np.ndarray, room: int) -> list[int]:
    out = []
    while room > 0:
        if take[room] > 0:
            out.append(int(take[room]))
            room -= out[-1]
        else:
            room -= 1
    return out


def _best_fit(demand: np.ndarray, capacity: int, begun: Sequence[Pattern] = ()) -> list[Pattern]:
    """Best fit, longest first, over what is left of the histogram, into ``begun`` too.

    Works on numbers of equal sequences, so its cost depends on the lengths, not on the
    number of pieces.
    """
    rooms: list[int] = []
    holds: dict[int, list[Pattern]] = defaultdict(list)

    def put(pattern: tuple[int, ...], uses: int, room: int) -> None:
        if room and not holds[room]:
            insort(rooms, room)
        holds[room].append((pattern, uses))

    for pattern, uses in begun:
        put(pattern, uses, capacity - sum(pattern))
    for length in range(capacity, 0, -1):
        todo = int(demand[length])
        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, uses = holds[room].pop()
                if not holds[room]:
                    rooms.pop(at)
                each = min(room // length, todo)
                filled = min(uses, todo // each)
                if filled < uses:
                    put(pattern, uses - filled, room)
            else:
                room, pattern, each = capacity, (), min(capacity // length, todo)
                filled = todo // each
            put(pattern + (length,) * each, filled, room - each * length)
            todo -= filled * each
    packed: dict[tuple[int, ...], int] = defaultdict(int)
    for patterns in holds.values():
        for pattern, uses in patterns:
            packed[pattern] += uses
    return list(packed.items())


def plan(histogram: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[Pattern]:
    """Patterns and uses that cover ``histogram`` (pieces per length) exactly."""
    exact = _exact_fillings(histogram, capacity, rounds)
    best: list[Pattern] = []
    for share in ROUNDING:
        whole = [(p, int(u * share)) for p, u in exact.items()]
        best = _fewer(best, _completed(whole, histogram, capacity))
    fewest = -(-int(histogram @ np.arange(capacity + 1)) // capacity)
    if _sequences(best) > fewest:
        for uses in _averaged(histogram, capacity, rounds, _sequences(best)):
            best = _fewer(best, _rounded(uses, histogram, capacity))
    return best


def _sequences(patterns: list[Pattern]) -> int:
    return sum(u for _, u in patterns)


def _fewer(one: list[Pattern], other: list[Pattern]) -> list[Pattern]:
    return other if not one or _sequences(other) < _sequences(one) else one


def _completed(whole: list[Pattern], histogram: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns with whole uses, and best fit for the pieces they leave."""
    rest = histogram.astype(np.int64).copy()
    whole = [(p, u) for p, u in whole if u]
    for pattern, uses in whole:
        np.subtract.at(rest, list(pattern), uses)
    return _best_fit(rest, capacity, whole)


def _rounded(
    uses: dict[tuple[int, ...], float], histogram: np.ndarray, capacity: int
) -> list[Pattern]:
    """Fractional uses as whole ones: rounded down, then one more by the largest fractions."""
    rest = histogram.astype(np.int64).copy()
    whole: dict[tuple[int, ...], int] = defaultdict(int)

    def use(pattern: tuple[int, ...], wanted: int) -> None:
        kinds, counts = np.unique(pattern, return_counts=True)
        n = min(wanted, int((rest[kinds] // counts).min()))
        if n > 0:
            whole[pattern] += n
            rest[kinds] -= n * counts

    for pattern, u in sorted(uses.items(), key=lambda e: -e[1]):
        use(pattern, int(u + 1e-9))
    for pattern, u in sorted(uses.items(), key=lambda e: -(e[1] % 1)):
        use(pattern, int(u + 1e-9) - whole.get(pattern, 0) + 1)
    return _completed(list(whole.items()), histogram, capacity)


def _averaged(histogram: np.ndarray, capacity: int, rounds: int, known: int):
    """Fractional solutions of the program (uses per pattern), each better than the last.

    Weights fall with the share of a length's demand that has been met; a step uses the
    patterns worth most and meets at most a small share of any demand. The uses of all
    steps, divided by the least share met, meet every demand. No solution has fewer
    sequences than the worth of all pieces over that of the best pattern.
    """
    lengths = np.flatnonzero(histogram)
    asked = histogram[lengths].astype(float)
    place = np.zeros(capacity + 1, np.int64)
    place[lengths] = np.arange(len(lengths))
    pool: dict[tuple[int, ...], int] = {}
    kinds, counts = np.zeros((0, 1), np.int64), np.zeros((0, 1))
    log_weight, prices, bound = np.zeros(len(lengths)), np.zeros(capacity + 1), 0.0
    for accuracy in ACCURACY:
        uses, met, best = np.zeros(len(pool)), np.zeros(len(lengths)), np.inf
        for _ in range(rounds // len(ACCURACY)):
            worth = lengths * np.exp(log_weight - log_weight.max())
            prices[lengths] = worth
            take = _knapsack(prices, lengths, capacity)
            top, new = 0.0, []
            for first in lengths[::-1].tolist():
                pattern = (first, *_filling(take, capacity - first))
                pattern = tuple(sorted(pattern, reverse=True))
                value = prices[list(pattern)].sum()
                top = max(top, value)
                new.append((pattern, value))
            bound = max(bound, float(worth @ asked) / top)
            if known <= max(np.ceil(bound - 1e-6), (1 + CLOSE) * bound):
                return
            added = {p: 0 for p, v in new if v >= (1 - accuracy) * top and p not in pool}
            if added:
                columns = [np.unique(p, return_counts=True) for p in added]
                wide = max(kinds.shape[1], *(len(k) for k, _ in columns))
                more_kinds = np.zeros((len(pool) + len(added), wide), np.int64)
                more_counts = np.zeros(more_kinds.shape)
                more_kinds[: len(pool), : kinds.shape[1]] = kinds
                more_counts[: len(pool), : kinds.shape[1]] = counts
                for at, (k, c) in enumerate(columns, len(pool)):
                    more_kinds[at, : len(k)], more_counts[at, : len(k)] = place[k], c
                kinds, counts = more_kinds, more_counts
                uses = np.concatenate([uses, np.zeros(len(added))])
                for p in added:
                    pool[p] = len(pool)
            most = np.where(counts > 0, asked[kinds] / np.maximum(counts, 1), np.inf).min(1)
            for _ in range(STEPS):
                worth = lengths * np.exp(log_weight - log_weight.max())
                value = (worth[kinds] * counts).sum(1)
                step = np.where(value >= (1 - accuracy) * value.max(), most, 0.0)
                gain = np.bincount(
                    kinds.ravel(), (counts * step[:, None]).ravel(), len(lengths)
                ) / asked
                step, gain = step / gain.max(), gain / gain.max()
                uses += step
                met += gain
                log_weight -= accuracy * gain
            if met.min() > 0:
                best = uses.sum() / met.min()
            if best <= (1 + accuracy) * bound:
                break
        if met.min() > 0:
            yield {p: float(u) for p, u in zip(pool, uses / met.min(), strict=True) if u > 0}


def _exact_fillings(
    histogram: np.ndarray, capacity: int, rounds: int
) -> dict[tuple[int, ...], int]:
    """Uses of patterns that leave no room, by prices that follow what demand is left."""
    demand = histogram.astype(np.int64).copy()
    patterns: dict[tuple[int, ...], int] = defaultdict(int)
    if demand[capacity]:
        patterns[(capacity,)] = int(demand[capacity])
        demand[capacity] = 0
    asked = np.maximum(histogram, 1).astype(float)
    plain = np.arange(capacity + 1) / capacity
    prices = plain
    for _ in range(rounds):
        lengths = np.flatnonzero(demand)
        if len(lengths) < 2 or demand.sum() < FEW:
            break
        take = _knapsack(prices, lengths, capacity)
        # Long pieces are placed while short ones are left to fill up with.
        used = 0
        for first in lengths[lengths > lengths[-1] // 2][::-1].tolist():
            if not demand[first]:
                continue
            pattern = (first, *sorted(_filling(take, capacity - first), reverse=True))
            if sum(pattern) < capacity:
                continue
            kinds, counts = np.unique(pattern, return_counts=True)
            possible = int((demand[kinds] // counts).min())
            if possible:
                uses = max(1, int(possible * SHARE))
                patterns[pattern] += uses
                demand[kinds] -= uses * counts
                used += uses
        if used:
            left = demand / asked
            mean = demand.sum() / asked[1:].sum()
            prices = np.maximum(prices * np.exp(RATE * np.clip(left - mean, -1, 1)), plain / 2)
        elif prices is plain:
            break  # the longest pieces fill no sequence: best fit does the rest
        else:
            prices = plain
    return patterns


def _runs(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length: rows (first number, first sequence, offset), by number."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, uses in patterns:
        offset = 0
        for length in lengths:
            runs[length].append((given[length], sequence, offset))
            given[length] += uses
            offset += length
        sequence += uses
    return {length: np.array(r, np.int64) for length, r in runs.items()}


_PIECE = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"
)
_PIECE_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int32()),
        ("number", pa.int64()),
    ]
)


def _pieces(path: str, capacity: int, end_id: int):
    """Pieces of every text, numbered inside this task by their length."""

    def run(batches: Batches) -> Batches:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        end, number = end_id.to_bytes(4, "little"), [0] * (capacity + 1)
        for b in batches:
            ids, texts, rows = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            for some in slices(texts, CHARACTERS):
                for doc, raw in zip(ids[some], encode(texts[some]), strict=True):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        piece = raw[at : at + 4 * capacity]
                        n = len(piece) // 4
                        rows.append((doc, k, at // 4, n, zlib.crc32(piece), part, number[n]))
                        number[n] += 1
            yield batch(_PIECE_ARROW, zip(*rows, strict=True))

    return run


def _placed(runs: dict[int, np.ndarray]):
    def run(batches: Batches) -> Batches:
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                mine = np.flatnonzero(length == n)
                run = runs[int(n)]
                at = np.searchsorted(run[:, 0], number[mine], "right") - 1
                sequence[mine] = run[at, 1] + number[mine] - run[at, 0]
                offset[mine] = run[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*b.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then ``end_id``; a null or empty text is ``end_id`` alone.
    One longer than ``capacity`` is cut into pieces of that many ids and a rest. Rows that
    repeat are packed again; ids may be null; other columns are ignored; an empty table
    gives no pieces. In a sequence, offsets begin at 0 and leave no gap.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    pieces = settle(mapped(rows, _pieces(path, capacity, end_id), _PIECE))
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    histogram = np.zeros(capacity + 1, np.int64)
    # At most one row for each length up to the capacity.
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    runs = _runs(plan(histogram, capacity))
    numbered = pieces.join(shift, ["length", "part"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("number") + F.col("before")).alias("number"),
    )
    return mapped(
        numbered,
        _placed(runs),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
