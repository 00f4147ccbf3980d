"""Hard negatives by exact integer scores from a residue number system.

Vectors become integers, floor(256 * x). Their products with the anchors are taken modulo
several small primes, one float32 matrix product each: residues stay so small that no sum
leaves the integers that float32 holds exactly. As many primes are used as the largest
possible score needs, and Chinese remaindering puts the signed scores together again.

Anchors are the stated query set. They are dealt into blocks that fit a task's memory, all
rows into splits; every split meets every block once, as a stream of batches, so a tile
holds one block and one batch at a time. A tile hands on the best few of each anchor, and
windows select among those. Labels take no part in the dealing: a label with a third of
all rows is spread like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import Batches, batch, mapped, shards_for, table

SCALE = 256
#: A squared norm from here on could give scores of which 100 times is no long any more.
LARGEST = 1 << 56
#: Exact integers of float32.
EXACT = 1 << 24
PRIMES = (127, 113, 109, 107, 103, 101, 97, 89, 83)
#: Bytes of an anchor block's residues, anchors of a block, rows of a split, and how many splits at most.
BLOCK_BYTES, BLOCK, SPLIT, SPLITS = 1 << 25, 16_384, 2_048, 32
#: Anchors and rows that are multiplied at once.
STEP, ROWS = 512, 4_096


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as tell all integers from -bound to bound apart."""
    n, product = 0, 1
    while product <= 2 * bound:
        product *= PRIMES[n]
        n += 1
    return PRIMES[: max(n, 1)]


def residues(q: np.ndarray, p: int) -> np.ndarray:
    """Integers modulo ``p`` as float32, from -(p - 1) / 2 to (p - 1) / 2."""
    r = q % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a times b transposed modulo ``p``, balanced; no partial sum leaves EXACT."""
    width = EXACT // (p // 2) ** 2 - 1
    total = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], width):
        total += (a[:, at : at + width] @ b[:, at : at + width].T).astype(np.int32)
        total %= p
    total[total > p // 2] -= p
    return total


def remaindered(found: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The signed integers with these balanced residues (mixed radix digits, each balanced,
    give a number between plus and minus half the product of the primes)."""
    value, radix = found[0].astype(np.int64), primes[0]
    for p, r in zip(primes[1:], found[1:], strict=True):
        digit = (r - value % p) * pow(radix, -1, p) % p
        digit[digit > p // 2] -= p
        value += digit * radix
        radix *= p
    return value


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Exact integer products of the rows of two matrices, given by their residues."""
    return remaindered([_product(x, y, p) for x, y, p in zip(a, b, primes, strict=True)], primes)


def _whole(batches: Batches) -> Batches:
    """Integer vectors of the rows that take part, as bytes, with their squared norms."""
    names = ("row", "id", "label", "anchor")
    for b in batches:
        taken, out = [], {"dim": [], "norm": [], "vector": []}
        for i, values in enumerate(_column(b, "v")):
            if any(x is None for x in values):
                continue
            q = np.floor(SCALE * np.array(values, np.float64))
            # no component of 2**28 or more has a norm below LARGEST
            if not (np.abs(q) < 1 << 28).all():
                continue
            q = q.astype(np.int64)
            norm = sum(int(x) ** 2 for x in q.tolist())
            if norm < LARGEST:
                taken.append(i)
                out["dim"].append(len(q))
                out["norm"].append(norm)
                out["vector"].append(q.tobytes())
        if taken:
            kept = {n: b.column(b.schema.get_field_index(n)).take(pa.array(taken)) for n in names}
            kept["dim"] = pa.array(out["dim"], pa.int32())
            kept |= {"norm": pa.array(out["norm"], pa.int64()), "vector": pa.array(out["vector"], pa.binary())}
            yield pa.RecordBatch.from_pydict(kept)


def _column(b: pa.RecordBatch | pa.Table, name: str) -> list:
    return b.column(b.schema.get_field_index(name)).to_pylist()


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.int64).reshape(len(vectors), -1 if vectors[0] else 0)


def _tiles(batches: Batches) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """Runs of rows of one tile: its key, whether they are anchors, and the rows."""
    for b in batches:
        if not b.num_rows:
            continue
        marks = list(zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in ("dim", "block", "split", "kind")), strict=True))
        at = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
        for lo, hi in zip(at, at[1:]):
            yield marks[lo][:3], marks[lo][3] == 0, b.slice(lo, hi - lo)


class _Best:
    """The first ``limit`` (score descending, then id and row number) of each place."""

    def __init__(self, limit: int):
        self.limit = limit
        #: place, score, id and row number
        self.held = [np.zeros(0, np.int64)] * 4

    def add(self, found: list[tuple[np.ndarray, ...]]) -> None:
        every = [np.concatenate(x) for x in zip(self.held, *found, strict=True)]
        place, score, key, row = every
        order = np.lexsort((row, key, -score, place))
        place = place[order]
        order = order[np.arange(len(place)) - np.searchsorted(place, place) < self.limit]
        self.held = [x[order] for x in every]


class _Tile:
    """One block of anchors, and the best rows seen for each of them."""

    def __init__(self, primes: tuple[int, ...], limit: int, select):
        self.primes, self.limit, self.select = primes, limit, select
        self.parts: list[pa.RecordBatch] = []
        self.best: list[_Best] = []

    def _prepare(self) -> None:
        anchors = pa.Table.from_batches(self.parts)
        self.rows, self.labels = (np.array(_column(anchors, n), np.int64) for n in ("row", "label"))
        self.positives = _column(anchors, "positives") if "positives" in anchors.column_names else None
        whole = _matrix(_column(anchors, "vector"))
        self.residues = [residues(whole, p) for p in self.primes]
        self.best = [_Best(self.limit) for _ in range(0, len(self.rows), STEP)]

    def meet(self, b: pa.RecordBatch) -> None:
        if not self.parts:
            return
        if not self.best:
            self._prepare()
        row, key, label = (np.array(_column(b, n), np.int64) for n in ("row", "id", "label"))
        whole = _matrix(_column(b, "vector"))
        for at in range(0, len(row), ROWS):
            part = slice(at, at + ROWS)
            right = [residues(whole[part], p) for p in self.primes]
            for best, lo in zip(self.best, range(0, len(self.rows), STEP), strict=True):
                block = slice(lo, lo + STEP)
                score = scores([x[block] for x in self.residues], right, self.primes)
                same = self.labels[block][:, None] == label[part][None, :]
                own = self.rows[block][:, None] == row[part][None, :]
                best.add(
                    [
                        (place, score[i, j], key[part][j], row[part][j])
                        for place, i, j in self.select(self, lo, score, same, own)
                    ]
                )


def _at_least(score: np.ndarray, allowed: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each line's ``limit`` largest allowed scores, those equal to the last included."""
    least = np.iinfo(np.int64).min
    open_scores = np.where(allowed, score, least)
    if score.shape[1] > limit:
        edge = np.partition(open_scores, -limit, axis=1)[:, -limit]
        allowed = allowed & (open_scores >= edge[:, None])
    return np.nonzero(allowed)


def _positives(limit: int):
    def select(tile: _Tile, lo: int, score: np.ndarray, same: np.ndarray, own: np.ndarray):
        i, j = _at_least(score, same & ~own, limit)
        yield lo + i, i, j

    return select


def _negatives(limit: int, most: int, low: int, high: int):
    """Places are anchor * most + the positive's number."""

    def select(tile: _Tile, lo: int, score: np.ndarray, same: np.ndarray, own: np.ndarray):
        mine = tile.positives[lo : lo + len(score)]
        for k in range(max(map(len, mine), default=0)):
            has = np.array([len(x) > k for x in mine])
            of = np.array([x[k] if len(x) > k else 0 for x in mine], np.int64)[:, None]
            fits = ~same & has[:, None] & (low * of <= high * score) & (score <= of)
            if fits.any():
                i, j = _at_least(score, fits, limit)
                yield (lo + i) * most + k, i, j

    return select


def _multiply(primes: tuple[int, ...], limit: int, select, most: int):
    out = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches: Batches) -> Batches:
        at, tile = None, None

        def done() -> Batches:
            for best in tile.best if tile else ():
                place, score, key, row = best.held
                yield batch(out, [tile.rows[place // most], (place % most).astype(np.int32), row, key, score])

        for key, anchors, b in _tiles(batches):
            if key != at:
                yield from done()
                at, tile = key, _Tile(primes, limit, select)
            if anchors:
                tile.parts.append(b)
            else:
                tile.meet(b)
        yield from done()

    return run


def _tiled(anchors: DataFrame, rows: DataFrame, blocks: int, splits: int) -> DataFrame:
    """Anchors in every split of their block, rows in every block, dealt out by tile."""
    number = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("kind", F.lit(0)).withColumn("block", number(blocks, 1)).withColumn("split", every(splits))
    right = rows.withColumn("kind", F.lit(1)).withColumn("split", number(splits, 2)).withColumn("block", every(blocks))
    tile = ["dim", "block", "split"]
    return (
        left.unionByName(right, allowMissingColumns=True)
        .repartition(*tile)
        .sortWithinPartitions(*tile, "kind")
    )


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels whose score is at most the positive's and ``high``
    times it at least ``low`` times the positive's.

    Scores are exact inner products of floor(256 * x); higher ones come first, ties by the
    smaller id. ``is_anchor`` and ``label`` are expressions on the given columns. Rows with
    a null label, a null vector, a null or non-finite component take no part, nor do rows
    without an id (a result could not name them) and those with a squared integer norm of
    2**56 or more (their scores would leave the long range). An empty vector is a vector of
    length 0; only vectors of equal length are compared. Rows that share an id are rows of
    their own: each can be an anchor, a positive of the other, or a negative. Anchors
    without a positive or fitting negative return nothing, as does an empty table. Other columns are ignored.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where("id is not null and label is not null and v is not null")
    rows = settle(
        mapped(rows, _whole, "row long, id long, label long, anchor boolean, dim int, norm long, vector binary")
    )
    chosen = rows.where("anchor").drop("anchor", "norm")
    top = rows.agg(F.max("norm").alias("norm"), F.max("dim").alias("dim"), F.count(F.lit(1)).alias("n")).first()
    primes = primes_for(top.norm or 0)
    each = min(BLOCK, max(STEP, BLOCK_BYTES // (4 * max(top.dim or 1, 1) * len(primes))))
    blocks = shards_for(chosen.count(), each)
    splits = min(SPLITS, shards_for(top.n, SPLIT))
    schema = "anchor long, slot int, row long, id long, score long"
    rows = rows.drop("anchor", "norm")

    tiles = _tiled(chosen, rows, blocks, splits)
    first = mapped(tiles, _multiply(primes, positives, _positives(positives), 1), schema)
    order = [F.col("score").desc(), F.col("id"), F.col("row")]
    own = settle(
        first.withColumn("k", F.row_number().over(Window.partitionBy("anchor").orderBy(*order)))
        .where(F.col("k") <= positives)
        .select("anchor", (F.col("k") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    # at most ``positives`` scores for each anchor
    listed = own.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))), lambda x: x.positive_score).alias("positives")
    )
    asked = settle(chosen.join(listed.withColumnRenamed("anchor", "row"), "row"))
    tiles = _tiled(asked, rows, blocks, splits)
    second = mapped(tiles, _multiply(primes, negatives, _negatives(negatives, positives, low, high), positives), schema)
    found = (
        second.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order)))
        .where(F.col("rank") <= negatives)
        .select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    )
    return (
        found.join(own, ["anchor", "slot"])
        .join(chosen.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shifted)


OP11_SQL = """
with whole as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as v
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    list_inner_product(a.v, b.v)::bigint as score
  from whole a join whole b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positive as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id, row_number() over pair::int as rank, n.id as negative_id,
  positive_score, n.score as negative_score
from positive p join scored n on n.anchor_id = p.anchor_id and not n.same
  and 80 * positive_score <= 100 * n.score and n.score <= positive_score
window pair as (partition by p.anchor_id, positive_id order by n.score desc, n.id)
qualify row_number() over pair <= 5
"""
