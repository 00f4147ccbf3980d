"""Similarity self-join of texts on word n-grams by MinHash banding.

A text's set holds its ``n``-word sequences (words are runs outside
``[\\x20\\x09-\\x0D]``; a text of fewer words has one, all its words). Texts with the
same set count once from here on. Band and row counts follow from the wanted recall at
the threshold. Texts that share a band hash are candidates, and a pair is verified on its full
sets in one place only: the bucket of the smallest band hash that the two share.

Buckets go through two passes. The first sees band hashes alone and finds which texts
have a pair to verify there; in a bucket of near copies that is usually one of their
many common buckets. The second brings the sets of those texts together, and verifies all
pairs of a block at once by matrix products over shared n-grams. A crowded bucket is dealt out
in pairs of blocks, so no task holds more than two. Only verified links are
connected: texts that merely meet make no larger problem of each other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import (
    PLACE,
    Batches,
    batch,
    components,
    due_here,
    local_roots,
    mapped,
    pairs_to_verify,
    table,
)
from portpulse.llm.wordhash import mix, slices, words_of

N = 5
THRESHOLD = 0.8
RECALL = 0.9995
#: Values of one signature at most.
SIGNATURE = 160
#: Texts of one block, about.
BLOCK_TEXTS = 400


def bands_and_rows(threshold: float, recall: float, signature: int) -> tuple[int, int]:
    """The longest rows (fewest false candidates) that reach the recall at the threshold
    with as few bands as that takes."""
    for rows in range(signature, 0, -1):
        miss = math.log1p(-(threshold**rows)) if threshold < 1 else -math.inf
        if miss and (bands := max(1, math.ceil(math.log1p(-recall) / miss))) * rows <= signature:
            return bands, rows
    return signature, 1


def _gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's n-grams."""
    words = words_of(texts)
    count = np.diff(words.first)
    start = words.starts(n)
    full = words.spans(start, n)
    bounds = np.searchsorted(start, words.first)
    short = words.spans(words.first[:-1], count)
    out = []
    for i in range(len(texts)):
        if count[i] >= n:
            out.append(np.unique(full[bounds[i] : bounds[i + 1]]))
        else:
            out.append(short[i : i + 1] if count[i] else short[:0])
    return out


def _set_key(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes, one row per set; every set has a member."""
    # 32 bits of a member: a chance agreement makes a candidate more, and half the width halves the work
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.zeros((len(sets), bands), np.uint64)
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for band in range(bands):
        hash_ = np.full(len(sets), band, np.uint64)
        for row in range(rows):
            seed = seeds[band * rows + row].astype(np.uint32)
            low = np.minimum.reduceat((flat ^ seed) * (seed | np.uint32(1)), at)
            hash_ = mix(hash_ ^ low) + np.uint64(1)
        out[:, band] = hash_
    return out


def _keys(n: int):
    """Set key and number of n-grams of every row."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            texts, keys, sizes = b.column(1).to_pylist(), [], []
            for part in slices(texts):
                for grams in _gram_sets(texts[part], n):
                    keys.append(_set_key(grams))
                    sizes.append(len(grams))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32())],
                names=["id", "key", "grams"],
            )

    return run


def _first_texts(n: int):
    """One text of every set that this task meets."""

    def run(batches: Batches) -> Batches:
        out, seen = pa.schema([("key", pa.binary()), ("text", pa.string())]), set()
        for b in batches:
            texts = b.column(0).to_pylist()
            for part in slices(texts):
                rows = {}
                for text, grams in zip(texts[part], _gram_sets(texts[part], n), strict=True):
                    if len(grams) and (key := _set_key(grams)) not in seen:
                        rows[key] = text
                        seen.add(key)
                if rows:
                    yield batch(out, [list(rows), list(rows.values())])

    return run


def _bands(n: int, bands: int, rows: int):
    """Band hashes of every set that this task meets, once."""

    def run(batches: Batches) -> Batches:
        out, seen = pa.schema([("key", pa.binary()), ("band", pa.int64())]), set()
        for b in batches:
            texts = b.column(0).to_pylist()
            for part in slices(texts):
                sets = {_set_key(g): g for g in _gram_sets(texts[part], n) if len(g)}
                sets = {k: g for k, g in sets.items() if k not in seen}
                if not sets:
                    continue
                seen.update(sets)
                found = _signatures(list(sets.values()), bands, rows)
                keys = [k for k in sets for _ in range(bands)]
                yield batch(out, [keys, found.ravel().view(np.int64)])

    return run


def _sets(n: int):
    """Sets of texts, as bytes."""

    def run(batches: Batches) -> Batches:
        out = pa.schema([("key", pa.binary()), ("set", pa.binary())])
        for b in batches:
            texts = b.column(1).to_pylist()
            for part in slices(texts):
                found = [g.tobytes() for g in _gram_sets(texts[part], n)]
                yield batch(out, [b.column(0).slice(part.start, len(found)), found])

    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared n-grams of every pair, by products of 0/1 matrices over shared n-grams."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared, where = np.intersect1d(a, b), {}
    out = np.zeros((len(left), len(right)), np.float32)
    for name, sets, flat in (("a", left, a), ("b", right, b)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.searchsorted(shared, flat)
        column[column == len(shared)] = 0
        on = shared[column] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(column[on], kind="stable")
        where[name] = owner[on][order], column[on][order]
    for at in range(0, len(shared), 2048):
        grids = []
        for name, size in (("a", len(left)), ("b", len(right))):
            owner, column = where[name]
            lo, hi = np.searchsorted(column, (at, at + 2048))
            grid = np.zeros((size, min(2048, len(shared) - at)), np.float32)
            grid[owner[lo:hi], column[lo:hi] - at] = 1
            grids.append(grid)
        out += grids[0] @ grids[1].T
    return out


_LINKS = pa.schema(
    [("key", pa.binary()), ("other", pa.binary()), ("links", pa.int64())]
)


def _verify(threshold: float):
    """Links of one pair of blocks: per text the number of linked rows, and an edge to
    the smallest text that it reaches inside this pair of blocks."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        here, one, two = (rows.column(n)[0].as_py() for n in PLACE)
        block, buckets, keys = (rows.column(n).to_pylist() for n in ("block", "buckets", "key"))
        left, right, near = due_here(here, one, two, block, buckets)
        none = pa.table([[], [], []], schema=_LINKS)
        if not near.any():
            return none
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("set").to_pylist()]
        size = np.array([len(s) for s in sets])
        both = _overlaps([sets[i] for i in left], [sets[i] for i in right])
        either = size[left][:, None] + size[right][None, :] - both
        near &= both >= threshold * either - 1e-6
        linked = np.zeros((len(keys), len(keys)), bool)
        linked[np.ix_(left, right)] = near
        linked |= linked.T
        links = linked.astype(np.int64) @ rows.column("copies").to_numpy()
        some = np.flatnonzero(links)
        if not len(some):
            return none
        root = local_roots(linked)
        return pa.table([[keys[i] for i in some], [keys[root[i]] for i in some], links[some]], schema=_LINKS)

    return run


def similar_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, kept.

    Rows whose sets have a Jaccard similarity of at least ``threshold`` are linked; a
    class is what links connect, and ``class_id`` its smallest id (null if it has none).
    ``n_links`` counts the other rows linked directly, rows with the same set included.
    ``kept`` is true for one row of each class: of those with the class id (or, if that is
    null, of all), the first in an arbitrary but fixed order. A null or empty text has no
    n-grams and is linked with nothing: it is a class of its own, under its own id. Null
    and repeated ids are allowed; other columns are ignored; an empty table gives none.
    """
    return _linked(docs, id_col, text_col, n, threshold, recall).select(
        F.col("id").alias(id_col), "class_id", "n_links", "kept"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """The rows of ``docs`` that ``similar_texts`` keeps, with all their columns."""
    found = _linked(docs, id_col, text_col, n, threshold, recall)
    stay = found.where("kept and key is not null").select(
        F.col("id").alias("_keep"), F.col("key").alias("_kept")
    )
    rows = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
    )
    tagged = rows.mapInArrow(_tagged(n), rows.drop("_text").schema.add("_key", "binary"))
    met = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_key") == F.col("_kept"))
    left = tagged.join(stay, met, "left_semi").dropDuplicates(["_id", "_key"])
    return left.unionByName(tagged.where("_key is null")).select("_row.*")


def _tagged(n: int):
    """Replace the text by its set key, null where there are no n-grams."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            at = b.num_columns - 1
            texts, keys = b.column(at).to_pylist(), []
            for part in slices(texts):
                keys += [_set_key(g) if len(g) else None for g in _gram_sets(texts[part], n)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:at], pa.array(keys, pa.binary())], names=[*b.schema.names[:at], "_key"]
            )

    return run


def _linked(
    docs: DataFrame, id_col: str, text_col: str, n: int, threshold: float, recall: float
) -> DataFrame:
    """id, key (null without n-grams), class_id, n_links and kept of every row."""
    bands, rows = bands_and_rows(threshold, recall, SIGNATURE)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    members = settle(
        mapped(source, _keys(n), "id long, key binary, grams int").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    counts = members.where("grams > 0").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("grams").alias("grams")
    )

    band_rows = settle(
        mapped(source.select("text"), _bands(n, bands, rows), "key binary, band long")
    )
    needed = pairs_to_verify(band_rows, "band", BLOCK_TEXTS)
    # A shuffled join whatever the size: the candidates grow with the texts.
    wanted = needed.select("key").distinct().join(counts.select("key", "copies"), "key")
    one_text = (
        mapped(source.select("text"), _first_texts(n), "key binary, text string")
        .join(wanted.select("key").hint("merge"), "key")
        .dropDuplicates(["key"])
    )
    sets = mapped(one_text.select("key", "text"), _sets(n), "key binary, `set` binary").join(wanted, "key")
    # in groups: sets are long, and a batch of many buckets could hold too many of them
    verified = settle(
        needed.join(sets, "key")
        .groupBy(*PLACE)
        .applyInArrow(_verify(threshold), "key binary, other binary, links long")
    )
    classes = components(verified, "key", "other")
    named = (
        classes.join(counts.select(F.col("key").alias("node"), "least"), "node")
        .groupBy("root")
        .agg(F.min("least").alias("class_least"))
    )
    links = verified.groupBy("key").agg(F.sum("links").alias("others"))
    per_set = (
        counts.select("key", "copies", "least")
        .join(links, "key", "left")
        .join(classes.withColumnRenamed("node", "key"), "key", "left")
        .join(named, "root", "left")
        .select(
            "key",
            F.coalesce("root", "key").alias("class_key"),
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("class_least")).alias("class_id"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    out = settle(
        members.where("grams > 0")
        .join(per_set, "key")
        .select("id", "row", "key", "class_key", "class_id", "n_links")
    )
    first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    keeper = settle(out.groupBy("class_key").agg(first))
    texts = out.join(
        keeper.select("class_key", F.col("first.row").alias("first")), "class_key"
    ).select("id", "key", "class_id", "n_links", (F.col("row") == F.col("first")).alias("kept"))
    empty = members.where("grams = 0").select(
        "id",
        F.lit(None).cast("binary").alias("key"),
        F.col("id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("kept"),
    )
    return texts.unionByName(empty)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_texts(table(spark, sf_dir, "documents"))
