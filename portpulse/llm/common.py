"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import settle

Batches = Iterator[pa.RecordBatch]
WHITE = bytes(range(9, 14)) + b" "
_TO_SPACE = bytes.maketrans(bytes(range(9, 14)), b" " * 5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def single_spaced(raw: bytes) -> bytes:
    """Each run of white space as one blank. The bytes 9 to 13 and 32 are always
    whole characters in UTF-8."""
    raw = raw.translate(_TO_SPACE)
    while b"  " in raw:
        raw = raw.replace(b"  ", b" ")
    return raw


def text_key(text: str | None) -> int:
    """A signed 64-bit hash of a text, to tell rows of one id apart."""
    return xxhash.xxh3_64_intdigest(utf8(text)) - (1 << 63)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def mapped(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def shards_for(amount: int, each: int) -> int:
    """How many parts a volume is dealt into so that one holds about ``each``."""
    return max(1, -(-int(amount) // each))


def same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has an edge: columns ``node, root``.

    ``edges`` holds pairs of one orderable type. Alternates large-star and small-star
    steps (Kiveris et al., 2014), each a minimum per node and a join, until the edges no
    longer change. Edges are never more than at the start, and no task gathers a
    node's neighbours: minima combine before the shuffle, and they are written before they are joined,
    so that adaptive execution can split a popular node's side of the join. Each round is written to the shared folder.
    """
    links = settle(
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
        .where("v <> u")
        .distinct()
    )
    mark = F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
    before = None
    while True:
        both = links.select("v", "u").union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = settle(both.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("m")))
        large = (
            both.where("u > v")
            .join(least, "v")
            .select(F.col("u").alias("v"), F.col("m").alias("u"))
        )
        large = settle(large.distinct())
        low = settle(large.groupBy("v").agg(F.min("u").alias("m")))
        small = large.join(low, "v")
        links = settle(
            small.select("v", F.col("m").alias("u"))
            .union(small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")))
            .distinct()
        )
        now = links.agg(mark.alias("s"), F.count(F.lit(1)).alias("n")).first()
        if now == before:
            break
        before = now
    return links.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def runs_of(batches: Batches, keys: list[str], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Of rows sorted by ``keys``: each run of equal keys, with its rows' ``names``.

    Rows of many small runs come as they are in a batch; a group for each of them would cost more
    than what is done with it.
    """
    held: list[tuple] = []
    last = None
    for b in batches:
        columns = {n: b.column(b.schema.get_field_index(n)).to_pylist() for n in dict.fromkeys((*keys, *names))}
        marks = list(zip(*(columns[k] for k in keys), strict=True))
        rows = list(zip(*(columns[n] for n in names), strict=True))
        at = 0
        while at < len(marks):
            to = at + 1
            while to < len(marks) and marks[to] == marks[at]:
                to += 1
            if held and marks[at] != last:
                yield last, held
                held = []
            held = held + rows[at:to] if held else rows[at:to]
            last, at = marks[at], to
    if held:
        yield last, held


def due_here(
    here: int, one: int, two: int, block: list[int], buckets: list[list[int]]
) -> tuple[list[int], list[int], np.ndarray]:
    """Places of the rows of the two blocks of a bucket, and which of their pairs have no
    smaller bucket in common."""
    left = [k for k, b in enumerate(block) if b == one]
    right = [k for k, b in enumerate(block) if b == two] if one != two else left
    fresh = np.ones((len(left), len(right)), bool)
    if one == two:
        np.fill_diagonal(fresh, False)
    sharing: dict[int, tuple[list[int], list[int]]] = {}
    for k, places in enumerate((left, right)):
        for at, row in enumerate(places):
            for bucket in buckets[row]:
                if bucket < here:
                    sharing.setdefault(bucket, ([], []))[k].append(at)
    for a, b in sharing.values():
        if a and b:
            fresh[np.ix_(a, b)] = False
    return left, right, fresh


_DUE = pa.schema(
    [("bucket", pa.int64()), ("one", pa.int32()), ("two", pa.int32()), ("block", pa.int32()),
     ("key", pa.binary()), ("buckets", pa.list_(pa.int64()))]
)
#: What the rows of a pair of blocks are told apart and sorted by.
PLACE = ["bucket", "one", "two"]


def _to_verify(batches: Batches) -> Batches:
    """The rows of each bucket's pair of blocks that have a pair to verify there."""
    out: list[tuple] = []
    for (here, one, two), rows in runs_of(batches, PLACE, ["block", "key", "buckets"]):
        if len(rows) == 2 and one == two:
            (_, _, a), (_, _, b) = rows
            some = [0, 1] if min(set(a).intersection(b)) == here else []
        else:
            left, right, fresh = due_here(here, one, two, [r[0] for r in rows], [r[2] for r in rows])
            some = sorted({left[k] for k in np.flatnonzero(fresh.any(1))} | {right[k] for k in np.flatnonzero(fresh.any(0))})
        out += [(here, one, two, *rows[k]) for k in some]
        if len(out) >= 5_000:
            yield batch(_DUE, zip(*out, strict=True))
            out = []
    if out:
        yield batch(_DUE, zip(*out, strict=True))


def by_place(rows: DataFrame) -> DataFrame:
    return rows.repartition(*PLACE).sortWithinPartitions(*PLACE)


def pairs_to_verify(places: DataFrame, bucket: str, block: int) -> DataFrame:
    """Where which rows have to be compared, of rows dealt to buckets by several hashes.

    ``places`` says which ``key`` (binary) is in which bucket (a long); it may say so more
    than once. Every pair of keys with a bucket in common is due in the smallest one they share.
    Returns, written to the shared folder, ``bucket``, ``one``, ``two`` (crowded buckets
    are dealt out in pairs of blocks of about ``block`` keys), ``block``, ``key`` and its
    ``buckets``, for the keys that have a pair due there: near copies share many buckets and
    need to be brought together in few of them. A key has as many buckets as there are hashes, at most.
    """
    places = places.select("key", F.col(bucket).alias("bucket"))
    # written, so that no aggregate shares a stage with a join: a crowded bucket can be split there
    shared = settle(
        places.groupBy("bucket")
        .agg(F.min("key").alias("a"), F.max("key").alias("z"))
        .where("a <> z")
        .select("bucket")
    )
    listed = settle(places.join(shared, "bucket").groupBy("key").agg(F.collect_set("bucket").alias("buckets")))
    entries = listed.select("key", "buckets", F.explode("buckets").alias("bucket"))
    # where all keys of a bucket agree in their smallest one, and that is another, no pair is due
    blocks = F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks")
    first = F.array_min("buckets")
    sizes = entries.groupBy("bucket").agg(blocks, F.min(first).alias("low"), F.max(first).alias("high"))
    due = settle(sizes.where("low <> high or low = bucket").select("bucket", "blocks"))
    entries = entries.join(due, "bucket")
    paired = (
        entries.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("one", F.least("block", "with"))
        .withColumn("two", F.greatest("block", "with"))
        .drop("with", "blocks")
    )
    return settle(
        mapped(by_place(paired), _to_verify, "bucket long, one int, two int, block int, key binary, buckets array<long>")
    )


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each row of a symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        low = np.where(linked, root[None, :], len(linked)).min(1)
        new = np.minimum(root, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
