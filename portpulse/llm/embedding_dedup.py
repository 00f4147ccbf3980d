"""Near-duplicate vectors by Euclidean hashing with p-stable projections.

A unit vector's hash in one table is ``k`` numbers floor((a . v + b) / width) with
Gaussian ``a``; vectors at a small distance often share all of them. The number of
projections follows from the number of vectors (so that a table brings together hardly
any two unrelated ones), the number of tables from the wanted recall at the threshold.
Vectors that share a bucket are compared exactly, in double precision. A pair is compared and
counts in the smallest bucket that it shares: which vectors have a pair due in which bucket
is found from the bucket numbers alone, and only those vectors are sent there. Crowded buckets are
dealt out in pairs of blocks.

Equal vectors count once up to here; their number goes into the links.
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
    by_place,
    components,
    due_here,
    local_roots,
    mapped,
    pairs_to_verify,
    runs_of,
    table,
)

THRESHOLD = 0.95
RECALL = 0.995
WIDTH = 2.0
#: Unrelated vectors that a vector meets in one table, on average.
STRANGERS = 0.05
BLOCK = 500


def collision(distance: float, width: float) -> float:
    """Probability that one projection puts two vectors at this distance together."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_and_projections(
    vectors: int, threshold: float, recall: float, width: float
) -> tuple[int, int]:
    near = collision(math.sqrt(2 - 2 * threshold), width)
    far = collision(math.sqrt(2), width)
    k = max(1, math.ceil(math.log(max(vectors, 2) / STRANGERS) / -math.log(far)))
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-(near**k)))), k


def _unit(raw: list[list[float] | None]) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for what links with nothing."""
    out = []
    for values in raw:
        if not values or any(x is None for x in values):
            out.append(None)
            continue
        v = np.asarray(values, np.float64)
        top = np.abs(v).max() if np.isfinite(v).all() else 0.0
        if not top > 0:
            out.append(None)
            continue
        v = v / top  # keeps the squares of very large and very small values in range
        out.append(v / np.linalg.norm(v))
    return out


def _keys(batches: Batches) -> Batches:
    out = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("vector", pa.binary())])
    for b in batches:
        vectors = [None if v is None else v.tobytes() for v in _unit(b.column(1).to_pylist())]
        keys = [None if v is None else xxhash.xxh3_128_digest(v) for v in vectors]
        yield batch(out, [b.column(0), keys, vectors])


def _hashes(tables: int, k: int, width: float):
    """All bucket numbers of every vector, as bytes."""

    def run(batches: Batches) -> Batches:
        drawn = {}
        for b in batches:
            raw = b.column(b.schema.get_field_index("vector")).to_pylist()
            signs = []
            for one in raw:
                v = np.frombuffer(one, np.float64)
                if len(v) not in drawn:
                    rng = np.random.default_rng(len(v))
                    drawn[len(v)] = rng.standard_normal((tables * k, len(v))), rng.uniform(0, width, tables * k)
                a, shift = drawn[len(v)]
                cells = np.floor((a @ v + shift) / width).astype(np.int64).reshape(tables, k)
                signs.append(
                    # the bucket's number tells the table and the length as well
                    b"".join(
                        xxhash.xxh3_64_digest(c.tobytes(), t << 32 | len(v)) for t, c in enumerate(cells)
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(signs, pa.binary())], names=[*b.schema.names, "sign"]
            )

    return run


def _buckets(batches: Batches) -> Batches:
    out = pa.schema([("key", pa.binary()), ("bucket", pa.int64())])
    for b in batches:
        keys, signs = b.column(0).to_pylist(), b.column(1).to_pylist()
        if not keys:
            continue
        grid = np.frombuffer(b"".join(signs), np.int64).reshape(len(keys), -1)
        yield batch(out, [[k for k in keys for _ in range(grid.shape[1])], grid.ravel()])


_LINKS = pa.schema([("key", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])


def _verify(threshold: float):
    def run(batches: Batches) -> Batches:
        names = ["block", "buckets", "key", "copies", "vector"]
        for (here, one, two), rows in runs_of(batches, PLACE, names):
            block, buckets, keys, copies, raw = zip(*rows, strict=True)
            left, right, near = due_here(here, one, two, block, buckets)
            if len(set(map(len, raw))) > 1:
                continue
            vectors = np.stack([np.frombuffer(v, np.float64) for v in raw])
            near &= vectors[left] @ vectors[right].T >= threshold
            if not near.any():
                continue
            linked = np.zeros((len(keys), len(keys)), bool)
            linked[np.ix_(left, right)] = near
            linked |= linked.T
            links = linked.astype(np.int64) @ np.array(copies)
            some, root = np.flatnonzero(links), local_roots(linked)
            yield batch(_LINKS, [[keys[i] for i in some], [keys[root[i]] for i in some], links[some]])

    return run


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    width: float = WIDTH,
) -> DataFrame:
    """One row per row: id, n_links, component_id, kept (the id is the component's).

    ``n_links`` counts the other rows found at a cosine of at least ``threshold``, equal
    vectors included; ``component_id`` is the smallest id that links reach. Vectors that are
    null, empty, zero or hold null or non-finite components, and vectors of different
    lengths, link with nothing. Null ids sort last and repeated ids are allowed (each row
    is a vector); other columns are ignored; an empty table gives none.
    """
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = settle(mapped(source, _keys, "id long, key binary, vector binary"))
    distinct = (
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("id").alias("least"),
            F.first("vector").alias("vector"),
        )
    )
    tables, k = tables_and_projections(rows.count(), threshold, recall, width)
    hashed = settle(
        mapped(
            distinct,
            _hashes(tables, k, width),
            "key binary, copies long, least long, vector binary, sign binary",
        )
    )
    places = settle(mapped(hashed.select("key", "sign"), _buckets, "key binary, bucket long"))
    hashed = hashed.drop("sign")
    needed = pairs_to_verify(places, "bucket", BLOCK)
    verified = settle(
        mapped(
            by_place(needed.join(hashed.drop("least"), "key")),
            _verify(threshold),
            "key binary, other binary, links long",
        )
    )
    found = components(verified, "key", "other")
    named = (
        found.join(hashed.select(F.col("key").alias("node"), "least"), "node")
        .groupBy("root")
        .agg(F.min("least").alias("component"))
    )
    per_vector = (
        hashed.select("key", "copies", "least")
        .join(verified.groupBy("key").agg(F.sum("links").alias("others")), "key", "left")
        .join(found.withColumnRenamed("node", "key"), "key", "left")
        .join(named, "root", "left")
        .select(
            "key",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"),
        )
    )
    alone = F.col("key").isNull()
    return rows.drop("vector").join(per_vector, "key", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("id").eqNullSafe(F.col("component"))).alias("kept"),
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
