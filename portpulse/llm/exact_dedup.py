"""Exact deduplication over an index of live digests that can grow and shrink.

A text's digest is the SHA-256 of its UTF-8 with each run of ``[\\x20\\x09-\\x0D]`` as one
blank. Digests are dealt over shards by their own bits; each task keeps a cuckoo filter
of its shard, whose slots also point to the stored digest. A filter hit is only believed
when the stored digest in that bucket is the same; a full filter is rebuilt at
twice the size from the stored digests.

Rows are combined per batch before they are dealt out, so that a text with very many
copies sends one row a batch to its shard.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import Batches, batch, mapped, shards_for, single_spaced, table, utf8

#: Digests in one shard, about; one takes some 300 bytes of a task's memory.
SHARD_DIGESTS = 400_000


class CuckooFilter:
    """A partial-key cuckoo filter (Fan et al., 2014) that keeps its keys beside the slots.

    Keys are digests of at least 16 bytes. ``find`` gives a key's value or None, exactly.
    """

    WAYS = 4
    KICKS = 200

    def __init__(self, buckets: int = 1024):
        self.buckets = buckets  # a power of two
        self.prints = array("H", bytes(2 * self.WAYS * buckets))
        self.entries: list = [None] * (self.WAYS * buckets)
        self.count = 0
        self.resized = 0

    def _places(self, key: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(key[:2], "little") or 1
        one = int.from_bytes(key[2:10], "little") & (self.buckets - 1)
        return print_, one, self._other(one, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return (bucket ^ (print_ * 0x5BD1E995)) & (self.buckets - 1)

    def _slot(self, key: bytes) -> int:
        print_, one, two = self._places(key)
        for bucket in (one, two):
            for slot in range(bucket * self.WAYS, (bucket + 1) * self.WAYS):
                # a filter hit, verified against the stored key
                if self.prints[slot] == print_ and self.entries[slot][0] == key:
                    return slot
        return -1

    def find(self, key: bytes):
        slot = self._slot(key)
        return None if slot < 0 else self.entries[slot][1]

    def insert(self, key: bytes, value) -> None:
        """Add a key that is not there."""
        self.count += 1
        entry = (key, value)
        while (entry := self._place(entry)) is not None:
            self._resize()

    def _place(self, entry):
        """None when all found a slot, else the entry that was left over."""
        print_, bucket, two = self._places(entry[0])
        if not self._free(two) < 0 and self._free(bucket) < 0:
            bucket = two
        for kick in range(self.KICKS):
            slot = self._free(bucket)
            if slot >= 0:
                self.prints[slot], self.entries[slot] = print_, entry
                return None
            slot = bucket * self.WAYS + kick % self.WAYS
            old_print, old = self.prints[slot], self.entries[slot]
            self.prints[slot], self.entries[slot] = print_, entry
            print_, entry, bucket = old_print, old, self._other(bucket, old_print)
        return entry

    def _free(self, bucket: int) -> int:
        for slot in range(bucket * self.WAYS, (bucket + 1) * self.WAYS):
            if not self.prints[slot]:
                return slot
        return -1

    def _resize(self) -> None:
        kept = [e for e in self.entries if e is not None]
        while True:
            self.buckets *= 2
            self.resized += 1
            self.prints = array("H", bytes(2 * self.WAYS * self.buckets))
            self.entries = [None] * (self.WAYS * self.buckets)
            if all(self._place(e) is None for e in kept):
                return

    def delete(self, key: bytes) -> bool:
        slot = self._slot(key)
        if slot < 0:
            return False
        self.prints[slot], self.entries[slot] = 0, None
        self.count -= 1
        return True

    def items(self):
        return (e for e in self.entries if e is not None)


_INDEX = "digest binary, keep_id long, keep_row long, live long"
_ENTRY = pa.schema(
    [
        ("digest", pa.binary()),
        ("keep_id", pa.int64()),
        ("keep_row", pa.int64()),
        ("live", pa.int64()),
    ]
)
_LAST = 1 << 63  # a null id comes after all others


def digest(text: str | None) -> bytes:
    return hashlib.sha256(single_spaced(utf8(text))).digest()


def _digests(batches: Batches) -> Batches:
    for b in batches:
        found = pa.array([digest(t) for t in b.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), found], names=["id", "digest"])


def _combined(batches: Batches) -> Batches:
    """Of each batch, one row per digest: its first row and the number of rows."""
    for b in batches:
        found: dict[bytes, list] = {}
        for i, d, row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            order = (_LAST if i is None else i, row)
            if d in found:
                found[d] = [min(found[d][0], order), found[d][1] + 1]
            else:
                found[d] = [order, 1]
        rows = [(d, None if o[0] == _LAST else o[0], o[1], n) for d, (o, n) in found.items()]
        yield batch(_ENTRY, zip(*rows, strict=True))


def _fold(batches: Batches) -> Batches:
    """Fold changes, additions first, into the live digests of this shard."""
    index = CuckooFilter()
    for b in batches:
        for d, i, row, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            entry = index.find(d)
            if n > 0:
                order = (_LAST if i is None else i, row)
                if entry is None:
                    index.insert(d, [order, n])
                else:
                    entry[0] = min(entry[0], order)
                    entry[1] += n
            elif entry is not None:
                entry[1] += n
                if entry[1] <= 0:
                    index.delete(d)
    rows = []
    for d, (order, n) in index.items():
        rows.append((d, None if order[0] == _LAST else order[0], order[1], n))
        if len(rows) == 20_000:
            yield batch(_ENTRY, zip(*rows, strict=True))
            rows = []
    if rows:
        yield batch(_ENTRY, zip(*rows, strict=True))


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest and a row number, written to the shared folder (so it stays the same)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return settle(
        mapped(rows, _digests, "id long, digest binary").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )


def without(rows: DataFrame, removed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` less the ``removed`` ones (both of ``digest_rows``), and those taken away.

    A removed row takes away one row with its id and digest, if there is one; null is an
    id like any other. Only rows that agree with a removed one are numbered, by their row
    numbers cut into ranges, so an id with very many rows is spread.
    """
    key = ["digest", "id"]
    asked = settle(removed.groupBy(*key).agg(F.count(F.lit(1)).alias("_asked")))
    told = asked.withColumnsRenamed({c: f"_{c}" for c in key})
    met = (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_id"))
    order = ["digest", "id", "row"]
    cut = settle(
        rows.join(told, met).select(*order, "_asked").repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(
        F.col("digest").alias("_digest"), F.col("id").alias("_id"), F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    nth = F.row_number().over(Window.partitionBy(*key, "_range").orderBy("row")) + F.col("_before")
    taken = settle(
        cut.join(counts, met & (F.col("_range") == F.col("_of")))
        .withColumn("_nth", nth)
        .where("_nth <= _asked")
        .select("id", "digest", "row")
    )
    return rows.join(taken.select("row"), "row", "left_anti").select("id", "digest", "row"), taken


def live_index(
    added: DataFrame,
    removed: DataFrame | None = None,
    index: DataFrame | None = None,
    live: DataFrame | None = None,
) -> DataFrame:
    """The digests that are live after adding and removing rows of ``digest_rows``.

    One row per digest: the smallest id among its live rows, that row, and how many are
    live. ``index`` is the one before, and ``live`` the rows behind it, which removals need: each
    takes exactly one live row with its id and digest away, and one that is not there has no effect. A
    digest without live rows is deleted from the filter; one that has lost rows and lives on
    takes its smallest id from the rows that are left.
    """
    changes = mapped(added, _combined, _INDEX)
    if index is not None:
        changes = changes.unionByName(index)
    left = None
    if removed is not None:
        if index is not None and live is None:
            raise ValueError("removals need the live rows behind the index")
        rows = added.select("id", "digest", "row")
        if live is not None:
            # row numbers of different tables may agree: these come after the others
            top = live.agg(F.coalesce(F.max("row"), F.lit(-1)) + 1).first()[0]
            rows = live.select("id", "digest", "row").unionByName(rows.withColumn("row", F.col("row") + top))
        left, taken = without(settle(rows), removed)
        gone = mapped(taken, _combined, _INDEX)
        changes = changes.unionByName(gone.withColumn("live", -F.col("live")))
    shards = shards_for(added.count() + (index.count() if index is not None else 0), SHARD_DIGESTS)
    least = int(added.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = changes.repartition(max(shards, least), "digest")
    if left is None:
        return mapped(dealt, _fold, _INDEX)
    folded = mapped(dealt.sortWithinPartitions(F.col("live").desc()), _fold, _INDEX)
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    least_of = (
        left.join(taken.select("digest").distinct(), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min(first).alias("_first"))
    )
    lost = F.col("_first").isNotNull()
    return folded.join(least_of, "digest", "left").select(
        "digest",
        F.when(lost, F.col("_first.id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(lost, F.col("_first.row")).otherwise(F.col("keep_row")).alias("keep_row"),
        "live",
    )


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty. Of equal texts the row with the smallest id stays; null
    ids come last, and of rows with the same id one stays. ``keep_id`` is null when all
    ids of the group are. Other columns are ignored; an empty table gives none.
    """
    rows = digest_rows(docs, id_col, text_col)
    index = live_index(rows)
    return rows.join(index, "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("live").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _tagged(batches: Batches) -> Batches:
    for b in batches:
        at = b.num_columns - 1
        found = pa.array([digest(t) for t in b.column(at).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:at], found], names=[*b.schema.names[:at], "_digest"]
        )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows are told apart by id and
    digest, which also spreads the copies of one text over the tasks."""
    index = live_index(digest_rows(docs, id_col, text_col))
    rows = docs.select(
        F.struct(*(F.col(c) for c in docs.columns)).alias("_row"),
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
    )
    tagged = rows.mapInArrow(_tagged, rows.drop("_text").schema.add("_digest", "binary"))
    stay = index.select(F.col("keep_id").alias("_keep"), F.col("digest").alias("_kept"))
    met = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_digest") == F.col("_kept"))
    left = tagged.join(stay, met, "left_semi").dropDuplicates(["_id", "_digest"])
    return left.select("_row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
