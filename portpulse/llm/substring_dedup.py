"""Substring deduplication: words inside a window that also occurs elsewhere are removed.

A window is ``window`` consecutive words of one text. Method: shards of a compressed
full-text index (``fmindex``); backward search over its wavelet levels finds the runs
that occur twice or more.

Which shard a window belongs to follows from its words alone, so equal windows always
meet: the window's minimizer (the smallest hash of the ``gram``-word sequences inside it,
the leftmost of equals) is its key. Neighbouring windows with one and the same minimizer
form a segment: the minimizer, and up to ``window - gram`` words on either side. A key that
occurs once in the whole corpus cannot belong to a repeated window, so only segments of
repeated keys go on, and equal ones count once from there.

A passage quoted everywhere gives one key as many different segments as it has
surroundings. So segments are trimmed: what stands on one side of the minimizer is kept
as far as some other segment of the key agrees with it. That is the longest common prefix
with the neighbours in the sorted order of all sides; the order is by range partitions, so a
key with any number of segments is spread. A repeated window agrees on both sides with
another occurrence, so it is inside what is kept. Trimmed segments of a quoted
passage are equal, and only different ones are indexed: twice where they stand for several
occurrences, once otherwise. The width of the interval found by backward search decides.

A shard holds whole keys; its volume is bounded but for one key with very many different
surroundings that repeat. Hashes are of 64 bits for words and sides and, with the key, of 128
bits for segments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portpulse.functions.scale import settle
from portpulse.llm.common import (
    Batches,
    batch,
    mapped,
    shards_for,
    signed,
    table,
    text_key,
    utf8,
)
from portpulse.llm.fmindex import FMIndex, repeated_runs
from portpulse.llm.wordhash import Words, sliding_argmin, slices, words_of

WINDOW = 35
GRAM = 8
#: Words in one index shard, about; an index of a million words takes some 100 MB to build.
SHARD_WORDS = 600_000

_SEGMENT = pa.schema(
    [
        ("id", pa.int64()),
        ("text_key", pa.int64()),
        ("key", pa.int64()),
        ("segment", pa.int64()),
        ("first", pa.int32()),
        ("left", pa.int32()),
        ("byte", pa.int64()),
        ("bytes", pa.int32()),
    ]
)


def _grams(words: Words, gram: int) -> np.ndarray:
    return words.spans(np.arange(max(0, len(words.hashes) - gram + 1)), gram)


def _segments(
    words: Words, grams: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimizer's first word of each segment."""
    start = words.starts(window)
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    place = sliding_argmin(grams, window - gram + 1)[start]
    new = np.ones(len(start), bool)
    new[1:] = place[1:] != place[:-1]
    run = np.flatnonzero(new)
    return start[run], np.diff(np.append(run, len(start))), place[run]


def _keys(window: int, gram: int):
    def run(batches: Batches) -> Batches:
        out = pa.schema([("key", pa.int64()), ("n", pa.int64())])
        for b in batches:
            texts = b.column(0).to_pylist()
            for part in slices(texts):
                words = words_of(texts[part])
                grams = _grams(words, gram)
                place = _segments(words, grams, window, gram)[2]
                if len(place):
                    found, n = np.unique(grams[place], return_counts=True)
                    yield batch(out, [signed(found), n.astype(np.int64)])

    return run


def _occurrences(window: int, gram: int):
    def run(batches: Batches) -> Batches:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for part in slices(texts):
                words = words_of(texts[part])
                grams = _grams(words, gram)
                start, windows, place = _segments(words, grams, window, gram)
                if not len(start):
                    continue
                text = np.searchsorted(words.first, start, "right") - 1
                keys = np.array([text_key(t) for t in texts[part]], np.int64)
                length = windows + window - 1
                begin, end = words.begin[start], words.end[start + length - 1]
                yield batch(
                    _SEGMENT,
                    [
                        ids.take(pa.array(text + part.start)),
                        keys[text],
                        signed(grams[place]),
                        signed(words.spans(start, length)),
                        (start - words.first[text]).astype(np.int32),
                        (place - start).astype(np.int32),
                        begin - words.text_begin[text],
                        (end - begin).astype(np.int32),
                    ],
                )

    return run


def _cut(batches: Batches) -> Batches:
    """The bytes of the chosen segments of each text."""
    out = pa.schema(
        [("key", pa.int64()), ("segment", pa.int64()), ("twice", pa.bool_()), ("left", pa.int32()), ("words", pa.binary())]
    )
    for b in batches:
        rows = []
        for text, chosen in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            raw = utf8(text)
            for c in chosen:
                words = raw[c["byte"] : c["byte"] + c["bytes"]]
                rows.append((c["key"], c["segment"], c["twice"], c["left"], words))
        for at in range(0, len(rows), 20_000):
            yield batch(out, zip(*rows[at : at + 20_000], strict=True))


def _decoded(raw: list[bytes]) -> list[str]:
    return [r.decode("utf-8", "surrogatepass") for r in raw]


def _column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


def _ragged(first: np.ndarray, size: np.ndarray, step: int) -> np.ndarray:
    """The places first, first + step, ... of every row, one row after the other."""
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(first, size) + step * at


def _sides(gram: int):
    """Of each segment, what stands left of its minimizer (nearest first) and right of it: a
    hash (``before``, ``after``), and 32 bits of each word, which is enough to compare by."""
    out = pa.schema(
        [("key", pa.int64()), ("segment", pa.int64()), ("twice", pa.bool_()), ("left", pa.int32()),
         ("before", pa.int64()), ("after", pa.int64()), ("words_before", pa.binary()), ("words_after", pa.binary())]
    )

    def run(batches: Batches) -> Batches:
        for b in batches:
            texts = _decoded(_column(b, "words").to_pylist())
            for part in slices(texts):
                words = words_of(texts[part])
                n = len(words.first) - 1
                left = _column(b, "left").to_numpy()[part].astype(np.int64)
                right = np.diff(words.first) - left - gram
                first, after = words.first[:-1], words.first[:-1] + left + gram
                brief = (words.hashes >> np.uint64(32)).astype(">u4")
                sides = []
                for places, size in ((_ragged(first + left - 1, left, -1), left), (_ragged(after, right, 1), right)):
                    ends = np.concatenate(([0], 4 * np.cumsum(size))).astype(np.int32)
                    raw = pa.py_buffer(brief[places].tobytes())
                    sides.append(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), raw]))
                marks = [signed(words.spans(first, left)), signed(words.spans(after, right))]
                given = (_column(b, c).slice(part.start, n) for c in ("key", "segment", "twice", "left"))
                yield batch(out, [*given, *marks, *sides])

    return run


def _filled(sides: list[bytes | None]) -> np.ndarray:
    """Rows of words, with as many columns as the longest has words."""
    size = np.array([len(s or b"") for s in sides]) >> 2
    grid = np.zeros((len(sides), int(size.max(initial=0))), np.uint32)
    grid[np.arange(grid.shape[1]) < size[:, None]] = np.frombuffer(b"".join(s or b"" for s in sides), np.uint32)
    return grid


def _agreed(one: list[bytes], two: list[bytes | None]) -> np.ndarray:
    """Number of first words in which two sides agree; none with a missing one."""
    a, b = _filled(one), _filled(two)
    width = min(a.shape[1], b.shape[1])
    both = np.minimum([len(s) for s in one], [len(s or b"") for s in two]) >> 2
    same = (a[:, :width] == b[:, :width]) & (np.arange(width) < both[:, None])
    return np.logical_and.accumulate(same, axis=1).sum(1)


_SIDE = "key long, side int, mark long, reach int, words binary, part int"


def _reach(batches: Batches) -> Batches:
    """How many words of each side another occurrence has, too, from the sorted rows of one
    range. The first and the last row keep their words: their neighbours are in other ranges."""
    out = pa.schema([("key", pa.int64()), ("side", pa.int32()), ("mark", pa.int64()), ("reach", pa.int32()),
                     ("words", pa.binary()), ("part", pa.int32())])
    task = TaskContext.get().partitionId()
    held: list[tuple] = []  # the last row of the batch before, its reach so far, and whether it is the first of all

    def given(rows: list[tuple], reach: np.ndarray, ends: list[bool]) -> pa.RecordBatch:
        key, side, words, mark, _ = zip(*rows, strict=True)
        kept = [w if end else None for w, end in zip(words, ends, strict=True)]
        return batch(out, [key, side, mark, reach.astype(np.int32), kept, [task] * len(rows)])

    reach, begun = np.zeros(0, np.int64), False
    for b in batches:
        rows = held + list(zip(*(_column(b, n).to_pylist() for n in ("key", "side", "words", "mark", "n")), strict=True))
        if not b.num_rows:
            continue
        alike = np.array([x[:2] == y[:2] for x, y in zip(rows, rows[1:])], bool)
        common = np.where(alike, _agreed([r[2] for r in rows[:-1]], [r[2] for r in rows[1:]]), 0) if len(rows) > 1 else np.zeros(0, np.int64)
        now = np.zeros(len(rows), np.int64)
        now[: len(reach)] = reach
        now[1:] = np.maximum(now[1:], common)
        now[:-1] = np.maximum(now[:-1], common)
        whole = np.array([len(r[2]) for r in rows]) >> 2
        now = np.where(np.array([r[4] for r in rows]) >= 2, whole, now)
        if len(rows) > 1:
            yield given(rows[:-1], now[:-1], [not begun and k == 0 for k in range(len(rows) - 1)])
            begun = True
        held, reach = rows[-1:], now[-1:]
    if held:
        yield given(held, reach, [True])


def _reaches(sided: DataFrame) -> DataFrame:
    """``reach`` of every different side (0: before, 1: after; ``mark``: its hash) of a key."""
    order = ["key", "side", "words"]
    both = F.array(
        *(F.struct(F.lit(k).alias("side"), F.col(f"words_{c}").alias("words"), F.col(c).alias("mark")) for k, c in enumerate(("before", "after")))
    )
    times = F.when(F.col("twice"), 2).otherwise(1)
    sides = (
        sided.select("key", times.alias("n"), F.explode(both).alias("_s"))
        .groupBy("key", "_s.side", "_s.words", "_s.mark")
        .agg(F.sum("n").alias("n"))
    )
    reached = settle(
        mapped(sides.repartitionByRange(*order).sortWithinPartitions(*order).select(*order, "mark", "n"), _reach, _SIDE)
    )
    # the two ends of each range meet their neighbours in the ranges beside it: two lines a range
    ends = reached.where("words is not null")
    along = Window.orderBy("part", "key", "side", "words")
    before, after = (
        F.struct(*(F.lag(c, n).over(along).alias(c) for c in ("key", "side", "words"))) for n in (1, -1)
    )
    met = ends.select("*", before.alias("_one"), after.alias("_two"))
    corrected = mapped(met, _reach_across, "key long, side int, mark long, reach int")
    slim = reached.select("key", "side", "mark", "reach")
    return settle(slim.unionByName(corrected).groupBy("key", "side", "mark").agg(F.max("reach").alias("reach")))


def _reach_across(batches: Batches) -> Batches:
    out = pa.schema([("key", pa.int64()), ("side", pa.int32()), ("mark", pa.int64()), ("reach", pa.int32())])
    for b in batches:
        rows = []
        for r in b.to_pylist():
            for other in (r["_one"], r["_two"]):
                if other["words"] is not None and (other["key"], other["side"]) == (r["key"], r["side"]):
                    rows.append((r["key"], r["side"], r["mark"], int(_agreed([r["words"]], [other["words"]])[0])))
        if rows:
            yield batch(out, zip(*rows, strict=True))


def _trim(gram: int):
    """Segments cut to the words that both reaches allow."""
    out = pa.schema(
        [("key", pa.int64()), ("segment", pa.int64()), ("twice", pa.bool_()), ("shift", pa.int32()),
         ("trimmed", pa.int64()), ("n_words", pa.int64()), ("words", pa.binary())]
    )

    def run(batches: Batches) -> Batches:
        for b in batches:
            texts = _decoded(_column(b, "words").to_pylist())
            before, after, left = (_column(b, n).to_numpy().astype(np.int64) for n in ("reach_before", "reach_after", "left"))
            for part in slices(texts):
                words = words_of(texts[part])
                length, shift = before[part] + gram + after[part], left[part] - before[part]
                start = words.first[:-1] + shift
                origin = words.text_begin
                begin, end = words.begin[start] - origin, words.end[start + length - 1] - origin
                raw = [t.encode("utf-8", "surrogatepass") for t in texts[part]]
                yield batch(
                    out,
                    [
                        *(_column(b, n).slice(part.start, len(raw)) for n in ("key", "segment", "twice")),
                        shift.astype(np.int32),
                        signed(words.spans(start, length)),
                        length,
                        [t[x:y] for t, x, y in zip(raw, begin, end, strict=True)],
                    ],
                )

    return run


def _index_shard(window: int):
    """Index one shard and stream its segments against it."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        parts = _decoded(rows.column("words").to_pylist())
        texts, length = [], []
        for part in slices(parts):
            words = words_of(parts[part])
            texts.append(words.hashes)
            length.append(np.diff(words.first))
        hashes, length = np.concatenate(texts), np.concatenate(length)
        twice = rows.column("twice").to_numpy(zero_copy_only=False).astype(bool)
        # Words that occur once here are in no repeated window: they get symbol 0.
        values, symbol, seen = np.unique(hashes, return_inverse=True, return_counts=True)
        again = np.zeros(len(values), np.int64)
        np.add.at(again, symbol[np.repeat(twice, length)], 1)
        kept = seen + again >= 2
        symbol = np.where(kept, np.cumsum(kept), 0)[symbol]
        index = FMIndex(symbol, length, 1 + twice)
        which, begin, end = repeated_runs(index, symbol, length, window)
        row = pa.array(which)
        return pa.table(
            {
                "key": rows.column("key").take(row),
                "trimmed": rows.column("trimmed").take(row),
                "from": pa.array(begin.astype(np.int32)),
                "to": pa.array(end.astype(np.int32)),
            }
        )

    return run


def _indexed(rows: DataFrame, words: int, window: int) -> DataFrame:
    """``rows``: key, trimmed, twice, words. Runs of repeated words within each."""
    n = shards_for(words, SHARD_WORDS)
    return (
        rows.select("key", "trimmed", "twice", "words")
        .groupBy(F.pmod(F.xxhash64("key"), F.lit(n)).alias("shard"))
        .applyInArrow(_index_shard(window), "key long, trimmed long, `from` int, `to` int")
    )


def _remove(as_given: bool):
    """Replace a row's text and runs by its number of words, of removed words, and the words
    that stay, joined by one blank (``as_given``: a text that loses none, as it was)."""
    tail = pa.schema(
        [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
    )

    def run(batches: Batches) -> Batches:
        for b in batches:
            ids, rows = b.column(0), b.column(1)
            texts, runs = b.column(2).to_pylist(), b.column(3).to_pylist()
            out = pa.schema([b.schema.field(0), b.schema.field(1), *tail])
            for part in slices(texts, 1 << 22):
                found = [_kept(t, r) for t, r in zip(texts[part], runs[part], strict=True)]
                if as_given:
                    found = [
                        f if f[1] else (*f[:2], t) for f, t in zip(found, texts[part], strict=True)
                    ]
                at, n = part.start, len(found)
                yield batch(out, [ids.slice(at, n), rows.slice(at, n), *zip(*found, strict=True)])

    return run


def _kept(text: str | None, runs: list | None) -> tuple[int, int, str]:
    words = utf8(text).split()
    stay = words
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for r in runs:
            edge[r["from"]] += 1
            edge[r["to"]] -= 1
        stay = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return len(words), len(words) - len(stay), b" ".join(stay).decode("utf-8", "surrogatepass")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_text (kept words joined
    by one blank).

    Words are runs outside ``[\\x20\\x09-\\x0D]``. A null or empty text has no words and
    an empty kept_text; a text of fewer than ``window`` words loses none. Null ids are
    allowed. Rows that repeat (the same text again, under any id) repeat all their
    windows and lose all of them. Windows are judged on the input. Other columns are
    ignored. An empty table gives an empty result.
    """
    found = _judged(docs, id_col, text_col, window, gram, F.lit(None).cast("boolean"), False)
    return found.drop("row").withColumnRenamed("id", id_col)


def strip_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """All rows and columns of ``docs``; texts that lose words are replaced by the words
    that stay (``length_col``, if given, by their length). Others keep their text as it is."""
    others = [F.col(c) for c in docs.columns if c != text_col]
    row = F.struct(*others) if others else F.lit(None).cast("boolean")
    found = _judged(docs, id_col, text_col, window, gram, row, True)

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("kept_text")
        if c == length_col:
            length = F.length("kept_text").cast(docs.schema[c].dataType)
            return F.when(F.col("n_removed") > 0, length).otherwise(F.col("row")[c])
        return F.col("row")[c]

    return found.select(*(column(c).alias(c) for c in docs.columns))


def _judged(
    docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, row: Column, as_given: bool
) -> DataFrame:
    """id, row (an expression that is carried along), n_words, n_removed, kept_text."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # written, so that no aggregate shares a stage with the join: a hot key can be split there
    repeated = settle(
        mapped(rows.select("text"), _keys(window, gram), "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where("n >= 2")
        .select("key")
    )
    found = settle(
        mapped(
            rows,
            _occurrences(window, gram),
            "id long, text_key long, key long, segment long, first int, left int, byte long, bytes int",
        ).join(repeated, "key")
    )
    different = found.groupBy("key", "segment").agg(
        (F.count(F.lit(1)) >= 2).alias("twice"),
        F.min(F.struct("id", "text_key", "byte", "bytes", "left")).alias("at"),
    )
    chosen = different.select("key", "segment", "twice", "at.*")
    chosen = chosen.groupBy("id", "text_key").agg(
        F.collect_list(F.struct("key", "segment", "twice", "left", "byte", "bytes")).alias("chosen")
    )
    keyed = mapped(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")),
        _with_key,
        "id long, text_key long, text string",
    )
    pieces = settle(
        mapped(
            _matched(keyed, chosen, "inner").select("text", "chosen"),
            _cut,
            "key long, segment long, twice boolean, left int, words binary",
        )
    )
    if pieces.select("key", "segment").distinct().count() < pieces.count():
        # of texts that repeat under one id
        pieces = settle(pieces.dropDuplicates(["key", "segment"]))
    sided = settle(
        mapped(
            pieces,
            _sides(gram),
            "key long, segment long, twice boolean, left int, before long, after long, "
            "words_before binary, words_after binary",
        )
    )
    reaches = _reaches(sided)
    reach = lambda side, name: reaches.where(F.col("side") == side).select(
        "key", F.col("mark").alias(name), F.col("reach").alias(f"reach_{name}")
    )
    kept = (
        sided.select("key", "segment", "before", "after")
        .join(reach(0, "before"), ["key", "before"])
        .join(reach(1, "after"), ["key", "after"])
        .where(F.col("reach_before") + F.lit(gram) + F.col("reach_after") >= window)
    )
    trimmed = settle(
        mapped(
            pieces.join(kept.select("key", "segment", "reach_before", "reach_after"), ["key", "segment"]),
            _trim(gram),
            "key long, segment long, twice boolean, shift int, trimmed long, n_words long, words binary",
        )
    )
    indexed = settle(
        trimmed.groupBy("key", "trimmed").agg(
            ((F.count(F.lit(1)) >= 2) | F.max("twice")).alias("twice"),
            F.first("words").alias("words"),
            F.first("n_words").alias("n_words"),
        )
    )
    volume = indexed.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    runs = (
        trimmed.select("key", "segment", "trimmed", "shift")
        .join(_indexed(indexed, volume, window), ["key", "trimmed"])
        .select("key", "segment", (F.col("from") + F.col("shift")).alias("from"), (F.col("to") + F.col("shift")).alias("to"))
    )
    spans = (
        found.select("id", "text_key", "key", "segment", "first")
        .join(runs, ["key", "segment"])
        .groupBy("id", "text_key")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("first") + F.col("from")).alias("from"),
                    (F.col("first") + F.col("to")).alias("to"),
                )
            ).alias("runs")
        )
    )
    carried = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row.alias("row")
    )
    carried = carried.mapInArrow(
        _with_key, carried.select("id", F.lit(0).cast("long").alias("text_key"), "text", "row").schema
    )
    ready = _matched(carried, spans, "left").select("id", "row", "text", "runs")
    schema = ready.select("id", "row").schema
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        schema = schema.add(name, kind)
    return ready.mapInArrow(_remove(as_given), schema)


def _with_key(batches: Batches) -> Batches:
    for b in batches:
        keys = pa.array([text_key(t) for t in b.column(1).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), keys, *b.columns[1:]], names=["id", "text_key", *b.schema.names[1:]]
        )


def _matched(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on the id, null included, and the text's hash."""
    other = other.withColumnsRenamed({"id": "_id", "text_key": "_key"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return rows.join(other, same, how).drop("_id", "_key")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
