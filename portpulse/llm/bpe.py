"""Encoding tables of texts to token ids and back; the machines are in ``tokens``."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.llm.common import Batches, batch, mapped, table
from portpulse.llm.tokens import TextDecoder, TokenJoiner, encoder
from portpulse.llm.wordhash import slices

#: Characters encoded at once.
CHARACTERS = 1 << 20
#: Ids decoded at once.
IDS = 1 << 16


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id and ``ids`` (an array of int) of every row. A null or empty text has no ids.
    Rows may repeat and ids may be null; other columns are ignored."""

    def run(batches: Batches) -> Batches:
        encode = encoder(path).encode
        for b in batches:
            texts = b.column(1).to_pylist()
            for part in slices(texts, CHARACTERS):
                ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in encode(texts[part])]
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
                lists = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(ids))
                )
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(part.start, len(ids)), lists], names=["id", "ids"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_col)
    return mapped(rows, run, "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(
    encoded: DataFrame,
    path: str,
    id_col: str = "doc_id",
    ids_col: str = "ids",
    readable: bool = False,
) -> DataFrame:
    """Id and ``text`` of every row of ids. As the library's decode for this file gives
    it (tokens joined by one blank), or ``readable``: bytes put together to characters
    and words parted by one blank. Null ids give an empty text."""

    def run(batches: Batches) -> Batches:
        v = encoder(path).v
        out = pa.schema([("id", pa.int64()), ("text", pa.string())])
        for b in batches:
            texts = []
            for ids in b.column(1).to_pylist():
                machine = TextDecoder(v) if readable else TokenJoiner(v)
                text = machine.feed(ids or [])
                texts.append(text + machine.close() if readable else text)
            yield batch(out, [b.column(0), texts])

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), ids_col)
    return mapped(rows, run, "id long, text string").withColumnRenamed("id", id_col)


def _digests(path: str):
    """Digests of the ids and of the decoded text, fed piece by piece."""

    def run(batches: Batches) -> Batches:
        known = encoder(path)
        decimal = {i: str(i) for i in known.v.tokens}.__getitem__
        out = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_tokens", pa.int64()),
                ("ids_sha256", pa.string()),
                ("decoded_sha256", pa.string()),
            ]
        )
        for b in batches:
            texts, rows = b.column(1).to_pylist(), []
            for part in slices(texts, CHARACTERS):
                for raw in known.encode(texts[part]):
                    ids_sha, text_sha = hashlib.sha256(), hashlib.sha256()
                    machine = TokenJoiner(known.v)
                    for at in range(0, len(raw), 4 * IDS):
                        ids = np.frombuffer(raw[at : at + 4 * IDS], "<u4").tolist()
                        ids_sha.update(b" " * (at > 0) + " ".join(map(decimal, ids)).encode())
                        text_sha.update(machine.feed(ids).encode())
                    rows.append((len(raw) // 4, ids_sha.hexdigest(), text_sha.hexdigest()))
            yield batch(out, [b.column(0), *zip(*rows, strict=True)])

    return run


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return mapped(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        _digests(path),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
