"""WARC archives: a writer of gzip members and a reader that splits files anywhere.

Every record is a gzip member of its own. The reader deals byte ranges of all files to
its tasks. A task looks for the gzip magic in its range; a candidate is a member only if
it inflates to a WARC record's header, and, where the header tells the record's offset
(as this writer's do), if that is the place. It owns the records that start inside its
range and reads the last one to its end, beyond the range. After one record the next
begins, so only the first of a range has to be searched for.

Files are opened through ``pyarrow.fs`` by URI, so the folder may be in any store that
all executors reach. A task names its files by partition and a random part; the manifest
lists those of the attempts that succeeded, and is written once, so a task that runs
again leaves a file that nobody reads.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portpulse.functions.scale import settle, shared_folder
from portpulse.llm.common import Batches, batch, mapped, table, utf8

LEAST_REVISIT = 100
RANGE = 8 << 20
FILE = 256 << 20
MAGIC = b"\x1f\x8b\x08"
_HEAD = 1 << 16
_READ = 1 << 20
_OFFSET = "X-Member-Offset"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _field(value: str) -> str:
    """A header value without line ends."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _name(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def record(offset: int, page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member: a response with its payload, or a revisit with its head only."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_name(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"{_OFFSET}: {offset}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _written(folder: str):
    def run(batches: Batches) -> Batches:
        store, root = _open(folder)
        part, out, path, size = TaskContext.get().partitionId(), None, "", 0
        made: list[tuple[str, int]] = []
        for b in batches:
            for page_id, url, html, digest, refers_to in zip(
                *(c.to_pylist() for c in b.columns), strict=True
            ):
                if out is None:
                    name = f"pages-{part:05d}-{len(made):05d}-{uuid.uuid4().hex}.warc.gz"
                    path, size = f"{folder}/{name}", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = record(size, page_id, url, utf8(html), digest, refers_to)
                out.write(member)
                size += len(member)
                if size >= FILE:
                    out.close()
                    made.append((path, size))
                    out = None
        if out is not None:
            out.close()
            made.append((path, size))
        yield batch(
            pa.schema([("path", pa.string()), ("size", pa.int64())]),
            zip(*made, strict=True) if made else [[], []],
        )

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record for every row into ``folder``; gives the manifest: path, size.

    Of rows with equal payloads of at least 100 bytes, those with the smallest id are
    responses and the others revisit that id; smaller payloads, and payloads none of whose rows
    has an id, are all responses. A null html is an empty payload, a null URL is left out.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).alias("url"),
        F.col(html_col).alias("html"),
        F.sha2(F.coalesce(F.col(html_col), F.lit("")).cast("binary"), 256).alias("digest"),
    )
    firsts = (
        rows.where(F.octet_length("html") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    ready = rows.join(firsts, "digest", "left").select(
        "id",
        "url",
        "html",
        "digest",
        F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    return settle(mapped(ready, _written(folder), "path string, size long"))


class Source:
    """A file read forwards from any place, in blocks."""

    def __init__(self, handle, size: int):
        self.handle, self.size = handle, size

    def at(self, place: int, n: int) -> bytes:
        self.handle.seek(place)
        return self.handle.read(min(n, self.size - place))


def _header(source: Source, place: int) -> dict[str, str] | None:
    """Fields of the record whose member starts here, or None if none does."""
    inflate, head, at = zlib.decompressobj(31), b"", place
    while b"\r\n\r\n" not in head:
        raw = source.at(at, _HEAD)
        try:
            head += inflate.decompress(raw, _HEAD)
            while inflate.unconsumed_tail and b"\r\n\r\n" not in head:
                head += inflate.decompress(inflate.unconsumed_tail, _HEAD)
        except zlib.error:
            return None
        if not head.startswith(b"WARC/"[: len(head)]) or (not raw or inflate.eof) and b"\r\n\r\n" not in head:
            return None
        at += len(raw)
    fields = {}
    lines = head.split(b"\r\n\r\n", 1)[0].decode("utf-8", "surrogatepass").split("\r\n")
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    told = fields.get(_OFFSET.lower())
    if "warc-type" not in fields or told is not None and told != str(place):
        return None
    return fields


def _member(source: Source, place: int) -> tuple[bytes, int]:
    """The inflated record that starts here, and where its member ends."""
    inflate, out, at = zlib.decompressobj(31), [], place
    while not inflate.eof:
        raw = source.at(at, _READ)
        if not raw:
            raise ValueError(f"the record at {place} is cut off")
        out.append(inflate.decompress(raw))
        at += len(raw)
    return b"".join(out), at - len(inflate.unused_data)


def first_record(source: Source, start: int, end: int) -> int | None:
    """Where the first record that starts in start:end does."""
    at = start
    while at < end:
        raw = source.at(at, min(_READ, end - at) + len(MAGIC) - 1)
        found = raw.find(MAGIC)
        while found >= 0 and at + found < end:
            if _header(source, at + found) is not None:
                return at + found
            found = raw.find(MAGIC, found + 1)
        at += _READ
    return None


def records(source: Source, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of every record that starts in start:end."""
    place = first_record(source, start, end)
    while place is not None and place < end:
        fields = _header(source, place)
        if fields is None:  # padding or damage between records: look for the next
            place = first_record(source, place + 1, end)
            continue
        raw, place = _member(source, place)
        body = raw.index(b"\r\n\r\n") + 4
        yield fields, raw[body : body + int(fields["content-length"])]


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(
        (int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")),
        len(payload),
    )
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response":
        found = hashlib.sha256(payload).hexdigest()
        if digest and found != digest or size != len(payload):
            raise ValueError(f"damaged record {fields.get('warc-record-id')}")
        digest = found
    page = fields.get("warc-record-id", "")
    refers = fields.get("warc-refers-to")
    url = fields.get("warc-target-uri")
    return (
        int(page[10:-1]) if page.startswith("<urn:page:") else None,
        None if url is None else _plain(url),
        kind,
        size,
        digest,
        int(refers[10:-1]) if refers else None,
        payload if payloads and kind == "response" else None,
    )


def _ranges(payloads: bool):
    def run(batches: Batches) -> Batches:
        for b in batches:
            for path, size, start, end in zip(*(c.to_pylist() for c in b.columns), strict=True):
                store, name = _open(path)
                rows, held = [], 0
                with store.open_input_file(name) as handle:
                    for fields, block in records(Source(handle, size), start, end):
                        rows.append(_row(fields, block, payloads))
                        held += len(block) if payloads else 0
                        if len(rows) >= 5000 or held > 16 << 20:
                            yield batch(_RECORD, zip(*rows, strict=True))
                            rows, held = [], 0
                if rows:
                    yield batch(_RECORD, zip(*rows, strict=True))

    return run


def read_archives(manifest: DataFrame, size: int = RANGE, payloads: bool = True) -> DataFrame:
    """Every record of the files of ``manifest`` (path, size), read in ranges of ``size``
    bytes: page_id, url, record_type, payload_bytes, payload_digest, refers_to and payload
    (null for revisits, or if not wanted). A response whose payload does not have its
    digest is an error. An empty manifest gives none."""
    ranges = manifest.where("size > 0").withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(size).cast("long")))
    )
    ranges = ranges.select(
        "path", "size", "start", F.least(F.col("start") + F.lit(size), F.col("size")).alias("end")
    )
    parts = max(2, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return mapped(
        ranges.repartition(parts, "path", "start"),
        _ranges(payloads),
        "page_id long, url string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, payload binary",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
         sha256(coalesce(html, '')) AS digest
  FROM pages
), f AS (
  SELECT page_id, n, digest, min(page_id) OVER (PARTITION BY digest) AS first FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
