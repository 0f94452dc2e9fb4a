"""WARC archives through a chunked record table.

A payload is never held whole by the writer or the reader. Spark cuts each
into rows ``(record identifier, chunk number, bytes)`` of at most
``CHUNK_BYTES``; the writer appends the chunks of a record to a gzip member as
they pass, and the reader gives the same rows back while it streams through an
archive, each with the length and SHA-1 of the payload so far. A record of any
size thus takes one chunk of memory, and the digest of the last chunk is that
of the payload.

Writing: records are spread by identifier, so copies of one payload do not
meet in a task. A task writes archives named by a random identifier and
returns a manifest row per archive; only the manifest of tasks that Spark
committed is kept, so the archives of a lost or repeated attempt are never
read. Archives are closed at ``ARCHIVE_BYTES``, and each is one unit of
reading. The folder must be reachable by every executor.

Equal payloads (same SHA-1 and length) of at least ``REVISIT_BYTES`` bytes:
the record of the largest page_id is the ``response``; the others are
``revisit`` records, without payload, that refer to it.

Defined cases: a null payload is empty; an empty one is a record with Defined cases: a null payload is empty; an empty one is a record with one
empty chunk. Rows that repeat both page_id and payload are one record, whose
header says how many they are, and ``page_records`` gives each its row.
Rows that share a page_id but not the payload are a record each. A null
page_id is smaller than any other. Null URLs give records without a target
URI. An empty table gives no archive and no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import stage_table
from rebuy.sources.stage import stage_root

CHUNK_BYTES = 64 * 1024
ARCHIVE_BYTES = 256 * 1024 * 1024
REVISIT_BYTES = 1000
#: Repeated rows that are counted out at once.
RUN = 1 << 14

#: Fixed by the archive format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

_MANIFEST = "path string, n_records long, n_bytes long"
_READ = (
    "record_id string, page_id long, n_rows long, record_type string, url string, refers_to_record string, "
    "declared_digest string, chunk_no long, is_last boolean, payload_bytes long, payload_digest string, data binary"
)


def record_id(page_id: Column, digest: Column) -> Column:
    """A UUID that page and payload decide, so a repeated attempt gives the same one."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("null")), digest))
    parts = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """The records to write, without payload: one row per distinct page_id and payload, with the number of its rows."""
    body = F.encode(F.coalesce(pages[payload].cast("string"), F.lit("")), "UTF-8")
    meta = (
        pages.select(
            pages[page_id].cast("long").alias("page_id"),
            pages[url].cast("string").alias("url"),
            F.sha1(body).alias("digest"),
            F.octet_length(body).cast("long").alias("n_bytes"),
        )
        .groupBy("page_id", "digest", "n_bytes")
        .agg(F.min("url").alias("url"), F.count("*").alias("n_rows"))
    )
    # One row per payload with copies: the hot side of the join is the other one, which AQE may split.
    copies = (
        meta.filter(F.col("n_bytes") >= REVISIT_BYTES)
        .groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("_d"), F.col("n_bytes").alias("_n"), "keeper")
    )
    joined = meta.join(copies, (F.col("digest") == F.col("_d")) & (F.col("n_bytes") == F.col("_n")), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select(
        record_id(F.col("page_id"), F.col("digest")).alias("record_id"),
        "page_id",
        "n_rows",
        "url",
        "digest",
        "n_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, record_id(F.col("keeper"), F.col("digest"))).alias("refers_to_record"),
    )


def chunks(pages: DataFrame, *, page_id: str = "page_id", payload: str = "html", size: int = CHUNK_BYTES) -> DataFrame:
    """``record_id, chunk_no, data``: every payload cut into pieces, in the JVM."""
    body = F.encode(F.coalesce(pages[payload].cast("string"), F.lit("")), "UTF-8")
    base = pages.select(pages[page_id].cast("long").alias("page_id"), body.alias("_body"))
    base = base.select(record_id(F.col("page_id"), F.sha1("_body")).alias("record_id"), "_body")
    # Only numbers are exploded: a chunk is cut out of the payload when its row is made.
    last = F.expr(f"greatest((octet_length(_body) - 1L) DIV {size}L, 0L)")
    numbered = base.select("record_id", "_body", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk_no"))
    return numbered.select("record_id", "chunk_no", F.expr(f"substring(_body, cast(chunk_no * {size}L AS int) + 1, {size})").alias("data"))


def _header(row: dict) -> tuple[bytes, bytes]:
    """The record's header block, and the start of its content before the payload."""
    revisit = row["record_type"] == "revisit"
    start = HTTP_HEAD.format(0 if revisit else row["n_bytes"]).encode()
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),  # pages carry no time
        ("WARC-Target-URI", row["url"]),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{row['refers_to_record']}>" if revisit else None),
        ("Page-Id", None if row["page_id"] is None else str(row["page_id"])),
        ("Page-Rows", str(row["n_rows"]) if row["n_rows"] > 1 else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(start) + (0 if revisit else row["n_bytes"]))),
    ]
    clean = ((k, v.replace("\r", "%0D").replace("\n", "%0A")) for k, v in fields if v is not None)
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in clean).encode() + b"\r\n", start


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class _Archive:
    """One archive being written: a gzip member per record."""

    def __init__(self, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, place = _opened(self.path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.out, self.size, self.records, self.member = system.open_output_stream(place), 0, 0, None

    def put(self, data: bytes) -> None:
        self._raw(self.member.compress(data))

    def _raw(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def begin(self, row: dict) -> None:
        self.member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.records += 1
        for part in _header(row):
            self.put(part)

    def end(self) -> None:
        if self.member is not None:
            self.put(b"\r\n\r\n")
            self._raw(self.member.flush())
            self.member = None

    def close(self) -> list:
        self.end()
        self.out.close()
        return [self.path, self.records, self.size]


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done, at, skip = None, [], (None, None), False
        for batch in batches:
            for row in batch.to_pylist():
                place = (row["record_id"], row["chunk_no"])
                if place == at:  # a repeated row
                    continue
                at = place
                if row["chunk_no"] < 0:
                    if archive is not None:
                        archive.end()
                        if archive.size >= archive_bytes:
                            done.append(archive.close())
                            archive = None
                    archive = archive or _Archive(folder)
                    archive.begin(row)
                    skip = row["record_type"] == "revisit"
                elif not skip:
                    archive.put(row["data"])
        if archive is not None:
            done.append(archive.close())
        columns = list(zip(*done, strict=True)) or [[], [], []]
        types = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["path", "n_records", "n_bytes"]
        )

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes the archives and returns their manifest, which is staged: a later use does not write again."""
    heads = records(pages, page_id=page_id, url=url, payload=payload)
    heads = heads.withColumns({"chunk_no": F.lit(-1).cast("long"), "data": F.lit(None).cast("binary")})
    body = chunks(pages, page_id=page_id, payload=payload, size=chunk_bytes)
    rows = heads.unionByName(body, allowMissingColumns=True)
    spread = rows.repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return stage_table(spread.mapInArrow(_writer(folder, archive_bytes), _MANIFEST), "op6_manifest")


class _Members:
    """Bytes of the gzip members of an archive, one after the other, with a bounded buffer."""

    def __init__(self, source, piece: int) -> None:
        self.source, self.piece, self.raw, self.buffer = source, piece, b"", b""
        self.member = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.member.eof:
            self.raw, self.member = self.member.unused_data or self.raw, zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.source.read(self.piece)
            if not self.raw:
                return False
        got = self.member.decompress(self.raw, self.piece)
        self.raw = b"" if self.member.eof else self.member.unconsumed_tail
        self.buffer += got
        return True

    def line(self) -> bytes:
        while (end := self.buffer.find(b"\n")) < 0:
            if not self._more():
                got, self.buffer = self.buffer, b""
                return got
        got, self.buffer = self.buffer[: end + 1], self.buffer[end + 1 :]
        return got

    def read(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got


def _fields(source: _Members) -> dict[str, str]:
    found = {}
    while (line := source.line().rstrip(b"\r\n")) != b"":
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _parsed(path: str, piece: int, with_data: bool) -> Iterator[tuple]:
    system, place = _opened(path)
    with system.open_input_stream(place) as raw:
        source = _Members(raw, piece)
        while version := source.line():
            if not version.strip():
                continue
            head = _fields(source)
            left, http = int(head["content-length"]), 0
            while True:  # the HTTP head counts as content, not as payload
                line = source.line()
                http += len(line)
                if not line.strip():
                    break
            left -= http
            digest, total, number = hashlib.sha1(), 0, 0
            while True:
                data = source.read(min(piece, left))
                if left and not data:
                    raise EOFError(f"{path} ends inside {head['warc-record-id']}")
                left, total = left - len(data), total + len(data)
                digest.update(data)
                yield (
                    head["warc-record-id"].strip("<>"),
                    int(head["page-id"]) if "page-id" in head else None,
                    int(head.get("page-rows", 1)),
                    head["warc-type"],
                    head.get("warc-target-uri"),
                    head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
                    head["warc-payload-digest"].removeprefix("sha1:"),
                    number,
                    left == 0,
                    total,
                    digest.hexdigest(),
                    data if with_data else None,
                )
                number += 1
                if left == 0:
                    break


def _reader(piece: int, with_data: bool):
    kinds = [
        pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(),
        pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary(),
    ]
    names = [c.split()[0] for c in _READ.split(", ")]
    at_once = 64 if with_data else 4096

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for given in batches:
            for path in given.column(0).to_pylist():
                for row in _parsed(path, piece, with_data):
                    rows.append(row)
                    if len(rows) >= at_once:
                        yield batch(rows)
                        rows = []
        yield batch(rows)

    return read


def read_chunks(manifest: DataFrame, *, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest``.

    One row per chunk, in order within a record: ``payload_bytes`` and
    ``payload_digest`` cover the payload up to and with this chunk,
    ``is_last`` marks the row where they cover all of it. ``with_data=False``
    leaves the bytes out, for uses that need only the figures.
    """
    # A number of partitions is given, or AQE would join such small rows to one task.
    paths = manifest.select("path").repartition(max(1, manifest.count()))
    return paths.mapInArrow(_reader(chunk_bytes, with_data), _READ)


def page_records(read: DataFrame) -> DataFrame:
    """One row per written row of pages from its record's last chunk; a revisit has the figures of the response that it refers to."""
    last = stage_table(read.filter("is_last").drop("data", "chunk_no", "is_last"), "op6_records")
    full = last.filter("record_type = 'response'").select(
        F.col("record_id").alias("_rid"),
        F.col("page_id").alias("_page"),
        F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest"),
    )
    joined = last.join(full, last["refers_to_record"] == full["_rid"], "left")
    revisit = F.col("record_type") == "revisit"
    # Rows that repeat are counted out in runs, so no array grows with their number.
    runs = F.sequence(F.lit(0).cast("long"), F.col("n_rows") - 1, F.lit(RUN).cast("long"))
    joined = joined.withColumn("_at", F.explode(runs))
    joined = joined.withColumn("_row", F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + RUN, F.col("n_rows")) - 1)))
    return joined.select(
        "page_id",
        F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.when(revisit, F.col("_page")).alias("refers_to"),
        "declared_digest",
        "url",
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared one that the cluster names."""
    return f"{stage_root(spark)}/warc-{uuid.uuid4().hex[:12]}"
