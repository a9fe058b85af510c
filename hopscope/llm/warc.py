"""WARC archives: a writer, and a sequential reader.

Archives are ``.warc.gz`` files with one gzip member for each record. The
reader takes an archive as a stream: it unpacks a member at a time by
incremental zlib decompression, frames the record by its Content-Length while the
chunks come, and updates block and payload digests with them. Bodies are passed on
in pieces of at most 64 kB, so a record of any length takes bounded memory.

Of pages with equal payloads of at least ``min_bytes`` bytes, that with the
largest page_id is written as a ``response``; the others are ``revisit``
records that refer to it and hold headers only. Equal payloads meet by their
digests alone: a digest's largest id is a grouped maximum, and only digests
that occur twice or more are joined back. They are broadcast up to 16 MB; more
of them (about 111,000) are joined through a shuffle of the pages.

Files go to the shared folder under names of their own for each attempt; the
table of committed attempts' files, written by Spark, says which count.

Defined results: a null html is an empty payload; a null url is written as an
empty target; a null page_id never is the largest, unless all are null; if
equal payloads share the largest page_id (repeated rows), each is a response;
an empty table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.llm.common import attach, fresh_path, stored

#: Bytes after which an archive is closed.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 16
LEVEL = 5

#: Fixed values of the format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    pass


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: tuple[int | None] | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as a gzip member. ``refers_to`` holds the response's id for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {record_uri(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        *([f"WARC-Refers-To: {record_uri(refers_to[0])}", f"WARC-Profile: {REVISIT_PROFILE}"] if refers_to else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def headers(lines: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = lines.decode("utf-8").split("\r\n")
    fields = {}
    for line in rest:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"not a header: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    return first, fields


def members(stream) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as an iterator over its unpacked
    chunks; a member must be used up before the next one is asked for."""
    data = stream.read(CHUNK)
    rest = [data]

    def unpack() -> Iterator[bytes]:
        z = zlib.decompressobj(31)
        while not z.eof:
            if not rest[0]:
                rest[0] = stream.read(CHUNK)
                if not rest[0]:
                    raise WarcError("the archive ends inside a record")
            out = z.decompress(rest[0], CHUNK)
            rest[0] = z.unused_data if z.eof else z.unconsumed_tail
            if out:
                yield out

    while rest[0]:
        yield unpack()
        rest[0] = rest[0] or stream.read(CHUNK)


def _head(chunks: Iterator[bytes], held: bytes = b"") -> tuple[bytes, bytes]:
    """The lines up to the first empty one, and what came after it."""
    got = bytearray(held)
    at = got.find(END)
    while at < 0:
        chunk = next(chunks, None)
        if chunk is None:
            raise WarcError("a record without end of headers")
        seen = max(len(got) - len(END) + 1, 0)
        got += chunk
        at = got.find(END, seen)
    return bytes(got[:at]), bytes(got[at + len(END) :])


def _framed(chunks: Iterator[bytes], held: bytes, size: int, digest) -> Iterator[bytes]:
    """The ``size`` bytes of a block as they come; the record must end after them."""
    while size:
        piece, held = held[:size], held[size:]
        if piece:
            size -= len(piece)
            digest.update(piece)
            yield piece
        elif (held := next(chunks, None)) is None:
            raise WarcError("a record isn't as long as its Content-Length")
    for chunk in chunks:
        held += chunk
        if len(held) > len(END):
            break
    if held != END:
        raise WarcError("a record isn't as long as its Content-Length")


def _differs(field: str | None, digest) -> bool:
    return field is not None and field != "sha1:" + base64.b32encode(digest.digest()).decode()


def _body(fields: dict[str, str], http: dict[str, str], pieces: Iterator[bytes], block) -> Iterator[bytes]:
    payload, size = hashlib.sha1(), 0
    for piece in pieces:
        payload.update(piece)
        size += len(piece)
        yield piece
    if _differs(fields.get("warc-block-digest"), block):
        raise WarcError("block digest differs")
    if fields["warc-type"] == "response":
        if size != int(http["content-length"]):
            raise WarcError("a payload isn't as long as its Content-Length")
        if _differs(fields.get("warc-payload-digest"), payload):
            raise WarcError("payload digest differs")


def records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], Iterator[bytes]]]:
    """(record headers, HTTP headers, pieces of the body) of each record.

    Framing and digests are checked as the pieces are taken; pieces that the
    caller leaves are read and checked before the next record."""
    for chunks in members(stream):
        head, rest = _head(chunks)
        version, fields = headers(head)
        if not version.startswith("WARC/"):
            raise WarcError(f"not a record: {version[:40]!r}")
        block = hashlib.sha1()
        framed = _framed(chunks, rest, int(fields["content-length"]), block)
        head, rest = _head(framed)
        _, http = headers(head)
        pieces = _body(fields, http, chain([rest] if rest else [], framed), block)
        yield fields, http, pieces
        for _ in pieces:
            pass


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


ARCHIVES = "path string, n_records long, n_bytes long"


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) below ``path``; return the table of archives."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    slim = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha"))
    large = slim.where(F.octet_length("html") >= min_bytes) if min_bytes else slim
    groups = large.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1").drop("n").withColumn("again", F.lit(True)), "warc-groups")
    marked = attach(slim, groups, ["sha"], groups.count(), 150, F.xxhash64("page_id"))
    revisit = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = marked.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, name, n, size = TaskContext.get().partitionId(), None, "", 0, 0

        def close() -> pa.RecordBatch:
            nonlocal out, n, size
            out.close()
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], ["path", "n_records", "n_bytes"])
            out, n, size = None, 0, 0
            return row

        for batch in batches:
            for page, url, text, first, again in zip(*batch.columns, strict=True):
                if out is None:
                    name = f"{path}/{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    files, place = _open(name)
                    files.create_dir(place.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(place, compression=None)
                data = record(page.as_py(), url.as_py(), text.as_py().encode("utf-8"), (first.as_py(),) if again.as_py() else None)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    yield close()
        if out is not None:
            yield close()

    ready.mapInArrow(run, ARCHIVES).write.parquet(f"{path}/archives")
    return spark.read.schema(ARCHIVES).parquet(f"{path}/archives")


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, body binary"


def _page(uri: str | None) -> int | None:
    found = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found else None


def read_archives(archives: DataFrame, bodies: bool = True) -> DataFrame:
    """A row for each record of the archives; each archive is read as a stream
    by one task. ``bodies=False`` checks them but leaves them out."""
    names = RECORDS.replace(",", "").split()[::2]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = _open(path)
                rows, held = [], 0

                def flush() -> pa.RecordBatch:
                    nonlocal rows, held
                    cols, rows, held = zip(*rows, strict=True), [], 0
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

                with files.open_input_stream(place, compression=None) as stream:
                    for fields, http, pieces in records(stream):
                        body = b"".join(pieces) if bodies else None
                        rows.append(
                            (
                                _page(fields["warc-record-id"]),
                                fields["warc-target-uri"],
                                fields["warc-type"],
                                _page(fields.get("warc-refers-to")),
                                int(http["content-length"]),
                                fields["warc-payload-digest"].removeprefix("sha1:"),
                                body,
                            )
                        )
                        held += len(body or b"") + 200
                        if held > 4 << 20:
                            yield flush()
                if rows:
                    yield flush()

    spark = archives.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return archives.select("path").repartition(tasks).mapInArrow(run, RECORDS)


PIECES = "page_id long, piece long, body binary"


def read_pieces(archives: DataFrame) -> DataFrame:
    """The bodies in numbered pieces, for records too long for one row."""
    types = [pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = _open(path)
                with files.open_input_stream(place, compression=None) as stream:
                    for fields, _, pieces in records(stream):
                        page = _page(fields["warc-record-id"])
                        for i, piece in enumerate(pieces):
                            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((page, i, piece), types, strict=True)], PIECES.replace(",", "").split()[::2])

    tasks = max(int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return archives.select("path").repartition(tasks).mapInArrow(run, PIECES)


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to the shared folder, and read them back."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "warc"), **options), bodies=False)
