"""WARC archives: one gzip member per record, written and read sequentially.

An archive travels as chunks (archive, chunk, data) of at most ``CHUNK`` bytes, so
that neither side holds a whole one; the bytes of its chunks in order are a ``.warc.gz``
file. The reader takes chunks one by one, inflates each member as far as the bytes at
hand go, frames the record by its Content-Length and checks its digests.

Nulls: a null payload is empty, a record without url has no WARC-Target-URI, a null
page_id is written as an empty identifier and read as null. Rows with the same page_id
and payload are records each, of one type. Columns beside the named ones are not read.
Targets that are no addresses are escaped, and kept as they are in a field of their own.
Records of other writers are read too, with a null page.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialise

CHUNK = 1 << 20
CHUNKS_SCHEMA = "archive int, chunk long, data binary"
RECORDS_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload string"
)
PAGE = "urn:page:"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# What an address may hold as it stands: reserved and unreserved characters, and escapes.
PLAIN = "%:/?#[]@!$&'()*+,;=-._~"
DATE = "2024-01-01T00:00:00Z"  # of every record, so that archives are repeatable


class WarcError(ValueError):
    """A record that cannot be read or fails its digest."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _name(number: int | None) -> str:
    return f"<{PAGE}{'' if number is None else number}>"


def _number(name: str) -> int | None:
    """The page of a record id; null for the ids of other writers."""
    number = name.strip().removeprefix(f"<{PAGE}").removesuffix(">")
    return int(number) if number.removeprefix("-").isdecimal() else None


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> bytes:
    """A record: its header and, for a response, the HTTP message."""
    block = HTTP_HEAD + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        address = quote(url, safe=PLAIN)
        lines.append(f"WARC-Target-URI: {address}")
        if address != url or _address(address) != url:  # no address: kept for reading back
            lines.append(f"X-Target: {quote(url, safe='')}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(refers_to)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _address(value: str) -> str:
    """A target as other writers spell it: some put it in angle brackets."""
    return value[1:-1] if value.startswith("<") and value.endswith(">") else value


def gzip_member(record: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The records of an archive, each inflated from its own member."""
    inflate, parts = zlib.decompressobj(31), []
    begun = False
    for data in chunks:
        while data:
            begun = True
            try:
                parts.append(inflate.decompress(data))
            except zlib.error as error:
                raise WarcError(f"not a gzip member: {error}") from error
            data = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts, begun = zlib.decompressobj(31), [], False
    if begun:
        raise WarcError("the archive ends inside a record")


def read_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The header (names in lower case) and the block of a record."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    header = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t"):  # goes on with the field before
            header[name] = f"{header.get(name, '')} {line.strip()}".strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        header[name] = value.strip()
    try:
        length = int(header["content-length"])
    except (KeyError, ValueError) as error:
        raise WarcError("no Content-Length") from error
    if rest[length:] != b"\r\n\r\n":
        raise WarcError("the record is not as long as its Content-Length")
    block = rest[:length]
    _verify(header.get("warc-block-digest"), block, "block")
    return header, block


def _verify(digest: str | None, data: bytes, what: str) -> None:
    """Digests are base32 or hexadecimal; those of unknown algorithms cannot be verified."""
    method, _, value = (digest or "").partition(":")
    method = method.strip().lower().replace("-", "")
    if method not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return
    found = hashlib.new(method, data).digest()
    spelled = base64.b32encode(found).decode("ascii").rstrip("="), found.hex().upper()
    if value.strip().upper().rstrip("=") not in spelled:
        raise WarcError(f"the {what} does not match its digest")


def parse_record(record: bytes) -> tuple:
    """The values of ``RECORDS_SCHEMA``; the payload of a revisit is null.

    Records of other writers have a null page. Their payload is the body of an HTTP message or,
    in records of other kinds, the whole block; a digest other than SHA-1 is verified and replaced
    by SHA-1, or in a revisit, which has no payload, kept with the name of its algorithm.
    """
    header, block = read_record(record)
    digest = header.get("warc-payload-digest")
    revisit = header.get("warc-type") == "revisit"
    http = header.get("content-type", "application/http").startswith("application/http")
    payload = None if revisit else block.partition(b"\r\n\r\n")[2] if http else block
    if payload is not None:
        _verify(digest, payload, "payload")
        digest = f"sha1:{base32_sha1(payload)}"
    elif digest is not None and digest.lower().startswith("sha1:"):
        digest = f"sha1:{digest[5:]}"
    url = header.get("warc-target-uri")
    if "x-target" in header:
        url = unquote(header["x-target"])
    elif url is not None:
        url = _address(url)
    return (
        _number(header.get("warc-record-id", "")),
        url,
        header.get("warc-type"),
        _number(header.get("warc-refers-to", "")) if revisit else None,
        int(header.get("x-payload-length", len(payload or b""))),
        (digest or f"sha1:{base32_sha1(payload or b'')}").removeprefix("sha1:"),
        None if payload is None else payload.decode("utf-8", errors="replace"),
    )


def choose_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) with ``revisit`` and ``refers_to``.

    Of equal payloads of at least ``least_bytes``, those with the largest page_id are
    responses and the others revisit them. Only repeated payloads take part in the
    join; their table is stored, so its size is known before Spark chooses the join.
    """
    pages = pages.select("page_id", "url", F.coalesce("payload", F.lit("")).alias("payload"))
    digest = F.sha1(F.col("payload").cast("binary"))
    repeated = materialise(
        pages.filter(F.octet_length("payload") >= least_bytes)
        .groupBy(digest.alias("_digest"))
        .agg(F.max("page_id").alias("_last"), F.count("*").alias("_copies"))
        .filter("_copies > 1")
        .drop("_copies")
    )
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return (
        pages.withColumn("_digest", digest)
        .join(repeated, "_digest", "left")
        .select(
            "page_id",
            "url",
            "payload",
            revisit.alias("revisit"),
            F.when(revisit, F.col("_last")).alias("refers_to"),
        )
    )


def write_archives(typed: DataFrame, level: int = 6) -> DataFrame:
    """The records of ``choose_types`` as archives, one per task."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        archive, chunk, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def full() -> pa.RecordBatch:
            rows = [pa.array([archive], pa.int32()), pa.array([chunk], pa.int64())]
            return pa.RecordBatch.from_arrays(
                [*rows, pa.array([b"".join(waiting)], pa.binary())], ["archive", "chunk", "data"]
            )

        for batch in batches:
            names = ("page_id", "url", "payload", "refers_to", "revisit")
            for page_id, url, payload, refers_to, revisit in zip(*(column(batch, n) for n in names)):
                record = record_bytes(
                    page_id.as_py(), url.as_py(), payload.as_py().encode(), refers_to.as_py(), revisit.as_py()
                )
                waiting.append(gzip_member(record, level))
                size += len(waiting[-1])
                if size >= CHUNK:
                    yield full()
                    chunk, waiting, size = chunk + 1, [], 0
        if waiting:
            yield full()

    return typed.mapInArrow(write, CHUNKS_SCHEMA)


def read_archives(chunks: DataFrame) -> DataFrame:
    """The records of archives, each read from its first chunk to its last."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for archive in _archives(batches):
            yield from _record_batches(parse_record(r) for r in members(archive))

    in_order = chunks.repartition("archive").sortWithinPartitions("archive", "chunk")
    return in_order.mapInArrow(read, RECORDS_SCHEMA)


def read_files(paths: DataFrame) -> DataFrame:
    """The records of ``.warc.gz`` files, as Spark's ``binaryFile`` source gives them."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in column(batch, "content"):
                data = memoryview(content.as_buffer())
                pieces = (bytes(data[i : i + CHUNK]) for i in range(0, len(data), CHUNK))
                yield from _record_batches(parse_record(r) for r in members(pieces))

    return paths.select("content").mapInArrow(read, RECORDS_SCHEMA)


def _archives(batches: Iterable[pa.RecordBatch]) -> Iterator[Iterator[bytes]]:
    """The chunks of one archive after the other."""
    rows = (
        (a.as_py(), d.as_py())
        for batch in batches
        for a, d in zip(column(batch, "archive"), column(batch, "data"))
    )
    for _, group in groupby(rows, key=lambda row: row[0]):
        yield (data for _, data in group)


def _record_batches(records: Iterable[tuple], most: int = 500) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for record in records:
        waiting.append(record)
        if len(waiting) >= most:
            yield _batch(waiting)
            waiting = []
    if waiting:
        yield _batch(waiting)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [part.split()[0] for part in RECORDS_SCHEMA.split(", ")]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


