"""Legacy ARC archives converted to WARC.

An ARC file starts with a version block that names the fields of its record headers; version 1 has
five of them, version 2 ten. Each record is a header line, as many bytes as the line declares, and a
line break. The converter turns every record into an equivalent WARC record: an identifier derived
from where the record lay, the timestamp, a type, and digests of block and payload. Of records with
one payload the first stays a response, the others become revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import files, map_arrow, materialized, put, shared_folder
from shelfline.plans.lookup import lookup_join

#: The record header fields of both ARC versions, as their version blocks name them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed value: the revisit profile of the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARCHIVE_BYTES = 8 << 20
_SLICE = 16 << 10
LEAST_PAYLOAD = 100
PAGE_HEADER = "X-Page-Id"
_DATE = "20200102030405"


def arc_version_block(version: int, name: str) -> bytes:
    """The record an ARC file of a version starts with."""
    block = f"{version} 0 example.org\n{ARC_FIELDS[version]}\n".encode()
    more = "" if version == 1 else f" 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {_DATE} text/plain{more} {len(block)}\n".encode() + block + b"\n"


def arc_record(version: int, name: str, offset: int, url: str, content: bytes, date: str = _DATE, kind: str = "text/html") -> bytes:
    """One ARC record."""
    more = "" if version == 1 else f" 200 {zlib.crc32(content):08x} - {offset} {name}"
    return f"{url} 0.0.0.0 {date} {kind}{more} {len(content)}\n".encode() + content + b"\n"


def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header fields and content of every record of an ARC file but the version block. The
    block says which fields a header line has; the last of them is the length of the content."""
    at, fields = 0, None
    while at < len(data):
        begin, end = at, data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no header line at {at}")
        line = data[at:end].decode("utf-8", "replace").split(" ")
        if not line[-1].isdigit():
            raise ValueError(f"no length in the header line at {at}")
        content = data[end + 1 : end + 1 + int(line[-1])]
        if len(content) < int(line[-1]):
            raise ValueError(f"the record at {at} is cut off")
        at = end + 1 + len(content)
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if fields is None:
            if not line[0].startswith("filedesc:"):
                raise ValueError("no version block")
            about = content.decode("utf-8", "replace").split("\n")
            fields = about[1].strip().split(" ")
            if about[0].split(" ")[0] not in {str(v) for v in ARC_FIELDS} or len(line) != len(fields):
                raise ValueError(f"unknown ARC version {about[0]!r}")
            continue
        if len(line) != len(fields):
            raise ValueError(f"{len(line)} header fields at {begin}, the version has {len(fields)}")
        yield begin, dict(zip(fields, line, strict=True)), content


def gzipped(record: bytes, level: int) -> bytes:
    """A record as a gzip member of its own, as archives of both kinds hold them."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def gzip_members(data: bytes) -> Iterator[bytes]:
    """What each gzip member holds, then what follows the last one, if anything. Members are fed in
    slices: what a member does not use is copied, and must not be the whole rest of the archive."""
    view, at = memoryview(data), 0
    while view[at : at + 2] == b"\x1f\x8b":
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            piece = view[at : at + _SLICE]
            if not len(piece):
                raise ValueError("the last record is cut off")
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        yield b"".join(parts)
    if at < len(view):
        yield bytes(view[at:])


def unzipped(data: bytes) -> bytes:
    """The records of an archive, whether it is compressed or not."""
    return b"".join(gzip_members(data))


def iso_date(date: str) -> str:
    """A 14-digit ARC date (8 or 12 digits in old files) as WARC writes it."""
    return datetime.strptime(date.ljust(14, "0"), "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header and payload; no header, all payload."""
    end = content.find(b"\r\n\r\n") if content.startswith(b"HTTP/") else -1
    return (content[: end + 4], content[end + 4 :]) if end >= 0 else (b"", content)


def _header_value(block: bytes, name: str) -> str | None:
    for line in block.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def record_id(archive: str, offset: int, *content: str) -> str:
    """An identifier that a repeated conversion gives again, and one of another archive does not:
    it follows from where the record lay and what it holds."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '#'.join([archive, str(offset), *content]))}>"


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record, a gzip member of its own."""
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzipped(head.encode() + block + b"\r\n\r\n", 4)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a gzipped WARC file; digests are checked."""
    for record in gzip_members(data):
        head, _, rest = record.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        block = rest[: int(headers["content-length"])]
        if len(block) < int(headers["content-length"]):
            raise ValueError(f"the block of {headers.get('warc-record-id')} is cut off")
        if headers["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"wrong block digest in {headers.get('warc-record-id')}")
        yield headers, block


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", size: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages as compressed ARC files of both versions by turns: ``name, records``. Null pages have an empty
    payload, a null address becomes ``about:blank``; the key travels in an HTTP header."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, data, records, length = TaskContext.get().partitionId(), 0, None, 0, 0

        def named() -> tuple[int, str]:
            return 1 + (part + number) % 2, f"{part:08d}-{number:06d}.arc.gz"

        def flush() -> pa.RecordBatch:
            put(f"{folder}/{named()[1]}", bytes(data))
            return pa.RecordBatch.from_pydict({"name": [named()[1]], "records": pa.array([records], pa.int64())})

        for batch in batches:
            for page, address, payload in zip(*(batch.column(c).to_pylist() for c in ("key", "url", "html")), strict=True):
                version, name = named()
                data = bytearray(gzipped(arc_version_block(version, name), 1)) if data is None else data
                payload = payload or b""
                who = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{who}Content-Length: {len(payload)}\r\n\r\n".encode()
                address = quote(address or "about:blank", safe=":/?#[]@!$&'()*+,;=%~")
                record = arc_record(version, name, len(data), address, head + payload)
                data += gzipped(record, 1)
                records, length = records + 1, length + len(record)
                if length >= size:
                    yield flush()
                    number, data, records, length = number + 1, None, 0, 0
        if records:
            yield flush()

    return materialized(map_arrow(rows, write, "name string, records bigint"), "arc")


_PARSED = "id string, page bigint, uri string, ip string, date string, http boolean, head binary, payload binary, digest string, bytes bigint"


def parsed_arc(spark, folder: str) -> DataFrame:
    """One row for every ARC record of a folder."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in _PARSED.split(", ")]
        kinds = {"page": pa.int64(), "http": pa.bool_(), "head": pa.binary(), "payload": pa.binary(), "bytes": pa.int64()}
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                rows = []
                for offset, f, block in arc_records(unzipped(content.as_py())):
                    head, payload = _split_http(block)
                    page = _header_value(head, PAGE_HEADER)
                    digest = hashlib.sha256(payload).hexdigest()
                    rows.append((record_id(name.as_py(), offset, digest, f["URL"], f["Archive-date"]), int(page) if page else None, f["URL"], f["IP-address"], iso_date(f["Archive-date"]), bool(head), head, payload, digest, len(payload)))
                columns = zip(*rows, strict=True) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names)

    return map_arrow(files(spark, folder), parse, _PARSED)


def convert(spark, arc_folder: str, warc_folder: str, least: int = LEAST_PAYLOAD, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Convert the ARC files of a folder: ``name, records`` of the WARC files made.

    Of records with equal payloads of at least ``least`` bytes, the one with the smallest page (then
    identifier; pages without a key last) is written as response, the others as revisits without
    their payload. Only digests are grouped, and counted before they move.
    """
    parsed = parsed_arc(spark, arc_folder)
    digests = materialized(parsed.select("id", "page", "uri", "date", "digest", "bytes"), "digests")
    large = digests.where(F.col("bytes") >= least)
    first = F.min(F.struct(F.col("page").isNull().alias("unknown"), "page", "id", "uri", "date"))
    firsts = large.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    again = lookup_join(large.select("id", "digest"), firsts, "digest", "inner").where("id <> first.id")
    again = again.select("id", F.col("first.id").alias("to_id"), F.col("first.uri").alias("to_uri"), F.col("first.date").alias("to_date"))
    decided = lookup_join(parsed, materialized(again, "revisits"), "id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, data, records = TaskContext.get().partitionId(), 0, None, 0

        def flush() -> pa.RecordBatch:
            name = f"{part:08d}-{number:06d}.warc.gz"
            put(f"{warc_folder}/{name}", bytes(data))
            return pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([records], pa.int64())})

        for batch in batches:
            for r in batch.to_pylist():
                if data is None:
                    about = f"software: shelfline\r\nformat: WARC File Format 1.0\r\npart: {part} {number}\r\n".encode()
                    own = record_id(f"warcinfo-{part}-{number}", 0, r["id"])
                    data = bytearray(warc_record("warcinfo", [("WARC-Record-ID", own), ("WARC-Date", iso_date(_DATE)), ("Content-Type", "application/warc-fields")], about))
                headers = [("WARC-Record-ID", r["id"]), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["uri"]), ("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha256:{r['digest']}")]
                headers.append(("Content-Type", "application/http; msgtype=response" if r["http"] else "application/octet-stream"))
                if r["to_id"]:
                    refers = [("WARC-Refers-To", r["to_id"]), ("WARC-Refers-To-Target-URI", r["to_uri"]), ("WARC-Refers-To-Date", r["to_date"])]
                    data += warc_record("revisit", [*headers, ("WARC-Profile", REVISIT_PROFILE), *refers], r["head"])
                else:
                    data += warc_record("response" if r["http"] else "resource", headers, r["head"] + r["payload"])
                records += 1
                if len(data) >= size:
                    yield flush()
                    number, data, records = number + 1, None, 0
        if records:
            yield flush()

    return materialized(map_arrow(decided, write, "name string, records bigint"), "warc")


def read_warc(spark, folder: str) -> DataFrame:
    """``id, page, payload_bytes, payload_digest, record_type, to_id`` of every response, resource
    and revisit of a folder. A payload that is there is checked against its digest; that of a revisit
    is described by its headers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "page", "payload_bytes", "payload_digest", "record_type", "to_id"]
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for headers, block in warc_records(content.as_py()):
                    kind = headers["warc-type"]
                    if kind == "warcinfo":
                        continue
                    head, payload = _split_http(block)
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"wrong payload digest in {headers['warc-record-id']}")
                    page = _header_value(head, PAGE_HEADER)
                    size = int(_header_value(head, "Content-Length") or 0) if kind == "revisit" else len(payload)
                    rows.append((headers["warc-record-id"], int(page) if page else None, size, digest, kind, headers.get("warc-refers-to")))
                columns = zip(*rows, strict=True) if rows else [[] for _ in names]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return map_arrow(files(spark, folder), read, "id string, page bigint, payload_bytes bigint, payload_digest string, record_type string, to_id string")


def archived_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_PAYLOAD) -> DataFrame:
    """Write ``pages`` as ARC files, convert them to WARC and read those back: ``key, payload_bytes,
    payload_digest, record_type, refers_to`` for every row.

    Null pages are empty payloads, rows without key keep a null key, repeated rows are records of
    their own, and an empty table gives an empty result.
    """
    spark = pages.sparkSession
    arc, warc = shared_folder(spark, "arc"), shared_folder(spark, "warc")
    if write_arc(pages, arc, key, url, html).isEmpty():
        empty = f"{key} bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
        return spark.createDataFrame([], empty)
    convert(spark, arc, warc, least)
    records = materialized(read_warc(spark, warc), "records")
    referred = records.where("to_id is not null").select(F.col("to_id").alias("id")).distinct()
    targets = lookup_join(records.select("id", "page"), referred, "id", "left_semi").toDF("to_id", "refers_to")
    named = lookup_join(records.drop("id"), targets, "to_id")
    return named.select(F.col("page").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")
