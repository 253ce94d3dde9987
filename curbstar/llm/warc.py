"""Legacy ARC archives, their conversion to WARC, and both formats read back.

An ARC file begins with a version block that names its fields; then each record has one header line
of these fields and as many bytes as its length says. Version 1 has five fields, version 2 has ten.
The converter makes one WARC file of each ARC file. It derives what ARC lacks: a record id from the
file's name and the record's offset, the date in ISO form, the type from the address and from the
first bytes of the block, and SHA-1 digests of block and payload. Records whose payload occurs again
elsewhere become revisits of one of them, chosen over all archives: pass one lists digests, a join
finds the revisits, pass two writes.

Archives are written by Spark as rows of one file each, of at most ``ARCHIVE_BYTES`` unless a single
record is longer; a file is read whole by one task, as archives of that time were small.

Defined results: a null page is an empty payload; a null or empty address is ``urn:unknown``, and
bytes that would break a header line are percent-encoded; a record without the header that ranks it
ranks lowest; of repeated rows one is the response, the record with the largest id; a length beyond the
end of the file takes what is there and says ``WARC-Truncated``; a header line that cannot be read is
skipped; a date that is none becomes the start of 1970; an empty table writes no archive and gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.llm.common import Scratch

ARCHIVE_BYTES = 32 << 20
GZIP_LEVEL = "BEST_SPEED"
#: Payloads from this size on are written once.
LEAST_REVISIT = 1000
CAPTURED = "20000101000000"
ID_HEADER = "X-Page-Id"

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))


# --- ARC ----------------------------------------------------------------------------------------


def page_block(page_id: str = "page_id", html: str = "html") -> Column:
    """A page as the HTTP response that an archive would hold."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    known = F.concat(F.lit(f"{ID_HEADER}: "), F.col(page_id).cast("string"), F.lit("\r\n"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n"),
        F.coalesce(known, F.lit("")),
        F.lit("\r\n"),
    )
    return F.concat(head.cast("binary"), body)


def _version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 curbstar\n{ARC_FIELDS[version]}\n\n"
    more = f" 200 - - 0 {name}" if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{more} {len(body)}\n{body}".encode()


def write_arc(
    records: DataFrame, folder: str, versions: Sequence[int] = (1, 2), date: str = CAPTURED,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write ``url, block`` as ARC archives, of the given versions in turn."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        parts: list[bytes] = []
        size = 0

        def begun() -> tuple[str, int]:
            version = versions[(task + number) % len(versions)]
            return f"curbstar-{task:06d}-{number:06d}.arc", version

        def closed() -> pa.RecordBatch:
            # the writer ends the row, and so the last record, with a line feed
            return pa.RecordBatch.from_arrays(
                [pa.array([b"".join(parts)[:-1]], pa.binary())], ["value"]
            )

        for batch in batches:
            for url, block in zip(batch.column("url"), batch.column("block")):
                block = block.as_py() or b""
                if parts and size + len(block) > archive_bytes:
                    yield closed()
                    parts, size, number = [], 0, number + 1
                name, version = begun()
                if not parts:
                    parts.append(_version_block(name, version, date))
                    size = len(parts[0])
                address = quote((url.as_py() or "").encode(), safe=_PRINTABLE) or "urn:unknown"
                more = f" 200 - - {size} {name}" if version == 2 else ""
                head = f"{address} 0.0.0.0 {date} text/html{more} {len(block)}\n".encode()
                parts += [head, block, b"\n"]
                size += len(head) + len(block) + 1
        if parts:
            yield closed()

    _write_archives(records.select("url", "block").mapInArrow(pack, "value binary"), folder, "\n")


def _write_archives(rows: DataFrame, folder: str, end: str) -> None:
    """A file for each row, with ``end`` after its bytes."""
    (
        rows.select(F.col("value").cast("string"))
        .write.option("maxRecordsPerFile", 1)
        .option("lineSep", end)
        .option("compression", "gzip")
        .option("zlib.compress.level", GZIP_LEVEL)
        .text(folder)
    )


def unpacked(content: bytes) -> bytes:
    """An archive's bytes, whether compressed as a whole, record by record, or not."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    block: memoryview
    truncated: bool

    @property
    def url(self) -> str:
        return self.fields.get("URL", "")

    @property
    def is_version_block(self) -> bool:
        return self.url.startswith("filedesc://")

    @property
    def http_end(self) -> int:
        """Where the HTTP header ends, 0 if the block is no HTTP response."""
        if bytes(self.block[:5]) != b"HTTP/":
            return 0
        found = re.search(rb"\r?\n\r?\n", self.block)
        return found.end() if found else len(self.block)

    @property
    def warc_type(self) -> str:
        if self.is_version_block:
            return "warcinfo"
        return "response" if self.http_end else "resource"


def _columns(line: bytes, names: Sequence[str]) -> dict[str, str] | None:
    """A header line by field names; blanks beyond their number belong to the address."""
    values = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
    if len(values) != len(names) or not values[-1].isdigit():
        return None
    return dict(zip(names, values))


def arc_records(content: bytes) -> Iterator[ArcRecord]:
    """Records of an unpacked ARC file, its version block first."""
    view, at = memoryview(content), 0
    names = ARC_FIELDS[1].split(" ")
    while at < len(content):
        end = content.find(b"\n", at)
        end = len(content) if end < 0 else end
        line = content[at:end].rstrip(b"\r")
        offset, at = at, end + 1
        if not line:
            continue
        if line.startswith(b"filedesc://"):
            # the names of its fields follow on its third line; versions differ in their number
            version = content[at : at + 1]
            names = ARC_FIELDS[2 if version == b"2" else 1].split(" ")
        fields = _columns(line, names)
        if fields is None:
            continue
        size = int(fields["Archive-length"])
        block = view[at : at + size]
        if line.startswith(b"filedesc://"):
            declared = bytes(block).split(b"\n")
            if len(declared) > 1 and declared[1].endswith(b"Archive-length"):
                names = declared[1].decode().split(" ")
        yield ArcRecord(offset, fields, block, len(block) < size)
        at += size


# --- WARC ---------------------------------------------------------------------------------------


def record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


def warc_date(arc_date: str) -> str:
    try:
        return datetime.strptime(arc_date, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def _digest(data: bytes | memoryview) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(block: memoryview, end: int, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", bytes(block[:end]))
    return found[1].decode("utf-8", "replace") if found else None


def _number(text: str) -> int | None:
    number = int(text) if re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def _warc(fields: Sequence[tuple[str, str]], block: bytes | memoryview) -> list[bytes | memoryview]:
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    return [f"{head}Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"]


def to_warc(name: str, content: bytes, revisits: dict[int, tuple[str, str, str]]) -> bytes:
    """The WARC file of an ARC file; ``revisits`` maps offsets to the record that each refers to
    (id, address, date)."""
    parts: list[bytes | memoryview] = []
    info = ""
    for record in arc_records(content):
        kind, fields = record.warc_type, record.fields
        own = record_id(name, record.offset)
        date = warc_date(fields["Archive-date"])
        if kind == "warcinfo":
            info = own
            about = (
                "software: curbstar\r\nformat: WARC File Format 1.0\r\n"
                f"description: converted from {record.url}\r\n"
            ).encode()
            parts += _warc(
                [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date),
                 ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], about)
            continue
        payload = record.block[record.http_end :]
        head = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date),
                ("WARC-Target-URI", record.url), ("WARC-IP-Address", fields["IP-address"]),
                ("WARC-Payload-Digest", _digest(payload))]
        if info:
            head.append(("WARC-Warcinfo-ID", info))
        if record.truncated:
            head.append(("WARC-Truncated", "length"))
        block = record.block
        if record.offset in revisits:
            target, address, target_date = revisits[record.offset]
            head[0] = ("WARC-Type", "revisit")
            head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", target),
                     ("WARC-Refers-To-Target-URI", address), ("WARC-Refers-To-Date", target_date)]
            block = record.block[: record.http_end]
        content_type = "application/http; msgtype=response" if kind == "response" else fields["Content-type"]
        parts += _warc([*head, ("WARC-Block-Digest", _digest(block)), ("Content-Type", content_type)], block)
    return b"".join(parts)


@dataclass
class WarcRecord:
    fields: dict[str, str] = field(default_factory=dict)
    block: memoryview = memoryview(b"")


def warc_records(content: bytes) -> Iterator[WarcRecord]:
    """Records of an unpacked WARC file, by their declared lengths."""
    view, at = memoryview(content), 0
    while (at := content.find(b"WARC/", at)) >= 0:
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields.get("content-length", 0))
        yield WarcRecord(fields, view[end + 4 : end + 4 + size])
        at = end + 4 + size


# --- over folders of archives -----------------------------------------------------------------------


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    """``file, content`` of every archive."""
    found = spark.read.format("binaryFile").load(folder)
    return found.select(F.substring_index("path", "/", -1).alias("file"), "content")


_INDEX = ("file string, offset long, record_id string, url string, date string, digest binary, "
          "payload_bytes long, place long")


def arc_index(spark: SparkSession, folder: str, id_header: str = ID_HEADER) -> DataFrame:
    """A row per record of the ARC archives; ``place`` is the number in its ``id_header``."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, packed in zip(batch.column("file").to_pylist(), batch.column("content")):
                rows = []
                for record in arc_records(unpacked(packed.as_py())):
                    if record.is_version_block:
                        continue
                    end = record.http_end
                    payload = record.block[end:]
                    place = _header(record.block, end, id_header) or ""
                    rows.append((
                        name, record.offset, record_id(name, record.offset), record.url,
                        warc_date(record.fields["Archive-date"]), hashlib.sha1(payload).digest(),
                        len(payload), _number(place),
                    ))
                yield _batch(rows, _INDEX)

    return _archives(spark, folder).mapInArrow(index, _INDEX)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _TYPES[k]) for c, k in zip(columns, kinds)], list(names)
    )


def convert(
    spark: SparkSession, arc_folder: str, warc_folder: str, scratch: Scratch,
    least: int = LEAST_REVISIT, id_header: str = ID_HEADER,
) -> None:
    """WARC archives of all ARC archives in a folder, payloads of ``least`` bytes written once."""
    index = scratch.write("arc-index", arc_index(spark, arc_folder, id_header))
    kept = (
        index.where(F.col("payload_bytes") >= least)
        .groupBy("digest", "payload_bytes")
        .agg(
            F.max(F.struct("place", "record_id", "url", "date")).alias("kept"),
            F.count("*").alias("n"),
        )
        .where("n > 1")
    )
    kept = scratch.write("kept", kept.select("digest", "payload_bytes", "kept"))
    revisits = (
        index.select("file", "offset", "record_id", "digest", "payload_bytes")
        .join(kept, ["digest", "payload_bytes"])
        .where("record_id <> kept.record_id")
        .select("file", "offset", "kept.record_id", "kept.url", "kept.date")
    )
    # a row per archive, which holds a bounded number of records
    of_file = (
        scratch.write("revisits", revisits)
        .groupBy("file")
        .agg(F.collect_list(F.struct("offset", "record_id", "url", "date")).alias("revisits"))
    )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, packed, found in zip(*(batch.column(c) for c in ("file", "content", "revisits"))):
                known = {
                    x["offset"]: (x["record_id"], x["url"], x["date"]) for x in found.as_py() or ()
                }
                made = to_warc(name.as_py(), unpacked(packed.as_py()), known)
                if made:
                    # the writer ends the row, and so the last record, with two line breaks
                    yield pa.RecordBatch.from_arrays([pa.array([made[:-4]], pa.binary())], ["value"])

    archives = _archives(spark, arc_folder).join(of_file, "file", "left")
    _write_archives(archives.mapInArrow(rewrite, "value binary"), warc_folder, "\r\n\r\n")


_RECORD = ("record_type string, record_id string, refers_to_id string, target_uri string, date string, "
           "payload_digest string, payload_bytes long, id long")


def read_warc(spark: SparkSession, folder: str, id_header: str = ID_HEADER) -> DataFrame:
    """A row per response, resource and revisit of the WARC archives.

    ``payload_digest`` is in hex: computed from the payload where the record has it, as declared in a
    revisit, whose ``payload_bytes`` are null.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("content"):
                rows = []
                for record in warc_records(unpacked(packed.as_py())):
                    get, kind = record.fields.get, record.fields.get("warc-type")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    http = ArcRecord(0, {}, record.block, False).http_end
                    place = _header(record.block, http, id_header) or ""
                    if kind == "revisit":
                        declared = get("warc-payload-digest", "").removeprefix("sha1:")
                        digest, size = base64.b32decode(declared).hex(), None
                    else:
                        payload = record.block[http:]
                        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    rows.append((
                        kind, get("warc-record-id"), get("warc-refers-to"), get("warc-target-uri"),
                        get("warc-date"), digest, size,
                        _number(place),
                    ))
                yield _batch(rows, _RECORD)

    return _archives(spark, folder).mapInArrow(records, _RECORD)


def archive_pages(
    pages: DataFrame, least: int = LEAST_REVISIT, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Pages written as ARC, converted to WARC and read back: what the archives say of each page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    arc, warc = f"{scratch.root}/arc", f"{scratch.root}/warc"
    write_arc(pages.select("url", page_block().alias("block")), arc, archive_bytes=archive_bytes)
    convert(spark, arc, warc, scratch, least)
    scratch.drop("arc")
    found = scratch.write("records", read_warc(spark, warc))
    scratch.drop("warc")
    responses = found.where("record_type <> 'revisit'")
    targets = responses.select(
        F.col("record_id").alias("refers_to_id"), F.col("id").alias("refers_to"),
        F.col("payload_bytes").alias("whole_bytes"),
    )
    again = found.where("record_type = 'revisit'").join(targets, "refers_to_id", "left")
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    whole = responses.withColumn("refers_to", F.lit(None).cast("long")).select(*columns)
    again = again.withColumn("payload_bytes", F.col("whole_bytes")).select(*columns)
    return whole.unionByName(again).withColumnRenamed("id", "page_id")
