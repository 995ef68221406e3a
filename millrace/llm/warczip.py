"""WARC records in ZIP-packaged archives, read back by ranges.

An archive is a ZIP file that only stores its members: ``archive/data.warc.gz`` with one
gzip member per WARC record, and ``indexes/index.txt`` with a line per record. Since
members are stored, a record is a range of bytes of the ZIP file itself. The reader finds
the end of the central directory from the file's tail, follows the ZIP64 locator where
there is one, parses the directory, finds the members' data behind their local headers,
reads the index, and then reads ranges of neighbouring records; nothing is extracted.

Of records with equal payloads of at least ``LEAST`` bytes, that with the smallest page id
is a response and the others are revisits, which carry its record id and the digest.

Writing: each task writes archives of up to ``ROLL`` bytes under a name nobody has used,
into the shared folder; the written table of their paths is the commit, so a repeated
task leaves at most a file that nobody reads. Paths may be of any file system that Arrow
opens.

Defined results: null html is an empty payload, null urls have no target; of repeated rows
with equal payloads one is the response. A null page id is larger than any other. An empty
table gives no archives and an empty result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.lineage import materialise, scratch_path

LEAST = 100
ROLL = 256 << 20
RANGE = 4 << 20  # bytes of neighbouring records that are read at once
DATA, INDEX = "archive/data.warc.gz", "indexes/index.txt"

MANIFEST_SCHEMA = "path string, records long, size long"
RANGE_SCHEMA = "path string, start long, lengths array<bigint>"
RECORD_SCHEMA = (
    "page_id long, record_id string, record_type string, target string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (pafs.LocalFileSystem(), path)


# Writing -------------------------------------------------------------------------------


def _record(row: dict) -> bytes:
    """One WARC record as a gzip member."""
    payload = row["payload"].encode()
    head = {"WARC-Type": row["record_type"], "WARC-Record-ID": f"<{row['record_id']}>"}
    if row["page_id"] is not None:
        head["X-Page-ID"] = str(row["page_id"])
    if row["url"] is not None:
        head["WARC-Target-URI"] = quote(row["url"], safe=":/?#[]@!$&'()*+,;=%~")
    head["WARC-Payload-Digest"] = f"sha256:{row['digest']}"
    if row["record_type"] == "revisit":
        head["WARC-Refers-To"] = f"<{row['refers_to']}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        block = b"HTTP/1.1 200 OK\r\n\r\n"
    else:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        block = block.encode() + payload
    head["Content-Type"] = "application/http;msgtype=response"
    head["Content-Length"] = str(len(block))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return gzip.compress(lines.encode() + block + b"\r\n\r\n", 6, mtime=0)


def write_archive(out, records: Iterator[bytes]) -> int:
    """A ZIP file with the stored records and their index; how many records it has."""
    lengths = []
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
        with archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
            for record in records:
                member.write(record)
                lengths.append(len(record))
        lines, at = [], 0
        for length in lengths:
            lines.append(f"{at} {length}\n")
            at += length
        archive.writestr(zipfile.ZipInfo(INDEX), "".join(lines))
    return len(lengths)


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll: int) -> Iterator[pa.RecordBatch]:
    system, base = _file_system(folder)
    system.create_dir(base, recursive=True)
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)
    while ahead is not None:
        name = f"{uuid.uuid4().hex}.wacz"
        size = 0

        def records() -> Iterator[bytes]:
            nonlocal ahead, size
            while ahead is not None and size < roll:
                record = _record(ahead)
                size += len(record)
                yield record
                ahead = next(rows, None)

        with system.open_output_stream(f"{base}/{name}") as out:
            n = write_archive(out, records())
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [n], "size": [size]})


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, roll: int = ROLL) -> DataFrame:
    """Write a record for each (page_id, url, html); the written table of (path, records, size)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "row": F.monotonically_increasing_id()})
    rows = materialise(rows, "pages")  # so that a row keeps its number
    large = F.octet_length("payload") >= least
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    copies = rows.where(large).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    copies = materialise(copies.where("n > 1").select("digest", F.col("first.row").alias("first")), "copies")
    rows = rows.join(copies, "digest", "left")
    revisit = F.coalesce(large & (F.col("row") != F.col("first")), F.lit(False))
    rows = rows.select(
        "page_id",
        "url",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:record:"), F.col("row")).alias("record_id"),
        F.when(revisit, F.concat(F.lit("urn:record:"), F.col("first"))).alias("refers_to"),
        F.when(revisit, "").otherwise(F.col("payload")).alias("payload"),
    )
    return materialise(rows.mapInArrow(partial(_write, folder=folder, roll=roll), MANIFEST_SCHEMA), "manifest")


# Reading -------------------------------------------------------------------------------

_END = struct.Struct("<4s4H2LH")  # end of central directory
_LOCATOR = struct.Struct("<4sLQL")  # ZIP64 end of central directory locator
_END64 = struct.Struct("<4sQ2H2L4Q")
_ENTRY = struct.Struct("<4s6H3L5H2L")  # central directory entry
_LOCAL = struct.Struct("<4s5H3L2H")  # local header
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


def _directory(file, size: int) -> tuple[int, int, int]:
    """Offset, size and entries of the central directory."""
    tail_size = min(size, _END.size + 0xFFFF)
    file.seek(size - tail_size)
    tail = file.read(tail_size)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0:
        if at + _END.size <= len(tail):
            _, _, _, _, entries, length, offset, comment = _END.unpack_from(tail, at)
            if at + _END.size + comment == len(tail):
                break
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    if entries == _FULL16 or length == _FULL32 or offset == _FULL32:
        where = size - tail_size + at - _LOCATOR.size
        file.seek(max(0, where))
        magic, _, end64, _ = _LOCATOR.unpack(file.read(_LOCATOR.size))
        if where < 0 or magic != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        file.seek(end64)
        magic, _, _, _, _, _, _, entries, length, offset = _END64.unpack(file.read(_END64.size))
        if magic != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
    return offset, length, entries


def _zip64(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset of an entry, those that are full taken from its ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            field, place = extra[at + 4 : at + 4 + length], 0
            for i, value in enumerate(values):
                if value == _FULL32:
                    values[i] = struct.unpack_from("<Q", field, place)[0]
                    place += 8
            break
        at += 4 + length
    return values


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset of the data, length) of the members that are stored."""
    offset, length, entries = _directory(file, size)
    file.seek(offset)
    data = file.read(length)
    found, at = {}, 0
    for _ in range(entries):
        entry = _ENTRY.unpack_from(data, at)
        if entry[0] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = entry[3], entry[4]
        name_size, extra_size, comment_size = entry[10], entry[11], entry[12]
        start = at + _ENTRY.size
        name = data[start : start + name_size].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[start + name_size : start + name_size + extra_size]
        # A field is in the extra field only if its place here is full, in this order.
        plain, packed, header = _zip64(extra, [entry[9], entry[8], entry[16]])
        at = start + name_size + extra_size + comment_size
        if method == 0 and not flags & 1 and plain == packed:
            file.seek(header)
            local = _LOCAL.unpack(file.read(_LOCAL.size))
            if local[0] != b"PK\x03\x04":
                raise ValueError("broken local header")
            found[name] = (header + _LOCAL.size + local[9] + local[10], plain)
    return found


def _plan(batches: Iterator[pa.RecordBatch], range_bytes: int) -> Iterator[pa.RecordBatch]:
    """Ranges of neighbouring records, from the directory and the index of each archive."""
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, name = _file_system(path)
            with system.open_input_file(name) as file:
                stored = members(file, file.size())
                base, _ = stored[DATA]
                at, length = stored[INDEX]
                file.seek(at)
                lines = file.read(length).decode().splitlines()
            rows, held = [], 0
            for line in lines:
                offset, size = map(int, line.split())
                if not rows or held + size > range_bytes:
                    rows.append({"path": path, "start": base + offset, "lengths": []})
                    held = 0
                rows[-1]["lengths"].append(size)
                held += size
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def parse_record(member: bytes) -> dict:
    """The fields and the payload of one gzipped WARC record."""
    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    page = fields.get("X-Page-ID")
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload and digest differ")
    return {
        "page_id": None if page is None else int(page),
        "record_id": fields["WARC-Record-ID"][1:-1],
        "record_type": fields["WARC-Type"],
        "target": fields.get("WARC-Target-URI"),
        "refers_to": fields["WARC-Refers-To"][1:-1] if revisit else None,
        "payload_bytes": None if revisit else len(payload),
        "payload_digest": digest,
        "payload": payload,
    }


_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for plan in batch.to_pylist():
            system, name = _file_system(plan["path"])
            with system.open_input_file(name) as file:
                file.seek(plan["start"])
                data = file.read(sum(plan["lengths"]))
            rows, at = [], 0
            for length in plan["lengths"]:
                row = parse_record(data[at : at + length])
                at += length
                rows.append(row if payloads else row | {"payload": None})
            yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)


def read_archives(paths: DataFrame, payloads: bool = True, range_bytes: int = RANGE) -> DataFrame:
    """All records of the archives in ``paths`` (path), checked against their digests.

    The ranges are dealt to the tasks anew, so that a large archive is read by many.
    """
    plan = paths.select("path").mapInArrow(partial(_plan, range_bytes=range_bytes), RANGE_SCHEMA)
    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return plan.repartition(tasks).mapInArrow(partial(_read, payloads=payloads), RECORD_SCHEMA)


def resolved(records: DataFrame) -> DataFrame:
    """Per record page_id, payload_bytes, payload_digest, record_type and refers_to, a revisit's from its response."""
    kept = materialise(records.drop("payload"), "records")
    targets = kept.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("_page"),
        F.col("payload_bytes").alias("_bytes"),
        F.col("payload_digest").alias("_digest"),
    )
    asked = kept.where("refers_to IS NOT NULL").select("refers_to").distinct()
    targets = materialise(targets.join(asked, "refers_to", "left_semi"), "targets")
    return kept.join(targets, "refers_to", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        F.col("_page").alias("refers_to"),
    )


def round_trip(pages: DataFrame, spark: SparkSession) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back, without the payloads."""
    manifest = write_archives(pages, scratch_path(spark, "warc"))
    return resolved(read_archives(manifest, payloads=False))
