"""WARC records in ZIP packages: written by tasks, read back by ranges.

A package is a ZIP whose members are all stored (not deflated): the WARC file
``archive/data.warc.gz``, each record a gzip member of its own, and an index
``indexes/index.cdxj`` with place and size of every record. A reader needs the
end of the package (central directory, ZIP64 or not), the index, and then single
ranges; nothing is unpacked to disk. A package without an index is walked record
by record.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, scratch_path, staged
from .files import new_name, read_from, read_range, write_to

# Payloads from this size on are stored once and revisited.
REVISIT_BYTES = 100
# A task starts a new package after so many records, which bounds its index.
PACKAGE_RECORDS = 50_000
# Neighbouring records are fetched together up to this many bytes.
FETCH_BYTES = 4 << 20
ARCHIVE_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"

# Fixed values of the ZIP format: signatures, sizes of the fixed parts, markers.
END_SIGNATURE = b"PK\x05\x06"
END_SIZE = 22
END64_LOCATOR_SIGNATURE = b"PK\x06\x07"
END64_LOCATOR_SIZE = 20
END64_SIGNATURE = b"PK\x06\x06"
END64_SIZE = 56
ENTRY_SIGNATURE = b"PK\x01\x02"
ENTRY_SIZE = 46
LOCAL_SIGNATURE = b"PK\x03\x04"
LOCAL_SIZE = 30
LONGEST_COMMENT = 65_535
IN_ZIP64 = 0xFFFFFFFF
ZIP64_EXTRA = 1
STORED = 0

PLACES = "path string, offset long, length long"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    start: int


def members(source) -> list[Member]:
    """The members of a ZIP by its central directory."""
    total = source.size()
    tail_size = min(total, END_SIZE + LONGEST_COMMENT)
    tail = read_range(source, total - tail_size, tail_size)
    at = tail.rfind(END_SIGNATURE)
    while at >= 0:
        # The comment must end where the file ends, else the bytes are part of it.
        if len(tail) >= at + END_SIZE and at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END_SIGNATURE, 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    locator = total - tail_size + at - END64_LOCATOR_SIZE
    if locator >= 0:
        found = read_range(source, locator, END64_LOCATOR_SIZE)
        if found[:4] == END64_LOCATOR_SIGNATURE:
            end64 = read_range(source, struct.unpack_from("<Q", found, 8)[0], END64_SIZE)
            if end64[:4] != END64_SIGNATURE:
                raise ValueError("no ZIP64 end of central directory where the locator points")
            count, size, start = struct.unpack_from("<QQQ", end64, 32)
    directory, out, at = read_range(source, start, size), [], 0
    for _ in range(count):
        if directory[at : at + 4] != ENTRY_SIGNATURE:
            raise ValueError("broken central directory")
        method, packed, full, name_size, extra_size, comment_size, local = struct.unpack(
            "<10xH8xIIHHH8xI", directory[at : at + ENTRY_SIZE]
        )
        name = directory[at + ENTRY_SIZE : at + ENTRY_SIZE + name_size].decode()
        extra = directory[at + ENTRY_SIZE + name_size : at + ENTRY_SIZE + name_size + extra_size]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == ZIP64_EXTRA:
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                full = next(wide) if full == IN_ZIP64 else full
                packed = next(wide) if packed == IN_ZIP64 else packed
                local = next(wide) if local == IN_ZIP64 else local
            extra = extra[4 + length :]
        header = read_range(source, local, LOCAL_SIZE)
        if header[:4] != LOCAL_SIGNATURE:
            raise ValueError(f"no local header of {name}")
        data = local + LOCAL_SIZE + sum(struct.unpack_from("<HH", header, 26))
        out.append(Member(name, method, packed, data))
        at += ENTRY_SIZE + name_size + extra_size + comment_size
    return out


def _record(row: dict) -> bytes:
    """One WARC record, gzipped. A revisit keeps the HTTP header only."""
    payload = (row["html"] or "").encode()
    kind = row["record_type"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if row['page_id'] is None else row['page_id']}>",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        # Line ends would end the header line; % marks them, and itself.
        url = row["url"].replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head.append(f"WARC-Target-URI: {url}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """A gunzipped record as a row of RECORDS. The payload of a response is
    hashed anew and must agree with its header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    size = int(_headers(http)["content-length"])
    if kind != "revisit":
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    url = fields.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": url,
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload if kind != "revisit" else None,
    }


def _write_packages(folder: str):
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                yield from batch.slice(i, 256).to_pylist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, row = rows_of(batches), None
        while (row := next(rows, None)) is not None:
            path, index, at = new_name(folder, ".wacz"), [], 0
            with write_to(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(ARCHIVE_MEMBER, "w", force_zip64=True) as member:
                    while row is not None:
                        data = _record(row)
                        member.write(data)
                        index.append(json.dumps({"offset": at, "length": len(data)}))
                        at += len(data)
                        row = next(rows, None) if len(index) < PACKAGE_RECORDS else None
                package.writestr(INDEX_MEMBER, "\n".join(index))
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [len(index)]})

    return work


def judge_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, html with record_type, refers_to and payload_digest.

    Among payloads of REVISIT_BYTES and more that are equal, the smallest
    page_id is the response. Rows that repeat its page_id and payload are
    responses too; a null page_id is never the smallest unless all are null,
    and then all are responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    seen = pages.select(
        F.col("page_id").cast("long"), "url", "html", F.sha2(payload, 256).alias("payload_digest")
    )
    long_one = F.octet_length("html") >= REVISIT_BYTES
    groups = (
        seen.filter(long_one)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    )
    groups = staged(groups, "payloads")
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    repeated = groups.filter(F.col("rows") > 1)
    judged = attach(seen, repeated, ["payload_digest"], "rows", total, ["page_id"])
    again = F.coalesce(long_one & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    return judged.select(
        "page_id",
        "url",
        "html",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page into packages under ``folder`` (a URI that all
    executors reach). Returns the packages: path, records."""
    made = judge_pages(pages).mapInArrow(_write_packages(folder), "path string, records long")
    return staged(made, "packages")


def _walk(source, member: Member) -> Iterator[tuple[int, int]]:
    """Place and size of each gzip member of a WARC without an index."""
    at, end = member.start, member.start + member.size
    while at < end:
        unpack, used = zlib.decompressobj(31), 0
        while not unpack.eof:
            data = read_range(source, at + used, min(1 << 16, end - at - used))
            if not data:
                raise EOFError("a record is cut off")
            unpack.decompress(data)
            used += len(data) - len(unpack.unused_data)
        yield at, used
        at += used


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with read_from(path) as source:
                found = {m.name: m for m in members(source)}
                if any(m.method != STORED for m in found.values()):
                    raise ValueError(f"{path} has members that are not stored")
                archive, index = found[ARCHIVE_MEMBER], found.get(INDEX_MEMBER)
                if index is None:
                    places = list(_walk(source, archive))
                else:
                    lines = read_range(source, index.start, index.size).decode().splitlines()
                    rows = map(json.loads, lines)
                    places = [(archive.start + r["offset"], r["length"]) for r in rows]
            yield pa.RecordBatch.from_pydict(
                {
                    "path": pa.array([path] * len(places), pa.string()),
                    "offset": pa.array([p[0] for p in places], pa.int64()),
                    "length": pa.array([p[1] for p in places], pa.int64()),
                }
            )


def locate_records(packages: DataFrame) -> DataFrame:
    """Where the records of packages (path) lie: path, offset, length."""
    return packages.select("path").mapInArrow(_locate, PLACES)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
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
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length"))))
        at = 0
        while at < len(rows):
            path, start, size = rows[at]
            end = at + 1
            while (
                end < len(rows)
                and rows[end][0] == path
                and rows[end][1] == start + size
                and size + rows[end][2] <= FETCH_BYTES
            ):
                size += rows[end][2]
                end += 1
            with read_from(path) as source:
                data = read_range(source, start, size)
            records = [
                parse_record(zlib.decompress(data[o - start : o - start + n], 31))
                for _, o, n in rows[at:end]
            ]
            yield pa.RecordBatch.from_pylist(records, schema)
            at = end


def read_records(places: DataFrame) -> DataFrame:
    """Read records by range (see RECORDS). Neighbours are fetched together,
    so places in file order need few requests."""
    return places.mapInArrow(_fetch, RECORDS)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as WARC packages in the shared folder, read them back."""
    spark = pages.sparkSession
    packages = write_warc(pages, scratch_path(spark, "warc"))
    return read_records(staged(locate_records(packages), "places"))
