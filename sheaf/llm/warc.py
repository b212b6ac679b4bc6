"""Legacy archives (ARC 1 and 2) turned into WARC, written and read through Spark's own
file writers and readers, so any store that Spark reaches will do.

A row of the writers is one archive of about ``ARCHIVE_BYTES``, and one file. The converter
reads each ARC file by its version block, header lines and declared lengths, and gives every
record a WARC identifier, date, type and digests. Records with equal payloads of at least
``LEAST`` bytes become revisits of the one with the smallest page_id; only digests and
record numbers are shuffled for that, and each archive then gets its own list of revisits.

Cases: a null html is an empty payload; a null url is ``unknown:``, white space in a url is
percent-encoded; a null page_id stays null and sorts behind all others; of repeated rows one
is the response, the others revisit it; an empty table gives no rows; extra columns are not
read. A payload of any length lies in one archive of its own. Payloads may be any bytes. A record
that cannot be read (a header line without its fields, a cut-off block) stops nothing: it becomes a
metadata record, ``bad_records`` lists it, and reading goes on at the next header line.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.session import checkpoint_dir

ARCHIVE_BYTES = 16 << 20
LEAST = 100

# Fixed values of the formats.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ),
}
LINE = b"\r\n"
# how archives are written: one a file; the fastest level takes a quarter of the default's time
# and a tenth more room
GZIPPED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1}
RECORD_END = "\r\n\r\n"
PAGE_FIELD = "X-Page-Id"
NO_PAGE = 2**63 - 1


# ---- ARC -------------------------------------------------------------------------------

def _http(page_id: int | None, payload: bytes) -> bytes:
    own = "" if page_id is None else str(page_id)
    return (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
        f"{PAGE_FIELD}: {own}\r\n\r\n"
    ).encode()


def _version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 legacy\n{' '.join(ARC_FIELDS[version])}\n".encode()
    line = f"filedesc://{name} 0.0.0.0 20000101000000 text/plain"
    line += f" 200 - - 0 {name} {len(body)}" if version == 2 else f" {len(body)}"
    return line.encode() + b"\n" + body


def _arc_record(version: int, name: str, at: int, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    block = _http(page_id, payload) + payload
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "unknown:"
    date = datetime(2000, 1, 1, tzinfo=UTC) + timedelta(seconds=(page_id or 0) % 10**9)
    line = f"{target} 0.0.0.0 {date:%Y%m%d%H%M%S} text/html"
    line += f" 200 - - {at} {name} {len(block)}" if version == 2 else f" {len(block)}"
    return line.encode() + b"\n" + block


def _texts(found: list[bytes]) -> pa.Array:
    """Bytes for Spark's text writer, which writes a string's bytes as they are, UTF-8 or not."""
    raw = pa.array(found, pa.binary())
    return pa.StringArray.from_buffers(len(raw), raw.buffers()[1], raw.buffers()[2])


def write_arc(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """``pages`` (page_id, url, html) as gzipped ARC files, every other one of version 2."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        size, made = 0, 0

        def name() -> str:
            return f"legacy-{made}.arc"

        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html = (batch.column(c)[row].as_py() for c in range(3))
                version = made % 2 + 1
                if not parts:
                    parts.append(_version_block(version, name()))
                parts.append(_arc_record(version, name(), size, page_id, url, (html or "").encode()))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield pa.record_batch({"value": _texts([b"\n".join(parts)])})
                    parts, size, made = [], 0, made + 1
        if parts:
            yield pa.record_batch({"value": _texts([b"\n".join(parts)])})

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    archives = rows.mapInArrow(task, "value string")
    archives.write.options(lineSep="\n", **GZIPPED).text(folder)


# What a record's header line ends in: date, type and further fields, length.
HEADER_LINE = re.compile(rb"(?m)^(?=\S)[^\r\n]* \d{1,20} [^ \r\n]*(?: [^ \r\n]*){0,5} \d+\r?\n")


def _header(line: bytes, fields: tuple[str, ...]) -> dict[str, str]:
    """A header line's fields, from the right: blanks beyond their number are the URL's, and
    bytes that are no ASCII are kept as Latin-1."""
    parts = line.decode("latin-1").rstrip("\r").rsplit(" ", len(fields) - 1)
    if len(parts) < len(fields):
        raise ValueError(f"{len(parts)} of {len(fields)} fields")
    if not parts[-1].isdigit():
        raise ValueError("no length")
    return dict(zip(fields, parts, strict=True))


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, version blocks too. A version block sets
    the fields of the lines behind it.

    A line that is no header, or a record that is cut off, comes as a head with ``Bad`` (the
    reason) and ``At`` (its byte), with its bytes up to the next line that looks like a header."""
    at, fields = 0, ARC_FIELDS[1]
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end]
        if not line.strip():
            at = end + 1
            continue
        try:
            if line.startswith(b"filedesc://"):  # its own version is only known from its block
                head = _header(line, ARC_FIELDS[2 if len(line.split(b" ")) >= len(ARC_FIELDS[2]) else 1])
            else:
                head = _header(line, fields)
            size = int(head["Archive-length"])
            block = data[end + 1:end + 1 + size]
            if len(block) < size:
                raise ValueError(f"record of {size} bytes is cut off at {len(block)}")
            if line.startswith(b"filedesc://"):
                version = int(block.split(b" ", 1)[0])
                fields = ARC_FIELDS[version]
                head = {k: head[k] for k in ("URL", "Archive-date")} | {"Content-type": "text/plain", "Version": str(version)}
        except (ValueError, KeyError) as e:
            following = HEADER_LINE.search(data, end + 1)
            until = following.start() if following else len(data)
            yield {"Bad": str(e), "At": str(at)}, data[at:until]
            at = until
            continue
        at = end + 1 + size
        yield head, block


# ---- WARC ------------------------------------------------------------------------------

def _split_http(block: bytes) -> tuple[bytes, bytes]:
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, _, payload = block.partition(b"\r\n\r\n")
    return head + b"\r\n\r\n", payload


def _page_id(head: bytes) -> int | None:
    found = re.search(rb"(?m)^X-Page-Id: (-?\d+)\r?$", head)
    return int(found[1]) if found else None


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(parts))}>"


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return LINE.join(x.encode() for x in lines) + LINE + LINE + block


def _warc_date(stamp: str) -> str:
    """ARC's fourteen digits; shorter stamps start their unit, and what is no date is the epoch."""
    whole = (stamp + "00000101000000"[len(stamp):])[:14]
    try:
        found = datetime(*(int(whole[a:b]) for a, b in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 12), (12, 14))))
    except ValueError:
        found = datetime(1970, 1, 1)
    return f"{found.isoformat()}Z"


def _uri(url: str) -> str:
    """The URL in ASCII without blanks; what it has of others is percent-encoded by byte."""
    return quote(url.encode("latin-1"), safe="!#$%&'()*+,/:;=?@[]~-._")


def to_warc(data: bytes, archive: str, revisits: dict[int, dict]) -> bytes:
    """One ARC file as WARC bytes, without the end of its last record. ``revisits``: by record
    number, the record it repeats (archive, n, page_id, uri, date). Bad records become metadata
    records that hold their bytes and the reason."""
    out = []
    for n, (head, block) in enumerate(arc_records(data)):
        if "Bad" in head:
            out.append(_warc_record([
                ("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id(archive, str(n))), ("WARC-Date", _warc_date("")),
                ("X-Bad-Record", f"byte {head['At']}: {head['Bad']}"), ("Content-Type", "application/octet-stream"),
            ], block))
            continue
        date = _warc_date(head["Archive-date"])
        fields = [("WARC-Record-ID", _record_id(archive, str(n))), ("WARC-Date", date)]
        if head["URL"].startswith("filedesc://"):
            info = f"software: legacy archive converter\r\nformat: ARC {head['Version']}\r\n".encode()
            fields = [("WARC-Type", "warcinfo"), *fields, ("Content-Type", "application/warc-fields")]
            out.append(_warc_record(fields, info))
            continue
        http, payload = _split_http(block)
        fields += [("WARC-Target-URI", _uri(head["URL"])), ("WARC-IP-Address", head["IP-address"])]
        fields.append(("WARC-Payload-Digest", f"sha256:{_sha256(payload)}"))
        if n in revisits and http:
            of, block = revisits[n], http
            fields = [
                ("WARC-Type", "revisit"), *fields,
                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ("WARC-Refers-To", _record_id(of["archive"], str(of["n"]))),
                ("WARC-Refers-To-Target-URI", of["uri"]),
                ("WARC-Refers-To-Date", of["date"]),
                ("WARC-Refers-To-Page", "" if of["page_id"] is None else str(of["page_id"])),
            ]
        else:
            fields = [("WARC-Type", "response" if http else "resource"), *fields]
        fields.append(("WARC-Block-Digest", f"sha256:{_sha256(block)}"))
        fields.append(("Content-Type", "application/http;msgtype=response" if http else head["Content-type"]))
        out.append(_warc_record(fields, block))
    return RECORD_END.encode().join(out)


def _archives(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


INDEX = "archive string, n long, page_id long, bytes long, digest string, uri string, date string, bad string"


def _index(archives: DataFrame) -> DataFrame:
    """Page, payload length and digest, URL and date of every record but version blocks; of bad
    records the reason alone."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for n, (head, block) in enumerate(arc_records(gzip.decompress(content.as_py()))):
                    if "Bad" in head:
                        rows.append((name, n, None, None, None, None, None, f"byte {head['At']}: {head['Bad']}"))
                    elif not head["URL"].startswith("filedesc://"):
                        http, payload = _split_http(block)
                        rows.append((
                            name, n, _page_id(http), len(payload), _sha256(payload), _uri(head["URL"]),
                            _warc_date(head["Archive-date"]), None,
                        ))
                if rows:
                    names = [x.split() for x in INDEX.split(", ")]
                    columns = zip(*rows, strict=True)
                    yield pa.record_batch({
                        x: pa.array(c, pa.int64() if kind == "long" else pa.string())
                        for (x, kind), c in zip(names, columns, strict=True)
                    })

    return archives.mapInArrow(task, INDEX)


def revisits(index: DataFrame, least: int = LEAST) -> DataFrame:
    """archive and ``repeats``: number of each of its records that repeats a payload, and
    the record it repeats. The lists are as long as an archive's records at most."""
    long_enough = index.filter(F.col("bytes") >= least)
    rank = F.struct(F.coalesce("page_id", F.lit(NO_PAGE)).alias("rank"), "archive", "n", "page_id", "uri", "date")
    first = long_enough.groupBy("digest", "bytes").agg(F.min(rank).alias("of"), F.count(F.lit(1)).alias("_copies"))
    own = long_enough.join(first.filter(F.col("_copies") > 1), ["digest", "bytes"])
    again = own.filter((F.col("archive") != F.col("of.archive")) | (F.col("n") != F.col("of.n")))
    entry = F.struct("n", F.struct("of.archive", "of.n", "of.page_id", "of.uri", "of.date").alias("of"))
    return again.groupBy("archive").agg(F.collect_list(entry).alias("repeats"))


def bad_records(spark: SparkSession, arc_folder: str) -> DataFrame:
    """archive, n and the reason of every record of a folder's ARC files that cannot be read."""
    return _index(_archives(spark, arc_folder)).filter("bad IS NOT NULL").select("archive", "n", F.col("bad").alias("reason"))


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, least: int = LEAST) -> None:
    """Every ARC file of one folder as a WARC file in the other."""
    archives = _archives(spark, arc_folder)
    lists = revisits(_index(archives), least)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, content, repeats = (batch.column(c)[i].as_py() for c in ("archive", "content", "repeats"))
                known = {x["n"]: x["of"] for x in repeats or []}
                made = to_warc(gzip.decompress(content), name, known)
                if made:  # Spark writes a file without archives where a task had no rows
                    yield pa.record_batch({"value": _texts([made])})

    converted = archives.join(lists, "archive", "left").mapInArrow(task, "value string")
    converted.write.options(lineSep=RECORD_END, **GZIPPED).text(warc_folder)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            break
        version, *lines = data[at:end].decode("latin-1").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        at = end + 4
        size = int(head["Content-Length"])
        block = data[at:at + size]
        if len(block) < size:
            raise ValueError(f"record of {size} bytes is cut off at {len(block)}")
        yield head, block
        at += size + len(RECORD_END)


RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string, target_uri string, warc_date string"
)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every response, revisit and resource of a folder's WARC files. Digests of payloads
    that are there are computed anew and must agree with the header."""

    def row(head: dict[str, str], block: bytes) -> tuple:
        http, payload = _split_http(block)
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        size = len(payload)
        if head["WARC-Type"] == "revisit":
            said = re.search(rb"(?mi)^Content-Length: *(\d+)\r?$", http)
            size = int(said[1]) if said else None
        elif _sha256(payload) != digest:
            raise ValueError(f"digest of {head['WARC-Record-ID']} does not agree with its payload")
        of = head.get("WARC-Refers-To-Page") or None
        return (
            _page_id(http), size, digest, head["WARC-Type"], int(of) if of else None, head["WARC-Record-ID"],
            head["WARC-Target-URI"], head["WARC-Date"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64() if " long" in x else pa.string() for x in RECORDS.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                found = warc_records(gzip.decompress(content.as_py()))
                rows = [row(head, block) for head, block in found if head["WARC-Type"] not in ("warcinfo", "metadata")]
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return _archives(spark, folder).mapInArrow(task, RECORDS)


def round_trip(pages: DataFrame, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``pages`` written as ARC, converted, and read back from the WARC files. The archives
    stay in a new folder below the session's checkpoint folder."""
    spark = pages.sparkSession
    folder = os.path.join(checkpoint_dir(spark), f"archives-{uuid.uuid4()}")
    write_arc(pages, f"{folder}/arc", archive_bytes)
    convert(spark, f"{folder}/arc", f"{folder}/warc", least)
    return read_warc(spark, f"{folder}/warc")
