"""Legacy ARC archives to WARC.

An ARC file begins with a version block whose second line gives the version and whose third
names the fields of every record's header line: five in version 1 (URL, IP address, date, type,
length), ten in version 2 (result code, checksum, location, offset and file name before the
length). Header lines are taken apart from the right by the declared fields, so a URL may hold
spaces; a body is exactly as long as declared. What WARC needs and ARC lacks is made up: record
ids are name-based UUIDs of file name and offset, dates become ISO 8601, types follow from the
body (an HTTP response, or a resource), payload and block digests are computed, and a record
whose payload an earlier one has becomes a revisit of it.

ARC files may be plain or gzipped, record by record, as they were kept; offsets count the plain
bytes. One ARC file gives one gzipped WARC file. Bodies are streamed; only a table of records, without bodies,
is shuffled to find the first of equal payloads.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote, quote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from fleetboard.llm.common import attempt_name, create_file, cut, open_stream, shared_path, text_batches

#: Fields of a header line by version, with the names that version blocks give them.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
#: Bytes after which a writer starts another ARC file.
ARC_BYTES = 100 << 20
CHUNK = 1 << 20
#: Header of a captured page that carries its number.
PAGE_HEADER = "X-Page-Id"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


# --- ARC -------------------------------------------------------------------------------------


@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    length: int
    body: BinaryIO


class _Body(io.RawIOBase):
    """The declared bytes of a record, read from the archive's stream."""

    def __init__(self, source: BinaryIO, length: int):
        self.source, self.left = source, length

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        data = self.source.read(self.left if n < 0 else min(n, self.left))
        if not data and self.left and n:
            raise ValueError(f"the archive ends {self.left} bytes early")
        self.left -= len(data)
        return data


class _Lines:
    """A binary stream that counts what was read."""

    def __init__(self, source: BinaryIO):
        self.source, self.at = source, 0

    def readline(self) -> bytes:
        line = self.source.readline()
        self.at += len(line)
        return line

    def read(self, n: int) -> bytes:
        data = self.source.read(n)
        self.at += len(data)
        return data


def plain_stream(source: io.BufferedReader) -> BinaryIO:
    """An archive's bytes, whether they are gzipped or not."""
    return gzip.GzipFile(fileobj=source) if source.peek(2)[:2] == b"\x1f\x8b" else source


def version_block(path: str, version: int) -> bytes:
    names = " ".join(FIELDS[version])
    body = f"{version} 0 fleetboard\n{names}\n".encode()
    extra = "" if version == 1 else "200 - - 0 - "
    return f"filedesc://{path} 0.0.0.0 20260101000000 text/plain {extra}{len(body)}\n".encode() + body


def arc_record(fields: dict[str, str], body: bytes, version: int) -> bytes:
    values = [quote(fields.get(n) or "-", safe="!#$%&'()*+,/:;=?@[]~") for n in FIELDS[version][:-1]]
    return f"\n{' '.join(values)} {len(body)}\n".encode() + body


def read_arc(source: BinaryIO) -> Iterator[ArcRecord]:
    """Records of a plain ARC stream, the version block first, as it is one. Bodies not read are skipped."""
    lines = _Lines(source)
    names = FIELDS[1]
    first = True
    while True:
        offset = lines.at
        line = lines.readline()
        while line in (b"\n", b"\r\n"):
            offset = lines.at
            line = lines.readline()
        if not line:
            return
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        # The version block's own header has the fields of its version.
        for tried in (FIELDS[2], FIELDS[1]) if first else (names,):
            values = text.rsplit(" ", len(tried) - 1)
            if len(values) == len(tried) and values[-1].isdigit() and re.fullmatch(r"\d{4,14}", values[2]):
                break
        else:
            raise ValueError(f"no ARC header at {offset}: {text[:200]!r}")
        length = int(values[-1])
        if first:
            block = lines.read(length)
            told = block.split(b"\n")
            version = int((told[0].split() or [b"1"])[0]) if told[0][:1].isdigit() else 1
            named = told[1].decode("ascii", "replace").split() if len(told) > 1 else []
            names = named if len(named) >= 2 else FIELDS.get(version, FIELDS[1])
            first = False
            yield ArcRecord(offset, dict(zip(tried, values)), length, io.BytesIO(block))
            continue
        body = _Body(lines, length)
        yield ArcRecord(offset, dict(zip(names, values)), length, body)
        while body.read(CHUNK):
            pass


@dataclass
class Capture:
    """What a pass over a body finds: where the payload begins, sizes and digests."""

    head: bytes = b""
    is_http: bool = False
    payload_bytes: int = 0
    payload: object = field(default_factory=hashlib.sha1)
    block: object = field(default_factory=hashlib.sha1)

    def header(self, name: str) -> str | None:
        found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", self.head)
        return found[1].decode("utf-8", "replace").strip() if found else None


def capture(body: BinaryIO) -> Capture:
    """Read a body through. Without an HTTP header all of it is payload.

    A header of any length is held whole; payloads are not.
    """
    found = Capture()
    begin, seen = bytearray(), 0
    while begin.find(b"\r\n\r\n", max(0, seen - 3)) < 0 and (data := body.read(CHUNK)):
        seen = len(begin)
        begin += data
        if not begin.startswith(b"HTTP/"):
            break
    begin = bytes(begin)
    if begin.startswith(b"HTTP/"):
        at = begin.find(b"\r\n\r\n")
        found.is_http = at >= 0
        found.head = begin[: at + 4] if at >= 0 else b""
    found.block.update(begin)
    rest = begin[len(found.head) :]
    if begin and not rest:
        # The header ended where the piece did.
        rest = body.read(CHUNK)
        found.block.update(rest)
    while rest:
        found.payload.update(rest)
        found.payload_bytes += len(rest)
        rest = body.read(CHUNK)
        found.block.update(rest)
    return found


# --- WARC ------------------------------------------------------------------------------------


def record_id(file_name: str, offset: int) -> str:
    """The same for the same record of the same file, whoever converts it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{file_name}#{offset}')}>"


def warc_date(arc_date: str) -> str:
    """An ARC date of 4 to 14 digits; what it lacks is the earliest."""
    d = (arc_date + "00000101000000"[len(arc_date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _member(headers: list[tuple[str, str]], chunks: Iterator[bytes]) -> Iterator[bytes]:
    """A record as a gzip member, piece by piece."""
    import zlib

    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    yield packer.compress(head.encode())
    for chunk in chunks:
        yield packer.compress(chunk)
    yield packer.compress(b"\r\n\r\n") + packer.flush()


def _chunks(first: bytes, source: BinaryIO) -> Iterator[bytes]:
    if first:
        yield first
    while data := source.read(CHUNK):
        yield data


def convert(arc_uri: str, name: str, warc_uri: str, known: dict[int, dict]) -> None:
    """Write the WARC file of an ARC file.

    ``known`` has for each record's offset what the first pass found, and for revisits the
    record that they refer to.
    """
    with open_stream(arc_uri) as source, create_file(warc_uri) as out:
        for record in read_arc(plain_stream(source)):
            own, f = known.get(record.offset), record.fields
            headers = [("WARC-Record-ID", record_id(name, record.offset)), ("WARC-Date", warc_date(f["Archive-date"]))]
            if own is None:
                body = record.body.read()
                headers = [("WARC-Type", "warcinfo"), *headers, ("WARC-Filename", warc_uri.rpartition("/")[2]),
                           ("Content-Type", "text/plain"), ("Content-Length", str(len(body)))]
                chunks = iter([body])
            else:
                refers = own["refers_id"]
                kind = "revisit" if refers else "response" if own["is_http"] else "resource"
                length = own["head_bytes"] if refers else record.length
                headers = [("WARC-Type", kind), *headers, ("WARC-Target-URI", f["URL"])]
                if f.get("IP-address", "-") not in ("-", "0.0.0.0"):
                    headers.append(("WARC-IP-Address", f["IP-address"]))
                if refers:
                    headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", refers),
                                ("WARC-Refers-To-Target-URI", own["refers_url"]), ("WARC-Refers-To-Date", warc_date(own["refers_date"]))]
                else:
                    headers.append(("WARC-Block-Digest", "sha1:" + own["block_digest"]))
                mime = "application/http; msgtype=response" if own["is_http"] else f.get("Content-type", "application/octet-stream")
                headers += [("WARC-Payload-Digest", "sha1:" + own["payload_digest"]), ("Content-Type", mime), ("Content-Length", str(length))]
                chunks = iter([record.body.read(length)]) if refers else _chunks(b"", record.body)
            for piece in _member(headers, chunks):
                out.write(piece)


def read_warc(source: BinaryIO) -> Iterator[tuple[dict[str, str], BinaryIO]]:
    """Headers and block of each record of a gzipped WARC stream; blocks not read are skipped."""
    lines = _Lines(gzip.GzipFile(fileobj=source))
    while line := lines.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:100]!r}")
        headers = {}
        while (line := lines.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        body = _Body(lines, int(headers["Content-Length"]))
        yield headers, body
        while body.read(CHUNK):
            pass


# --- on Spark --------------------------------------------------------------------------------


def write_arcs(pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", html: str = "html", arc_bytes: int = ARC_BYTES) -> DataFrame:
    """Pages as ARC captures, in gzipped files of about ``arc_bytes`` at most: arc (path).

    Files of even number are of version 1, the others of version 2. NULL html is empty; NULL
    and white space in URLs are written as "-" and percent codes.
    """
    text_batches(pages.sparkSession, 200)
    rows = pages.select(F.col(f"`{key}`").cast("string"), F.col(f"`{url}`"), F.col(f"`{html}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, size, number, paths = None, 0, 0, []
        for batch in batches:
            for page, target, body in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None or size > arc_bytes:
                    if file:
                        file.close()
                    version, name = 1 + number % 2, f"{attempt_name('capture')}.arc.gz"
                    number += 1
                    paths.append(f"{folder}/{name}")
                    file = create_file(paths[-1])
                    size = file.write(gzip.compress(version_block(name, version)))
                payload = (body or "").encode()
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += "" if page is None else f"{PAGE_HEADER}: {quote_plus(page)}\r\n"
                block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                fields = {"URL": target, "IP-address": "0.0.0.0", "Archive-date": "20260101000000", "Content-type": "text/html", "Result-code": "200"}
                size += file.write(gzip.compress(arc_record(fields, block, version), 6))
        if file:
            file.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["arc"])

    return rows.mapInArrow(run, "arc string")


_RECORD = (
    "arc string, offset long, url string, date string, place long, page string, is_http boolean, head_bytes long, "
    "payload_bytes long, payload_digest string, block_digest string"
)


def _spread(paths: DataFrame) -> DataFrame:
    """One file a task, as far as there are partitions."""
    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(n)


def place_of(page: str | None) -> int | None:
    """The order of a page that is a 64-bit integer."""
    number = int(page) if page and re.fullmatch(r"[+-]?[0-9]{1,40}", page) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def list_records(arcs: DataFrame) -> DataFrame:
    """First pass: a row for each record of ARC files (column arc), without version blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _RECORD.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with open_stream(path) as source:
                    for i, record in enumerate(read_arc(plain_stream(source))):
                        if not i:
                            continue
                        seen = capture(record.body)
                        page = seen.header(PAGE_HEADER)
                        rows.append((
                            path, record.offset, record.fields["URL"], record.fields["Archive-date"], place_of(page), page, seen.is_http,
                            len(seen.head), seen.payload_bytes, base32_sha1(seen.payload), base32_sha1(seen.block),
                        ))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = zip(*rows) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return _spread(arcs).mapInArrow(run, _RECORD)


def to_warc(arcs: DataFrame, folder: str, *, min_bytes: int = 0) -> DataFrame:
    """Convert ARC files (column arc): a row per WARC file: arc, warc.

    Of records with equal payloads of at least ``min_bytes`` the first stays whole: that of the
    smallest page number, then date, file and offset; records whose page is no number come after
    those, by the page's text, and records without a page last.
    """
    records = cut(list_records(arcs), "arc-records")
    order = F.struct(F.col("place").isNull().alias("odd"), "place", F.col("page").isNull().alias("none"), F.url_decode("page").alias("named"), "date", "arc", "offset", "url")
    first = records.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.min(order).alias("first"))
    # Outer, and with the large side on the left, so that a payload with very many copies can be split.
    known = records.join(first, "payload_digest", "left").select(
        "arc", "offset", "is_http", "head_bytes", "payload_digest", "block_digest",
        F.when(
            (F.col("payload_bytes") >= min_bytes) & ((F.col("first.arc") != F.col("arc")) | (F.col("first.offset") != F.col("offset"))),
            F.struct(F.col("first.arc").alias("arc"), F.col("first.offset").alias("offset"), F.col("first.url").alias("url"), F.col("first.date").alias("date")),
        ).alias("refers"),
    )

    def run(rows: pa.Table) -> pa.Table:
        path = rows["arc"][0].as_py()
        found = {}
        for row in rows.to_pylist():
            refers = row.pop("refers")
            row["refers_id"] = record_id(refers["arc"].rpartition("/")[2], refers["offset"]) if refers else None
            row["refers_url"], row["refers_date"] = (refers["url"], refers["date"]) if refers else (None, None)
            found[row["offset"]] = row
        name = path.rpartition("/")[2]
        target = f"{folder}/{attempt_name(name.partition('.arc')[0])}.warc.gz"
        convert(path, name, target, found)
        return pa.table({"arc": [path], "warc": [target]})

    return known.groupBy("arc").applyInArrow(run, "arc string, warc string")


def read_records(warcs: DataFrame) -> DataFrame:
    """Records of WARC files (column warc), digests computed anew; warcinfo records left out.

    Gives id, type, url, page (text), refers (a record id), refers_page, payload_bytes and
    payload_digest; a revisit has no payload of its own, so its two are those of the record it
    refers to. Only revisits are joined with the records that they refer to.
    """
    schema = "id string, type string, url string, page string, refers string, payload_bytes long, payload_digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 5 + [pa.int64(), pa.string()]
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with open_stream(path) as source:
                    for headers, body in read_warc(source):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        seen = capture(body)
                        refers = headers.get("WARC-Refers-To")
                        digest = base32_sha1(seen.payload)
                        if not refers and headers["WARC-Payload-Digest"] != f"sha1:{digest}":
                            raise ValueError(f"{headers['WARC-Record-ID']} does not have the declared payload")
                        page = seen.header(PAGE_HEADER)
                        rows.append((
                            headers["WARC-Record-ID"], headers["WARC-Type"], headers.get("WARC-Target-URI"),
                            page, refers, None if refers else seen.payload_bytes, None if refers else digest,
                        ))
                columns = zip(*rows) if rows else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    read = cut(_spread(warcs.select("warc")).mapInArrow(run, schema), "warc-records")
    whole = read.where("refers IS NULL")
    targets = whole.select(F.col("id").alias("refers"), F.col("page").alias("refers_page"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    again = read.where("refers IS NOT NULL").join(targets, "refers", "left").select(
        "id", "type", "url", "page", "refers", "refers_page", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest")
    )
    return again.unionAll(
        whole.select("id", "type", "url", "page", "refers", F.lit(None).cast("string").alias("refers_page"), "payload_bytes", "payload_digest")
    )


def archive_pages(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, arc_bytes: int = ARC_BYTES) -> DataFrame:
    """Pages written as ARC files, converted to WARC files, and those read back.

    A row per page: key, payload_bytes, payload_digest, record_type, refers_to (the key of the
    record that a revisit refers to). Keys have any type that text gives back; those that are
    64-bit integers are ordered as such, others after them as text. Rows that repeat a key are
    records of their own, and so are pages with a NULL key. An empty table gives no rows. Other
    columns are not read.
    """
    spark = pages.sparkSession
    folder = shared_path(spark, "archives")
    arcs = cut(write_arcs(pages, folder, key=key, url=url, html=html, arc_bytes=arc_bytes), "arcs")
    warcs = cut(to_warc(arcs, folder, min_bytes=min_bytes), "warcs")
    kind = pages.schema[key].dataType
    return read_records(warcs).select(
        _key("page", kind).alias(key), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        _key("refers_page", kind).alias("refers_to"),
    )


def _key(page: str, kind: DataType) -> Column:
    return F.url_decode(page).cast(kind)
