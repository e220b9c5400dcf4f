"""Legacy web archives: ARC files parsed by their version and converted to WARC records."""

from __future__ import annotations

import re
import uuid
from base64 import b32encode
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replivote.llm.common import chunks, stored

#: Names of the header line's parts, by the version an archive declares.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = re.compile(r"[\x00-\x20\x7f]")


@dataclass
class Capture:
    """A document of an ARC file: its header line and its HTTP message."""

    url: str
    ip: str
    date: str
    type: str
    http: bytes
    payload: bytes

    @property
    def key(self) -> int | None:
        value = http_field(self.http, b"X-Key")
        return int(value) if value else None

    @property
    def digest(self) -> str:
        return b32encode(sha1(self.payload).digest()).decode()


def http_field(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\r\n")[1:]:
        field, _, value = line.partition(b":")
        if field.lower() == name.lower():
            return value.strip()
    return None


def arc_file(captures: Iterable[tuple[int | None, str | None, str | None]], version: int, date: str, ip: str = "0.0.0.0") -> bytes:
    """An ARC file of ``(key, url, html)`` rows; null html is an empty body, a null or blank address ``-``."""
    names = " ".join({"url": "URL", "ip": "IP-address", "date": "Archive-date", "type": "Content-type", "length": "Archive-length"}.get(f, f.capitalize()) for f in ARC_FIELDS[version])
    told = f"{version} 0 replivote\n{names}\n\n".encode()
    name = "filedesc://pages.arc"
    line = {1: f"{name} {ip} {date} text/plain {len(told)}\n", 2: f"{name} {ip} {date} text/plain 200 - - 0 pages.arc {len(told)}\n"}[version]
    out = bytearray(line.encode() + told)
    for key, url, html in captures:
        payload = (html or "").encode("utf-8", "surrogatepass")
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Key: {'' if key is None else key}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        target = _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or "-"
        length = len(head) + len(payload)
        more = "" if version == 1 else f" 200 {b32encode(sha1(payload).digest()).decode()} - {len(out)} pages.arc"
        out += f"{target} {ip} {date} text/html{more} {length}\n".encode() + head + payload + b"\n"
    return bytes(out)


def arc_captures(data: bytes) -> Iterator[Capture]:
    """Documents of an ARC file. The first record declares the version, and so the parts of every header line."""
    end = data.index(b"\n")
    size = int(data[:end].rpartition(b" ")[2])
    version = int(data[end + 1 : end + 2])
    fields = ARC_FIELDS[version]
    at = end + 1 + size
    while at < len(data):
        if data[at : at + 1] == b"\n":  # records are parted by blank lines
            at += 1
            continue
        end = data.index(b"\n", at)
        parts = data[at:end].decode().split(" ")
        if len(parts) != len(fields):
            raise ValueError(f"a header line of version {version} has {len(fields)} parts: {data[at:end][:200]!r}")
        line = dict(zip(fields, parts))
        block = data[end + 1 : end + 1 + int(line["length"])]
        if len(block) < int(line["length"]):
            raise ValueError("the archive ends within a document")
        head, _, payload = block.partition(b"\r\n\r\n")
        yield Capture(line["url"], line["ip"], line["date"], line["type"], head, payload)
        at = end + 1 + int(line["length"])


def warc_date(date: str) -> str:
    """A date of 14 digits (fewer are filled up) as a WARC timestamp."""
    full = date + "00000101000000"[len(date) :] if len(date) < 14 else date[:14]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def record_id(key: int | None, url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {date} {digest} {url}')}>"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{n}: {v}\r\n" for n, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def converted(capture: Capture, refers_to: int | None) -> bytes:
    """A WARC record of an ARC document: a response, or a revisit of the response with key ``refers_to``."""
    digest = capture.digest
    block_head = capture.http + b"\r\n\r\n"
    block = block_head + (capture.payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Target-URI", capture.url),
        ("WARC-Date", warc_date(capture.date)),
        ("WARC-Record-ID", record_id(capture.key, capture.url, capture.date, digest)),
        ("WARC-IP-Address", capture.ip),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{b32encode(sha1(block).digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("X-Refers-To-Key", str(refers_to))]
    return warc_record(fields, block)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of every record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts here: {lines[0][:80]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        at = start + int(fields["Content-Length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, data[start:at]
        at += 4


def _packed(parts: Iterable[bytes], limit: int) -> Iterator[bytes]:
    """Records joined to archives of about ``limit`` bytes."""
    open_, size = [], 0
    for part in parts:
        if open_ and size + len(part) > limit:
            yield b"".join(open_)
            open_, size = [], 0
        open_.append(part)
        size += len(part)
    if open_:
        yield b"".join(open_)


def legacy_archives(pages: DataFrame, key: str = "page_id", date: str = "20010203040506", limit: int = 8 << 20) -> DataFrame:
    """``body``: the pages as ARC files of about ``limit`` bytes, half of them of either version."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks([whole], "html", limit):
                rows = list(zip(*[batch.column(c).to_pylist() for c in ("key", "url", "html")]))
                files = [arc_file([r for r in rows if (r[0] or 0) % 2 == v - 1], v, date) for v in ARC_FIELDS]
                yield pa.RecordBatch.from_arrays([pa.array(files, pa.large_binary() if sum(map(len, files)) > 1 << 30 else pa.binary())], ["body"])

    narrow = pages.select(F.col(key).cast("long").alias("key"), F.col("url").cast("string").alias("url"), F.col("html").alias("html"))
    return narrow.mapInArrow(run, "body binary")


CAPTURE = "key long, url string, ip string, date string, type string, http binary, payload binary, digest string, n_bytes long"


def captures(archives: DataFrame) -> DataFrame:
    """One row per document of ARC files ``body``."""
    names = [c.split()[0] for c in CAPTURE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in CAPTURE.split(", ")]
        for batch in batches:
            for body in batch.column("body"):
                rows = [
                    (c.key, c.url, c.ip, c.date, c.type, c.http, c.payload, c.digest, len(c.payload)) for c in arc_captures(body.as_py())
                ]
                columns = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names)

    return archives.mapInArrow(run, CAPTURE)


def convert(archives: DataFrame, least: int = 0, limit: int = 8 << 20) -> DataFrame:
    """``body``: ARC files as WARC files of about ``limit`` bytes.

    Of documents with equal payloads of ``least`` bytes or more the one with the largest
    key becomes the response and the others revisit it; smaller ones and those without
    a key are responses. Rows that repeat the largest key are all responses.
    """
    found = captures(archives)
    first = found.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.max("key").alias("response"))
    refers = F.when((F.col("n_bytes") >= least) & (F.col("key") != F.col("response")), F.col("response"))
    decided = found.join(first, "digest", "left").withColumn("refers_to", refers)
    columns = ["url", "ip", "date", "type", "http", "payload", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = warc_record([("WARC-Type", "warcinfo"), ("Content-Type", "application/warc-fields")], b"software: replivote\r\nformat: WARC File Format 1.1\r\n")

        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*[batch.column(c) for c in columns]):
                    *parts, refers_to = [v.as_py() for v in row]
                    yield converted(Capture(*parts), refers_to)

        for body in _packed(records(), limit):
            yield pa.RecordBatch.from_arrays([pa.array([info + body], pa.binary())], ["body"])

    return decided.select(*columns).mapInArrow(run, "body binary")


READ = "key long, url string, date string, record_id string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_back(archives: DataFrame) -> DataFrame:
    """One row per page record of WARC files ``body``; a response's payload must match its digest."""
    names = [c.split()[0] for c in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in READ.split(", ")]
        for batch in batches:
            for body in batch.column("body"):
                rows = []
                for fields, block in warc_records(body.as_py()):
                    if fields["WARC-Type"] in ("response", "revisit"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].partition(":")[2]
                        whole = fields["WARC-Type"] == "response"
                        if whole and b32encode(sha1(payload).digest()).decode() != digest:
                            raise ValueError("a payload does not have its digest")
                        key, other = http_field(head, b"X-Key"), fields.get("X-Refers-To-Key")
                        rows.append(
                            (int(key) if key else None, fields["WARC-Target-URI"], fields["WARC-Date"], fields["WARC-Record-ID"],
                             int(http_field(head, b"Content-Length")), digest, fields["WARC-Type"], int(other) if other else None, payload if whole else None)
                        )
                columns = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names)

    return archives.mapInArrow(run, READ)


def archived_pages(pages: DataFrame, key: str = "page_id", least: int = 0) -> DataFrame:
    """The pages through ARC files into stored WARC files, and one row per record read back from them.

    Null html is an empty payload; other columns than key, address and html are not archived.
    """
    return read_back(stored(convert(legacy_archives(pages, key), least), "warc"))
