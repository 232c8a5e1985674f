"""Legacy archive converter (operator 9): ARC files to WARC files.

An ARC file begins with a version block that names the fields of the header
lines after it: five in version 1, ten in version 2. Each record is such a
line and as many bytes as its last field declares. The converter reads both
versions (also several version blocks in one file), and synthesises for
every record an equivalent WARC record: an identifier (a name-based UUID of
address, date, page and digest, so reruns agree), the timestamp in ISO form,
the record type, and SHA-256 digests of block and payload. Of records with
equal payloads of ``REVISIT_BYTES`` bytes or more, the one with the smallest
page number is the response, the others are revisits of it.

All files are written and read by Spark's own sources: a row of the text
writer is a whole segment of an archive (bytes, not lines), files are read
whole by the binary source. Segments and files have bounded sizes; a record
larger than that is a segment of its own.

Null page text counts as empty. Rows that repeat the smallest page number of
a payload are all responses. A null page number is kept as such, and comes
after all others when the response is chosen. A header line that does not
parse (its date included), or a declared length beyond the end of the file,
ends that file with a record of type ``error`` (no page number, digest of the
bytes left); so does a broken or cut gzip member, or bytes after the last one.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from datetime import datetime
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.staging import new_folder, staged

REVISIT_BYTES = 100
SEGMENT = 4 << 20           # bytes of a segment, about
SEGMENTS_A_FILE = 8
# The header fields of both versions.
FIELDS = {
    b"1": (b"URL", b"IP-address", b"Archive-date", b"Content-type", b"Archive-length"),
    b"2": (b"URL", b"IP-address", b"Archive-date", b"Content-type", b"Result-code", b"Checksum", b"Location",
           b"Offset", b"Filename", b"Archive-length"),
}
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")   # the standard name space of addresses
RECORD = ("page_id long, url string, ip string, date string, mime string, record_type string, block binary, "
          "payload_bytes long, payload_digest string")
RECORD_TYPES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                          ("mime", pa.string()), ("record_type", pa.string()), ("block", pa.binary()),
                          ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def unpacked(data: bytes) -> tuple[bytes, bytes]:
    """The bytes of a file that may be gzip, of one member or several, and
    those that could not be unpacked: a member that is broken or cut off, or
    what follows the last one (zeros and line ends are padding)."""
    if data[:2] != b"\x1f\x8b":
        return data, b""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            part = member.decompress(data)
        except zlib.error:
            break
        if not member.eof:
            break
        out.append(part)
        data = member.unused_data
    return b"".join(out), data if data.strip(b"\0\r\n") else b""


def unreadable(left: bytes, names) -> dict:
    """An ``error`` record of the bytes left, with the columns ``names``."""
    known = {"record_type": "error", "block": left, "payload_bytes": len(left), "payload_digest": sha(left)}
    return {n: known.get(n) for n in names}


# -- ARC ---------------------------------------------------------------------

def version_block(version: bytes, name: str, date: str) -> bytes:
    body = version + b" 0 archive\n" + b" ".join(FIELDS[version]) + b"\n"
    plain = [b"0.0.0.0", date.encode(), b"text/plain"]
    more = [b"200", b"-", b"-", b"0", name.encode()] if version == b"2" else []
    return b" ".join([b"filedesc://" + name.encode(), *plain, *more, str(len(body)).encode()]) + b"\n" + body


def arc_record(version: bytes, url: str, ip: str, date: str, mime: str, block: bytes, offset: int, name: str) -> bytes:
    said = [re.sub(r"\s", "%20", url or "-").encode(), ip.encode(), date.encode(), mime.encode()]
    if version == b"2":
        said += [b"200", b"-", b"-", str(offset).encode(), name.encode()]
    return b" ".join([*said, str(len(block)).encode()]) + b"\n" + block


def http_block(page_id, html: str) -> bytes:
    body = html.encode()
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{page}\r\n").encode() + body


def arc_segments(date: str, ip: str):
    """Task: pages (page_id, url, html) to ARC segments; the two versions take turns."""
    def run(batches):
        part, size, turn = [], 0, 0

        def start():
            name = f"segment-{turn}.arc"
            return b"12"[turn % 2:turn % 2 + 1], name, [version_block(b"12"[turn % 2:turn % 2 + 1], name, date)]

        version, name, part = start()
        for batch in batches:
            out = []
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                block = http_block(page, html or "")
                part.append(arc_record(version, url, ip, date, "text/html", block, size, name))
                size += len(block)
                if size >= SEGMENT:
                    out.append(b"\n".join(part))
                    turn, size = turn + 1, 0
                    version, name, part = start()
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["segment"])
        if len(part) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"\n".join(part)], pa.binary())], names=["segment"])

    return run


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and body of an HTTP message; a block
    that is none is all body."""
    head, cut, body = block.partition(b"\r\n\r\n")
    if not cut or not head.startswith(b"HTTP/"):
        return {}, block
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {a.decode("latin-1").strip().lower(): b.decode("latin-1").strip() for a, _, b in pairs}, body


def iso(date: str) -> str:
    """14 digits (12 and 8 occur too) to an ISO timestamp."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


#: Address (may hold spaces), IP address, date, further fields, length.
HEADER = re.compile(rb"(.*?) (-|[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*) ([0-9]{14}|[0-9]{12}|[0-9]{8}) (.*) ([0-9]+)", re.S)


def header_fields(line: bytes, version: bytes) -> dict[str, str] | None:
    """Fields of a record's header line, None where it is none. They are told
    by their form from the left, since addresses and content types may hold
    spaces; in version 2 the five behind the content type hold none."""
    found = HEADER.fullmatch(line)
    if not found:
        return None
    url, ip, date, more, length = found.groups()
    said = [more] if version == b"1" else more.rsplit(b" ", len(FIELDS[b"2"]) - 5)
    if version == b"2" and len(said) < len(FIELDS[b"2"]) - 4:
        return None
    try:
        datetime.strptime(date.decode().ljust(14, "0"), "%Y%m%d%H%M%S")
    except ValueError:
        return None
    text = lambda b: b.decode("utf-8", "replace")
    return {"url": text(url), "ip": text(ip), "date": iso(text(date)), "mime": text(said[0]), "length": int(length)}


def parse_arc(data: bytes):
    """Records of an ARC file, as dicts of RECORD."""
    at, version, end = 0, b"1", len(data)
    while at < end:
        if data[at] in b"\r\n":                         # between records
            at += 1
            continue
        line_end = data.find(b"\n", at)
        line = data[at:line_end if line_end >= 0 else end]
        start, line = at + len(line) + 1, line.rstrip(b"\r")
        said = header_fields(line, version)
        if line.startswith(b"filedesc://"):             # its own body says which version follows
            length = line.rpartition(b" ")[2]
            length = int(length) if length.isdigit() else end
            if start + length <= end:
                new = data[start:start + length].split(b" ")[0]
                version, at = new if new in FIELDS else version, start + length
                continue
            said = None
        if line_end < 0 or said is None or start + said["length"] > end:
            yield unreadable(data[at:], RECORD_TYPES.names)
            return
        block = data[start:start + said["length"]]
        head, body = http_parts(block)
        page = head.get("x-page-id", "")
        yield {"page_id": int(page) if re.fullmatch("-?[0-9]+", page) else None, **{n: said[n] for n in ("url", "ip", "date", "mime")},
               "record_type": "response" if said["url"].startswith(("http://", "https://")) or head else "resource",
               "block": block, "payload_bytes": len(body), "payload_digest": sha(body)}
        at = start + said["length"]


def read_records(parse, schema: pa.Schema, columns: tuple[str, ...], batch_bytes: int = 8 << 20):
    """Task: files (content) to records, some at a time."""
    kind = pa.schema([schema.field(c) for c in columns])

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                data, left = unpacked(content.as_py())
                for record in chain(parse(data), [unreadable(left, schema.names)] if left else []):
                    rows.append({c: record[c] for c in columns})
                    size += 200 + (len(record["block"]) if "block" in columns else 0)
                    if size >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema=kind)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return run


def ddl(spec: str, columns: tuple[str, ...]) -> str:
    kinds = dict(x.strip().split(" ") for x in spec.split(","))
    return ", ".join(f"{c} {kinds[c]}" for c in columns)


def files(spark, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("content")


def read_arc(spark, folder: str, columns: tuple[str, ...] = tuple(RECORD_TYPES.names)) -> DataFrame:
    """Records of all ARC files in a folder."""
    return files(spark, folder).mapInArrow(read_records(parse_arc, RECORD_TYPES, columns), ddl(RECORD, columns))


def write_segments(df: DataFrame, column: str, folder: str, end: str) -> None:
    """Segments as files of bounded size, compressed, each followed by ``end``."""
    (df.select(F.col(column).cast("string").alias("value")).write.option("lineSep", end).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", SEGMENTS_A_FILE).text(folder))


def write_arc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
              date: str = "20240101000000", ip: str = "192.0.2.1") -> None:
    """Pages as ARC files of both versions."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    write_segments(rows.mapInArrow(arc_segments(date, ip), "segment binary"), "segment", folder, "\n")


# -- WARC --------------------------------------------------------------------

def record_id(page, url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{url} {date} {page} {digest}')}>"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha256:{sha(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{a}: {b}\r\n" for a, b in head).encode() + b"\r\n" + block


def as_warc(r: dict, refers_to) -> bytes:
    """The WARC record of an ARC record; ``refers_to``: the page it revisits."""
    fields = [("WARC-Record-ID", record_id(r["page_id"], r["url"], r["date"], r["payload_digest"])),
              ("WARC-Payload-Digest", f"sha256:{r['payload_digest']}")]
    fields += [(n, v) for n, v in (("WARC-Target-URI", r["url"]), ("WARC-Date", r["date"]), ("WARC-IP-Address", r["ip"])) if v]
    if r["page_id"] is not None:
        fields.append(("X-Page-Id", str(r["page_id"])))
    if refers_to is None:
        mime = "application/http; msgtype=response" if r["record_type"] == "response" else (r["mime"] or "application/octet-stream")
        return warc_record("metadata" if r["record_type"] == "error" else r["record_type"],
                           [*fields, ("Content-Type", mime), ("X-Payload-Length", str(r["payload_bytes"]))], r["block"])
    head = r["block"].partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to)),
               ("Content-Type", "application/http; msgtype=response"), ("X-Payload-Length", str(r["payload_bytes"]))]
    return warc_record("revisit", fields, head)


def warc_segments(batches):
    """Task: ARC records and what they revisit to WARC segments."""
    info = b"software: sitelens\r\nformat: WARC File Format 1.1\r\n"
    first = warc_record("warcinfo", [("WARC-Record-ID", record_id(None, "warcinfo", "", sha(info))),
                                     ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], info)
    part, size = [first], 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            part.append(as_warc(r, r["refers_to"]))
            size += len(part[-1])
            if size >= SEGMENT:
                out.append(b"\r\n\r\n".join(part))
                part, size = [first], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["segment"])
    if len(part) > 1:
        yield pa.RecordBatch.from_arrays([pa.array([b"\r\n\r\n".join(part)], pa.binary())], names=["segment"])


def parse_warc(data: bytes):
    """Records of a WARC file but warcinfo. Digests and lengths of payloads
    are taken from the block where the record has one."""
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        head_end = data.find(b"\r\n\r\n", at)
        if head_end < 0:
            return
        pairs = (line.partition(b":") for line in data[at:head_end].split(b"\r\n")[1:])
        head = {a.decode().lower(): b.decode().strip() for a, _, b in pairs}
        start = head_end + 4
        block = data[start:start + int(head["content-length"])]
        kind = head["warc-type"]
        if kind != "warcinfo":
            digest, length = head["warc-payload-digest"].removeprefix("sha256:"), int(head["x-payload-length"])
            if kind != "revisit":
                _, body = http_parts(block) if kind == "response" else ({}, block)
                if (sha(body), len(body)) != (digest, length):
                    raise ValueError(f"{head['warc-record-id']}: its payload does not fit its header")
            page, to = head.get("x-page-id"), head.get("x-refers-to-page-id")
            yield {"page_id": None if page is None else int(page), "record_id": head["warc-record-id"],
                   "url": head.get("warc-target-uri"), "date": head.get("warc-date"), "record_type": kind, "block": block,
                   "payload_bytes": length, "payload_digest": digest, "refers_to": None if to is None else int(to)}
        at = data.find(b"WARC/", start + len(block))


WARC = ("page_id long, record_id string, url string, date string, record_type string, block binary, "
        "payload_bytes long, payload_digest string, refers_to long")
WARC_TYPES = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()),
                        ("record_type", pa.string()), ("block", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64())])


def read_warc(spark, folder: str, columns: tuple[str, ...] = tuple(WARC_TYPES.names)) -> DataFrame:
    """Records of all WARC files in a folder."""
    return files(spark, folder).mapInArrow(read_records(parse_warc, WARC_TYPES, columns), ddl(WARC, columns))


def convert(spark, arc_folder: str, warc_folder: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """ARC files of a folder to WARC files in another.

    Only payloads that occur more than once are looked up by digest; that
    table has one small row for each."""
    brief = read_arc(spark, arc_folder, ("page_id", "payload_bytes", "payload_digest", "record_type"))
    brief = brief.filter((F.col("payload_bytes") >= revisit_bytes) & (F.col("record_type") == "response"))
    again = staged(brief.groupBy(F.col("payload_digest").alias("d")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1 AND first IS NOT NULL").select("d", "first"), "payloads")
    records = read_arc(spark, arc_folder).join(again, (F.col("payload_digest") == F.col("d")) & (F.col("record_type") == "response"), "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    rows = records.select(*RECORD_TYPES.names, refers.cast("long").alias("refers_to"))
    write_segments(rows.mapInArrow(warc_segments, "segment binary"), "segment", warc_folder, "\r\n\r\n")


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages written as ARC, converted to WARC and read back: (page_id,
    record_id, url, date, record_type, payload_bytes, payload_digest,
    refers_to), one row a page. The files stay in the shared folder."""
    spark = pages.sparkSession
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(pages, arc, key, url, html)
    convert(spark, arc, warc)
    return read_warc(spark, warc, tuple(n for n in WARC_TYPES.names if n != "block"))
