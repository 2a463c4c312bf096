"""WARC records in ZIP packages, written by tasks and read back by ranges.

A package is one ZIP file a task: stored (uncompressed) members ``archive/data-N.warc.gz``, every record a gzip member of
its own, each followed by ``indexes/data-N.cdx``, one line of JSON a record with offset and length. A central directory
in ZIP64 form closes the file. Tasks send members to Spark's text writer as they fill, so a task holds one member, Spark's
committer takes care of lost and repeated tasks, and any store that Spark writes to will do. The writer ends a row by a
newline: between members that is a gap, which ZIP allows, and at the end it is the archive's comment.

The reader lists packages with Spark, reads the end of each, follows the ZIP64 locator, parses the central directory and the
indexes, and emits ranges of neighbouring records; after a shuffle of these few bytes tasks read each range with one seek and
inflate its records. Nothing is unpacked. Tasks open packages by ranges where the store allows it; where only Spark
reaches the store, they come as ``binaryFile`` rows of at most 2 GB.

Of equal payloads the one with the smallest page_id is a response, the others are revisits that refer to it; rows of that
smallest id are all responses. Payload digests are SHA-1, but payloads count as equal by SHA-256.

Edge cases: a null html is an empty payload; a null id is greater than all others, and if all ids of a payload are null all
are responses; repeated rows each give a record; null and unprintable addresses are replaced or percent-encoded; an
empty table gives an empty result and no package; payloads of any length that fit a row are written whole; other columns
are not read. A package without an index is read by walking through its members; compressed members are refused.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import map_rows
from itinera.session import scratch_path

#: Bytes after which a member is closed; bytes of neighbouring records that one seek reads; bytes of packages a task reads.
MEMBER, RANGE, SHARE = 8 << 20, 4 << 20, 32 << 20
DATE = "1970-01-01T00:00:00Z"

# Signatures and layouts of the ZIP format.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF
_STAMP = 0x0021_0000  # the first of January 1980, midnight

# WARC revisit profile.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str | None):
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


def warc_record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """A response, or a revisit: the same HTTP header, which states the payload's length, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    address = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:x-page:{page_id}"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Target-URI", address),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        *([("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", _PROFILE)] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one inflated record in lower case, its HTTP fields and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    more = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}
    return {"fields": fields, "http": more, "payload": payload}


# --- writing ---------------------------------------------------------------------------------------------------------


class Package:
    """Builds one ZIP file front to back; every call returns the bytes that come next."""

    def __init__(self, gap: int = 1):
        self.at, self.gap, self.entries = 0, gap, []

    def member(self, name: str, data: bytes) -> bytes:
        crc, where = zlib.crc32(data), self.at
        path = name.encode()
        head = _LOCAL + struct.pack("<HHHIIIIHH", 45, 0x800, 0, _STAMP, crc, len(data), len(data), len(path), 0) + path
        self.entries.append((path, crc, len(data), where))
        self.at += len(head) + len(data) + self.gap
        return head + data

    def close(self, comment: bytes = b"\n") -> bytes:
        """Central directory, always with offsets and ends in ZIP64 form. ``comment`` is what the writer itself adds."""
        start, parts = self.at, []
        for path, crc, size, where in self.entries:
            extra = struct.pack("<HHQ", 1, 8, where)
            parts.append(
                _CENTRAL + struct.pack("<HHHHIIIIHHHHHII", 45, 45, 0x800, 0, _STAMP, crc, size, size, len(path), len(extra), 0, 0, 0, 0, _MAX32) + path + extra
            )
        directory = b"".join(parts)
        count, end = len(self.entries), start + len(directory)
        end64 = _END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, len(directory), start)
        locator = _LOCATOR + struct.pack("<IQI", 0, end, 1)
        short = min(count, _MAX16)
        tail = _END + struct.pack("<HHHHIIH", 0, 0, short, short, min(len(directory), _MAX32), _MAX32, len(comment))
        return directory + end64 + locator + tail


def _packed(batches):
    """Rows of the text writer: members of one package in order, its directory last."""
    package, number = Package(), 0
    data, lines = io.BytesIO(), []

    def flush():
        nonlocal number, data, lines
        name = f"data-{number:06d}"
        out = [package.member(f"archive/{name}.warc.gz", data.getvalue()), package.member(f"indexes/{name}.cdx", "".join(sorted(lines)).encode())]
        number, data, lines = number + 1, io.BytesIO(), []
        return out

    for batch in batches:
        for page_id, url, payload, refers_to, revisit in zip(*(batch[c] for c in ("page_id", "url", "payload", "refers_to", "revisit")), strict=True):
            deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
            packed = deflate.compress(warc_record(page_id, url, payload, refers_to, revisit)) + deflate.flush()
            entry = {"id": _record_id(page_id), "offset": data.tell(), "length": len(packed), "type": "revisit" if revisit else "response"}
            lines.append(json.dumps(entry) + "\n")
            data.write(packed)
            if data.tell() >= MEMBER:
                for part in flush():
                    yield ([part],)
    if lines:
        for part in flush():
            yield ([part],)
    if package.entries:
        yield ([package.close()],)


def with_references(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit). Only hashes are grouped; the join back has one row a payload on its right,
    so adaptive execution may broadcast it if it is small and split a hot payload's rows if not."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    first = rows.where(F.octet_length("payload") >= least).groupBy("key").agg(F.min("page_id").alias("refers_to"))
    joined = rows.join(first, "key", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))


def write_packages(pages: DataFrame, folder: str, least: int = 0) -> None:
    """One package a task below ``folder``, which must not exist yet."""
    rows = map_rows(with_references(pages, least), _packed, "part binary")
    rows.select(F.col("part").cast("string").alias("part")).write.option("compression", "none").option("lineSep", "\n").text(folder)


# --- reading ---------------------------------------------------------------------------------------------------------


class Ranges:
    """Reads byte ranges of a file that tasks can open by themselves, or of one that came as a row."""

    def __init__(self, path: str, content: bytes | None = None):
        if content is not None:
            self.file = io.BytesIO(content)
        elif (local := re.match(r"(?:file:/*)?(/.*)", path)) and path.startswith(("/", "file:")):
            from pyarrow.fs import LocalFileSystem

            self.file = LocalFileSystem().open_input_file(re.sub(r"^/+", "/", "/" + local[1]))
        else:
            from pyarrow.fs import FileSystem

            system, name = FileSystem.from_uri(path)
            self.file = system.open_input_file(name)
        self.file.seek(0, 2)
        self.size = self.file.tell()

    def read(self, at: int, count: int) -> bytes:
        if at < 0 or at + count > self.size:
            raise ValueError("a range leaves the file")
        self.file.seek(at)
        return self.file.read(count)

    def close(self) -> None:
        self.file.close()

    @staticmethod
    def opens(path: str) -> bool:
        """Schemes that tasks can open without Spark."""
        return path.startswith(("/", "file:", "hdfs:", "s3:", "gs:"))


def central_directory(ranges: Ranges) -> dict[str, tuple[int, int, int, int]]:
    """{member: (method, size, offset of its local header, crc)} in order, ZIP64 structures included."""
    tail_size = min(ranges.size, 22 + _MAX16)
    tail = ranges.read(ranges.size - tail_size, tail_size)
    at = len(tail)
    while True:
        at = tail.rfind(_END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = ranges.size - tail_size + at
    if _MAX16 == count or _MAX32 in (size, start):
        sign, _, where, _ = struct.unpack("<4sIQI", ranges.read(end - 20, 20))
        if sign != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        record = ranges.read(where, 56)
        if record[:4] != _END64:
            raise ValueError("no ZIP64 end of a central directory")
        count, size, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, members = ranges.read(start, size), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        flags, method, _, crc, packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<HHIIIIHHH", directory, at + 8)
        offset = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, to = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while to + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, to)
            if kind == 1:  # the 64-bit values of those fields that say so, in this order
                wide = list(struct.unpack_from(f"<{length // 8}Q", extra, to + 4))
                plain = wide.pop(0) if plain == _MAX32 else plain
                packed = wide.pop(0) if packed == _MAX32 else packed
                offset = wide.pop(0) if offset == _MAX32 else offset
            to += 4 + length
        members[name] = (method, packed, offset, crc)
        at += 46 + n_name + n_extra + n_comment
    return members


def member_range(ranges: Ranges, members: dict, name: str) -> tuple[int, int]:
    """(offset, size) of a stored member's bytes."""
    method, size, offset, _ = members[name]
    if method != 0:
        raise ValueError(f"{name} is compressed; only stored members can be read by ranges")
    head = ranges.read(offset, 30)
    if head[:4] != _LOCAL:
        raise ValueError(f"no local header of {name}")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return offset + 30 + n_name + n_extra, size


def _walk(ranges: Ranges, start: int, size: int, zipped: bool) -> Iterator[tuple[int, int]]:
    """(offset, length) of every record of a member without an index, read piece by piece."""
    at, stop = start, start + size
    while at < stop:
        if zipped:
            inflate, to = zlib.decompressobj(31), at
            while not inflate.eof:
                piece = ranges.read(to, min(1 << 16, stop - to))
                if not piece:
                    raise ValueError("a record ends early")
                inflate.decompress(piece)
                to += len(piece)
            length = to - len(inflate.unused_data) - at
        else:
            head = b""
            while b"\r\n\r\n" not in head:
                piece = ranges.read(at + len(head), min(1 << 12, stop - at - len(head)))
                if not piece:
                    raise ValueError("a record ends early")
                head += piece
            head = head[: head.index(b"\r\n\r\n") + 4]
            block = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
            length = len(head) + int(block[1]) + 4
        yield at, length
        at += length


def record_ranges(ranges: Ranges) -> Iterator[list[tuple[int, int]]]:
    """Lists of neighbouring (offset, length) in the file, about ``RANGE`` bytes each."""
    members = central_directory(ranges)
    for name in members:
        if not (found := re.fullmatch(r"archive/(.+)\.warc(\.gz)?", name)):
            continue
        start, size = member_range(ranges, members, name)
        index = f"indexes/{found[1]}.cdx"
        if index in members:
            lines = ranges.read(*member_range(ranges, members, index)).decode().splitlines()
            entries: Iterable = sorted((start + e["offset"], e["length"]) for e in (json.loads(x[x.index("{") :]) for x in lines))
        else:
            entries = _walk(ranges, start, size, bool(found[2]))
        held, held_size = [], 0
        for offset, length in entries:
            if held and (held_size + length > RANGE or offset != held[-1][0] + held[-1][1]):
                yield held
                held, held_size = [], 0
            held.append((offset, length))
            held_size += length
        if held:
            yield held


def read_records(ranges: Ranges, entries: list[tuple[int, int]]) -> Iterator[dict]:
    """The records of one list of neighbours, by one read."""
    first = entries[0][0]
    data = ranges.read(first, sum(n for _, n in entries))
    for offset, length in entries:
        part = data[offset - first : offset - first + length]
        yield parse_record(zlib.decompress(part, 31) if part[:2] == b"\x1f\x8b" else part)


def _facts(record: dict) -> tuple:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of one record, checked by its digest."""
    fields, kind = record["fields"], record["fields"]["warc-type"]
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    page = _page_of(fields.get("warc-record-id"))
    if kind == "revisit":
        return page, fields.get("warc-target-uri"), None, int(record["http"]["content-length"]), said, kind, _page_of(fields.get("warc-refers-to"))
    payload = record["payload"]
    digest = payload_digest(payload)
    if said and digest != said:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not have its digest")
    return page, fields.get("warc-target-uri"), payload, len(payload), digest, kind, None


SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_packages(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row a record of all packages below ``folder``; with ``payloads=False`` payloads are checked but not sent on."""
    files = spark.read.format("binaryFile").load(folder)
    where, size = files.agg(F.min("path"), F.coalesce(F.sum("length"), F.lit(0))).first()
    direct = where is None or Ranges.opens(where)
    columns = SCHEMA if payloads else SCHEMA.replace("payload binary, ", "")

    def rows_of(ranges, lists):
        for entries in lists:
            found = [_facts(r) for r in read_records(ranges, entries)]
            yield tuple([f[i] for f in found] for i in range(7) if payloads or i != 2)

    def locate(batches):
        for batch in batches:
            for path in batch["path"]:
                ranges = Ranges(path)
                for entries in record_ranges(ranges):
                    yield [path], [[{"o": o, "n": n} for o, n in entries]]
                ranges.close()

    def fetch(batches):
        for batch in batches:
            for path, entries in zip(batch["path"], batch["entries"], strict=True):
                ranges = Ranges(path)
                yield from rows_of(ranges, [[(e["o"], e["n"]) for e in entries]])
                ranges.close()

    def whole(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                ranges = Ranges(path, bytes(content))
                yield from rows_of(ranges, record_ranges(ranges))

    if not direct:
        return map_rows(files.select("path", "content"), whole, columns)
    located = map_rows(files.select("path"), locate, "path string, entries array<struct<o:long,n:long>>")
    # the ranges are few bytes, so their number of tasks follows the bytes that they stand for
    return map_rows(located.repartition(max(2, -(-size // SHARE)), "path", F.col("entries")[0]["o"]), fetch, columns)


def op13(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "packages")
    write_packages(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_packages(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# base32 of SHA-1 in SQL: 20 bits are five hexadecimal digits and four letters
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_LETTERS}', 1 + (CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f ON f.html = p.html"""
