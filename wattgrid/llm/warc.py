"""WARC archives: a writer with revisit records and a salvage reader.

The writer makes one archive per partition, one gzip member per record. Of records with equal
payloads only one is stored whole; the others are revisits that name it.

The reader checks every member (gzip checksum and size), the record's version line,
length and ending, and the block and payload digests. After a failed check it searches on
for the next gzip member, or in uncompressed archives the next version line,
whose record passes all checks, goes on from there, and reports the bytes between as a
gap. Blocks are inflated and digested piece by piece: a payload of over ``HOLD`` bytes is held only once
its record has passed, so damaged lengths and gzip bombs take no memory. Header lines between two blank
lines are read once, however many version lines stand among them, and so is the block behind them. Headers
of over ``HEADER`` bytes count as damage, and gzip headers of over ``GZIP_HEADER``. ``quarantine`` stores the bytes of gaps.

Defined results: NULL payload is empty; NULL addresses and ids are left out of the headers
and read back as NULL; repeats of the row a group keeps are kept like it; an empty
table gives an empty archive set.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import masked, place_of, scratch, ship, table, written
from .token_records import place

VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD_CHECK = b"X-Header-CRC32: "  # an extension, last in the header: digests cover the block alone
GZIP = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
BLOCK = 1 << 20
FLUSH = 8 << 20
HOLD = 8 << 20
HEADER = 16 << 20
GZIP_HEADER = 4096
PIECE = 1 << 20
MIN_REVISIT = 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line: control characters as percent codes."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", sha1(block)), ("Content-Length", str(len(block)))]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in lines).encode()
    return head + HEAD_CHECK + b"%08x\r\n\r\n" % zlib.crc32(head) + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                refers_url: str | None, date: str = DATE) -> bytes:
    """A response record with its payload, or a revisit of page ``refers_to``."""
    digest = sha1(payload)
    h = [("WARC-Type", "response" if refers_to is None else "revisit"),
         ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"), ("WARC-Date", date)]
    if url is not None:
        h.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        h.append(("X-Page-ID", str(page_id)))
    h += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", digest), ("X-Payload-Length", str(len(payload)))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record(h, http + payload)
    h += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    if refers_url is not None:
        h += [("WARC-Refers-To-Target-URI", _clean(refers_url)),
              ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to} {refers_url} {digest}')}>")]
    return record(h, http)


def _write(folder: str, compress: bool, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        fs, top = place(folder)
        fs.create_dir(top, recursive=True)
        name = f"pages-{ctx.partitionId():05d}.warc" + (".gz" if compress else "")
        own = f"{top}/.{name}-{ctx.taskAttemptId()}"
        out, n, size = None, 0, 0
        pack = (lambda r: member(r, level)) if compress else (lambda r: r)
        for b in batches:
            for page, url, html, to, to_url in zip(*(b.column(c).to_pylist() for c in ("_id", "_url", "_html", "_to", "_to_url"))):
                if out is None:
                    out = fs.open_output_stream(own)
                data = pack(page_record(page, url, html, to, to_url))
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            fs.move(own, f"{top}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["file", "records", "bytes"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = MIN_REVISIT, compress: bool = True, level: int = 4) -> DataFrame:
    """Write a record per row; returns the written manifest ``file``, ``records``, ``bytes``.

    Payloads of ``min_revisit`` bytes or more that occur more than once: the row with the
    largest id is the response, the others revisit it. Groups are met by digest and
    length in aggregates and a join; only repeated payloads' keys are on the join's other side.
    """
    ship(pages.sparkSession)
    body = F.coalesce(F.col(place_of(pages, payload_col)), F.lit("")).cast("binary")
    rows = masked(pages).select(F.col(place_of(pages, id_col)).cast("long").alias("_id"), F.col(place_of(pages, url_col)).alias("_url"), body.alias("_html"))
    rows = rows.withColumn("_sha", F.when(F.octet_length("_html") >= min_revisit, F.sha2("_html", 256)))
    groups = (rows.filter("_sha IS NOT NULL").groupBy("_sha", F.octet_length("_html").alias("_size"))
              .agg(F.count(F.lit(1)).alias("_m"), F.max(F.struct("_id", "_url")).alias("_last")).filter("_m > 1 AND _last._id IS NOT NULL")
              .select(F.col("_sha").alias("_gsha"), F.col("_size").alias("_gsize"), F.col("_last._id").alias("_gid"), F.col("_last._url").alias("_gurl")))
    groups = written(groups, "payload-groups")
    joined = rows.join(groups, (rows["_sha"] == groups["_gsha"]) & (F.octet_length(rows["_html"]) == groups["_gsize"]), "left")
    other = ~F.col("_id").eqNullSafe(F.col("_gid"))
    joined = joined.select("_id", "_url", "_html", F.when(other, F.col("_gid")).alias("_to"), F.when(other, F.col("_gurl")).alias("_to_url"))
    return written(joined.mapInArrow(_write(folder, compress, level), "file string, records long, bytes long"), "warc-manifest")


class Damaged(Exception):
    """A record that fails a check; the message says which."""


class Archive:
    """One archive, read in blocks at any offset, a record at a time."""

    def __init__(self, f):
        self.f, self.size = f, f.size()
        self.at, self.block, self.after = 0, b"", 0
        self.blank_line = 0, -1
        self.lines: Lines | None = None
        self.lines_end, self.body = -1, None

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``, from the block at hand where it has them."""
        lo = at - self.at
        if lo < 0 or lo + n > len(self.block):
            self.at, self.block = at, self.f.read_at(max(0, min(max(n, BLOCK), self.size - at)), at) if at < self.size else b""
            lo = 0
        return self.block[lo:lo + n]

    def find(self, at: int) -> int:
        """Offset of the next gzip mark or version line from ``at`` on, or the end."""
        keep = 16
        while at < self.size:
            data = self.read(at, min(BLOCK, self.size - at))
            hit = START.search(data)
            if hit:
                return at + hit.start()
            if at + len(data) >= self.size:
                break
            at += len(data) - keep
        return self.size

    def blank(self, at: int) -> int:
        """Offset of the next blank line from ``at`` on; remembered, as many version lines may come before it."""
        lo, hit = self.blank_line
        if not lo <= at <= hit:
            pos, hit = at, self.size
            while pos < self.size:
                data = self.read(pos, min(BLOCK, self.size - pos))
                cut = data.find(b"\r\n\r\n")
                if cut >= 0:
                    hit = pos + cut
                    break
                if pos + len(data) >= self.size:
                    break
                pos += len(data) - 3
            self.blank_line = at, hit
        return hit

    def inflated(self, at: int) -> Iterator[bytes]:
        """The gzip member at ``at`` in pieces of bounded size; ``after`` is then the offset behind it."""
        z, pos, step, some = zlib.decompressobj(31), at, 512, False
        try:
            while not z.eof:
                data = z.unconsumed_tail
                if not data:
                    if not some and pos - at >= GZIP_HEADER:
                        raise Damaged("gzip header is too long")
                    data = self.read(pos, min(step, self.size - pos)) if pos < self.size else b""
                    pos, step = pos + len(data), min(step * 8, BLOCK >> 4)
                    if not data:
                        raise Damaged("member is cut off")
                piece = z.decompress(data, PIECE)
                some = some or bool(piece)
                yield piece
        except zlib.error as e:
            raise Damaged(f"gzip: {e}") from None
        self.after = pos - len(z.unused_data)

    def packed(self, at: int, hold: int | None) -> tuple[dict[str, str], Body, int]:
        """Headers, checked body and end of the record in the gzip member at ``at``."""
        pieces, data, cut = self.inflated(at), b"", -1
        for piece in pieces:
            data += piece
            if len(data) >= len(VERSION) and not VERSION_LINE.match(data):
                raise Damaged("no version line")
            cut = data.find(b"\r\n\r\n")
            if cut >= 0:
                break
            if len(data) > HEADER:
                raise Damaged("header is too long")
        if cut < 0 or not VERSION_LINE.match(data):
            raise Damaged("no end of header" if cut < 0 else "no version line")
        lines = Lines(data[:cut], 0)
        left = lines.length(0)
        body, head, rest = lines.body(0, hold), data[:cut], data[cut + 4:]
        while True:
            body.feed(rest[:left])
            rest, left = rest[left:], max(0, left - len(rest))
            if len(rest) > 4:
                raise Damaged("length and data differ")
            piece = next(pieces, None)
            if piece is None:
                break
            rest += piece
        if left or rest != b"\r\n\r\n":
            raise Damaged("length and data differ")
        lines.check(0, head, body)
        return lines.headers(0), body, self.after

    def plain(self, at: int, hold: int | None) -> tuple[dict[str, str], Body, int]:
        """Headers, checked body and end of the uncompressed record at ``at``."""
        if not VERSION_LINE.match(self.read(at, min(len(VERSION), self.size - at))):
            raise Damaged("no version line")
        cut = self.blank(at)
        if cut >= self.size:
            raise Damaged("header is cut off")
        if cut - at > HEADER:
            raise Damaged("header is too long")
        if self.lines is None or self.lines_end != cut or self.lines.at > at:
            self.lines, self.lines_end, self.body = Lines(self.read(at, cut - at), at), cut, None
        lines = self.lines
        n = lines.length(at)
        end = cut + 4 + n + 4
        if end > self.size:
            raise Damaged("record is cut off")
        if self.f.read_at(4, end - 4) != b"\r\n\r\n":
            raise Damaged("length and data differ")
        body = lines.body(at, hold)
        key = n, body.http, hold
        if self.body is not None and self.body[0] == key:
            body = self.body[1]
        else:
            for pos in range(cut + 4, cut + 4 + n, PIECE):
                body.feed(self.read(pos, min(PIECE, cut + 4 + n - pos)))
            self.body = key, body
        lines.check(at, self.read(at, cut - at), body)
        return lines.headers(at), body, end

    def record(self, at: int, hold: int | None) -> tuple[dict[str, str], Body, int]:
        """The record at ``at``, checked; ``hold`` bounds the payload that is kept (None: no bound)."""
        if self.read(at, 3) == GZIP:
            return self.packed(at, hold)
        if self.read(at, 5) == b"WARC/":
            return self.plain(at, hold)
        raise Damaged("no version line")


class Body:
    """Digests of a block and of the payload in it, fed in pieces."""

    def __init__(self, http: bool, hold: int | None):
        self.http, self.hold = http, hold
        self.block, self.digest, self.size = hashlib.sha1(), hashlib.sha1(), 0
        self.within, self.tail = not http, b""
        self.parts: list[bytes] | None = []

    def feed(self, data: bytes) -> None:
        self.block.update(data)
        if not self.within:  # the payload follows the HTTP header
            data = self.tail + data
            cut = data.find(b"\r\n\r\n")
            if cut < 0:
                self.tail = data[-3:]
                return
            self.within, data = True, data[cut + 4:]
        self.digest.update(data)
        self.size += len(data)
        if self.hold is not None and self.size > self.hold:
            self.parts = None
        elif self.parts is not None:
            self.parts.append(data)


def _named(h) -> str:
    return "sha1:" + base64.b32encode(h.digest()).decode()


class Lines:
    """Header lines before a blank line, read once for all version lines among them: of each name the last
    place and value, and the last line that is none."""

    def __init__(self, data: bytes, at: int):
        self.at, self.bad, self.last = at, 0, {}
        pos = 0
        for line in data.split(b"\r\n"):
            k, colon, v = line.partition(b":")
            if colon:
                self.last[k.decode("utf-8", "replace").strip().lower()] = pos, v.decode("utf-8", "replace").strip()
            else:
                self.bad = pos
            pos += len(line) + 2

    def get(self, name: str, at: int) -> str:
        """Value for the record whose version line is at ``at``, or nothing."""
        pos, value = self.last.get(name, (-1, ""))
        return value if pos >= at - self.at + len(VERSION) else ""

    def headers(self, at: int) -> dict[str, str]:
        return {k: v for k, (pos, v) in self.last.items() if pos >= at - self.at + len(VERSION)}

    def length(self, at: int) -> int:
        if self.bad >= at - self.at + len(VERSION):
            raise Damaged("bad header line")
        n = self.get("content-length", at)
        if not re.fullmatch(r"[0-9]{1,18}", n):
            raise Damaged("no length")
        return int(n)

    def body(self, at: int, hold: int | None) -> Body:
        return Body("application/http" in self.get("content-type", at), hold)

    def check(self, at: int, head: bytes, body: Body) -> None:
        """Digests of block and payload and the header's checksum, as far as the record names them."""
        want = self.get("warc-block-digest", at)
        if want.startswith("sha1:") and want != _named(body.block):
            raise Damaged("block digest differs")
        want = self.get("warc-payload-digest", at)
        if self.get("warc-type", at) != "revisit" and want.startswith("sha1:") and want != _named(body.digest):
            raise Damaged("payload digest differs")
        pos = head.rfind(HEAD_CHECK)
        if pos >= 0 and head[pos + len(HEAD_CHECK):] != b"%08x" % zlib.crc32(head[:pos]):
            raise Damaged("header checksum differs")


def salvage(f, with_payload: bool = True) -> Iterator[tuple[str, int, int, object, object, object]]:
    """``("record", offset, end, headers, payload, (SHA-1, size))`` and ``("gap", offset, end, reason, None, None)``
    of an open archive, in order; without ``with_payload`` payloads are None."""
    a = Archive(f)
    at, gap, reason = 0, None, ""
    while at < a.size:
        try:
            head, body, end = a.record(at, HOLD if with_payload else 0)
            if with_payload and body.parts is None:  # a large one that passed: read again and held
                head, body, end = a.record(at, None)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = a.find(at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at, reason, None, None
            gap = None
        yield "record", at, end, head, b"".join(body.parts) if with_payload else None, (body.digest.hexdigest(), body.size)
        at = end
    if gap is not None:
        yield "gap", gap, a.size, reason, None, None


READ_SCHEMA = ("file string, kind string, offset long, end long, reason string, record_type string, page_id long, url string, "
               "refers_to long, payload_digest string, payload_bytes long, payload binary")
READ_NAMES = [c.split()[0] for c in READ_SCHEMA.split(", ")]
READ_TYPES = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in READ_SCHEMA.split(", ")]


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?\d+", text) else None


def _hex(digest: str | None) -> str | None:
    if not digest or not digest.startswith("sha1:"):
        return None
    try:
        return base64.b32decode(digest[5:]).hex()
    except ValueError:
        return digest[5:].lower()


def _read(folder: str, with_payload: bool):
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), READ_TYPES)], names=READ_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = place(folder)
        for b in batches:
            for name in b.column("file").to_pylist():
                rows, size = [], 0
                with fs.open_input_file(f"{top}/{name}") as f:
                    for kind, at, end, head, body, found in salvage(f, with_payload):
                        if kind == "gap":
                            rows.append((name, kind, at, end, head, *[None] * 7))
                            continue
                        revisit = head.get("warc-type") == "revisit"
                        digest = _hex(head.get("warc-payload-digest")) if revisit else found[0]
                        length = _number(head.get("x-payload-length")) if revisit else found[1]
                        rows.append((name, kind, at, end, None, head.get("warc-type"), _number(head.get("x-page-id")), head.get("warc-target-uri"),
                                     _number(head.get("x-refers-to-page-id")), digest, length, body if with_payload and not revisit else None))
                        size += len(body) if with_payload else 200
                        if size >= FLUSH:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)
    return run


def read_archives(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Rows of kind ``record`` and ``gap`` of every archive named in ``files.file``, one task each."""
    return files.select("file").repartitionByRange(max(1, files.count()), "file").mapInArrow(_read(folder, with_payload), READ_SCHEMA)


def _gap_bytes(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = place(folder)
        for b in batches:
            for row in b.to_pylist():
                with fs.open_input_file(f"{top}/{row['file']}") as f:
                    for at in range(row["offset"], row["end"], PIECE):
                        data = f.read_at(min(PIECE, row["end"] - at), at)
                        yield pa.RecordBatch.from_arrays([pa.array([row["file"]]), pa.array([at], pa.int64()), pa.array([len(data)], pa.int64()),
                                                          pa.array([row["reason"]], pa.string()), pa.array([data], pa.binary())],
                                                         names=["file", "offset", "length", "reason", "bytes"])
    return run


def quarantine(rows: DataFrame, folder: str) -> DataFrame:
    """Written table of the gaps among ``rows`` of ``read_archives``: ``file``, ``offset``, ``length``, ``reason``, ``bytes``;
    a gap of over ``PIECE`` bytes has several rows."""
    gaps = rows.filter("kind = 'gap'").select("file", "offset", "end", "reason")
    return written(gaps.mapInArrow(_gap_bytes(folder), "file string, offset long, length long, reason string, bytes binary"), "warc-quarantine")


def read_checked(files: DataFrame, folder: str, with_payload: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written records, the quarantine table, and of each archive of the manifest with missing records ``file``, ``records``, ``found``."""
    rows = written(read_archives(files, folder, with_payload), "warc-rows")
    records = rows.filter("kind = 'record'")
    per = records.groupBy(F.col("file").alias("_file")).agg(F.count(F.lit(1)).alias("found"))
    missing = files.join(per, files["file"] == F.col("_file"), "left").select("file", "records", F.coalesce("found", F.lit(0)).alias("found")).filter("found <> records")
    return records, quarantine(rows, folder), missing


def op10_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as archives and read back: payload size, digest and record type of each. Records that
    the manifest counts and the reader did not find are an error."""
    folder = scratch(spark, "warc")
    files = write_archives(table(spark, sf_dir, "pages"), folder)
    records, gaps, missing = read_checked(files, folder)
    if not missing.isEmpty():
        raise RuntimeError(f"records lost in {folder}, their bytes are in {gaps.inputFiles()[:1]}")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Digests, sizes and groups are functions of the table, so plain SQL can give them.
ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, count(*) AS m, max(page_id) AS last FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN g.m > 1 AND p.page_id IS DISTINCT FROM g.last AND g.last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.m > 1 AND p.page_id IS DISTINCT FROM g.last THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""
