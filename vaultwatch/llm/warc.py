"""WARC archives: written from pages with duplicates as revisits, and read back by a reader that salvages.

Each record is a gzip member of its own. The reader checks every member and record: the gzip sum, the version
line, the length, the closing lines and the digest of the block. Where a check fails it looks for the next member
or version line at which a record passes all checks, goes on there, and logs the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import pieces, settle
from vaultwatch.llm.shared_files import attempt_name, new_folder, open_folder

# Fixed values of the format.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

REVISIT_FROM = 1000  # bytes of payload from which equal payloads are stored once
DATE = "2000-01-01T00:00:00Z"
FIRST_FEED, WINDOW = 4096, 1 << 20
_CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _uri(text: str) -> str:
    """No line breaks or blanks in a header's value."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, uncompressed. A revisit has the digest and length of the payload, not the payload."""
    block = HTTP_HEAD if refers_to is not None else HTTP_HEAD + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())),
        ("WARC-Payload-Digest", _base32(hashlib.sha1(payload).digest())),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _uri(url)))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    tool = zlib.compressobj(level, zlib.DEFLATED, 31)
    return tool.compress(data) + tool.flush()


class Broken(Exception):
    """A member or record that fails a check; the text says which."""


class Source:
    """Random access by windows of a file."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.start, self.data = 0, b""

    def bytes(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if not self.start <= at <= at + n <= self.start + len(self.data):
            self.start, self.data = at, self.file.read_at(max(n, min(WINDOW, self.size - at)), at)
        return self.data[at - self.start : at - self.start + n]

    def candidate(self, at: int) -> int:
        """The next place that looks like a member or a version line, or the end."""
        while at < self.size:
            chunk = self.bytes(at, WINDOW)
            if hit := _CANDIDATE.search(chunk):
                return at + hit.start()
            if at + len(chunk) >= self.size:
                break
            at += max(1, len(chunk) - 6)
        return self.size


def _unzip(source: Source, at: int) -> tuple[bytes, int]:
    tool, out, fed, step = zlib.decompressobj(31), [], 0, FIRST_FEED
    while not tool.eof:
        chunk = source.bytes(at + fed, step)
        if not chunk:
            raise Broken("truncated member")
        try:
            out.append(tool.decompress(chunk))
        except zlib.error:
            raise Broken("damaged member") from None
        fed += len(chunk)
        step = min(2 * step, WINDOW)
    return b"".join(out), at + fed - len(tool.unused_data)


def _head(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[0-9]", lines[0]):
        raise Broken("no version line")
    pairs = [line.partition(":") for line in lines[1:] if line]
    if any(not colon for _, colon, _ in pairs):
        raise Broken("damaged header")
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _length(head: dict[str, str]) -> int:
    value = head.get("content-length", "")
    if not re.fullmatch("[0-9]+", value):
        raise Broken("no length")
    return int(value)


def parse(source: Source, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at this place, its block, and where the next one begins; :class:`Broken` if any check fails."""
    if source.bytes(at, 3) == MAGIC:
        data, end = _unzip(source, at)
        cut = data.find(b"\r\n\r\n")
        if cut < 0:
            raise Broken("no header")
        head = _head(data[:cut])
        block, tail = data[cut + 4 : cut + 4 + _length(head)], data[cut + 4 + _length(head) :]
    else:
        n, cut = FIRST_FEED, -1
        while cut < 0:
            text = source.bytes(at, n)
            cut = text.find(b"\r\n\r\n")
            if cut < 0 and (at + n >= source.size or n >= WINDOW):
                raise Broken("no header")
            n *= 2
        head = _head(text[:cut])
        end = at + cut + 8 + _length(head)
        if end > source.size:
            raise Broken("truncated record")
        block, tail = source.bytes(at + cut + 4, _length(head)), source.bytes(end - 4, 4)
    if len(block) != _length(head) or tail != b"\r\n\r\n":
        raise Broken("wrong length")
    said = head.get("warc-block-digest")
    if said and said.startswith("sha1:") and said != _base32(hashlib.sha1(block).digest()):
        raise Broken("wrong digest")
    return head, block, end


def salvage(source: Source) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str | None]]:
    """All sound records and, between them, the gaps: (offset, length, header, block, None) or
    (offset, length, None, b"", reason)."""
    at = 0
    while at < source.size:
        try:
            head, block, end = parse(source, at)
            yield at, end - at, head, block, None
            at = end
        except Broken as why:
            gap, found = at, at
            while True:
                found = source.candidate(found + 1)
                if found >= source.size:
                    break
                try:
                    parse(source, found)
                    break
                except Broken:
                    continue
            yield gap, found - gap, None, b"", str(why)
            at = found


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages that repeat another's payload of ``REVISIT_FROM`` bytes or more.

    Of pages with equal payloads the one with the largest page_id is kept, each of its rows if it has several; a
    page without an id is never a revisit. Only digests are shuffled.
    """
    digests = pages.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("size"))
    long_ones = settle(digests.filter(F.col("size") >= REVISIT_FROM).select("page_id", "digest"), "payloads")
    largest = long_ones.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return settle(long_ones.join(largest, "digest").filter("page_id <> refers_to").distinct(), "revisits")


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages (page_id, url, html) as archives, a file for each task; returns the settled list of files.

    A null html is an empty payload, a null url leaves out that header. Other columns are not used. A table
    without rows gives no files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, home = open_folder(folder)
        name, count, out = attempt_name(TaskContext.get().partitionId(), ".warc.gz"), 0, None
        for batch in batches:
            for part in pieces(batch, "html"):
                for page_id, url, html, refers_to in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    out = out or files.open_output_stream(f"{home}/{name}", compression=None)
                    out.write(member(record(page_id, url, html or b"", refers_to)))
                    count += 1
        if out:
            out.close()
            yield pa.record_batch({"file": pa.array([name]), "records": pa.array([count], pa.int64())})

    source = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"))
    repeated = revisits(pages.select("page_id", "html"))
    marked = source.withColumn("digest", F.sha1("html")).join(repeated, ["page_id", "digest"], "left")
    return settle(marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, "file string, records long"), "archives")


def _page(head: dict[str, str], name: str) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?[0-9]+)>", head.get(name, ""))
    return int(found[1]) if found else None


READ_SCHEMA = (
    "file string, offset long, length long, gap string, page_id long, url string, record_type string,"
    " payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def read(listed: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every record and gap of the listed files (column ``file``), a task for each file.

    ``gap`` is the failed check, null for a record. A revisit's payload is null; its length and digest are those
    of the payload it stands for. Foreign records keep null in what they do not say.
    """
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in READ_SCHEMA.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, home = open_folder(folder)
        rows, held = [], 0

        def flush() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[] for _ in names]
            return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for name in batch.column("file").to_pylist():
                with files.open_input_file(f"{home}/{name}") as file:
                    for at, n, head, block, gap in salvage(Source(file)):
                        if head is None:
                            rows.append((name, at, n, gap, *[None] * 7))
                            continue
                        kind = head.get("warc-type")
                        payload = block.partition(b"\r\n\r\n")[2] if head.get("content-type", "").startswith("application/http") else block
                        if kind == "revisit":
                            payload, size = None, head.get("x-payload-length", "")
                            size = int(size) if size.isdigit() else None
                            said = head.get("warc-payload-digest", "").removeprefix("sha1:")
                            digest = base64.b32decode(said).hex() if len(said) == 32 else None
                        else:
                            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        rows.append((name, at, n, None, _page(head, "warc-record-id"), head.get("warc-target-uri"), kind, size, digest, _page(head, "warc-refers-to"), payload if payloads else None))
                        held += len(payload or b"") if payloads else 200
                        if held > WINDOW << 2:
                            yield flush()
                            rows, held = [], 0
        if rows:
            yield flush()

    tasks = max(1, listed.count())
    return listed.select("file").repartition(tasks).mapInArrow(run, READ_SCHEMA)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write the pages and read the records back, without their payloads."""
    folder = new_folder(pages.sparkSession, "warc")
    found = read(write(pages, folder), folder, payloads=False)
    return found.filter("gap IS NULL").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
