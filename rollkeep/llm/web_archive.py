"""WARC files with revisit records, and a reader that salvages damaged ones.

Writing: payloads are equal by a digest of 256 bits and their length; of equal ones the row with the largest id is the
response, the others are revisit records that name it. A record is a gzip member of its own, so any record can be read
by itself; a shard begins with a warcinfo record. A task writes its shards under names of their own, and the manifest
names only those of committed tasks. The row side of the join with the repeated payloads' largest ids is split by
adaptive execution where a payload is very frequent, and a shard is closed at a fixed size, so no file grows with a group.

Reading: a member counts if it decompresses with its checksum, holds a version line, headers and a block of the length
stated, and its block and payload digests agree. After a failed check the reader searches for the next place where a valid
record begins (a member, or a version line in a file that is not compressed), goes on from there, and logs the bytes between as a
quarantined gap with the first failed check. A damaged record thus costs itself, not the rest of its file.

Defined results: a null html is an empty payload; repeated rows of one id and payload are alike (all response or all
revisit); a null id counts as smaller than any other; a null url leaves the target header out; control characters of a url
are percent-encoded; an empty table gives no file and no row. A record that was cut off by damage is missing from the
records and named by a gap; a revisit whose response is missing keeps ``refers_to`` null and has no ``payload_bytes``.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.llm.common import ddl, python_tasks, record_batch, split_count
from rollkeep.sources.staging import staged

# Fixed values of the format.
VERSION = b"WARC/1.1"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
CONTROL = re.compile(rb"[\x00-\x08\x0a-\x1f\x7f]")
END = b"\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_IDS = uuid.UUID("7a0f4c1e-54b2-4f0f-9a57-3a86d15f2f6c")  # a name space of its own
CHUNK, STEP = 1 << 20, 1 << 14  # bytes held of a file, and handed to the decompressor at a time

LONG, TEXT = pa.int64(), pa.string()
MANIFEST = pa.schema([("file", TEXT), ("n_records", LONG), ("n_bytes", LONG)])
READ = pa.schema(
    [("file", TEXT), ("kind", TEXT), ("start", LONG), ("end", LONG), ("reason", TEXT), ("record_type", TEXT), ("record_id", TEXT)]
    + [("page_id", LONG), ("payload_bytes", LONG), ("payload_digest", TEXT), ("refers", TEXT)]
)


@dataclass(frozen=True)
class Record:
    """A record as read: where it lay, its headers in lower case, and its block."""

    start: int
    end: int
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(END)[2]


@dataclass(frozen=True)
class Gap:
    """Bytes that no valid record claims, and the check that failed first there."""

    start: int
    end: int
    reason: str


class Damaged(ValueError):
    """A check of a record failed."""


def bare_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_IDS, f'{page_id}:{digest}')}>"


def _safe(value: str) -> str:
    """A header's value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", f"sha1:{bare_digest(block)}"), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in lines)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + END


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record, or a revisit record of the page ``refers_to``, whose payload is the same."""
    digest = bare_digest(payload)
    own = record_id(page_id, digest) if not revisit else f"<urn:uuid:{uuid.uuid5(RECORD_IDS, f'revisit {page_id}:{url}:{digest}')}>"
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _safe(url)))
    if page_id is not None:
        headers.append(("Page-Id", str(page_id)))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", record_id(refers_to, digest))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    return record(headers, http if revisit else http + payload)


def information(name: str, date: str) -> bytes:
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(RECORD_IDS, name)}>"), ("WARC-Date", date)]
    block = b"software: rollkeep\r\nformat: WARC File Format 1.1\r\n"
    return record([*headers, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def member(data: bytes) -> bytes:
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


class Window:
    """A binary file that can seek, read at any place through one block that is held."""

    def __init__(self, source):
        self.source, self.size, self.base, self.held = source, source.size(), 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.base or at + n > self.base + len(self.held):
            self.source.seek(at)
            self.base, self.held = at, self.source.read(max(n, CHUNK))
        return self.held[at - self.base : at - self.base + n]

    def places(self, mark: bytes, start: int) -> Iterator[int]:
        """Where a mark stands at or after a place."""
        at = start
        while at < self.size:
            data = self.read(at, CHUNK)
            place = data.find(mark)
            while place >= 0:
                yield at + place
                place = data.find(mark, place + 1)
            at += max(1, len(data) - len(mark) + 1)


def _unpacked(source: Window, at: int) -> tuple[bytes, int]:
    """The gzip member at a place, checked by its own sum and length, and where it ends."""
    unpress, out, read = zlib.decompressobj(31), [], at
    while not unpress.eof:
        data = source.read(read, STEP)
        if not data:
            raise Damaged("member is cut off")
        read += len(data)
        try:
            out.append(unpress.decompress(data))
        except zlib.error:
            raise Damaged("member does not decompress") from None
    return b"".join(out), read - len(unpress.unused_data)


def _headers(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line has no colon")
        if CONTROL.search(line):
            raise Damaged("a header line holds control characters")
        name = name.strip().decode("utf-8", "replace").lower()
        if name in found:
            raise Damaged("a header is repeated")
        found[name] = value.strip().decode("utf-8", "replace")
    return found


def _stated(headers: dict[str, str]) -> int:
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    return int(length)


def _checked(start: int, end: int, headers: dict[str, str], block: bytes) -> Record:
    def differs(name: str, data: bytes) -> bool:
        algorithm, _, value = headers.get(name, "").partition(":")
        return algorithm.lower() == "sha1" and value.upper() != bare_digest(data)

    found = Record(start, end, headers, block)
    if "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("no type or record id")
    if differs("warc-block-digest", block):
        raise Damaged("block digest differs")
    if headers["warc-type"] == "response" and differs("warc-payload-digest", found.payload):
        raise Damaged("payload digest differs")
    return found


def _from_member(source: Window, at: int) -> Record:
    data, end = _unpacked(source, at)
    line = VERSION_LINE.match(data)
    if not line:
        raise Damaged("no version line")
    head, _, rest = data[line.end() :].partition(END)
    headers = _headers(head)
    length = _stated(headers)
    if rest[length:] != END:
        raise Damaged("content length differs")
    return _checked(at, end, headers, rest[:length])


def _from_plain(source: Window, at: int) -> Record:
    seen = source.read(at, STEP)
    line = VERSION_LINE.match(seen)
    if not line:
        raise Damaged("no version line")
    while END not in seen and at + len(seen) < source.size and len(seen) < CHUNK:
        seen = source.read(at, 4 * len(seen))
    head, blank, _ = seen.partition(END)
    if not blank:
        raise Damaged("headers do not end")
    headers = _headers(head[line.end() :])
    begin, length = at + len(head) + len(END), _stated(headers)
    if begin + length + len(END) > source.size:
        raise Damaged("record is cut off")
    block = source.read(begin, length + len(END))
    if block[length:] != END:
        raise Damaged("content length differs")
    return _checked(at, begin + len(block), headers, block[:length])


FORMS = {MEMBER: _from_member, VERSION[:7]: _from_plain}


def _next(source: Window, mark: bytes, start: int) -> Record | None:
    """The next valid record of a form at or after a place."""
    for place in source.places(mark, start):
        try:
            return FORMS[mark](source, place)
        except Damaged:
            continue
    return None


def _mark(source: Window) -> bytes:
    """What the file's records begin with; where its first bytes are damaged, what the first valid record begins with."""
    for mark in FORMS:
        if source.read(0, len(mark)) == mark:
            return mark
    found = {mark: _next(source, mark, 0) for mark in FORMS}
    return min(FORMS, key=lambda mark: found[mark].start if found[mark] else source.size)


def salvage(file) -> Iterator[Record | Gap]:
    """Records and gaps of a binary file that can seek, in order; every byte belongs to one of them."""
    source = Window(file)
    mark, at = _mark(source), 0
    while at < source.size:
        try:
            found = FORMS[mark](source, at)
        except Damaged as why:
            found = _next(source, mark, at + 1)
            yield Gap(at, found.start if found else source.size, str(why))
        if found is None:
            return
        yield found
        at = found.end


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _payload(html: str) -> Column:
    return F.coalesce(F.col(html).cast("string"), F.lit(""))


def decided(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``html``, and for revisits the id of the response (``refers_to``) of every page.

    Payloads of fewer than ``least_bytes`` bytes are always responses.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), _payload(html).alias("html"))
    size = F.octet_length("html")
    rows = rows.withColumn("payload", F.concat(F.unhex(F.sha2("html", 256)), F.encode(size.cast("string"), "utf-8")))
    # A null id is smaller than any other, as max leaves it out; payloads of one id only need no row here.
    most = rows.where(size >= least_bytes).groupBy("payload").agg(F.max("page_id").alias("largest"), F.min("page_id").alias("smallest"), F.max(F.col("page_id").isNull()).alias("unknown"))
    repeated = staged(most.where("largest > smallest or (unknown and largest is not null)").select(F.col("payload").alias("same"), "largest"), "payloads")
    joined = rows.join(repeated.hint("shuffle_hash"), F.col("payload") == F.col("same"), "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("largest")).alias("refers_to"))


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", shard_bytes: int = 64 << 20,
) -> DataFrame:
    """Write all pages below ``folder`` as compressed WARC files; the manifest, one row per file."""
    python_tasks(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(folder)
        shards: list[list] = []
        out, room = None, 0
        for batch in batches:
            for page_id, target, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                if out is None or room <= 0:
                    if out is not None:
                        out.close()
                    store.create_dir(place, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, first = store.open_output_stream(f"{place}/{name}", compression=None), member(information(name, date))
                    out.write(first)
                    shards.append([f"{folder}/{name}", 0, len(first)])
                    room = shard_bytes
                data = member(page_record(page_id, target, html.encode(), refers_to, refers_to is not None, date))
                out.write(data)
                shards[-1][1] += 1
                shards[-1][2] += len(data)
                room -= len(data)
        if out is not None:
            out.close()
        yield record_batch([tuple(s) for s in shards], MANIFEST)

    return staged(decided(pages, key, url, html, least_bytes).mapInArrow(run, ddl(MANIFEST)), "web-archives")


def _row(file: str, found: Record | Gap) -> tuple:
    if isinstance(found, Gap):
        return (file, "gap", found.start, found.end, found.reason, *[None] * 6)
    headers = found.headers
    kind, page = headers["warc-type"], headers.get("page-id")
    size = len(found.payload) if kind == "response" else None
    digest = headers.get("warc-payload-digest", "").partition(":")[2] or None
    own = (headers["warc-record-id"], None if page is None else int(page), size, digest, headers.get("warc-refers-to"))
    return (file, "record", found.start, found.end, None, kind, *own)


def read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """All records and gaps of the files (column ``file``), staged: one row each, ``kind`` is record or gap."""
    python_tasks(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, place = _store(file)
                with store.open_input_file(place) as source:
                    found = (_row(file, x) for x in salvage(source))
                    while rows := list(itertools.islice(found, 1024)):
                        yield record_batch(rows, READ)

    # One file a task: files are of bounded size.
    count = max(1, files.count(), split_count(files))
    numbered = files.select("file").repartitionByRange(count, "file")
    return staged(numbered.mapInArrow(run, ddl(READ)), "web-records")


def gaps(found: DataFrame) -> DataFrame:
    """The quarantine log: byte ranges that no valid record claims."""
    return found.where("kind = 'gap'").select("file", "start", "end", "reason")


def pages_of(found: DataFrame) -> DataFrame:
    """One row per page record: a revisit takes size and id from the response that it names."""
    records = found.where("kind = 'record' and record_type in ('response', 'revisit')")
    named = records.where("record_type = 'revisit'").select("refers").distinct()
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("named"), F.col("page_id").alias("response_id"), F.col("payload_bytes").alias("response_bytes")
    )
    wanted = responses.join(named, F.col("named") == F.col("refers"), "left_semi").distinct()
    joined = records.join(staged(wanted, "named-responses").hint("shuffle_hash"), F.col("refers") == F.col("named"), "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("response_id").alias("refers_to")
    )
