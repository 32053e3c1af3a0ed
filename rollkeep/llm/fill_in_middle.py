"""Fill-in-the-middle transformation over seekable compressed texts.

A text is stored as independent zstandard frames, each cut after a word, with two running counts per frame: the units
(a word with the white space before it, or the white space at a text's end) and the code points up to its end. To cut a
text at a number of units, the counts name the one frame that holds the cut; only that frame is decompressed to find the
place. Output and restored text are never put together: their frames are decompressed in order, and the pieces go
through a digest. A text of one frame, as most are, costs one decompression for all of that.

Restoring takes only the output and its form: the markers are looked for in the stream, then the three ranges between them
are streamed in the text's own order.

Defined results: a null text is empty, has no unit and is plain; a text of white space only is one unit; repeated rows
give repeated results; a null id draws from the digest of the empty string instead of the id, and stays null; a word longer
than a frame has a frame of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from rollkeep.llm.common import ddl, python_tasks, record_batch, texts
from rollkeep.sources.staging import staged

# The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLANK = b" \t\n\x0b\x0c\r"
UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")
WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
CONTINUED = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point

LONG, TEXT = pa.int64(), pa.string()
FRAMES = pa.schema(
    [("doc_id", LONG), ("marked", pa.bool_()), ("n", LONG), ("units", pa.list_(LONG)), ("chars", pa.list_(LONG)), ("frames", pa.list_(pa.binary()))]
)
RESULT = pa.schema(
    [("doc_id", LONG), ("n", LONG), ("form", TEXT), ("prefix_chars", LONG), ("middle_chars", LONG), ("output_sha256", TEXT), ("restored_sha256", TEXT)]
)
OUTPUT = pa.schema([("doc_id", LONG), ("form", TEXT), ("output", TEXT)])


@dataclass(frozen=True)
class FillInMiddle:
    """``percent`` of the texts are left plain as they are, ``spm`` of 100 others start with the suffix."""

    seed: str = "42"
    percent: int = 50
    spm: int = 80
    frame_bytes: int = 1 << 16


def units_of(data: bytes) -> int:
    """Units of a text: its words, and white space after the last one."""
    return len(data.split()) + (data[-1:] in BLANK if data else 0)


def code_points(data: bytes) -> int:
    return len(data.translate(None, CONTINUED))


def sections(data: bytes, size: int) -> Iterator[bytes]:
    """The text in parts of about ``size``, each but the last ending with a word."""
    at = 0
    while len(data) - at > size:
        found = WORD_END.search(data, at + size - 1)
        if not found:
            break
        yield data[at : found.end()]
        at = found.end()
    if at < len(data):
        yield data[at:]


class StoredText:
    """Frames of a text with the units and code points up to the end of each."""

    def __init__(self, units: list[int], chars: list[int], frames: list[bytes], unpress: Callable[[bytes], bytes]):
        self.units, self.chars, self.frames, self.unpress = units, chars, frames, unpress
        self.at, self.open = -1, b""

    def frame(self, k: int) -> bytes:
        if k != self.at:  # the frame met last is kept
            self.at, self.open = k, self.unpress(self.frames[k])
        return self.open

    def cut(self, units: int) -> tuple[tuple[int, int], int]:
        """The place (frame, byte) after so many units, and the code points before it."""
        k = bisect.bisect_left(self.units, units)
        if not units:
            return (0, 0), 0
        before, chars = (self.units[k - 1], self.chars[k - 1]) if k else (0, 0)
        if units == self.units[k]:
            return (k + 1, 0), self.chars[k]
        data, end = self.frame(k), 0
        for _, found in zip(range(units - before), UNIT.finditer(data)):
            end = found.end()
        return (k, end), chars + code_points(data[:end])

    def between(self, start: tuple[int, int], end: tuple[int, int]) -> Iterator[bytes]:
        """The text from one place to another, a frame at a time."""
        for k in range(start[0], min(end[0] + 1, len(self.frames))):
            stop = end[1] if k == end[0] else None
            if stop != 0:
                yield self.frame(k)[start[1] if k == start[0] else 0 : stop]


def draws(seed: str, doc_id: int | None) -> list[int]:
    """Four numbers below 2^32 that depend on the seed and the id only."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def arranged(text: StoredText, form: str, low: tuple[int, int], high: tuple[int, int]) -> Iterator[bytes]:
    """The output as a stream."""
    start, end = (0, 0), (len(text.frames), 0)
    if form == "plain":
        yield from text.between(start, end)
        return
    prefix, middle, suffix = (start, low), (low, high), (high, end)
    parts = [(PREFIX, prefix), (SUFFIX, suffix)] if form == "psm" else [(SUFFIX, suffix), (PREFIX, prefix)]
    for marker, (a, b) in [*parts, (MIDDLE, middle)]:
        yield marker
        yield from text.between(a, b)


def _found(stream: Iterator[bytes], markers: tuple[bytes, ...]) -> dict[bytes, int]:
    """Where each marker begins in a stream, also where it spans two pieces of it."""
    places, at, tail = {}, 0, b""
    longest = max(map(len, markers))
    for piece in stream:
        seen = tail + piece
        for marker in markers:
            place = -1 if marker in places else seen.find(marker)
            if place >= 0:
                places[marker] = at - len(tail) + place
        at, tail = at + len(piece), seen[-(longest - 1) :]
    places[b""] = at
    return places


def _range(stream: Iterator[bytes], start: int, end: int) -> Iterator[bytes]:
    at = 0
    for piece in stream:
        if at >= end:
            return
        if at + len(piece) > start:
            yield piece[max(0, start - at) : end - at]
        at += len(piece)


def restored(output: Callable[[], Iterator[bytes]], form: str) -> Iterator[bytes]:
    """The text, from an output that can be streamed again and its form."""
    if form == "plain":
        yield from output()
        return
    places = _found(output(), (PREFIX, SUFFIX, MIDDLE))
    ends = sorted(places.values())
    for marker in (PREFIX, MIDDLE, SUFFIX):
        begin = places[marker]
        yield from _range(output(), begin + len(marker), ends[bisect.bisect_right(ends, begin)])


def _digest(stream: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in stream:
        digest.update(piece)
    return digest.hexdigest()


def chosen(doc_id: int | None, n: int, marked: bool, rule: FillInMiddle) -> tuple[str, int, int]:
    """Form of the output, and the units before its middle and before its suffix."""
    one, two, share, kind = draws(rule.seed, doc_id)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    if not n or marked or share % 100 >= rule.percent:
        return "plain", low, high
    return "spm" if kind % 100 < rule.spm else "psm", low, high


def transformed(text: StoredText, doc_id: int | None, n: int, marked: bool, rule: FillInMiddle) -> tuple:
    """One row of the result, without the id."""
    form, *units = chosen(doc_id, n, marked, rule)
    if form == "plain":
        digest = _digest(arranged(text, form, (0, 0), (0, 0)))
        return n, form, None, None, digest, digest
    (low, before), (high, until) = map(text.cut, units)
    if len(text.frames) == 1:  # one decompression serves the cuts and all streams
        whole = [b"".join(arranged(text, form, low, high))]
        output = lambda: iter(whole)
    else:
        output = lambda: arranged(text, form, low, high)
    return n, form, before, until - before, _digest(output()), _digest(restored(output, form))


def store(docs: DataFrame, rule: FillInMiddle | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its frames with their running counts, and whether it holds a marker."""
    rule = rule or FillInMiddle()
    python_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows = []
            for doc_id, value in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                data, n, length, units, chars, frames = value.encode(), 0, 0, [], [], []
                for part in sections(data, rule.frame_bytes):
                    n, length = n + units_of(part), length + code_points(part)
                    units.append(n)
                    chars.append(length)
                    frames.append(press.compress(part))
                rows.append((doc_id, any(m in data for m in (PREFIX, SUFFIX, MIDDLE)), n, units, chars, frames))
            yield record_batch(rows, FRAMES)

    return texts(docs, key, text).mapInArrow(run, ddl(FRAMES))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[StoredText, int | None, int, bool]]:
    import zstandard

    unpress = zstandard.ZstdDecompressor().decompress
    for doc_id, marked, n, units, chars, frames in zip(*(batch.column(c).to_pylist() for c in FRAMES.names)):
        yield StoredText(units, chars, frames, unpress), doc_id, n, marked


def fill_in_middle(stored: DataFrame, rule: FillInMiddle | None = None) -> DataFrame:
    """Form, cuts and digests of output and restored text, one row per stored text."""
    rule = rule or FillInMiddle()
    python_tasks(stored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, *transformed(text, doc_id, n, marked, rule)) for text, doc_id, n, marked in _texts(batch)]
            yield record_batch(rows, RESULT)

    return stored.mapInArrow(run, ddl(RESULT))


def outputs(stored: DataFrame, rule: FillInMiddle | None = None) -> DataFrame:
    """``doc_id``, ``form`` and the ``output`` text itself, for training; the longest text must fit a task here."""
    rule = rule or FillInMiddle()
    python_tasks(stored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, doc_id, n, marked in _texts(batch):
                form, *units = chosen(doc_id, n, marked, rule)
                (low, _), (high, _) = map(text.cut, units)
                rows.append((doc_id, form, b"".join(arranged(text, form, low, high)).decode()))
            yield record_batch(rows, OUTPUT)

    return stored.mapInArrow(run, ddl(OUTPUT))


def stored_frames(docs: DataFrame, rule: FillInMiddle | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`store`, written to the shared folder and read back."""
    return staged(store(docs, rule, key, text), "text-frames")
