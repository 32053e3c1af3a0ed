"""Token ids on disk: one zstandard frame per document, a trailing seek table, a checksum per frame.

A shard is a file of independent frames in document order, then two skippable frames: the document ids, and the seek
table of the zstandard seekable format (compressed size, size and checksum of each frame, then the number of frames).
A reader seeks to the end, reads both tables, and decompresses only the frames it wants; other zstandard readers skip
the tables. Rows are range-partitioned by id, so a shard holds a run of ids; a task writes its shard under a name of
its own, and the manifest names only the shards of tasks that were committed, so a lost executor leaves at most files
that nothing reads.

Defined results: a null text is empty and has only the end id; null ids come first; rows with one id follow each other
by a hash of their text; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollkeep.llm.common import python_tasks, split_count, texts
from rollkeep.llm.encoders import packed, word_encoder
from rollkeep.sources.staging import staged

# Fixed values of the seekable format, and the mark of the frame with document ids.
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
SKIPPABLE_IDS = 0x184D2A5D
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("stored", "<u4"), ("size", "<u4"), ("check", "<u4")])

MANIFEST = "shard int, file string, n_docs long, n_ids long, first_id long, last_id long"
READ = "shard int, doc_id long, inner long, n_tokens long, ids_crc32 long"
READ_NAMES = ["shard", "doc_id", "inner", "n_tokens", "ids_crc32"]


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_shard(out, rows: Iterable[tuple[int | None, bytes]]) -> dict:
    """Frames of (id, packed ids) to a binary stream, then the tables; what the manifest says about them."""
    import xxhash
    import zstandard

    press = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
    entries, keys, known = [], [], []
    for key, ids in rows:
        frame = press.compress(ids)
        out.write(frame)
        entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        keys.append(0 if key is None else key)
        known.append(key is not None)
    table = np.array(entries, dtype=ENTRY)
    listed = np.array(known, dtype="u1").tobytes() + np.array(keys, dtype="<i8").tobytes()
    out.write(struct.pack("<II", SKIPPABLE_IDS, len(listed)) + listed)
    seek = table.tobytes() + FOOTER.pack(len(table), HAS_CHECKSUMS, SEEKABLE)
    out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)
    present = [k for k, there in zip(keys, known) if there]
    ends = (present[0], present[-1]) if present else (None, None)
    return {"n_docs": len(table), "n_ids": int(table["size"].sum(dtype="i8")) // 4, "first_id": ends[0], "last_id": ends[1]}


def read_shard(source, wanted: set[int] | None = None) -> Iterator[tuple[int, int | None, bytes]]:
    """(place, id, packed ids) of the wanted documents, or of all, from a binary file that can seek."""
    import xxhash
    import zstandard

    end = source.size()
    source.seek(end - FOOTER.size)
    n, flags, mark = FOOTER.unpack(source.read(FOOTER.size))
    if mark != SEEKABLE or not flags & HAS_CHECKSUMS:
        raise ValueError("no seek table with checksums at the end of the file")
    ids_at = end - FOOTER.size - n * ENTRY.itemsize - 8 - n * 9 - 8
    source.seek(ids_at + 8)
    known = np.frombuffer(source.read(n), dtype="u1")
    keys = np.frombuffer(source.read(8 * n), dtype="<i8")
    source.read(8)
    table = np.frombuffer(source.read(n * ENTRY.itemsize), dtype=ENTRY)
    starts = np.concatenate([[0], np.cumsum(table["stored"], dtype="i8")])
    unpress = zstandard.ZstdDecompressor()
    for place in range(n):
        key = int(keys[place]) if known[place] else None
        if wanted is not None and key not in wanted:
            continue
        source.seek(int(starts[place]))
        ids = unpress.decompress(source.read(int(table["stored"][place])))
        if xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != table["check"][place]:
            raise ValueError(f"checksum of frame {place} differs")
        yield place, key, ids


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write all documents below ``folder``; the manifest, one row per shard."""
    python_tasks(docs.sparkSession)
    rows = texts(docs, key, text).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(split_count(docs), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, last = word_encoder(tokenizer), packed([end_id])
        documents = (
            (None if pd.isna(k) else int(k), ids + last)
            for batch in batches
            for k, ids in zip(batch["doc_id"], encode(list(batch["text"])))
        )
        first = next(documents, None)
        if first is None:
            return
        store, place = _open(folder)
        store.create_dir(place, recursive=True)
        number = TaskContext.get().partitionId()
        name = f"shard-{number:06d}-{uuid.uuid4().hex}.zst"
        with store.open_output_stream(f"{place}/{name}", compression=None) as out:
            about = write_shard(out, _with_first(first, documents))
        frame = pd.DataFrame([{"shard": number, "file": f"{folder}/{name}", **about}])
        yield frame.astype({"first_id": "Int64", "last_id": "Int64"})

    return staged(ordered.select("doc_id", "text").mapInPandas(shard, MANIFEST), "shards")


def _with_first(first, rest):
    yield first
    yield from rest


def read(manifest: DataFrame, wanted: set[int] | None = None) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``wanted``: only these ids, of which only their frames are decompressed; ``start`` is then null.
    """
    shards = manifest
    if wanted is not None:
        shards = shards.where(" or ".join(f"{k} between first_id and last_id" for k in sorted(wanted)) or "false")

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, file in zip(batch["shard"], batch["file"]):
                store, place = _open(file)
                with store.open_input_file(place) as source:
                    found = [(k, len(ids) // 4, zlib.crc32(ids)) for _, k, ids in read_shard(source, wanted)]
                frame = pd.DataFrame(found, columns=["doc_id", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})
                yield frame.assign(shard=number, inner=frame["n_tokens"].cumsum() - frame["n_tokens"])[READ_NAMES]

    parts = max(1, split_count(manifest))
    found = shards.select("shard", "file").repartition(parts, "shard").mapInPandas(frames, READ)
    if wanted is not None:
        return found.select("doc_id", F.lit(None).cast("long").alias("start"), "n_tokens", "ids_crc32")
    # One row per shard in this window, and in what is broadcast.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
