"""Harmonic packing of documents into sequences of a fixed capacity.

A document's ids are cut into full sequences and a rest; the rest gives up its parts at 1/2, 1/4 and 1/8 of the
capacity, and what is left is a short tail. A piece of length n belongs to class k = capacity // n, whose sequences
take exactly k pieces: pieces at 1/k of the capacity fill theirs without any padding, and a tail class wastes at most
1/(k+1). A worker fills the sequences of a class by itself, so a piece has its place as soon as it is cut, and ids move
nowhere. What is left are fewer than k pieces per worker and class, short ones for the most part: these are ranked over
all workers of the class and fill common sequences. Then each class has at most one sequence that is not full; those, one
per class, are put together first-fit, and a last one is padded only to the next power of two.

Defined results: a null text is empty and has only the end id; repeated rows are packed each; a null id stays null;
an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollkeep.llm.byte_pairs import PART, class_table_of, different_slices
from rollkeep.llm.common import give_back, id_files, in_files, python_tasks, table_files, texts
from rollkeep.llm.encoders import grouped, packed, piece_encoder
from rollkeep.sources.staging import staged

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker int, kind int, place long, at long, ids binary"


def cuts(n: int, capacity: int, divisors: tuple[int, ...]) -> list[int]:
    """Lengths of the pieces of a document with n ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for divisor in divisors:
        part = capacity // divisor
        if part and rest >= part:
            out += [part] * (rest // part)
            rest %= part
    return out + [rest] * (rest > 0)


def encoded(values: list[str], path: str) -> list[bytes]:
    """Packed ids of each text as the tokenizers file gives them, special strings included."""
    lookup, whole, special = piece_encoder(path)
    plain = [i for i, text in enumerate(values) if not any(s in text for s in special)]
    out = {i: whole(values[i]) for i in set(range(len(values))) - set(plain)}
    parts: dict[int, list[bytes]] = {i: [] for i in plain}
    table = class_table_of(path)
    for group in grouped([values[i] for i in plain], PART):
        known, found = different_slices([part for _, part in group], table)
        ids = lookup(known)
        for (i, _), places in zip(group, found):
            parts[plain[i]].append(b"".join([ids[place] for place in places]))
    return [out[i] if i in out else b"".join(parts[i]) for i in range(len(values))]


def pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, divisors: tuple[int, ...], keep_ids: bool, key: str, text: str
) -> DataFrame:
    """Encoded and cut documents, each piece with its worker, its class, its place among that worker's of the class, and
    the ids before it in its sequence of k such pieces."""
    python_tasks(docs.sparkSession, 256)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker, last = TaskContext.get().partitionId(), packed([end_id])
        seen, load = [0] * (capacity + 1), [0] * (capacity + 1)
        for batch in batches:
            rows = []
            for key, ids in zip(batch["doc_id"], encoded(list(batch["text"]), path)):
                ids, key, start = ids + last, None if pd.isna(key) else int(key), 0
                total = len(ids) // 4
                for length in cuts(total, capacity, divisors):
                    part = ids[4 * start : 4 * (start + length)]
                    kind = capacity // length
                    place = (worker, kind, seen[kind], load[kind])
                    rows.append((key, start, length, zlib.crc32(part), total, *place, part if keep_ids else None))
                    seen[kind] += 1
                    load[kind] = load[kind] + length if seen[kind] % kind else 0
                    start += length
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            yield frame.astype({"doc_id": "Int64"})
        give_back()

    return texts(in_files(docs, table_files(docs)), key, text).mapInPandas(run, PIECES)


def first_fit(loads: list[tuple[int, int]], capacity: int) -> dict[int, tuple[int, int]]:
    """(class, load) of the sequences that are not full, at most one per class: class -> (bin, offset in it)."""
    rooms: list[int] = []
    out = {}
    for kind, load in sorted(loads, key=lambda x: (-x[1], x[0])):
        spot = next((i for i, room in enumerate(rooms) if room >= load), len(rooms))
        if spot == len(rooms):
            rooms.append(capacity)
        out[kind] = (spot, capacity - rooms[spot])
        rooms[spot] -= load
    return out


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 0,
    divisors: tuple[int, ...] = (2, 4, 8),
    keep_ids: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    Sequences are numbered class by class; the class sizes that this needs are one row per class.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, path, capacity, end_id, divisors, keep_ids, key, text), "pieces")
    counts = cut.groupBy("kind", "worker").agg(F.count("*").alias("n"))
    whole, left = F.floor(F.col("n") / F.col("kind")), F.col("n") % F.col("kind")
    before = Window.partitionBy("kind").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda x: F.coalesce(F.sum(x).over(before), F.lit(0))
    bases = staged(counts.select("kind", "worker", whole.alias("whole"), left.alias("left"), earlier(whole).alias("sequences"), earlier(left).alias("rests")), "bases", id_files(docs))
    # At most one row per class, and there are no more classes than the capacity.
    totals = bases.groupBy("kind").agg(F.sum("whole").alias("whole"), F.sum("left").alias("left")).collect()
    sizes = {r["kind"]: (r["whole"], r["left"]) for r in totals}
    starts, first = [], 0
    for kind in sorted(sizes):
        whole_total, rest_total = sizes[kind]
        starts.append((kind, first, first + whole_total, rest_total // kind))
        first += whole_total + rest_total // kind
    starts_of = F.broadcast(spark.createDataFrame(starts, "kind int, first long, shared long, filled long"))
    placed = cut.join(bases, ["kind", "worker"]).join(starts_of, "kind")
    inside = F.col("place") < F.col("whole") * F.col("kind")

    rank = F.col("rests") + F.col("place") - F.col("whole") * F.col("kind")
    rests = placed.where(~inside).withColumn("rank", rank).withColumn("bin", F.floor(F.col("rank") / F.col("kind")))
    last = F.col("bin") == F.col("filled")
    loads = [(r["kind"], r["load"]) for r in rests.where(last).groupBy("kind").agg(F.sum("length").alias("load")).collect()]
    moved = [(k, first + spot, at) for k, (spot, at) in first_fit(loads, capacity).items()]
    order = Window.partitionBy("kind", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    rests = rests.withColumn("within", F.coalesce(F.sum("length").over(order), F.lit(0)))
    rests = rests.join(F.broadcast(spark.createDataFrame(moved, "kind int, target long, shift long")), "kind", "left")

    def row(sequence: Column, offset: Column) -> list:
        own = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return [*own, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"), *(["ids"] if keep_ids else [])]

    by_worker = placed.where(inside).select(*row(F.col("first") + F.col("sequences") + F.floor(F.col("place") / F.col("kind")), F.col("at")))
    common = F.when(last, F.col("target")).otherwise(F.col("shared") + F.col("bin"))
    return by_worker.unionAll(rests.select(*row(common, F.col("within") + F.when(last, F.col("shift")).otherwise(0))))
