"""Exact n-gram Jaccard join at three quarters, by partitions of the shingle universe.

Two sets within the similarity differ in at most a third of the smaller one's size. Sets are taken by size band; in a
band, the universe of shingles is hashed into segments, and if two sets differ in h shingles, they agree on one of any
h + 1 segments, or differ by one shingle on one of any (h + 1) / 2. Each set is indexed under the contents of its
segments, in small bands also under each content with one shingle left out, and the smaller set of a pair probes. A set
has a few segments more than it needs; once the frequency of every key is known, it gives up its most expensive probes.

Steps:
1. One pass makes each document's set: a row with the set's id, and the keys of the set. Equal sets are one class from here on.
2. Keys go out packed by bucket, and only keys that two sets share come back.
3. Frequencies allocate the probes.
4. Each key's sets are compared with two leaders, the same ones for most keys of a group of near copies; candidates
   pass a parity-bit bound and then an exact intersection. Links give components.
5. All candidates of different components that were not compared are compared in the same way (the parity bound is part of
   the join here), so that no link is lost but those inside a component, which cannot change it.
A group of near copies thus costs what its size costs, not its square.

:func:`every_link` is the full form: after step 3 it compares every candidate pair of distinct sets, also inside components,
and counts each document's links. A group of near copies costs its square there, as its links do.

Defined results: a null text or one without words has an empty set, is linked with nothing and is its own component;
repeated rows and copies share a component; a null id is kept, and counts for no component's smallest id.
Ids of sets are 64-bit hashes; a second hash is kept beside them, and a clash stops the job.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollkeep.llm.common import ddl, free, free_name, id_files, python_tasks, record_batch, split_count, split_join, table_files, texts
from rollkeep.llm.encoders import tidy
from rollkeep.llm.links import components
from rollkeep.llm.shingle_sets import bits_apart, mix, parity_bits, parity_longs, shingle_sets
from rollkeep.sources.staging import discard, scope, staged

LEAST = 3  # smaller sets are linked with equal ones only
DOUBLES_BELOW = 192  # bands up to this size index one-deletion neighbourhoods, and are half as wide
SPARE = 1.15  # segments beyond what is needed, as a factor, in bands without neighbourhoods
DEVIATIONS = 6.5  # and at least so many standard deviations of the number of segments with content
# A record is indexed as a whole content or as one with a shingle left out. A whole content probes whole ones, and those
# with a shingle left out; a content with a shingle left out probes whole ones.
INDEXED, INDEXED_LESS, MARK, PROBES, PROBES_LESS, PROBES_NEAR = 1, 2, 4, 8, 16, 32
HOT = 16  # a key that so many sets have in one flush is known to be shared: its records go to no bucket
MEMBER_FLUSH = 4096  # and members
FLUSH = 1 << 19  # records held before they are packed
WIDEST = 1024  # sets of up to this size need no more parity places than the longs have
COUNTED = 1 << 21  # places in which the keys of a flush are counted
BLOCK = 256  # sets of a key that meet as many others in one group, about, where all pairs are compared

LONG, INT, LONGS = pa.int64(), pa.int32(), pa.list_(pa.int64())
MEMBERS = pa.schema(
    [("doc_id", LONG), ("rep", LONG), ("n_shingles", LONG), ("set_id", LONG), ("proof", LONG), ("slack", INT), ("lacking", INT)]
    + [("bits", pa.binary()), ("low", LONGS), ("high", LONGS)]
)
RECORDS = pa.schema([("key", LONG), ("set_id", LONG), ("n", INT), ("flags", INT), ("slot", LONG)])
INDEXED_ROWS = pa.schema([*MEMBERS, *(f for f in RECORDS if f.name != "set_id")])  # a member, or a record if there is a key
PACKED = "bucket int, spread int, payload binary"
MEMBER_ROWS = 1 << 30  # the bucket number of a payload of members
# Key and slot (0 where a segment has only one key), set, its size and what the record is for.
RECORD = np.dtype([("key", "<u8"), ("set", "<u8"), ("n", "<i4"), ("flags", "u1"), ("slot", "u1")])
LOW = np.uint64((1 << 48) - 1)


def needed(n):
    """Most shingles by which a set of size n and a set at least as large can differ within the similarity."""
    return n // 3


def _edges() -> list[int]:
    half = [round(LEAST * 2 ** (k / 2)) for k in range(24)]
    low = [e for e in half if e < DOUBLES_BELOW]
    return low + [DOUBLES_BELOW << k for k in range(40)]


EDGES = _edges()  # sizes at which bands begin


def band_of(n: int) -> int:
    return bisect.bisect_right(EDGES, n) - 1


def upper(band: int) -> int:
    return EDGES[band + 1]


def doubles(band: int) -> bool:
    return upper(band) <= DOUBLES_BELOW


def _doubled(n: int) -> int:
    """Segments of a set of size n where agreement but for one shingle counts twice, and a third more to choose from."""
    need = (needed(n) + 2) // 2
    return need + (need + 1) // 3


@functools.cache
def segments(band: int) -> int:
    """Segments of a band's universe: enough for its largest sets."""
    top = upper(band) - 1
    if doubles(band):
        return _doubled(top)
    count = math.ceil(1.3 * upper(band) / 3) + 3
    # The smallest sets leave the most segments empty.
    while max(_span(top, count), _span(EDGES[band], count)) > count:
        count += 1
    return count


@functools.cache
def _span(n: int, count: int) -> int:
    """Segments of which enough have content, but for one set in about ten thousand million."""
    load = n / count
    empty = math.exp(-load)
    used = math.ceil(SPARE * (needed(n) + 1) / (1 - empty)) + 2
    while True:
        spread = math.sqrt(max(1.0, used * empty * (1 - empty) - used * used / count * load * empty * empty))
        wanted = math.ceil((needed(n) + 1 + DEVIATIONS * spread) / (1 - empty))
        if used >= wanted:
            return used
        used = wanted


def span(n: int, band: int) -> int:
    """How many of a band's segments, from the first, a set of size n uses; no fewer for a larger set."""
    if n >= upper(band):
        return segments(band)
    if doubles(band):
        return _doubled(n)
    return min(segments(band), _span(n, segments(band)))


def set_id(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent hashes of a set."""
    size = np.uint64(len(shingles))
    with np.errstate(over="ignore"):
        one = mix(np.array([mix(shingles).sum(dtype=np.uint64) + size], dtype=np.uint64))
        two = mix(np.array([mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + size], dtype=np.uint64))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


def _segment_sums(shingles: np.ndarray, band: int, used: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments with shingles, their sums, and the place of each shingle's segment among them (-1 beyond ``used``)."""
    # The high bits choose the segment, so sorted shingles are in the segments' order.
    of = ((shingles >> np.uint64(32)) * np.uint64(segments(band))) >> np.uint64(32)
    inside = int(np.searchsorted(of, used))
    of = of[:inside].astype(np.int64)
    if not inside:
        return np.empty(0, np.int64), np.empty(0, np.uint64), of
    start = np.flatnonzero(np.diff(of, prepend=-1))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mix(shingles[:inside]), start)
    return of[start], sums, np.cumsum(np.diff(of, prepend=of[0]) > 0)


def slack_of(shingles: np.ndarray) -> tuple[int, int]:
    """What a set may give up when it probes; and its band if it lacks as many segments with content as it needs, or -1.

    Probing a segment for agreement counts one, for agreement but for one shingle two; what is needed is one more than
    the most that two sets can differ by.
    """
    n = len(shingles)
    if n < LEAST:
        return 0, -1
    band = band_of(n)
    used = span(n, band)
    if doubles(band):
        return 2 * used - needed(n) - 1, -1
    there = len(_segment_sums(shingles, band, used)[0])
    return there - needed(n) - 1, band if there < needed(n) + 1 else -1


def records(shingles: np.ndarray, identity: int, lacking: frozenset[int], empty_only: bool = False) -> list[np.ndarray]:
    """All keys of one set: in its own band, and as a larger partner in the band below.

    In bands of ``lacking`` segments without content have keys too; ``empty_only``: no other keys.
    """
    n = len(shingles)
    if n < LEAST:
        return []
    own = band_of(n)
    bands = [own] + [b for b in range(own) if n <= (upper(b) - 1) * 4 // 3]
    out = []
    for band in bands:
        if empty_only and band not in lacking:
            continue
        probes = band == own
        whole = INDEXED | (PROBES | PROBES_NEAR * doubles(band)) * probes
        used = span(n, band)
        slots, sums, place = _segment_sums(shingles, band, used)
        rows = [] if empty_only else [(slots, sums, whole)]
        if doubles(band) and len(place) and not empty_only:
            with np.errstate(over="ignore"):
                less = sums[place] - mix(shingles[: len(place)])
            rows.append((slots[place], less, INDEXED_LESS | PROBES_LESS * probes))
        if doubles(band) or band in lacking:
            empty = np.setdiff1d(np.arange(used), slots)
            wants = doubles(band) or len(slots) < needed(n) + 1
            rows.append((empty, np.zeros(len(empty), np.uint64), whole if wants else INDEXED))
        for slot, content, flags in rows:
            record = np.empty(len(slot), dtype=RECORD)
            with np.errstate(over="ignore"):
                record["key"] = mix(content + mix(slot.astype(np.uint64) + np.uint64((band + 1) << 40)))
            record["set"], record["n"], record["flags"] = np.uint64(identity & (2**64 - 1)), n, flags
            record["slot"] = slot + 1 if doubles(band) else 0
            out.append(record)
    return out


def _member(doc_id: int | None, rep: int, shingles: np.ndarray, identity: tuple[int, int]) -> tuple:
    """A row of ``MEMBERS``: the set's size, two hashes of it, its spare segments and its parity bits."""
    bits = parity_bits(shingles) if len(shingles) > WIDEST else None  # parity over 1024 places says as much of a smaller one
    return (doc_id, rep, len(shingles), *identity, *slack_of(shingles), bits, *parity_longs(shingles))


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rep", F.xxhash64("doc_id", "text"))


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records by key, and where each key begins."""
    rows = rows[np.argsort(rows["key"], kind="stable")]
    return rows, np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))


def _payload(part: np.ndarray) -> bytes:
    """Records in runs of one set: the sets with their sizes and numbers of records, then 48 bits of each key, flags and slots."""
    first = np.flatnonzero(np.concatenate([[True], part["set"][1:] != part["set"][:-1]]))
    heads = np.array([len(first), len(part)], dtype="<u4").tobytes()
    counts = np.diff(first, append=len(part)).astype("<u4").tobytes()
    low = np.ascontiguousarray(part["key"]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    sets, sizes = part["set"][first].tobytes(), part["n"][first].tobytes()
    return b"".join([heads, sets, sizes, counts, low, part["flags"].tobytes(), part["slot"].tobytes()])


def _unpacked(payload: bytes) -> np.ndarray:
    n_sets, n = map(int, np.frombuffer(payload, "<u4", 2))
    at = 8

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, count, at)
        at += out.nbytes
        return out

    sets, sizes, counts = take("<u8", n_sets), take("<i4", n_sets), take("<u4", n_sets)
    low, flags, slots = take("u1", 6 * n).reshape(-1, 6), take("u1", n), take("u1", n)
    key = np.zeros((n, 8), dtype=np.uint8)
    key[:, :6] = low
    rows = np.empty(n, dtype=RECORD)
    rows["key"] = key.view("<u8").ravel()
    rows["set"], rows["n"] = np.repeat(sets, counts), np.repeat(sizes, counts)
    rows["slot"], rows["flags"] = slots, flags
    return rows


def _packed(rows: np.ndarray, buckets: int, turn: int) -> pd.DataFrame:
    """One binary per bucket (from the keys' high bits), and some of the records of hot keys, which may go anywhere.

    Keys are counted by their low bits in a table of fixed size; a key that shares its place with others and is taken for
    hot by mistake costs the exchange of its records, no more. Records stay in the order of their sets.
    """
    keys = np.ascontiguousarray(rows["key"])
    place = (keys & np.uint64(COUNTED - 1)).astype(np.int64)
    hot = (np.bincount(place, minlength=COUNTED) >= HOT)[place]
    first = np.unique(keys[hot], return_index=True)[1]
    marks = rows[hot][first]
    marks["flags"] = MARK
    cold = np.concatenate([rows[~hot], marks]) if len(first) else rows
    out = _dealt(cold, buckets, lambda b: (b, b))
    for k, part in enumerate(np.array_split(rows[hot], -(-int(hot.sum()) // 65536)) if len(first) else []):
        out += _dealt(part, buckets, lambda b: (-1 - b, (turn * 31 + k * 7 + b) % buckets))  # noqa: B023
    return pd.DataFrame(out, columns=["bucket", "spread", "payload"])


def _dealt(rows: np.ndarray, buckets: int, named: Callable[[int], tuple[int, int]]) -> list[tuple[int, int, bytes]]:
    """(bucket, partition, payload) for each bucket that has records."""
    bucket = _bucket(rows["key"], buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    return [(*named(int(bucket[a])), _payload(rows[a:b])) for a, b in zip(edges, [*edges[1:], len(rows)])]


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)).astype(np.int64)


def _rows(rows: np.ndarray, bucket: int) -> pa.RecordBatch:
    """Records as rows; a bucket's number makes its 48-bit keys distinct from those of others."""
    with np.errstate(over="ignore"):
        key = mix((rows["key"] & LOW) + mix(np.array([bucket], dtype=np.uint64))).view(np.int64)
    slot = np.where(rows["slot"] == 0, key, rows["slot"].astype(np.int64))
    sets = np.ascontiguousarray(rows["set"]).view(np.int64)
    return _wide({"key": key, "set_id": sets, "n": rows["n"], "flags": rows["flags"].astype(np.int32), "slot": slot}, len(key))


def _wide(columns: dict, rows: int) -> pa.RecordBatch:
    """A batch of ``INDEXED_ROWS`` with nulls in the columns that are not given."""
    arrays = [pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(rows, f.type) for f in INDEXED_ROWS]
    return pa.record_batch(arrays, schema=INDEXED_ROWS)


def indexed_rows(rows: DataFrame, lacking: frozenset[int] = frozenset(), empty_only: bool = False) -> DataFrame:
    """In one pass over the texts, the members and the records of all keys that two sets or more have, one of them as a probe.

    Copies met by two tasks may be repeated among the records. Members go through the records' exchange, as payloads.
    """
    python_tasks(rows.sparkSession, 256)
    buckets = min(1 << 20, split_count(rows, 8 << 20))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, done, turn, known = [], 0, set(), TaskContext.get().partitionId(), []

        def sent() -> Iterator[pd.DataFrame]:
            if size:
                yield _packed(np.concatenate(held), buckets, turn)
            if known:
                data = record_batch(known, MEMBERS)
                payload = pa.ipc.new_stream(sink := pa.BufferOutputStream(), MEMBERS)
                payload.write_batch(data)
                payload.close()
                yield pd.DataFrame([(MEMBER_ROWS, turn % buckets, sink.getvalue().to_pybytes())], columns=["bucket", "spread", "payload"])

        for batch in batches:
            # Ids go as text: pandas would make floats of a column that also holds nulls.
            for key, rep, found in zip(batch["doc_id"], batch["rep"], shingle_sets(list(batch["text"]))):
                identity = set_id(found)
                if not empty_only:
                    known.append(_member(None if key is None else int(key), int(rep), found, identity))
                if identity[0] not in done:  # else a copy that this flush has met
                    done.add(identity[0])
                    new = records(found, identity[0], lacking, empty_only)
                    held += new
                    size += sum(map(len, new))
                if size >= FLUSH or len(known) >= MEMBER_FLUSH:
                    yield from sent()
                    held, size, done, turn, known = [], 0, set(), turn + 1, []
        yield from sent()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "payload"))):
                if bucket == MEMBER_ROWS:
                    for data in pa.ipc.open_stream(payload):
                        yield _wide(dict(zip(data.schema.names, data.columns)), data.num_rows)
                elif bucket < 0:
                    yield _rows(_unpacked(payload), -1 - bucket)
                else:
                    payloads.setdefault(bucket, []).append(payload)
        for bucket in list(payloads):
            found, start = _sorted(np.concatenate([_unpacked(p) for p in payloads.pop(bucket)]))
            counts = np.diff(start, append=len(found))
            several = np.minimum.reduceat(found["set"], start) != np.maximum.reduceat(found["set"], start)
            several &= np.bitwise_or.reduceat(found["flags"], start) >= PROBES
            marked = np.bitwise_or.reduceat(found["flags"], start) & MARK > 0
            found = found[np.repeat(several | marked, counts)]
            yield _rows(found[found["flags"] & MARK == 0], bucket)

    named = _named(rows).withColumn("doc_id", F.col("doc_id").cast("string"))
    packed = named.mapInPandas(tidy(pack), PACKED)
    return packed.repartitionById(buckets, F.col("spread")).mapInArrow(tidy(keep), ddl(INDEXED_ROWS))


def allocated(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """The records without the probes that their sets can give up, the most expensive first.

    Giving up the neighbourhood of a segment saves the records that its whole content and its contents with a shingle
    left out would meet; giving up the segment saves those that hold the same content. The second comes after the first.
    """
    shared = shared.distinct()
    has = lambda bit: F.col("flags").bitwiseAND(F.lit(bit)) > 0
    frequent = shared.groupBy("key").agg(F.count_if(has(INDEXED)).alias("same"), F.count_if(has(INDEXED_LESS)).alias("less"))
    probing = split_join(shared.where(f"flags >= {PROBES}"), frequent, ["key"])
    near = F.when(has(PROBES_LESS), F.col("same")).when(has(PROBES_NEAR), F.col("less")).otherwise(F.lit(0))
    slots = probing.groupBy("set_id", "slot").agg(
        F.sum(near).alias("first"), F.sum(F.when(has(PROBES), F.col("same")).otherwise(0)).alias("second"), F.max(has(PROBES_NEAR | PROBES_LESS)).alias("double")
    )
    first = F.greatest(F.col("first").cast("double"), (F.col("first") + F.col("second")) / 2)
    second = F.least(F.col("second").cast("double"), (F.col("first") + F.col("second")) / 2)
    both = F.array(F.struct(F.lit(0).alias("turn"), first.alias("cost")), F.struct(F.lit(1).alias("turn"), second.alias("cost")))
    only = F.array(F.struct(F.lit(1).alias("turn"), F.col("second").cast("double").alias("cost")))
    units = slots.select("set_id", "slot", F.explode(F.when(F.col("double"), both).otherwise(only)).alias("unit"))
    order = Window.partitionBy("set_id").orderBy(F.desc("unit.cost"), "slot", "unit.turn")
    ranked = units.withColumn("place", F.row_number().over(order)).join(classes.select("set_id", "slack"), "set_id")
    spared = ranked.where("place <= slack").groupBy("set_id", "slot").agg(F.max("unit.turn").alias("upto"))
    marked = shared.join(spared, ["set_id", "slot"], "left")
    keep = F.when(F.col("upto").isNull(), 255).when(F.col("upto") == 0, 255 - PROBES_LESS - PROBES_NEAR).otherwise(INDEXED | INDEXED_LESS)
    return marked.select("key", "set_id", "n", F.col("flags").bitwiseAND(keep).alias("flags"))


PARITY = [f"{half}{k}" for half in ("l", "h") for k in range(8)]


def _parities(classes: DataFrame) -> DataFrame:
    """``set_id`` and the parity longs as columns of their own; those of the upper half are null for small sets."""
    low, high = ([F.get(F.col(half), F.lit(k)).alias(f"{half[0]}{k}") for k in range(8)] for half in ("low", "high"))
    return classes.select("set_id", *low, *high)


def _near_sql() -> str:
    """Whether the parities of p and i leave the similarity possible, the cheapest tests first; part of the joins, so that no
    other pair comes out."""

    def apart(*columns: str) -> str:
        return " + ".join("bit_count(" + " ^ ".join(f"{side}.{c}" for side in "pi" for c in x.split()) + ")" for x in columns)

    lower, upper = [f"l{k}" for k in range(8)], [f"h{k}" for k in range(8)]
    both = apart(*upper, *[f"l{k} h{k}" for k in range(8)])
    tests = [f"7 * ({apart(*lower[:3])}) <= p.n + i.n", f"7 * ({apart(*lower)}) <= p.n + i.n"]
    return " and ".join([*tests, f"(p.h0 is null or i.h0 is null or 7 * ({both}) <= p.n + i.n)"])


def _exact(pairs: DataFrame, docs: DataFrame, classes: DataFrame, label: str, files: int | None) -> DataFrame:
    """The pairs (a, b) of sets that are links, staged: first by parity bits, then by the intersection of their shingles."""
    half = F.struct(F.col("n_shingles").alias("n"), *PARITY)
    sides = _parities(classes).join(classes.select("set_id", "bits", "n_shingles"), "set_id")
    one = sides.select(F.col("set_id").alias("a"), half.alias("p"), F.col("bits").alias("x"))
    two = sides.select(F.col("set_id").alias("b"), half.alias("i"), F.col("bits").alias("y"))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Apart by d, sets of sizes n and m have (n + m - d) / 2 in common. Only large sets have bits of their own.
            apart = [0 if x is None or y is None else bits_apart(x, y) for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[7 * np.array(apart, dtype=np.int64) <= (batch["n"] + batch["m"]).to_numpy(), ["a", "b"]]

    likely = split_join(split_join(pairs, one, ["a"]), two, ["b"]).where(F.expr(_near_sql())).select("a", "b", "x", "y", F.col("p.n").alias("n"), F.col("i.n").alias("m"))
    close = staged(likely.mapInPandas(tidy(near), "a long, b long"), "close", files)
    wanted = close.select(F.col("a").alias("set_id")).union(close.select("b")).distinct()
    chosen = staged(wanted.join(classes.select("set_id", "rep"), "set_id"), "wanted", id_files(docs))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(list(batch["text"]))]
            yield pd.DataFrame({"set_id": batch["set_id"], "shingles": sets})

    held = _named(docs).join(chosen.hint("shuffle_hash"), "rep").select("set_id", "text")
    texts_of = staged(held.mapInPandas(tidy(expand), "set_id long, shingles binary"), "sets", files)
    sets = texts_of.dropDuplicates(["set_id"])

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["x"], batch["y"]):
                s, t = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * common >= 75 * (len(s) + len(t) - common):
                    rows.append((a, b))
            yield pd.DataFrame(rows, columns=["a", "b"])

    left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    links = staged(close.join(left, "a").join(right, "b").mapInPandas(tidy(link), "a long, b long"), label, files)
    discard(close, chosen, texts_of)
    return links


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _indexed(docs: DataFrame, key: str, text: str, files: int | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Steps 1 to 3: the rows, their sets, one row per distinct set, and the allocated records."""
    rows, spark = texts(docs, key, text), docs.sparkSession
    one = staged(indexed_rows(rows), "indexed", files)
    found = one.where("key is null").select(*MEMBERS.names)
    proofs = F.when(F.min("proof") != F.max("proof"), F.raise_error(F.lit("two sets have one id"))).otherwise(F.first("n_shingles"))
    classes = found.where("n_shingles > 0").groupBy("set_id").agg(
        proofs.alias("n_shingles"), F.first("slack").alias("slack"), F.max("lacking").alias("lacking"), F.first("bits").alias("bits"),
        F.first("low").alias("low"), F.first("high").alias("high"), F.count("*").alias("copies"),
        F.min("rep").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rep")).alias("least"),
    )
    classes = staged(classes, "classes", files)
    found = staged(found.select("doc_id", "rep", "n_shingles", "set_id"), "members", files)
    lacking = frozenset(r["lacking"] for r in classes.where("lacking >= 0").select("lacking").distinct().collect())  # bands

    parts = [one]
    if lacking:  # very rare: their segments without content become keys too
        parts.append(staged(indexed_rows(rows, lacking, empty_only=True), "empty-segments", files))
    shared = reduce(DataFrame.union, [part.where("key is not null").select(*RECORDS.names) for part in parts])
    free(spark)
    kept = staged(allocated(shared, classes), "allocated", files)
    discard(*parts)
    free(spark)
    return rows, found, classes, kept


def _meeting() -> str:
    """Whether records p and i make their sets a candidate pair, with p as the smaller set."""
    meet = [(PROBES, INDEXED), (PROBES_NEAR, INDEXED_LESS), (PROBES_LESS, INDEXED)]
    kinds = " or ".join(f"(p.flags & {asks} > 0 and i.flags & {holds} > 0)" for asks, holds in meet)
    return f"p.key = i.key and p.n <= i.n and 3 * i.n <= 4 * p.n and ({kinds}) and {_near_sql()}"


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``members`` (doc_id, n_shingles, set_id, component_id, rep, kept) and the ``links`` (a, b) found between sets.

    ``rep`` is a hash of the id and the text; ``kept`` marks the row with the smallest id of each component. The links are
    those that give the components; :func:`every_link` finds all. Only these two tables are left on disk.
    """
    spark, files, few = docs.sparkSession, table_files(docs), id_files(docs)
    with scope(spark) as own:
        rows, found, classes, kept = _indexed(docs, key, text, files)
        by_key = kept.groupBy("key").agg(
            F.max("flags").alias("most"), *[F.min_by("set_id", F.xxhash64("set_id", F.lit(seed))).alias(f"leader{seed}") for seed in (1, 2)]
        )
        led = split_join(kept, by_key.where(f"most >= {PROBES}"), ["key"])
        stars = led.select("set_id", F.explode(F.array("leader1", "leader2")).alias("leader")).where("set_id <> leader")
        tried = staged(stars.select(*_ordered("set_id", "leader")).distinct(), "tried", few)
        first = _exact(tried, rows, classes, "star-links", files)
        roots = components(first)

        placed = kept.join(roots, kept["set_id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "set_id")).drop("node")
        mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("flags").alias("most"))
        mixed = mixed.where(f"lo <> hi and most >= {PROBES}").select("key")
        some = split_join(placed, mixed, ["key"], "left_semi").select("key", "set_id", "n", "flags", "root")
        left = staged(some.join(_parities(classes), "set_id"), "mixed", files)
        discard(kept)
        free(spark)
        p, i = left.where(f"flags >= {PROBES}").alias("p"), left.alias("i")
        match = f"p.root <> i.root and {_meeting()}"
        rest = staged(p.join(i, F.expr(match)).select(*_ordered("p.set_id", "i.set_id")).distinct().join(tried, ["a", "b"], "left_anti"), "rest", few)
        discard(left, tried)
        free(spark)
        links = own.keep(first.union(_exact(rest, rows, classes, "rest-links", files)), "links", few)
        return own.keep(_placed(found, classes, links, few), "placed", few), links


def _placed(found: DataFrame, classes: DataFrame, links: DataFrame, files: int | None) -> DataFrame:
    """The rows with the component that the links put them in."""
    roots = components(links)
    named = classes.select("set_id", "least").join(roots, F.col("set_id") == F.col("node"), "left")
    named = named.withColumn("root", F.coalesce("root", "set_id"))
    smallest = named.groupBy("root").agg(F.min("least").alias("first"))
    joined = found.join(staged(split_join(named, smallest, ["root"]).select("set_id", "first"), "firsts", files), "set_id", "left")
    empty = F.col("n_shingles") == 0
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("rep") == F.col("first.rep"))
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("first.doc_id"))
    return joined.select("doc_id", "n_shingles", "set_id", component.alias("component_id"), "rep", (empty | chosen).alias("kept"))


def every_link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``members`` as :func:`join` gives them, with ``n_links``, and all ``links`` (a, b) between distinct sets, a < b.

    ``n_links`` is the number of other rows whose set is similar: the row's copies and those of each linked set. A row
    without words has none.
    """
    files = table_files(docs)
    with scope(docs.sparkSession) as own:
        rows, found, classes, kept = _indexed(docs, key, text, files)
        held = kept.groupBy("key").agg(F.count_if(F.col("flags") >= PROBES).alias("asking"), F.count("*").alias("held"))
        held = held.where("asking > 0 and held > 1")
        parts = lambda count: F.ceil(F.col(count) / BLOCK).cast("int")
        held = held.select("key", parts("asking").alias("rows_p"), parts("held").alias("rows_i"))
        left = staged(split_join(kept, held, ["key"]).join(_parities(classes), "set_id"), "candidates", files)
        discard(kept)
        free(docs.sparkSession)

        # The sets of a key are cut in parts; each part that probes meets each part that is indexed in a group of its own.
        def cut(count: str, seed: int) -> Column:
            return F.pmod(F.xxhash64("set_id", F.lit(seed)), F.col(count)).cast("int")

        def every(count: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

        p = left.where(f"flags >= {PROBES}").withColumn("part_p", cut("rows_p", 1)).withColumn("part_i", every("rows_i")).alias("p")
        i = left.withColumn("part_i", cut("rows_i", 2)).withColumn("part_p", every("rows_p")).alias("i")
        # Of two sets of one size each probes for the other, so one of the two is enough.
        once = "(p.n < i.n or p.set_id < i.set_id) and p.set_id <> i.set_id"
        match = f"p.part_p = i.part_p and p.part_i = i.part_i and {once} and {_meeting()}"
        pairs = staged(p.join(i, F.expr(match)).select(*_ordered("p.set_id", "i.set_id")).distinct(), "pairs", files)
        discard(left)
        links = own.keep(_exact(pairs, rows, classes, "every-link", files), "links", files)

        copies = classes.select("set_id", "copies")
        both = links.select(F.col("a").alias("of"), F.col("b").alias("set_id")).unionAll(links.select("b", "a"))
        linked = split_join(both, copies, ["set_id"]).groupBy("of").agg(F.sum("copies").alias("linked"))
        counted = copies.join(linked, F.col("set_id") == F.col("of"), "left")
        counted = staged(counted.select("set_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "counted", files)
        n_links = F.when(F.col("n_shingles") == 0, F.lit(0)).otherwise(F.col("n_links")).cast("long")
        placed = _placed(found, classes, links, files).join(counted, "set_id", "left").withColumn("n_links", n_links)
        return own.keep(placed, "placed", files), links


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id; the columns stay."""
    kept = join(docs, key, text)[0].where("kept").select(F.col("doc_id").alias("kept_id"), F.col("rep").alias("kept_rep")).distinct()
    rep = free_name(docs, "rep")
    named = docs.withColumn(rep, F.xxhash64(F.col(key).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))))
    same = F.col(key).cast("long").eqNullSafe(F.col("kept_id")) & (F.col(rep) == F.col("kept_rep"))
    return named.join(kept.hint("shuffle_hash"), same, "left_semi").dropDuplicates([key, rep]).drop(rep)
