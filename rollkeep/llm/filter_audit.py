"""Audit of how filters interact: what each removes first, again, alone, and on average over all orders.

1. One pass over the texts gives a row of facts per document: the filters that judge a text by itself, as a mask, a 64-bit
   hash and the digest of the whole text. Texts do not move after that.
2. Every task counts hashes in a counting Bloom filter, in slices of the hashes, and sends what it counted, by slice;
   merged slices hold for each counter whether it is none, one or more. A text with a counter below two is unique for sure.
3. Only the other rows, the possible repeats, are exchanged by the digest of their full texts, for the smallest id of each text.
4. Their flag joins the mask, the labels join by id, and (part, mask) is counted. Every figure of every order is a sum of
   those counts: masks without an earlier filter's bit, and so on.

A slice has a fixed number of texts, so the number of slices grows with the table and each stays a few megabytes. Rows meet
their slice in groups of a fixed number of rows, cut by row number: a text with a third of all rows is spread over all
groups of its slice, and is one entry of a task's counts.

Defined results: a null text is empty, a null part is the empty string; a null id is no smaller id of any text, and fails no
duplicate test and has no label; rows with one id and text are not smaller than each other; several labels of one id count as one that has the
value if any has it; an empty table gives no row.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeep.llm.common import BLANKS, GAP, python_tasks
from rollkeep.operators import joins
from rollkeep.sources.staging import staged

FILTERS = "ABCDE"  # E, the duplicate test, is the only one that looks beyond its row
DUPLICATE = 1 << FILTERS.index("E")
PARTIAL = "slice int, once binary, more binary"
SLICE = "slice int, n_counters int, once binary, more binary"


@dataclass(frozen=True)
class Sketch:
    """Texts per slice, counters per text, counters that a text raises, rows per group that is tested together."""

    slice_texts: int = 1 << 20
    counters: int = 8
    hashes: int = 3
    group_rows: int = 1 << 18
    flush: int = 1 << 20


def own_filters(text: Column) -> Column:
    """Mask of the filters A to D that a text fails."""
    inside = F.btrim(text, F.lit(BLANKS))
    words = F.when(inside == "", F.array().cast("array<string>")).otherwise(F.split(inside, GAP))
    # The words are made once: transform over a one-element array binds them to a name.
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(w)).alias("distinct")))[0]
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    tests = F.transform(
        F.array(counts),
        lambda n: F.when(n["all"] < 50, 1).otherwise(0) + F.when(100 * n["distinct"] < 65 * n["all"], 2).otherwise(0),
    )[0]
    return tests + F.when(100 * capitals > 5 * F.length(text), 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)


def facts(docs: DataFrame, part: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``part``, ``mask``, ``hash``, ``digest`` and a number for every row."""
    filled = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), filled(text).alias("text"), filled(part).alias("part"))
    return staged(
        rows.select(
            "doc_id", "part", own_filters(F.col("text")).cast("int").alias("mask"), F.xxhash64("text").alias("hash"),
            F.unhex(F.sha2("text", 256)).alias("digest"), F.monotonically_increasing_id().alias("row"),
        ),
        "facts",
    )


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def slices_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return ((_mixed(hashes, 1) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)


def places_of(hashes: np.ndarray, counters: int, count: int) -> np.ndarray:
    """``count`` counters of each hash, one column each."""
    one, two = _mixed(hashes, 2), _mixed(hashes, 3) | np.uint64(1)
    with np.errstate(over="ignore"):
        steps = [one + np.uint64(k) * two for k in range(count)]
    return np.stack([(s >> np.uint64(32)) * np.uint64(counters) >> np.uint64(32) for s in steps], axis=1).astype(np.int64)


def partial_counts(hashes: np.ndarray, slices: int, counters: int, count: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Per slice the counters that were raised once, and those raised more often, as places."""
    of, places = slices_of(hashes, slices), places_of(hashes, counters, count)
    places.sort(axis=1)
    first = np.ones(places.shape, dtype=bool)  # a text raises a counter once, though two of its places may be the same
    first[:, 1:] = places[:, 1:] != places[:, :-1]
    found, times = np.unique((of[:, None] * counters + places)[first], return_counts=True)
    edges = np.searchsorted(found, np.arange(slices + 1) * counters) if slices < len(found) else None
    which = range(slices) if edges is not None else np.unique(of)
    for k in map(int, which):
        a, b = (edges[k], edges[k + 1]) if edges is not None else np.searchsorted(found, [k * counters, (k + 1) * counters])
        if a < b:
            own, often = (found[a:b] - k * counters).astype("<u4"), times[a:b] > 1
            yield k, own[~often].tobytes(), own[often].tobytes()


def sketch(rows: DataFrame, slices: int, counters: int, rule: Sketch) -> DataFrame:
    """The merged counting Bloom filter, one row per slice: bits of counters above none and above one."""
    python_tasks(rows.sparkSession, 1 << 16)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def sent(held: list[np.ndarray]) -> pd.DataFrame:
            found = partial_counts(np.concatenate(held), slices, counters, rule.hashes)
            return pd.DataFrame(found, columns=["slice", "once", "more"])

        held, size = [], 0
        for batch in batches:
            held.append(batch["hash"].to_numpy().view(np.uint64))
            size += len(batch)
            if size >= rule.flush:
                yield sent(held)
                held, size = [], 0
        if size:
            yield sent(held)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, values = None, np.empty(0, dtype=np.uint8)

        def made() -> pd.DataFrame:
            bits = [np.packbits(values >= k).tobytes() for k in (1, 2)]
            return pd.DataFrame([(now, counters, *bits)], columns=["slice", "n_counters", "once", "more"])

        for batch in batches:
            for k, once, more in batch.itertuples(index=False, name=None):
                if k != now:
                    if now is not None:
                        yield made()
                    now, values = k, np.zeros(counters, dtype=np.uint8)
                places = np.frombuffer(once, dtype="<u4")
                values[places] = np.minimum(values[places] + 1, 2)
                values[np.frombuffer(more, dtype="<u4")] = 2
        if now is not None:
            yield made()

    partial = rows.select("hash").mapInPandas(count, PARTIAL)
    merged = partial.repartition("slice").sortWithinPartitions("slice").mapInPandas(merge, SLICE)
    return staged(merged, "sketch")


TESTED = "doc_id long, part string, mask int, digest binary"
FACTS = ["doc_id", "part", "mask", "hash", "digest"]


def tested(rows: DataFrame, rule: Sketch) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of all rows, and the ``digest`` of those whose text may be repeated."""
    spark = rows.sparkSession
    n = rows.count()
    slices = max(1, -(-n // rule.slice_texts))
    counters = max(1024, rule.counters * -(-n // slices))
    merged = sketch(rows, slices, counters, rule)
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rule.group_rows))
    each = max(1, -(-groups // slices))  # groups of a slice
    python_tasks(spark, 1 << 13)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = slices_of(batch.column("hash").to_numpy().view(np.uint64), slices)
            row = _mixed(batch.column("row").to_numpy().view(np.uint64), 4)
            cell = (of * each + (row >> np.uint64(32)).astype(np.int64) % each).astype(np.int32)
            yield pa.record_batch([*(batch.column(c) for c in FACTS), pa.array(cell)], names=[*FACTS, "cell"])

    kept = rows.mapInArrow(numbered, "doc_id long, part string, mask int, hash long, digest binary, cell int")
    cells = F.explode(F.sequence(F.col("slice") * each, F.col("slice") * each + (each - 1)))
    first = merged.select(cells.alias("cell"), F.lit(0).alias("tag"), "more", *[F.lit(None).alias(c) for c in FACTS])
    after = kept.select("cell", F.lit(1).alias("tag"), F.lit(None).cast("binary").alias("more"), *FACTS)
    both = first.unionByName(after).repartitionById(slices * each, F.col("cell")).sortWithinPartitions("cell", "tag")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, more = None, np.empty(0, dtype=np.uint8)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            heads = np.flatnonzero(batch.column("tag").to_numpy() == 0)
            for a, b in zip([0, *heads], [*heads, batch.num_rows]):
                if b > a and a in heads:  # a slice comes before its rows
                    now, more = cells[a], np.frombuffer(batch.column("more")[int(a)].as_py(), dtype=np.uint8)
                    a += 1
                if b <= a:
                    continue
                if (cells[a:b] != now).any():
                    raise ValueError("rows without a slice of the sketch")
                part = batch.slice(a, b - a)
                places = places_of(part.column("hash").to_numpy().view(np.uint64), counters, rule.hashes)
                repeated = ((more[places >> 3] >> (7 - (places & 7))) & 1).all(axis=1)
                digest = pc.if_else(pa.array(repeated), part.column("digest"), pa.scalar(None, pa.binary()))
                yield pa.record_batch([*(part.column(c) for c in ("doc_id", "part", "mask")), digest], names=["doc_id", "part", "mask", "digest"])

    return staged(both.mapInArrow(test, TESTED), "tested")


def masks(docs: DataFrame, part: str, rule: Sketch | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``part`` and the mask of all five filters, one row per row."""
    found = tested(facts(docs, part, key, text), rule or Sketch())
    possible = found.where("digest is not null")
    least = staged(possible.groupBy("digest").agg(F.min("doc_id").alias("least")).where("least is not null"), "least-ids")
    joined = possible.join(least.hint("shuffle_hash"), "digest", "left")
    failed = F.when(F.col("doc_id") > F.col("least"), F.lit(DUPLICATE)).otherwise(0)
    flagged = joined.select("doc_id", "part", (F.col("mask") + failed).alias("mask"))
    return found.where("digest is null").select("doc_id", "part", "mask").unionByName(flagged)


def mask_counts(masked: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``part``, ``mask``, and the rows, good rows and toxic rows with them."""
    said = lambda name: F.coalesce(F.max((F.col(name) == 1).cast("int")), F.lit(0))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id")).agg(said(quality).alias("good"), said(toxic).alias("toxic"))
    joined = joins.left(masked, known, ["doc_id"], hot=True)
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long")
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), total("good").alias("good"), total("toxic").alias("toxic"))


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, mask of the earlier filters, bit of this one) for all orders."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        name = "".join(FILTERS[k] for k in order)
        out += [(name, step + 1, sum(1 << j for j in order[:step]), 1 << k) for step, k in enumerate(order)]
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley."""
    spark = counts.sparkSession
    every = orders()
    # Most figures depend on the set of earlier filters and the filter only: 80 of these instead of 600 steps.
    pairs = sorted({(before, bit) for _, _, before, bit in every})
    literal = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(bit).alias("bit")) for before, bit in pairs])
    wide = counts.withColumn("pair", F.explode(literal)).select("part", "mask", "n", "good", "toxic", "pair.before", "pair.bit")
    hit = lambda column: F.col("mask").bitwiseAND(F.col(column)) != 0
    # Of all orders of its failed filters, each is first in an equal share of them.
    share = F.lit(math.factorial(len(FILTERS))) / F.bit_count("mask")
    figures = {
        "kept": (~hit("before") & ~hit("bit"), F.col("n")),
        "removed": (~hit("before") & hit("bit"), F.col("n")),
        "redundant": (hit("before") & hit("bit"), F.col("n")),
        "unique_fails": (F.col("mask") == F.col("bit"), F.col("n")),
        "good_lost": (~hit("before") & hit("bit"), F.col("good")),
        "toxic_lost": (~hit("before") & hit("bit"), F.col("toxic")),
        "shapley": (hit("bit"), F.col("n") * share.cast("long")),
    }
    sums = [F.sum(F.when(test, value).otherwise(0)).cast("long").alias(name) for name, (test, value) in figures.items()]
    summed = wide.groupBy("part", "before", "bit").agg(*sums)
    steps = spark.createDataFrame(every, "filter_order string, step int, before int, bit int")  # 600 rows
    joined = summed.join(F.broadcast(steps), ["before", "bit"])
    return joined.select("part", "filter_order", "step", *figures)


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", rule: Sketch | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All figures of all orders of the filters for every part of the documents."""
    return interactions(staged(mask_counts(masks(docs, part, rule, key, text), labels, key), "mask-counts"))
