"""Next-fit over an ordered table: groups that are closed when the next row no longer fits.

Where a group begins depends on all rows before it. Within a range partition that dependence is a function of one
number, the load of the group that is open on entry: its load on exit, and how many groups begin in between. Every
partition works out its function for all loads by itself, the functions are composed over the partitions, one row
each, and with its load on entry known every partition numbers its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeep.operators.ordering import Order, place_rows
from rollkeep.sources.staging import staged


def entry_function(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each load on entry from 0 to ``limit``: the load on exit (at most ``limit``) and the groups that begin."""
    n, upto = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    # A group that begins with row i takes the rows before row after[i].
    after = np.searchsorted(upto, upto[:-1] + limit, side="right") - 1
    after = np.maximum(after, np.arange(n) + 1)
    begun, left = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    for i in range(n - 1, -1, -1):
        j = after[i]
        begun[i], left[i] = (1 + begun[j], left[j]) if j < n else (1, upto[n] - upto[i])
    entry = np.arange(limit + 1)
    broken = np.searchsorted(upto, limit - entry, side="right") - 1  # the first row that does not fit
    inside = broken >= n
    place = np.where(inside, n, broken)
    exits = np.where(inside, entry + upto[n], left[place])
    starts = np.where(inside, 0, begun[place])
    if n:  # nothing is open: the first row opens a group, whatever its size
        exits[0], starts[0] = left[0], begun[0] - 1
    return np.minimum(exits, limit), starts


def next_fit(df: DataFrame, order: Order, size: str, limit: int, name: str) -> DataFrame:
    """Add the number (from 0) of the group that each row falls in, in the given total order.

    A row joins the open group if the group's sizes with its own are at most ``limit``, and opens the next one if not;
    a row over the limit has a group of its own. Sizes are whole numbers from 1.
    """
    own = df.columns
    placed, parts = place_rows(df, order)
    ordered = placed.repartitionById(parts, F.col("_part")).sortWithinPartitions("_place")

    def function(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, part = [], None
        for batch in batches:
            if len(batch):
                sizes.append(batch["_size"].to_numpy(dtype=np.int64))
                part = int(batch["_part"].iloc[0])
        if part is not None:
            exits, starts = entry_function(np.concatenate(sizes), limit)
            yield pd.DataFrame([(part, exits, starts)], columns=["_part", "exits", "starts"])

    def composed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        load, groups = 0, 0
        for batch in batches:
            for part, exits, starts in zip(batch["_part"], batch["exits"], batch["starts"]):
                yield pd.DataFrame([(part, load, groups)], columns=["_p", "_load", "_groups"])
                load, groups = int(exits[load]), groups + int(starts[load])

    sizes = ordered.select("_part", F.col(size).cast("long").alias("_size"))
    functions = sizes.mapInPandas(function, "_part int, exits array<long>, starts array<long>")
    in_order = staged(functions, "next-fit").coalesce(1).sortWithinPartitions("_part")
    entries = staged(in_order.mapInPandas(composed, "_p int, _load long, _groups long"), "next-fit-entries")
    known = ordered.join(F.broadcast(entries), F.col("_part") == F.col("_p"))  # one row per partition
    known = known.sortWithinPartitions("_place").withColumn("_size", F.col(size).cast("long"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = group = None
        for batch in batches:
            if load is None and batch.num_rows:
                load, group = batch.column("_load")[0].as_py(), batch.column("_groups")[0].as_py()
            numbers = []
            for one in batch.column("_size").to_pylist():
                fits = not load or load + one <= limit
                load, group = (load + one, group) if fits else (one, group + 1)
                numbers.append(group)
            columns = [batch.column(c) for c in own]
            yield pa.record_batch([*columns, pa.array(numbers, pa.int64())], names=[*own, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return known.mapInArrow(number, f"{fields}, `{name}` long")
