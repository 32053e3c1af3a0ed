"""Token counts with a digest cache.

Counts are stored under two digests: of the text as the tokenizer sees it (white space squeezed, for a tokenizer that
drops it) and of the tokenizer's version. A run joins all rows to the stored counts, encodes one text of each missing
digest, appends those counts, and joins again. A group of copies is one digest; its rows meet their count in a join
that adaptive execution may split. Two runs that append the same digest are harmless: the reader takes one.

Defined results: a null text is empty and has no token; repeated rows give repeated results; a null id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.llm.common import BLANKS, GAP, exists, hex_sha256, python_tasks, split_join, texts
from rollkeep.llm.encoders import version, word_counter

DONE = 1 << 16  # digests that a task remembers
STORED = "digest binary, version string, n_tokens long"


def stored_counts(spark: SparkSession, cache_dir: str, tokenizer: str) -> DataFrame:
    table = spark.read.schema(STORED).parquet(cache_dir) if exists(spark, cache_dir) else spark.createDataFrame([], STORED)
    return table.where(F.col("version") == version(tokenizer)).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, cache_dir: str, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. New counts go to ``cache_dir``."""
    spark = docs.sparkSession
    python_tasks(spark)
    seen = F.btrim(F.regexp_replace("text", GAP, " "), F.lit(BLANKS)) if tokenizer.endswith(".json") else F.col("text")
    rows = texts(docs, key, text).withColumn("digest", F.unhex(hex_sha256(seen)))
    # The id that stands for a digest is any of those that hold it; the digest itself is part of the join below.
    known = stored_counts(spark, cache_dir, tokenizer).select("digest")
    missing = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(known, "digest", "left_anti")
    chosen = missing.select(F.col("digest").alias("missing"), F.col("doc_id").alias("missing_id")).hint("shuffle_hash")
    one_each = rows.join(chosen, (F.col("digest") == F.col("missing")) & F.col("doc_id").eqNullSafe(F.col("missing_id")), "left_semi")
    label = version(tokenizer)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n_tokens, done = word_counter(tokenizer), set()
        for batch in batches:
            # Rows alike in id and text are all chosen, and stand in one task.
            new = batch[~batch["digest"].isin(done)].drop_duplicates("digest")
            done = (done if len(done) < DONE else set()) | set(new["digest"])
            yield pd.DataFrame({"digest": new["digest"], "version": label, "n_tokens": n_tokens(list(new["text"]))})

    one_each.select("digest", "text").mapInPandas(count, STORED).write.mode("append").parquet(cache_dir)
    counts = stored_counts(spark, cache_dir, tokenizer)
    sizes = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    joined = split_join(sizes, counts, ["digest"], "left")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
