"""Documents from raw to packed sequences: each stage works on all that the one before kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.llm import disclosure, harmonic, jaccard_join, line_rules, weak_labels
from rollkeep.llm.common import documents, in_files, table_files
from rollkeep.session import prepare
from rollkeep.sources.staging import Scope, discard, owned_by, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_LAST: list[Scope] = []


def free_last() -> None:
    """Delete what the stage before staged for its result, which is written by now."""
    while _LAST:
        _LAST.pop().free()


def owned(stage: Stage) -> Stage:
    """A stage that owns what it stages. Its result is written before the next stage begins, which frees it, and in as many
    files as its input's size asks for."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_last()
        _LAST.append(Scope(spark))
        with owned_by(_LAST[0]):
            return in_files(stage(spark, docs, sf_dir), table_files(docs))

    return run_stage


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    changed = docs.withColumn("text", F.col(text))
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@owned
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go. Its voters and labels come from the training folds."""
    rules = weak_labels.WeakLabels()
    model = weak_labels.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), rules)
    return docs.select(*COLUMNS).where(weak_labels.scores_of(model)(F.col("text")) < rules.threshold)


@owned
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, then documents that the rules reject."""
    return _with_text(line_rules.cleaned(docs.select(*COLUMNS)), "text")


@owned
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


@owned
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced or removed; every document stays."""
    marked, found = disclosure.sanitise(docs.select(*COLUMNS))
    return _with_text(marked, f"{found}.clean_text")


@owned
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 1024."""
    return harmonic.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]
ORACLE_SQL: str | None = None  # models, tokenizers and bounded searches have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written and read again; of what they staged only the last result stays."""
    prepare(spark)
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        free_last()
        if before is not None:
            discard(before)
        before = docs
    return docs
