"""What the operators of this folder share: their input, free names, sizes of partitions and session limits."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.operators.joins import hash_condition

# ASCII white space as the contracts have it: blank and the codes 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only key (as long) and text (null becomes empty), whatever other columns there are."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def split_count(df: DataFrame, target_bytes: int = 24 << 20) -> int:
    """Partitions for an exchange of this table, from the optimiser's size of it; never under the session's own number."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A size that no source states is a huge guess; the session's number is then all there is.
    return least if size >= 1 << 60 else max(least, -(-size // target_bytes))


def file_count(df: DataFrame, target_bytes: int = 4 << 20, least: int | None = None) -> int | None:
    """Files for tables made from this one: as many as the optimiser's size of it asks for, and no fewer than ``least`` (two per
    core).

    Where exchanges have far more partitions than that, each file of a few rows costs more than they do: on a local file
    system Hadoop starts four processes per file, and every later scan has a task for it. None: no source states the size.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = 2 * df.sparkSession.sparkContext.defaultParallelism if least is None else least
    return None if size >= 1 << 60 else max(least, -(-size // target_bytes))


def in_files(df: DataFrame, files: int | None) -> DataFrame:
    """In at most so many partitions; before a step that numbers its rows by task, as a task then runs that step once."""
    return df if files is None else df.coalesce(files)


def table_files(df: DataFrame) -> int | None:
    """Files for tables as wide as this one, with one per core at least: a step that works on texts needs every core."""
    return file_count(df, 16 << 20, df.sparkSession.sparkContext.defaultParallelism)


def id_files(df: DataFrame, target_bytes: int = 32 << 20) -> int | None:
    """Files for tables of a few numbers for each row of this one; two at least, so that no task reads a whole table."""
    return file_count(df, target_bytes, 2)


def text_batches(spark: SparkSession, rows: int = 512) -> None:
    """Let scans read so many rows at once: a batch of whole texts must fit an executor many times."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(rows))


def python_tasks(spark: SparkSession, rows: int = 512) -> None:
    """Make this package importable in tasks, and batches small, of Arrow and of scans: one of whole texts must fit a worker
    many times."""
    text_batches(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if getattr(context, "_rollkeep_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="rollkeep-code-")) / "rollkeep_code.zip"  # the driver sends it to executors
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._rollkeep_shipped = True


def free(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now: it does when the driver's objects for them are collected."""
    gc.collect()
    spark._jvm.System.gc()


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a side that was grouped on the join keys, such that adaptive execution may split the left side's hot keys."""
    own = {c: f"_of_right_{c}" for c in on}
    named = right.withColumnsRenamed(own)
    same = hash_condition(left, on, list(own.values()))
    for c, other in own.items():
        same = same & (F.col(c) == F.col(other))
    joined = left.join(named, same, how)
    return joined if how == "left_semi" else joined.drop(*own.values())


def give_back() -> None:
    """Return to the system what this worker has freed; it would keep it while others wait for memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def hex_sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def salted(column: Column, parts: int) -> Column:
    """A small number from the value, to split a group by."""
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


NAMES = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}


def ddl(schema: pa.Schema) -> str:
    """The same columns as Spark's text form."""

    def name(kind: pa.DataType) -> str:
        return f"array<{name(kind.value_type)}>" if pa.types.is_list(kind) else NAMES[kind]

    return ", ".join(f"{field.name} {name(field.type)}" for field in schema)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as an Arrow batch; unlike pandas, Arrow keeps long ids whole in a column that also holds nulls."""
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)
