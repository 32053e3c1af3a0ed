"""The shared folder that staged tables are written to, and how long they live.

A staged table cuts lineage: a lost executor costs a re-read, not a recomputation, and row
positions taken from it stay the same however often it is read.

A scope owns what is staged while it is open and deletes it at its end; what should outlive it is
staged with :meth:`Scope.keep` in the scope around it. Without a scope a table lives as long as the
application, or until :func:`discard` or :func:`release`.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_OPEN: ContextVar[tuple[Scope, ...]] = ContextVar("open scopes", default=())
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the context's checkpoint folder. Only
    a local session without either gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollkeep-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scope:
    """Folders of staged tables that are deleted together."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folders = spark, set()

    def keep(self, df: DataFrame, label: str, files: int | None = None) -> DataFrame:
        """Stage a table that outlives this scope: it belongs to the scope around it."""
        scopes = _OPEN.get()
        token = _OPEN.set(scopes[: scopes.index(self)] if self in scopes else scopes)
        try:
            return staged(df, label, files)
        finally:
            _OPEN.reset(token)

    def free(self) -> None:
        """Delete what the scope owns now; after the session's end there is nothing left to ask."""
        if self.spark.sparkContext._jsc is not None:
            for folder in self.folders:
                _delete(self.spark, folder)
        self.folders.clear()


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Own what is staged inside and delete it at the end. A result that reads it lazily must be staged
    by :meth:`Scope.keep`, or be consumed inside."""
    own = Scope(spark)
    with owned_by(own):
        try:
            yield own
        finally:
            own.free()


@contextmanager
def owned_by(own: Scope) -> Iterator[Scope]:
    """Let a scope own what is staged inside, without freeing it at the end."""
    token = _OPEN.set((*_OPEN.get(), own))
    try:
        yield own
    finally:
        _OPEN.reset(token)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name of its own; one level per application. The innermost open scope owns it."""
    folder = f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for own in _OPEN.get()[-1:]:
        own.folders.add(folder)
    return folder


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/rollkeep/{spark.conf.get('spark.app.id')}"


def staged(df: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """Write once to the shared folder and read it back; ``files``: by at most so many tasks, each of which writes a file."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    (df if files is None else df.coalesce(files)).write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete staged tables whose last reader is done; what was derived from them must be written by now."""
    for table in tables:
        folder = _FOLDERS.pop(table, None)
        if folder is None:
            raise ValueError("not a staged table, or one that was discarded already")
        _delete(table.sparkSession, folder)
        for own in _OPEN.get():
            own.folders.discard(folder)


def folders(spark: SparkSession) -> list[str]:
    """The staged folders that are on disk now."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application staged. Results that were not yet written are lost."""
    _delete(spark, _application_dir(spark))
