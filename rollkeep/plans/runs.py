"""Runs that record themselves, and file definitions that keep their history.

A ledger is a folder of tables: ``events`` (every status of every attempt), ``exceptions`` (with the run's and the record's
number) and ``instances`` (one row per run, what it came to). What an attempt writes goes to a folder that carries the run
and the attempt, so writing it again after a loss replaces it. The instance is written last and names its attempt:
exceptions of an attempt without one are not read, and a run that is repeated replaces its instance.

Definitions are system-versioned: a changed one closes its open row and opens a new one, and a run is read with the row
that was open when it started.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.operators import joins
from rollkeep.operators.asof import latest_as_of
from rollkeep.operators.ordering import number_rows
from rollkeep.plans import enrolment
from rollkeep.sources.ledger import number_exceptions
from rollkeep.sources.staging import discard, staged
from rollkeep.sources.versions import new_version, newest

EVENTS = "file_instance_id long, attempt int, event_no int, file_instance_status string, event_time timestamp"
INSTANCES = (
    "file_instance_id long, file_definition_id int, attempt int, file_instance_start_time timestamp, "
    "file_instance_end_time timestamp, file_instance_status string, file_location string, loaded long, kept long, errors long"
)
EXCEPTIONS = (
    "exception_id long, file_record_id long, file_instance_id long, attempt int, exception_type string, category string, "
    "sub_category string, detail string, subscriber_id string, member_id string"
)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    path: str

    def _table(self, name: str, schema: str) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{name}")

    def _put(self, name: str, rows: DataFrame, *numbers: int) -> None:
        folder = "-".join(f"{n:012d}" for n in numbers)
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{folder}")

    def events(self) -> DataFrame:
        """Every status of every attempt."""
        return self._table("events", EVENTS)

    def statuses(self) -> DataFrame:
        """The last event of each run: its status now."""
        return latest_as_of(
            self.events().withColumn("_order", F.col("attempt") * 1000 + F.col("event_no")), ["file_instance_id"], "event_time", seq="_order"
        ).drop("_order")

    def instances(self) -> DataFrame:
        """One row per finished run: its last attempt."""
        return self._table("instances", INSTANCES)

    def exceptions(self) -> DataFrame:
        """The exceptions of the attempts that the instances name."""
        return joins.semi(self._table("exceptions", EXCEPTIONS), self.instances(), ["file_instance_id", "attempt"])

    def next_attempt(self, run: int) -> int:
        last = self.events().where(F.col("file_instance_id") == run).agg(F.max("attempt")).first()[0]
        return (last or 0) + 1

    def event(self, run: int, attempt: int, number: int, status: str, time: dt.datetime) -> None:
        self._put("events", self.spark.createDataFrame([(run, attempt, number, status, time)], EVENTS).coalesce(1), run, attempt, number)

    def record_exceptions(self, run: int, attempt: int, rows: DataFrame) -> DataFrame:
        names = [part.split()[0] for part in EXCEPTIONS.split(", ")]
        self._put("exceptions", rows.withColumn("attempt", F.lit(attempt)).select(*names), run, attempt)
        return self.exceptions()

    def record_instance(self, *values) -> None:
        self._put("instances", self.spark.createDataFrame([values], INSTANCES).coalesce(1), values[0])


def recorded_run(
    ledger: Ledger,
    run: int,
    definition: int,
    rows: DataFrame,
    covers: DataFrame,
    path: str,
    envelope: enrolment.Envelope = enrolment.Envelope(),
    max_errors: int = 0,
    rules: Sequence[enrolment.Rule] = enrolment.RULES,
    clock: Callable[[], dt.datetime] = _now,
) -> str:
    """Validate, reject, check the gate and write as :func:`enrolment.run_file` does, and record it all; the run's status.

    ``sent``; ``empty`` when there are no subscribers; ``stopped`` when the gate is closed, which raises after it is
    recorded. A run that fails in between leaves its events, and no instance. The file of a repeated run needs a path of its own.
    """
    attempt, started = ledger.next_attempt(run), clock()
    ledger.event(run, attempt, 1, "started", started)
    numbered = number_rows(rows, ["subscriber_id", "member_seq"], "file_record_id").withColumn("file_instance_id", F.lit(run).cast("long"))
    numbered, covers = staged(numbered, "run-members"), staged(covers, "run-coverages")
    exceptions = staged(number_exceptions(enrolment.all_exceptions(numbered, covers, rules)), "exceptions")
    kept = enrolment.reject_families(numbered, exceptions)
    counts = enrolment.run_counts(numbered, kept, exceptions).first()
    ledger.record_exceptions(run, attempt, exceptions)
    ledger.event(run, attempt, 2, "validated", clock())
    status = "empty" if not counts["loaded"] else "stopped" if counts["errors"] > max_errors else "sent"
    if status == "sent":
        enrolment.write_edi(kept.drop("file_record_id", "file_instance_id"), covers, path, envelope)
    finished = clock()
    ledger.event(run, attempt, 3, status, finished)
    place = path if status == "sent" else None
    ledger.record_instance(run, definition, attempt, started, finished, status, place, counts["loaded"], counts["kept"], counts["errors"])
    discard(numbered, covers)
    if status == "stopped":
        raise enrolment.TooManyErrors(f"the number of errors ({counts['errors']}) exceeds the maximum of {max_errors}", exceptions)
    return status


# --- definitions ---------------------------------------------------------------------------


def record_definitions(changes: DataFrame, path: str, at: dt.datetime, key: str = "file_definition_id") -> DataFrame:
    """Take over the definitions in ``changes`` from a time on; all rows with their ``sys_period`` after that.

    A definition that is new or differs in any column opens a row; an open row that differs is closed. Definitions that
    ``changes`` does not name stay as they are. Every call writes a version of its own of the whole, small, table.
    """
    spark = changes.sparkSession
    columns, moment = [c for c in changes.columns if c != "sys_period"], F.lit(at).cast("timestamp")
    open_end = F.lit(None).cast("timestamp")
    before = newest(spark, path)
    period = lambda lower, upper: F.struct(lower.alias("lower"), upper.alias("upper"))
    opened = changes.select(*columns, period(moment, open_end).alias("sys_period"))
    if before is not None:
        old = before.read("definitions")
        is_open = F.col("sys_period.upper").isNull()
        differs = F.struct(*columns).eqNullSafe(F.col("_new"))
        new = changes.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
        joined = old.join(new, is_open & (F.col(key) == F.col("_key")), "left")
        closed = F.col("_key").isNotNull() & ~differs
        kept = joined.withColumn("sys_period", period(F.col("sys_period.lower"), F.when(closed, moment).otherwise(F.col("sys_period.upper"))))
        same = joins.semi(old.where(is_open), changes, [key]).select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
        unchanged = (F.col(key) == F.col("_key")) & F.struct(*columns).eqNullSafe(F.col("_old"))
        opened = kept.select(*columns, "sys_period").unionByName(opened.join(same, unchanged, "left_anti"))
    version = new_version(spark, path)
    written = version.write("definitions", opened)
    version.complete()
    return written


def definitions(spark: SparkSession, path: str) -> DataFrame:
    """All definitions with their periods."""
    version = newest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no definitions below {path}")
    return version.read("definitions")
