"""The run ledger: file definitions, instances, transfers and exceptions as append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.functions.predicates import like
from rollkeep.operators import joins
from rollkeep.operators.asof import latest_as_of
from rollkeep.operators.layout import to_layout
from rollkeep.operators.ordering import number_rows

_LONG = "exception_id file_record_id file_instance_id file_instance_transfer_status_id".split()
_INT = (
    "file_definition_id job_id vendor_id business_id client_id member_term_limit members_per_transaction_set_soft_limit "
    "return_code"
).split()
_BOOLEAN = "show_dependent_total show_employee_total show_total is_prod_file".split()
_DATE = "file_definition_effective_date file_effective_date lookback_min_date termination_min_date".split()
_TIMESTAMP = (
    "file_instance_start_time file_instance_end_time file_instance_transfer_status_start_time "
    "file_instance_transfer_status_end_time"
).split()
# The columns of the exception view in order.
EXCEPTION_VIEW_COLUMNS = (
    "exception_id file_record_id exception_type category sub_category detail subscriber_id member_id file_definition_id "
    "job_id vendor_id business_id client_id file_definition_name status exchange jira_stories version cutoff databases "
    "functions repo_location spec_location contents sys_period file_definition_effective_date member_term_limit "
    "members_per_transaction_set_soft_limit authorization_information_qualifier authorization_information "
    "security_information_qualifier security_information interchange_sender_id_qualifier interchange_sender_id "
    "interchange_receiver_id_qualifier interchange_receiver_id repetition_separator interchange_control_version_number "
    "acknowledgment_requested component_element_separator segment_separator segment_supplemental_separator "
    "functional_identifier_code application_senders_code application_receivers_code responsible_agency_code "
    "version_release_industry_identifier_code transaction_set_identifier_code master_policy_number show_dependent_total "
    "show_employee_total show_total plan_sponsor_name sponsor_identifier_qualifier sponsor_identifier insurer_name "
    "insurer_identification_code_qualifier insurer_identification_code broker_name "
    "broker_identification_code_qualifier broker_identification_code broker_account_number_1 broker_account_number_2 "
    "tpa_name tpa_identification_code_qualifier tpa_identification_code tpa_account_number_1 tpa_account_number_2 "
    "file_instance_id file_instance_start_time file_instance_end_time file_instance_status is_prod_file file_name "
    "file_location file_log file_log_contents file_effective_date lookback_min_date termination_min_date "
    "transaction_set_purpose_code original_transaction_set_reference_number action_code dtp_effective dtp_report_start "
    "dtp_report_end dtp_maintenance_effective dtp_enrollment dtp_payment_commencement file_instance_transfer_status_id "
    "file_instance_transfer_status return_code failure_reason java_exception data_exception "
    "file_instance_transfer_status_start_time file_instance_transfer_status_end_time"
).split()


def _type_of(name: str) -> T.DataType:
    if name == "sys_period":  # a range of times, open at the right end when that is null
        ends = [T.StructField("lower", T.TimestampType()), T.StructField("upper", T.TimestampType())]
        return T.StructType(ends)
    for names, data_type in (
        (_LONG, T.LongType()),
        (_INT, T.IntegerType()),
        (_BOOLEAN, T.BooleanType()),
        (_DATE, T.DateType()),
        (_TIMESTAMP, T.TimestampType()),
    ):
        if name in names:
            return data_type
    return T.StringType()


EXCEPTION_VIEW = T.StructType([T.StructField(name, _type_of(name)) for name in EXCEPTION_VIEW_COLUMNS])


def ledger_append(rows: DataFrame, path: str) -> None:
    """Add rows to a ledger table; what is there stays."""
    rows.write.mode("append").parquet(path)


def current_status(events: DataFrame) -> DataFrame:
    """The last event of each run by time and number: its status now."""
    return latest_as_of(events, ["file_instance_id"], "event_time", seq="event_no")


def number_exceptions(exceptions: DataFrame, start: int = 0) -> DataFrame:
    """Give ``exception_id`` in subscriber order, after ``start``."""
    order = ["file_instance_id", "subscriber_id", "member_id", "detail", "file_record_id"]
    numbered = number_rows(exceptions, [c for c in order if c in exceptions.columns], "exception_id")
    return numbered.withColumn("exception_id", F.col("exception_id") + F.lit(start))


def exception_view(
    exceptions: DataFrame, definitions: DataFrame, instances: DataFrame, transfers: DataFrame
) -> DataFrame:
    """Exceptions with their run, its definition and its transfers, in the view's layout.

    Of definitions with a ``sys_period`` the row counts that was valid when the run started. A run without a transfer
    shows nulls there; columns none of the tables has are typed nulls. Runs and transfers are joined to each other first and
    the exceptions, many per run, to them; definitions, few and by far the widest, come last, so that no exchange carries their
    columns.
    """
    runs = joins.left(instances, transfers, ["file_instance_id"])
    rows = joins.inner(joins.inner(exceptions, runs, ["file_instance_id"]), definitions, ["file_definition_id"])
    if "sys_period" in definitions.columns:
        start, period = F.col("file_instance_start_time"), F.col("sys_period")
        rows = rows.where((period["lower"] <= start) & (period["upper"].isNull() | (start < period["upper"])))
    known = {name: F.col(name) for name in EXCEPTION_VIEW.names if name in rows.columns}
    return to_layout(rows, known, EXCEPTION_VIEW)


def runs_like(definitions: DataFrame, instances: DataFrame, pattern: str) -> DataFrame:
    """Runs of the definitions whose name matches a pattern."""
    named = definitions.where(like("file_definition_name", pattern))
    return joins.semi(instances, named, ["file_definition_id"])


def run_rows(records: DataFrame, run_id: int) -> DataFrame:
    """The records of one run."""
    return records.where(F.col("file_instance_id") == run_id)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
