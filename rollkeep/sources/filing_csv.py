"""The filing file: one header line, quoted text, bare numbers, empty nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.functions.scalars import us_date
from rollkeep.plans.filing import RESULT

# The file's columns in order, and which of them are written without quotes.
HEADER = (
    "PF_CORP COMPANY LEGAL_NAME DBA_NAME ADDRESS1 ADDRESS2 CITY STATE POSTAL NAICS FEDERAL_EIN STATE_DOL# LEGAL_STATUS "
    "CLIENT_PHONE CLIENT_FAX EMAIL_ADDR FILING_DESCR ADDRESS1_1 ADDRESS2_1 CITY_1 STATE_1 POSTAL_1 DBL_MALES DBL_FEMALES "
    "PFL_MALES PFL_FEMALES COVERED_ANNUAL_PAYROLL STATUS STATUS_DATE CANCEL_REASON"
).split()
HEADER_LINE = ", ".join(HEADER)
BARE = {"POSTAL", "FEDERAL_EIN", "STATE_DOL#", "POSTAL_1"}

FILE_SCHEMA = T.StructType(
    [T.StructField(name, field.dataType) for name, field in zip(HEADER, RESULT.fields[1:], strict=True)]
)


def _rendered(field: T.StructField, name: str) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        text = us_date(value)
    elif isinstance(field.dataType, T.StringType) and name not in BARE:
        text = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def write_filing_csv(filing: DataFrame, path: str) -> None:
    """Write the filing in record order.

    The parts of the folder, joined in name order, are the file: the header is the first line
    of the first part only, and it is all there is when the filing has no rows.
    """
    spark = filing.sparkSession
    fields = [_rendered(field, name) for field, name in zip(RESULT.fields[1:], HEADER, strict=True)]
    lines = filing.select(F.col(RESULT.names[0]).alias("_at"), F.concat_ws(",", *fields).alias("value"))
    header = spark.range(1).select(F.lit(0).cast("long").alias("_at"), F.lit(HEADER_LINE).alias("value"))
    ordered = header.unionAll(lines).repartitionByRange("_at").sortWithinPartitions("_at")
    ordered.select("value").write.text(path)


def read_filing_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a filing back with its declared types; the header line is dropped wherever it stands."""
    texts = T.StructType([T.StructField(name, T.StringType()) for name in HEADER])
    raw = spark.read.schema(texts).option("escape", '"').option("header", False).csv(path)
    rows = raw.where(~F.trim(F.col(HEADER[1])).eqNullSafe(HEADER[1]))
    return rows.select(
        *[
            (F.to_date(f"`{f.name}`", "MM/dd/yyyy") if isinstance(f.dataType, T.DateType) else F.col(f"`{f.name}`"))
            .cast(f.dataType)
            .alias(f.name)
            for f in FILE_SCHEMA.fields
        ]
    )
