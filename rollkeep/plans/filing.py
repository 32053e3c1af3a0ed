"""The disability filing: one row per company with head counts, payroll and a filing address.

The steps follow the data: locations in force, employees counted per company and location,
company totals, one filing location per company, industry code, and the joined result. Each
step is a function of its own; the filing itself takes totals and location choice from one
grouping, so the job table is read by a single plan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.functions import predicates as p
from rollkeep.functions import scalars as s
from rollkeep.operators import joins
from rollkeep.operators.aggregates import choose_location, count_when, location_kinds, rollup_counts, subtotals
from rollkeep.operators.asof import latest_as_of
from rollkeep.operators.layout import typed
from rollkeep.operators.ordering import number_rows
from rollkeep.sources.staging import discard, staged
from rollkeep.sources.tables import Tables, insert_select
from rollkeep.sources.versions import new_version, newest

# The population the filing counts.
FILING_STATE = "NY"
FILING_SETID = "USPEO"
COUNTED_STATUSES = ["A", "L", "P", "S"]
ADVISOR_PAYGROUP = "NP"
TEST_COMPANY = "31T"
COBRA_PATTERN = "C%"
OWNER_CLASSES = ["K1", "K1E", "K1D"]
FIXED_POLICY_START = "2018-01-01"


@dataclass(frozen=True)
class Variant:
    """What the published variants of the filing differ in."""

    term_filter: str | None  # "policy", "effective", "fixed" or no filter
    cancel: str  # "before", "after" or "never"
    job_key: tuple[str, ...] = ("emplid", "empl_rcd")
    location_status_in_key: bool = True
    null_class_ok: bool = True
    blank_address_ok: bool = True


_WIDE = ("emplid", "empl_rcd", "company", "location", "empl_status", "paygroup")

VARIANTS = {
    "commit": Variant(term_filter="policy", cancel="before"),
    "v1": Variant(term_filter=None, cancel="after"),
    "b3201": Variant(term_filter="fixed", cancel="before"),
    "wide": Variant(term_filter=None, cancel="before", job_key=_WIDE),
    "wide_class": Variant(term_filter=None, cancel="before", job_key=(*_WIDE, "empl_class")),
    "master": Variant(
        term_filter="effective",
        cancel="never",
        location_status_in_key=False,
        null_class_ok=False,
        blank_address_ok=False,
    ),
}

LOCATIONS = T.StructType(
    [T.StructField(c, T.StringType()) for c in "location descr address1 address2 city state postal".split()]
)
COUNTS = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("total_employees", T.IntegerType()),
        T.StructField("dbl_males", T.IntegerType()),
        T.StructField("dbl_females", T.IntegerType()),
        T.StructField("covered_annual_payroll", T.DecimalType(20, 3)),
        T.StructField("level", T.IntegerType()),
    ]
)
# Result columns in order.
RESULT = T.StructType(
    [T.StructField("ny_dbl_record_id", T.LongType())]
    + [
        T.StructField(c, T.StringType())
        for c in (
            "pf_corp company legal_name dba_name company_address1 company_address2 company_city company_state "
            "company_zip naics federal_ein state_dol legal_status client_phone client_fax email_addr filing_descr "
            "location_address1 location_address2 location_city location_state location_zip"
        ).split()
    ]
    + [T.StructField(c, T.IntegerType()) for c in "dbl_males dbl_females pfl_males pfl_females".split()]
    + [
        T.StructField("covered_annual_payroll", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("status_date", T.DateType()),
        T.StructField("cancel_reason", T.StringType()),
    ]
)


def locations(tables: Tables, effective: p.DateLike, variant: Variant) -> DataFrame:
    """Distinct active locations of the filing state in force on the date.

    With the status and state among the keys a later inactive row does not hide an active one;
    the oldest variant selects by set and location only.
    """
    rows = tables["ps_location_tbl"]
    if variant.location_status_in_key:
        current = latest_as_of(
            rows,
            ["setid", "location", "state"],
            "effdt",
            effective,
            status="eff_status",
            status_value="A",
            status_in_key=True,
        )
    else:
        current = latest_as_of(
            rows, ["setid", "location"], "effdt", effective, status="eff_status", status_value="A"
        )
    here = current.where((F.col("state") == FILING_STATE) & (F.col("setid") == FILING_SETID))
    return insert_select(here.select(*LOCATIONS.names).distinct(), LOCATIONS)


def counted_rows(tables: Tables, places: DataFrame, effective: p.DateLike, variant: Variant) -> DataFrame:
    """The employees to count, one row each, with company, location, sex and pay."""
    job = latest_as_of(tables["ps_job"], variant.job_key, "effdt", effective, seq="effseq")
    owners = p.not_in_or_null if variant.null_class_ok else p.not_in
    counted = job.where(
        p.in_list("empl_status", COUNTED_STATUSES)
        & (F.col("paygroup") != ADVISOR_PAYGROUP)
        & (F.col("company") != TEST_COMPANY)
        & p.like("emplid", COBRA_PATTERN, negate=True)
        & owners("empl_class", OWNER_CLASSES)
    ).select("emplid", "company", "location", "annual_rt")
    person = latest_as_of(tables["ps_pers_data_effdt"], ["emplid"], "effdt", effective).select("emplid", "sex")
    # a location listed twice (two addresses on one date) counts its employees twice
    here = joins.inner(counted, places.select("location"), ["location"])
    return joins.inner(here, person, ["emplid"])


def measures() -> dict[str, Column]:
    return {
        "total_employees": F.count(F.lit(1)),
        "dbl_males": count_when((F.col("sex") == "M") | (F.col("sex") == "U")),
        "dbl_females": count_when(F.col("sex") == "F"),
        "covered_annual_payroll": F.sum("annual_rt"),
    }


def employee_counts(tables: Tables, places: DataFrame, effective: p.DateLike, variant: Variant) -> DataFrame:
    """Head counts and payroll rolled up over company and location, with the roll-up ``level``."""
    rows = counted_rows(tables, places, effective, variant)
    return typed(rollup_counts(rows, ["company", "location"], measures()), COUNTS)


def company_totals(counts: DataFrame) -> DataFrame:
    """Company subtotals; the grand total is among them, with no company."""
    return subtotals(counts, 1).drop("location")


def filing_locations(counts: DataFrame, places: DataFrame, variant: Variant) -> DataFrame:
    detail = counts.where("level = 0").select("company", "location")
    return choose_location(detail, places, blank_address_ok=variant.blank_address_ok)


def counted_companies(tables: Tables, places: DataFrame, effective: p.DateLike, variant: Variant) -> DataFrame:
    """Totals and filing location of each company in one row.

    The same as :func:`company_totals` joined to :func:`filing_locations`, from one grouping of
    the counted employees; the filing uses this one.
    """
    rows = counted_rows(tables, places, effective, variant)
    detail = rows.groupBy("company", "location").agg(*[m.alias(name) for name, m in measures().items()])
    office, remote = location_kinds(blank_address_ok=variant.blank_address_ok)
    kinds = places.groupBy("location").agg(F.bool_or(office).alias("_office"), F.bool_or(remote).alias("_remote"))
    typed_detail = joins.left(detail, kinds, ["location"])
    found = typed_detail.groupBy("company").agg(
        F.sum("dbl_males").cast("int").alias("dbl_males"),
        F.sum("dbl_females").cast("int").alias("dbl_females"),
        F.sum("covered_annual_payroll").cast(COUNTS["covered_annual_payroll"].dataType).alias("covered_annual_payroll"),
        F.min(F.when(F.col("_office"), F.col("location"))).alias("_first"),
        F.min(F.when(F.col("_remote"), F.col("location"))).alias("_second"),
    )
    chosen = found.withColumn("filing_location", F.coalesce("_first", "_second")).drop("_first", "_second")
    return chosen.where(F.col("filing_location").isNotNull())


def industry_codes(tables: Tables, counts: DataFrame, effective: p.DateLike) -> DataFrame:
    """Distinct codes of counted companies; a company with two codes gives two filing rows."""
    current = latest_as_of(tables["ps_estab_tbl_usa"], ["estabid"], "effdt", effective)
    return joins.restrict_dim(current, counts, {"estabid": "company"}, ["estabid", "naics"])


def unnumbered_filing(tables: Tables, policy_start: p.DateLike, effective: p.DateLike, variant: str) -> DataFrame:
    """The filing rows before the record id is given, in the result's column order."""
    rule = VARIANTS[variant]
    places = locations(tables, effective, rule)
    counted = counted_companies(tables, places, effective, rule)
    codes = latest_as_of(tables["ps_estab_tbl_usa"], ["estabid"], "effdt", effective).select("estabid", "naics")

    company = latest_as_of(
        tables["ps_company_tbl"], ["company"], "effdt", effective, status="eff_status", status_value="A"
    )
    option = latest_as_of(tables["ps_t2_cloptn_effdt"], ["company", "pf_client"], "effdt", effective)
    limit = {"policy": policy_start, "effective": effective, "fixed": FIXED_POLICY_START}.get(rule.term_filter)
    if limit is not None:
        option = option.where(p.term_after("t2_comp_term_dt", limit))

    option = option.select("company", "pf_client", "t2_legal_name", "t2_comp_term_dt")
    office = places.select(
        "location", F.col("descr").alias("filing_descr"), *[F.col(c).alias(f"location_{c}") for c in LOCATIONS.names[2:]]
    )
    joined = joins.inner(company, option, ["company", "pf_client"])
    joined = joins.inner(joined, counted, ["company"])
    joined = joins.inner(joined, codes.distinct(), {"company": "estabid"})
    joined = joins.inner(joined, office, {"filing_location": "location"})

    blank = F.lit(" ")
    return joined.select(
        "pf_corp",
        "company",
        F.col("t2_legal_name").alias("legal_name"),
        blank.alias("dba_name"),
        F.col("address1").alias("company_address1"),
        F.col("address2").alias("company_address2"),
        F.col("city").alias("company_city"),
        F.col("state").alias("company_state"),
        F.col("postal").alias("company_zip"),
        "naics",
        s.ein("pf_client_ein").alias("federal_ein"),
        blank.alias("state_dol"),
        s.legal_status("legal_type").alias("legal_status"),
        blank.alias("client_phone"),
        blank.alias("client_fax"),
        blank.alias("email_addr"),
        "filing_descr",
        "location_address1",
        "location_address2",
        "location_city",
        "location_state",
        F.col("location_postal").alias("location_zip"),
        "dbl_males",
        "dbl_females",
        F.col("dbl_males").alias("pfl_males"),
        F.col("dbl_females").alias("pfl_females"),
        s.whole_number("covered_annual_payroll").alias("covered_annual_payroll"),
        s.filing_status("t2_comp_term_dt", effective, rule.cancel).alias("status"),
        p.as_date(effective).alias("status_date"),
        s.cancel_reason("t2_comp_term_dt", effective, rule.cancel).alias("cancel_reason"),
    )


def filing(
    tables: Tables,
    policy_start: dt.date | str,
    effective: dt.date | str,
    variant: str = "commit",
) -> DataFrame:
    """The filing as a table of 31 typed columns, numbered by company, location address and code.

    The variants without a date argument take ``effective`` for "today".
    """
    rows = unnumbered_filing(tables, policy_start, effective, variant)
    order = ["company", "naics", "filing_descr", "location_address1"]
    rest = [c for c in rows.columns if c not in order]
    return typed(number_rows(rows, [*order, *rest], "ny_dbl_record_id"), RESULT)


def register_filing(
    tables: Tables, policy_start: dt.date | str, effective: dt.date | str, name: str, variant: str = "commit"
) -> DataFrame:
    """Publish one filing for use in SQL; calling it again replaces the definition."""
    rows = filing(tables, policy_start, effective, variant)
    rows.createOrReplaceTempView(name)
    return rows


# The address columns a change is looked for in.
ADDRESS_COLUMNS = (
    "company_address1 company_address2 company_city company_state company_zip "
    "location_address1 location_address2 location_city location_state location_zip"
).split()


# what says when and why a row was sent, not what it says
_OF_THE_RUN = ("ny_dbl_record_id", "status", "status_date", "cancel_reason")


def filing_digests(rows: DataFrame) -> DataFrame:
    """``company`` and a digest of all its rows, whatever their order, without what differs from run to run."""
    said = F.sha2(F.to_json(F.struct(*[c for c in RESULT.names if c not in _OF_THE_RUN]), {"ignoreNullFields": "false"}), 256)
    listed = F.array_join(F.sort_array(F.collect_list("_digest")), ",")
    return rows.select("company", said.alias("_digest")).groupBy("company").agg(F.sha2(listed, 256).alias("digest"))


def change_run(current: DataFrame, path: str, run: int, effective: dt.date | str) -> DataFrame:
    """The change file of a run against what was sent last, as :func:`change_filing` makes it, and keep what is sent now.

    What was sent last is a version of its own per run, with a digest by company: only companies whose digest is new,
    other or gone are compared row by row. A repeated run compares with the state before it again. Staged.
    """
    spark = current.sparkSession
    now, digests = staged(current, "filing-now"), staged(filing_digests(current), "filing-digests")
    before = newest(spark, path, below=run)
    if before is None:
        changed = staged(change_filing(now, now.limit(0), effective), "filing-changes")
    else:
        known = before.read("digests")
        same = digests.join(known, ["company", "digest"], "left_semi").select("company")
        changed = staged(
            change_filing(joins.anti(now, same, ["company"]), joins.anti(before.read("rows"), same, ["company"]), effective), "filing-changes"
        )
    version = new_version(spark, path, run)
    version.write("rows", now)
    version.write("digests", digests)
    version.complete()
    discard(now, digests)
    return changed


def change_filing(current: DataFrame, sent: DataFrame, effective: dt.date | str) -> DataFrame:
    """The rows of a change file against what was sent before, in the filing's layout.

    ``ADD`` for companies never sent (all of them in a first, full feed), ``ADDRESS`` for rows
    whose address was not sent like that, ``CANCEL`` for sent companies that are gone. The
    comparison is by sets of rows, so a company with several rows is fine. Without changes the
    result is empty.
    """
    added = joins.anti(current, sent, ["company"]).withColumn("status", F.lit("ADD"))
    known = joins.semi(current, sent, ["company"])
    old = sent.select("company", F.struct(*ADDRESS_COLUMNS).alias("_old"))
    unsent = (F.col("company") == F.col("_c")) & F.struct(*ADDRESS_COLUMNS).eqNullSafe(F.col("_old"))
    moved = known.join(old.withColumnRenamed("company", "_c"), unsent, "left_anti").withColumn(
        "status", F.lit("ADDRESS")
    )
    gone = joins.anti(sent, current, ["company"]).withColumns(
        {"status": F.lit("CANCEL"), "cancel_reason": F.lit("Client's Request")}
    )
    changed = added.unionByName(moved).unionByName(gone).withColumn("status_date", p.as_date(effective))
    return typed(changed, RESULT)
