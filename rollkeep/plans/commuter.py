"""The commuter eligibility extract: two personnel sources in one 39-column layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.functions import predicates as p
from rollkeep.functions import scalars as s
from rollkeep.operators import joins
from rollkeep.operators.asof import conditional_as_of, latest_as_of
from rollkeep.operators.dedupe import keep_best
from rollkeep.operators.layout import to_layout
from rollkeep.operators.ordering import ordered
from rollkeep.operators.sets import union_distinct
from rollkeep.sources.staging import staged
from rollkeep.sources.tables import Tables

Window = tuple[dt.date | str, dt.date | str]

# Layout columns in order; all are text but the three dates.
LAYOUT_COLUMNS = (
    "record_type group_id employee_id employee_ssn change_to_unique_id old_unique_id last_name first_name "
    "middle_initial birth_date gender street_address_1 street_address_2 city state zip_code zip_code_extension "
    "work_zip_code email_address phone phone_extension employment_hire_date employment_termination_date "
    "benefit_group_code benefit_group_effective_date payroll_group_code payroll_group_effective_date location_code "
    "company_code for_future_use_1 for_future_use_2 bank_name bank_account_number bank_routing_number "
    "bank_account_type payment_preference commuter_program_eligibility_status client_id payroll_type"
).split()
LAYOUT_DATES = {"birth_date", "employment_hire_date", "employment_termination_date"}
LAYOUT = T.StructType(
    [T.StructField(c, T.DateType() if c in LAYOUT_DATES else T.StringType()) for c in LAYOUT_COLUMNS]
)

# Code lists of the first source.
EXCLUDING_CODE_TYPES = ["SOI_MIG_WSE", "SOI_TERM_WSE"]
EMPLOYED = ["F", "f", "Y", "y"]
COUNTRIES = ["USA", "US"]

# Code lists of the second source.
WORKING = ["A", "P", "S"]
TERMINATED = ["T"]
COBRA_PATTERN = "C%"
UNPAID_CLASSES = ["U"]
CLIENT_GROUP = "SOI"
EXCLUDED_CORP = "PEOCN"
EXCLUDED_CITY_PATTERNS = ["SAN%FRAN%"]
EXCLUDED_CITIES = ["SFO"]
FULL_TIME_HOURS = 30


def source1(
    tables: Tables,
    client_window: Window,
    employee_window: Window,
    asof: dt.date | str,
    initial_mode: str = "reference",
) -> DataFrame:
    """Employees of open (or lately and regularly closed) clients with their primary location,
    before de-duplication."""
    codes = tables["sthccdira"].where(p.in_list("code_type", EXCLUDING_CODE_TYPES))
    client = joins.not_in_flag(
        tables["syclntr"].select("client_id", "payroll_type", "termination_date", "term_reason_code"),
        "term_reason_code",
        codes,
        "code_key_1",
        "allowed",
    ).where(p.open_or_closed_in("termination_date", *client_window, F.col("allowed")))
    year = joins.not_in_flag(
        tables["syempyr"]
        .where(p.in_list("empl_status", EMPLOYED))
        .select("empl_id", "orig_hire_date", "terminated", "term_reason_code", F.col("payroll_type").alias("company")),
        "term_reason_code",
        codes,
        "code_key_1",
        "allowed",
    ).where(p.open_or_closed_in("terminated", *employee_window, F.col("allowed")))
    at = F.coalesce("terminated", p.as_date(asof))
    primary = tables["soemploc"].where("primary_yn = 'Y'")
    person = tables["syemsad"].where(p.in_list("country", COUNTRIES))

    rows = joins.inner(year.drop("term_reason_code", "allowed"), person.drop("country"), ["empl_id"])
    rows = joins.valid_at(rows, primary, ["empl_id"], at, "effective_date", "expiry_date")
    rows = joins.inner(
        rows.drop("effective_date", "expiry_date", "primary_yn"),
        client.select("payroll_type", "client_id"),
        ["payroll_type", "client_id"],
    )
    rows = joins.valid_at(
        rows,
        tables["sthclocra"],
        ["client_id", "location_id"],
        at,
        "effective_date",
        "expiry_date",
    )
    return to_layout(
        rows,
        {
            "employee_id": F.col("empl_id"),
            "employee_ssn": F.col("soc_sec_num"),
            "last_name": F.col("last_name"),
            "first_name": F.col("first_name"),
            "middle_initial": s.initial("middle_name", initial_mode),
            "birth_date": F.col("birthdate"),
            "gender": F.col("sex_id"),
            "street_address_1": F.col("address1"),
            "street_address_2": s.blank_if_null("address2"),
            "city": F.col("city"),
            "state": F.col("state"),
            "zip_code": F.col("zip"),
            "work_zip_code": F.col("postal_zip"),
            "phone": F.col("phone"),
            "employment_hire_date": F.col("orig_hire_date"),
            "employment_termination_date": F.col("terminated"),
            "location_code": F.col("location_id"),
            "company_code": F.col("company"),
            "commuter_program_eligibility_status": s.flag(F.col("terminated").isNull()),
            "client_id": F.col("client_id"),
            "payroll_type": F.col("payroll_type"),
        },
        LAYOUT,
    ).distinct()


def dedupe(rows: DataFrame) -> DataFrame:
    """One employment per employee where the rules can tell; full ties stay."""
    return keep_best(rows, "employee_id", "employment_termination_date", ["company_code", "location_code"])


def _jobs(tables: Tables, asof: dt.date | str, eligible: bool) -> DataFrame:
    """Job rows in force: working today, or ended within the trailing days."""
    keys = ["emplid", "empl_rcd"]
    if eligible:
        current = latest_as_of(tables["ps_job"], keys, "effdt", asof, seq="effseq")
        statuses, label = WORKING, "Y"
    else:
        ended = p.trailing_days("termination_dt", asof)
        current = conditional_as_of(tables["ps_job"], keys, "effdt", "effseq", ended)
        statuses, label = TERMINATED, "N"
    wanted = (
        p.in_list("empl_status", statuses)
        & p.like("emplid", COBRA_PATTERN, negate=True)
        & p.not_in_or_null("empl_class", UNPAID_CLASSES)
    )
    return current.where(wanted).select(
        "emplid",
        "empl_rcd",
        "company",
        "pf_client",
        "last_hire_dt",
        "termination_dt",
        "full_part_time",
        "reg_temp",
        "std_hours",
        "tax_location_cd",
        F.lit(label).alias("eligible"),
    )


def job_rows(
    tables: Tables, addresses: DataFrame, asof: dt.date | str, eligible: bool | None = None
) -> DataFrame:
    """Jobs with option, name, person and the three branch flags ``b1``, ``b2``, ``b3``.

    ``addresses`` are the current ones. ``eligible`` picks one population; without it both run
    through the same joins once.
    """
    if eligible is None:
        jobs = _jobs(tables, asof, True).unionAll(_jobs(tables, asof, False))
    else:
        jobs = _jobs(tables, asof, eligible)
    city = {"patterns": EXCLUDED_CITY_PATTERNS, "exact": EXCLUDED_CITIES}

    option = latest_as_of(tables["ps_t2_cloptn_effdt"], ["company", "pf_client"], "effdt", asof).where(
        (F.col("t2_peo_id") == CLIENT_GROUP) & (F.col("pf_corp") != EXCLUDED_CORP)
    )
    names = latest_as_of(tables["ps_names"], ["emplid", "name_type"], "effdt").where("name_type = 'PRI'")
    people = (
        addresses.where(p.in_list("country", ["USA"]) & p.city_ok("city", **city))
        .groupBy("emplid")
        .agg(F.bool_or(F.col("address_type") == "HOME").alias("_home_ok"))
    )
    taxed = tables["ps_tax_location1"].where(p.city_ok("city", **city))

    rows = joins.inner(jobs, option.select("company", "pf_client"), ["company", "pf_client"])
    rows = joins.inner(rows, names.select("emplid", "first_name", "last_name", "middle_name"), ["emplid"])
    rows = joins.inner(rows, tables["ps_person"].select("emplid", "birthdate"), ["emplid"])
    rows = joins.left(rows, people, ["emplid"])
    rows = joins.flag_keys(rows, taxed, ["tax_location_cd"], "_tax_ok")

    any_ok = F.col("_home_ok").isNotNull()
    home_ok = F.coalesce("_home_ok", F.lit(False))
    tax_ok = F.col("_tax_ok")
    hours = F.col("std_hours").cast("double")
    full = (hours >= FULL_TIME_HOURS) & (F.col("full_part_time") == "F") & (F.col("reg_temp") == "R")
    return rows.select(
        *[c for c in rows.columns if c not in ("_home_ok", "_tax_ok")],
        (full & any_ok & tax_ok).alias("b1"),
        (home_ok | tax_ok).alias("b2"),
        ((hours < FULL_TIME_HOURS) & (home_ok | tax_ok)).alias("b3"),
    )


def current_addresses(tables: Tables, asof: dt.date | str) -> DataFrame:
    return latest_as_of(
        tables["ps_addresses"],
        ["emplid", "address_type"],
        "effdt",
        asof,
        status="eff_status",
        status_value="A",
    )


def source2(
    tables: Tables,
    asof: dt.date | str,
    eligible: bool | None = None,
    work_type: str = "HOME",
    initial_mode: str = "reference",
) -> DataFrame:
    """Persons of the second source in the layout.

    The source describes its population as the union of three branches over the same tables.
    They differ in filters only, so one pass keeps a row that any branch takes, and the
    distinct at the end is the union's.
    """
    # read three times: for the branch flags, as home and as work address
    addresses = staged(current_addresses(tables, asof), "addresses")
    taken = job_rows(tables, addresses, asof, eligible).where("b1 or b2 or b3")
    address_columns = ["address1", "address_type", "address2", "city", "state", F.col("postal").alias("home_postal")]
    rows = joins.address_roles(taken, addresses, "emplid", address_columns, work_type=work_type)
    phone = tables["ps_personal_phone"].where("pref_phone_flag = 'Y'")
    nid = tables["ps_pers_nid"].where("primary_nid = 'Y'")
    rows = joins.lookup_one(rows, phone, ["emplid"], s.digits("phone"), "home_phone")
    rows = joins.lookup_one(rows, nid, ["emplid"], "national_id", "national_id")
    rows = joins.lookup_as_of(rows, tables["ps_pers_data_effdt"], ["emplid"], "sex", "sex", "effdt", asof)
    return to_layout(
        rows,
        {
            "employee_id": F.col("emplid"),
            "employee_ssn": F.col("national_id"),
            "last_name": F.col("last_name"),
            "first_name": F.col("first_name"),
            "middle_initial": s.initial("middle_name", initial_mode),
            "birth_date": F.col("birthdate"),
            "gender": s.gender("sex"),
            "street_address_1": F.col("address1"),
            "street_address_2": F.col("address2"),
            "city": F.col("city"),
            "state": F.col("state"),
            "zip_code": F.col("home_postal"),
            "work_zip_code": F.col("work_postal"),
            "phone": F.col("home_phone"),
            "employment_hire_date": F.col("last_hire_dt"),
            "employment_termination_date": F.col("termination_dt"),
            "location_code": F.col("pf_client"),
            "company_code": F.col("company"),
            "commuter_program_eligibility_status": F.col("eligible"),
            "client_id": F.col("company"),
        },
        LAYOUT,
    ).distinct()


def extract(
    tables: Tables,
    client_window: Window,
    employee_window: Window,
    asof: dt.date | str,
    initial_mode: str = "reference",
) -> DataFrame:
    """The whole extract, ordered by employee."""
    # de-duplication reads the first source twice
    first = staged(source1(tables, client_window, employee_window, asof, initial_mode), "commuter-source1")
    second = source2(tables, asof, initial_mode=initial_mode)
    return ordered(union_distinct(dedupe(first), second), ["employee_id"])
