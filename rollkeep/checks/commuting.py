"""Queries over the commuter extract."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollkeep.checks.registry import query
from rollkeep.checks.standins import ASOF, newest, out_of_town, phone_digits, standins, with_standins
from rollkeep.operators.joins import semi
from rollkeep.operators.sets import union_distinct
from rollkeep.plans import commuter as c
from rollkeep.sources.staging import staged

SOURCE1 = ["soemploc", "sthclocra", "syemsad", "syclntr", "syempyr", "sthccdira"]
SOURCE2 = [
    "ps_job",
    "ps_t2_cloptn_effdt",
    "ps_names",
    "ps_person",
    "ps_addresses",
    "ps_tax_location1",
    "ps_personal_phone",
    "ps_pers_nid",
    "ps_pers_data_effdt",
]
CLIENTS = ("1998-01-15", "1998-12-31")
EMPLOYEES = ("1998-02-01", "1998-09-30")

_DAY = f"cast('{ASOF}' as date)"


def _layout_sql(filled: dict[str, str]) -> str:
    """A select list over the whole layout; columns not filled are typed nulls."""
    return ", ".join(
        f"{filled.get(f.name, 'null')} as {f.name}" if f.name in filled else f"cast(null as varchar) as {f.name}"
        for f in c.LAYOUT.fields
    )


_LAYOUT1 = _layout_sql(
    {
        "employee_id": "a.empl_id",
        "employee_ssn": "a.soc_sec_num",
        "last_name": "a.last_name",
        "first_name": "a.first_name",
        "middle_initial": "coalesce(substr(a.middle_name, 0, 1), '')",
        "birth_date": "a.birthdate",
        "gender": "a.sex_id",
        "street_address_1": "a.address1",
        "street_address_2": "coalesce(a.address2, '')",
        "city": "a.city",
        "state": "a.state",
        "zip_code": "a.zip",
        "work_zip_code": "z.postal_zip",
        "phone": "a.phone",
        "employment_hire_date": "y.orig_hire_date",
        "employment_termination_date": "y.terminated",
        "location_code": "z.location_id",
        "company_code": "y.payroll_type",
        "commuter_program_eligibility_status": "case when y.terminated is null then 'Y' else 'N' end",
        "client_id": "e.client_id",
        "payroll_type": "a.payroll_type",
    }
)


def _still_or_ended(column: str, bounds: tuple[str, str]) -> str:
    """Not ended, or ended within the bounds for a reason that is known and not among the migrations."""
    first, last = bounds
    return f"""case when {column} is null then true
      else {column} >= date '{first}' and {column} <= date '{last}' and not coalesce(term_reason_code in (select reason from migrations), true) end"""


# people first, each with the day that counts for them; then what holds on that day
_COMBINED = f"""migrations as (select code_key_1 as reason from sthccdira where code_type in ('SOI_MIG_WSE', 'SOI_TERM_WSE')),
employed as (select *, coalesce(terminated, {_DAY}) as day from syempyr
  where lower(empl_status) in ('f', 'y') and {_still_or_ended('terminated', EMPLOYEES)}),
served as (select distinct client_id, payroll_type from syclntr where {_still_or_ended('termination_date', CLIENTS)}),
combined as (select distinct {_LAYOUT1}
  from employed y
    join syemsad a on a.empl_id = y.empl_id and a.country in ('US', 'USA')
    join soemploc e on e.empl_id = y.empl_id and e.primary_yn = 'Y' and y.day between e.effective_date and e.expiry_date
    join served on (served.client_id, served.payroll_type) = (e.client_id, a.payroll_type)
    join sthclocra z on (z.client_id, z.location_id) = (e.client_id, e.location_id) and y.day between z.effective_date and z.expiry_date)"""


def _pass(new: str, old: str, keep: str) -> str:
    """One clean-up pass: rows stay unless the comparison with the employee's best is false."""
    return f"{new} as (select r.* from {old} r where coalesce({keep}, true))"


def _best(old: str, column: str, function: str) -> str:
    return (
        f"r.{column} = (select {function}(q.{column}) from {old} q where q.employee_id = r.employee_id)"
    )


_CLEANED = ",\n".join(
    [
        _pass(
            "c1",
            "combined",
            "not (r.employment_termination_date is not null and r.employee_id in "
            "(select q.employee_id from combined q where q.employment_termination_date is null))",
        ),
        _pass("c2", "c1", _best("c1", "employment_termination_date", "max")),
        _pass("c3", "c2", _best("c2", "company_code", "min")),
        _pass("c4", "c3", _best("c3", "location_code", "min")),
    ]
)

_UPTO = f"effdt <= {_DAY}"


def _source2_sql(eligible: bool, branches: tuple[str, ...] = ("full time", "any", "part time")) -> str:
    """People with their facts, one newest row per fact, and the branches as conditions on them."""
    counted = _UPTO if eligible else f"termination_dt between {_DAY} - 36 and {_DAY} - 1"
    statuses = "'A', 'P', 'S'" if eligible else "'T'"
    home = newest("ps_addresses", "emplid address_type", _UPTO)
    outside = f"select emplid, address_type from {home} where eff_status = 'A' and country = 'USA' and {out_of_town('city')}"
    taxed = f"tax_location_cd in (select tax_location_cd from ps_tax_location1 where {out_of_town('city')})"
    somewhere = f"emplid in (select emplid from ({outside}))"
    either = f"(emplid in (select emplid from ({outside}) where address_type = 'HOME') or {taxed})"
    conditions = {
        "full time": f"(full_part_time = 'F' and reg_temp = 'R' and std_hours::double >= 30 and {somewhere} and {taxed})",
        "any": either,
        "part time": f"(std_hours::double < 30 and {either})",
    }
    return f"""select emplid, empl_rcd, company, pf_client, last_hire_dt, termination_dt, full_part_time, reg_temp, std_hours,
    first_name, last_name, middle_name, birthdate, {phone_digits('phone')} as home_phone, national_id, sex,
    '{'Y' if eligible else 'N'}' as eligible, lives.address1, lives.address2, lives.city, lives.state,
    lives.postal as home_postal, works.postal as work_postal
  from {newest('ps_job', 'emplid empl_rcd', counted, sequence=True)}
    join (select company, pf_client from {newest('ps_t2_cloptn_effdt', 'company pf_client', _UPTO)}
      where t2_peo_id = 'SOI' and pf_corp <> 'PEOCN') using (company, pf_client)
    join (select emplid, first_name, last_name, middle_name from {newest('ps_names', 'emplid name_type')} where name_type = 'PRI') using (emplid)
    join (select emplid, birthdate from ps_person) using (emplid)
    join (select emplid, address1, address2, city, state, postal from {home} where address_type = 'HOME' and eff_status = 'A') lives using (emplid)
    join (select emplid, postal from {home} where address_type = 'HOME' and eff_status = 'A') works using (emplid)
    left join (select emplid, phone from ps_personal_phone where pref_phone_flag = 'Y') using (emplid)
    left join (select emplid, national_id from ps_pers_nid where primary_nid = 'Y') using (emplid)
    left join (select emplid, sex from {newest('ps_pers_data_effdt', 'emplid', _UPTO)}) using (emplid)
  where empl_status in ({statuses}) and not starts_with(emplid, 'C') and coalesce(empl_class <> 'U', true)
    and ({' or '.join(conditions[b] for b in branches)})"""


_LAYOUT2 = _layout_sql(
    {
        "employee_id": "emplid",
        "employee_ssn": "national_id",
        "last_name": "last_name",
        "first_name": "first_name",
        "middle_initial": "coalesce(substr(middle_name, 0, 1), '')",
        "birth_date": "birthdate",
        "gender": "coalesce(nullif(sex, ''), 'U')",
        "street_address_1": "address1",
        "street_address_2": "address2",
        "city": "city",
        "state": "state",
        "zip_code": "home_postal",
        "work_zip_code": "work_postal",
        "phone": "home_phone",
        "employment_hire_date": "last_hire_dt",
        "employment_termination_date": "termination_dt",
        "location_code": "pf_client",
        "company_code": "company",
        "commuter_program_eligibility_status": "eligible",
        "client_id": "company",
    }
)


@query(with_standins(SOURCE1, "select * from combined", _COMBINED))
def commuter_source1(spark, sf_dir):
    return c.source1(standins(spark, sf_dir, *SOURCE1), CLIENTS, EMPLOYEES, ASOF)


@query(with_standins(SOURCE1, "select * from c4", f"{_COMBINED},\n{_CLEANED}"))
def commuter_deduped(spark, sf_dir):
    return c.dedupe(c.source1(standins(spark, sf_dir, *SOURCE1), CLIENTS, EMPLOYEES, ASOF))


@query(with_standins(SOURCE2, f"select distinct {_LAYOUT2} from s2", f"s2 as ({_source2_sql(True)})"))
def commuter_eligible(spark, sf_dir):
    return c.source2(standins(spark, sf_dir, *SOURCE2), ASOF, eligible=True)


@query(with_standins(SOURCE2, f"select distinct {_LAYOUT2} from s2", f"s2 as ({_source2_sql(False)})"))
def commuter_ineligible(spark, sf_dir):
    return c.source2(standins(spark, sf_dir, *SOURCE2), ASOF, eligible=False)


@query(
    with_standins(
        SOURCE1 + SOURCE2,
        f"""select * from c4 union select distinct {_LAYOUT2} from s2 union select distinct {_LAYOUT2} from s3""",
        f"{_COMBINED},\n{_CLEANED},\ns2 as ({_source2_sql(True)}),\ns3 as ({_source2_sql(False)})",
    )
)
def commuter_extract(spark, sf_dir):
    return c.extract(standins(spark, sf_dir, *SOURCE1, *SOURCE2), CLIENTS, EMPLOYEES, ASOF)


@query(
    with_standins(
        SOURCE2,
        " union ".join(
            f"select distinct emplid, empl_rcd, eligible from ({_source2_sql(eligible, (branch,))})"
            for eligible in (True, False)
            for branch in ("full time", "any", "part time")
        ),
    )
)
def union_branches(spark, sf_dir):
    """The three branches as a union of their own filters, restricted to persons with an address."""
    tables = standins(spark, sf_dir, *SOURCE2)
    addresses = staged(c.current_addresses(tables, ASOF), "addresses")
    rows = c.job_rows(tables, addresses, ASOF)
    rows = semi(rows, addresses.where(F.col("address_type") == "HOME"), ["emplid"])
    columns = ["emplid", "empl_rcd", "eligible"]
    # all branches read the same joined rows
    rows = staged(rows.select(*columns, "b1", "b2", "b3"), "branches")
    return union_distinct(*[rows.where(branch).select(*columns) for branch in ("b1", "b2", "b3")])
