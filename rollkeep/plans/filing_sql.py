"""The filing as a table function of SQL with two dates.

The same rules as :mod:`rollkeep.plans.filing`, said in SQL, so that one statement can ask for several pairs of dates:
``select * from disability_filing(date'2018-01-01', date'2018-01-23')``. Every newest row comes from a grouped maximum and
a join, so no window gathers a key's rows. Rows come without the record number, which SQL could only give in one task.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rollkeep.functions.scalars import LEGAL_FORM_DEFAULT, LEGAL_FORMS
from rollkeep.plans import filing as f
from rollkeep.sources.tables import Tables

TABLES = ("ps_location_tbl", "ps_job", "ps_pers_data_effdt", "ps_estab_tbl_usa", "ps_company_tbl", "ps_t2_cloptn_effdt")


def _listed(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def filing_text(name: str, variant: str = "commit") -> str:
    """The body of the function ``name`` over views ``name_table``."""
    rule, effective = f.VARIANTS[variant], f"{name}.effective"

    def newest(table: str, keys: str, sequence: bool = False) -> str:
        best = "max(struct(effdt, effseq))" if sequence else "max(struct(effdt))"
        same = " and ".join(f"own.{key} = best.{key}" for key in keys.split())
        number = " and own.effseq = best.newest.effseq" if sequence else ""
        groups = f"select {', '.join(keys.split())}, {best} as newest from {name}_{table} where effdt <= {effective} group by {', '.join(keys.split())}"
        return f"(select own.* from {name}_{table} own join ({groups}) best on {same} and own.effdt = best.newest.effdt{number})"

    limit = {"policy": f"{name}.policy_start", "effective": effective, "fixed": f"date'{f.FIXED_POLICY_START}'"}.get(rule.term_filter)
    open_ones = f"where t2_comp_term_dt is null or t2_comp_term_dt > {limit}" if limit else ""
    cancelled = {"before": f"t2_comp_term_dt < {effective}", "after": f"t2_comp_term_dt > {effective}", "never": "false"}[rule.cancel]
    owners = f"empl_class not in ({_listed(f.OWNER_CLASSES)})" + (" or empl_class is null" if rule.null_class_ok else "")
    office_keys = "setid location state eff_status" if rule.location_status_in_key else "setid location"
    remote = "upper(descr) like '%REMOTE%'"
    usable = remote if rule.blank_address_ok else f"{remote} and address1 <> ' '"
    forms = " ".join(f"when '{code}' then '{label}'" for code, label in LEGAL_FORMS.items())
    columns = {
        "pf_corp": "pf_corp", "company": "company", "legal_name": "t2_legal_name", "dba_name": "' '",
        **{f"company_{c}": f"filed.{c}" for c in ("address1", "address2", "city", "state")}, "company_zip": "filed.postal",
        "naics": "naics", "federal_ein": "concat(' ', lpad(cast(pf_client_ein as string), 9, '0'))", "state_dol": "' '",
        "legal_status": f"case legal_type {forms} else '{LEGAL_FORM_DEFAULT}' end", "client_phone": "' '", "client_fax": "' '",
        "email_addr": "' '", "filing_descr": "office.descr",
        **{f"location_{c}": f"office.{c}" for c in ("address1", "address2", "city", "state")}, "location_zip": "office.postal",
        **{f"{kind}_{sex}": sex for kind in ("dbl", "pfl") for sex in ("males", "females")},
        "covered_annual_payroll": "cast(round(payroll, 0) as bigint)",
        "status": f"case when {cancelled} then 'CANCEL' else 'ADD' end", "status_date": effective,
        "cancel_reason": f"case when {cancelled} then 'Client\\'s Request' else ' ' end",
    }
    chosen = ", ".join(f"{columns[c]} as {c}" for c in f.RESULT.names if c != "ny_dbl_record_id")
    return f"""
with places as (
  select distinct location, descr, address1, address2, city, state, postal
  from {newest('ps_location_tbl', office_keys)} where setid = '{f.FILING_SETID}' and state = '{f.FILING_STATE}' and eff_status = 'A'),
staff as (
  select job.company, job.location, person.sex, job.annual_rt
  from {newest('ps_job', ' '.join(rule.job_key), sequence=True)} job
    join {newest('ps_pers_data_effdt', 'emplid')} person on person.emplid = job.emplid
    join places on places.location = job.location
  where job.empl_status in ({_listed(f.COUNTED_STATUSES)}) and job.paygroup <> '{f.ADVISOR_PAYGROUP}'
    and job.company <> '{f.TEST_COMPANY}' and job.emplid not like '{f.COBRA_PATTERN}' and ({owners})),
kinds as (
  select location, bool_or(not ({remote})) as office, bool_or({usable}) as remote from places group by location),
totals as (
  select company, cast(count_if(sex in ('M', 'U')) as int) as males, cast(count_if(sex = 'F') as int) as females,
    cast(sum(annual_rt) as decimal(20,3)) as payroll,
    coalesce(min(case when office then staff.location end), min(case when remote then staff.location end)) as filed_from
  from staff join kinds on kinds.location = staff.location group by company),
codes as (select distinct estabid, naics from {newest('ps_estab_tbl_usa', 'estabid')}),
filed as (
  select firm.company, firm.pf_corp, firm.address1, firm.address2, firm.city, firm.state, firm.postal, firm.pf_client_ein,
    firm.legal_type, deal.t2_legal_name, deal.t2_comp_term_dt, males, females, payroll, filed_from, naics
  from {newest('ps_company_tbl', 'company')} firm
    join (select * from {newest('ps_t2_cloptn_effdt', 'company pf_client')} {open_ones}) deal
      on deal.company = firm.company and deal.pf_client = firm.pf_client
    join totals on totals.company = firm.company join codes on codes.estabid = firm.company
  where firm.eff_status = 'A')
select {chosen} from filed join (select location, descr, address1, address2, city, state, postal from places) office
  on office.location = filed.filed_from"""


def register_filing_function(spark: SparkSession, tables: Tables, name: str = "disability_filing", variant: str = "commit") -> None:
    """Make ``name(policy_start date, effective date)`` a table function of the session; calling it again replaces it."""
    for table in TABLES:
        tables[table].createOrReplaceTempView(f"{name}_{table}")
    columns = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in f.RESULT.fields if c.name != "ny_dbl_record_id")
    spark.sql(
        f"create or replace temporary function {name}(policy_start date, effective date) returns table ({columns}) return {filing_text(name, variant)}"
    )
