"""The feeds' tables, derived from the driver's tables.

Each stand-in is one projection over one whole driver table, written as expressions that
Spark SQL and DuckDB read alike, so both engines start from the same rows. Everything after
that is written separately: grouped reductions and joins here, windows over whole tables in the oracles.
All values are invented from keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollkeep.functions.scalars import DIGITS, LEGAL_FORM_DEFAULT, LEGAL_FORMS, PHONE_DROPPED
from rollkeep.sources.ledger import EXCEPTION_VIEW, EXCEPTION_VIEW_COLUMNS
from rollkeep.sources.tables import scan

ASOF = "1998-06-01"
POLICY_START = "1998-01-01"
EFFECTIVE = "1999-06-01"

_O_DATE = "cast(o_orderdate as date)"
_C_COMPANY = "concat('K', lpad(cast(cast(floor(c_custkey / 15) as bigint) as string), 7, '0'))"
_C_CLIENT = "concat('P', cast(cast(floor(c_custkey / 15) as bigint) % 7 as string))"
_C_PERSON = "concat(case when c_custkey % 37 = 5 then 'C' else 'E' end, lpad(cast(c_custkey as string), 9, '0'))"
_O_PERSON = "concat(case when o_custkey % 37 = 5 then 'C' else 'E' end, lpad(cast(o_custkey as string), 9, '0'))"
_CITY = (
    "case when {k} % 19 = 3 then null when {k} % 5 = 1 then 'San Francisco' when {k} % 7 = 2 then 'sfo' "
    "when {k} % 7 = 3 then 'Sanford' else concat('Town ', cast({k} % 40 as string)) end"
)

_DEFINITION = EXCEPTION_VIEW_COLUMNS[EXCEPTION_VIEW_COLUMNS.index("file_definition_id") : EXCEPTION_VIEW_COLUMNS.index("file_instance_id")]
_DEFINITION = [c for c in _DEFINITION if c != "sys_period"]
_INSTANCE = EXCEPTION_VIEW_COLUMNS[EXCEPTION_VIEW_COLUMNS.index("file_instance_id") : EXCEPTION_VIEW_COLUMNS.index("file_instance_transfer_status_id")]
_TRANSFER = EXCEPTION_VIEW_COLUMNS[EXCEPTION_VIEW_COLUMNS.index("file_instance_transfer_status_id") :]


def _filler(column: str, key: str, later: bool) -> str:
    """An invented value of the column's type; a third of the rows have another one ``later``."""
    place = EXCEPTION_VIEW_COLUMNS.index(column)
    number = f"cast(({key} * {place + 3} + case when {int(later)} = 1 and {key} % 3 = 0 then 1 else 0 end) % 97 as int)"
    kind = EXCEPTION_VIEW[column].dataType.simpleString()
    return {
        "string": f"case when {number} % 11 = 5 then null else concat('{column} ', cast({number} as string)) end",
        "boolean": f"{number} % 2 = 0",
        "date": f"cast('1994-01-01' as date) + {number}",
        "timestamp": f"cast(cast('1994-01-01' as date) + {number} as timestamp)",
        "bigint": f"cast({number} as bigint)",
    }.get(kind, number)


# name -> (driver table, {column: expression})
STANDINS: dict[str, tuple[str, dict[str, str]]] = {
    # order rows as effective-dated rows of a person
    "staff": (
        "orders",
        {
            "emplid": "case when o_orderkey % 211 = 7 then null else o_custkey end",
            "effdt": f"case when o_orderkey % 97 = 3 then null else {_O_DATE} end",
            "effseq": "case when o_orderkey % 11 = 4 then null else cast(o_orderkey % 3 as int) end",
            "status": "o_orderstatus",
            "priority": "o_orderpriority",
            "amount": "cast(o_totalprice as decimal(20,3))",
            "row_id": "o_orderkey",
        },
    ),
    # the same rows with few days, so that dates tie
    "staff_ties": (
        "orders",
        {
            "emplid": "o_custkey",
            "effdt": f"{_O_DATE} - (cast(o_orderkey % 2 as int) + cast(extract(day from o_orderdate) as int))",
            "effseq": "case when o_orderkey % 5 = 4 then null else cast(o_orderkey % 3 as int) end",
            "status": "o_orderstatus",
            "row_id": "o_orderkey",
        },
    ),
    # order rows as assignments that may have ended
    "assignments": (
        "orders",
        {
            "employee_id": "case when o_orderkey % 501 = 9 then null else o_custkey end",
            "ended": f"case when o_orderstatus = 'F' or o_custkey % 3 = 0 then {_O_DATE} - cast(extract(day from o_orderdate) as int) end",
            "company_code": "case when o_orderkey % 23 = 5 then null else o_orderpriority end",
            "location_code": "case when o_orderkey % 29 = 6 then null else concat('L', cast(o_orderkey % 9 as string)) end",
            "row_id": "o_orderkey",
        },
    ),
    # feed A, first source
    "soemploc": (
        "orders",
        {
            "empl_id": "lpad(cast(o_custkey as string), 9, '0')",
            "client_id": "concat('K', lpad(cast(cast(floor(o_custkey / 15) as bigint) as string), 7, '0'))",
            "location_id": "concat('L', cast(o_orderkey % 4 as string))",
            "effective_date": _O_DATE,
            "expiry_date": f"{_O_DATE} + cast(400 + o_orderkey % 900 as int)",
            "primary_yn": "case when o_orderkey % 4 = 1 then 'N' else 'Y' end",
        },
    ),
    "sthclocra": (
        "customer",
        {
            "client_id": _C_COMPANY,
            "location_id": "concat('L', cast(c_custkey % 4 as string))",
            "postal_zip": "lpad(cast(c_custkey * 7 % 90000 as string), 5, '0')",
            "effective_date": "cast('1994-01-01' as date) + cast(c_custkey % 15 * 180 as int)",
            "expiry_date": "cast('1994-01-01' as date) + cast(c_custkey % 15 * 180 + 700 as int)",
        },
    ),
    "syemsad": (
        "customer",
        {
            "empl_id": "lpad(cast(c_custkey as string), 9, '0')",
            "soc_sec_num": "lpad(cast(c_custkey * 31 as string), 9, '0')",
            "last_name": "concat('Last', cast(c_custkey % 89 as string))",
            "first_name": "concat('First', cast(c_custkey % 53 as string))",
            "middle_name": "case when c_custkey % 6 = 1 then null else c_mktsegment end",
            "birthdate": "cast('1950-01-01' as date) + cast(c_custkey * 13 % 18000 as int)",
            "sex_id": "case when c_custkey % 2 = 0 then 'M' else 'F' end",
            "address1": "concat(cast(c_custkey as string), ' Main St')",
            "address2": "case when c_custkey % 3 = 0 then concat('Unit ', cast(c_custkey % 10 as string)) end",
            "city": "concat('Town ', cast(c_custkey % 40 as string))",
            "state": "case when c_nationkey % 2 = 0 then 'NY' else 'CA' end",
            "zip": "lpad(cast(c_custkey % 90000 as string), 5, '0')",
            "phone": "lpad(cast(c_custkey as string), 10, '5')",
            "country": "case when c_nationkey = 7 then 'CAN' when c_nationkey % 2 = 0 then 'US' else 'USA' end",
            "payroll_type": "concat('R', cast(c_custkey % 15 as string))",
        },
    ),
    "syclntr": (
        "customer",
        {
            "client_id": _C_COMPANY,
            "payroll_type": "concat('R', cast(c_custkey % 15 as string))",
            "termination_date": "case when c_custkey % 4 = 3 then cast('1998-01-01' as date) + cast(c_custkey % 400 as int) end",
            "term_reason_code": "case when c_custkey % 9 = 4 then null else concat('NATION_', cast(c_nationkey as string)) end",
        },
    ),
    "syempyr": (
        "customer",
        {
            "empl_id": "lpad(cast(c_custkey as string), 9, '0')",
            "orig_hire_date": "cast('1990-01-01' as date) + cast(c_custkey % 1500 as int)",
            "terminated": "case when c_custkey % 5 = 2 then cast('1998-01-01' as date) + cast(c_custkey % 330 as int) end",
            "term_reason_code": "case when c_custkey % 8 = 5 then null else concat('NATION_', cast(c_nationkey as string)) end",
            "empl_status": "case when c_custkey % 31 = 4 then 'C' when c_custkey % 4 = 0 then 'f' when c_custkey % 4 = 1 then 'Y' else 'F' end",
            "payroll_type": "concat('R', cast(c_custkey % 11 as string))",
        },
    ),
    "sthccdira": (
        "nation",
        {
            "code_key_1": "n_name",
            "code_type": "case when n_nationkey % 5 = 0 then 'SOI_MIG_WSE' when n_nationkey % 5 = 1 then 'SOI_TERM_WSE' else 'OTHER' end",
        },
    ),
    # the same list with a null among the codes in use
    "codes_with_null": (
        "nation",
        {
            "code_key_1": "case when n_nationkey = 10 then null else n_name end",
            "code_type": "case when n_nationkey % 5 = 0 then 'SOI_MIG_WSE' when n_nationkey % 5 = 1 then 'SOI_TERM_WSE' else 'OTHER' end",
        },
    ),
    # feeds A (second source) and B
    "ps_job": (
        "orders",
        {
            "emplid": _O_PERSON,
            "empl_rcd": "cast(o_orderkey % 2 as int)",
            "effdt": f"case when o_orderkey % 97 = 3 then null else {_O_DATE} end",
            "effseq": "case when o_orderkey % 41 = 4 then null else cast(o_orderkey % 3 as int) end",
            "company": "concat('K', lpad(cast(cast(floor(o_custkey / 15) as bigint) as string), 7, '0'))",
            "pf_client": "concat('P', cast(cast(floor(o_custkey / 15) as bigint) % 7 as string))",
            "empl_status": "case when o_orderkey % 5 = 0 then 'T' when o_orderkey % 7 = 0 then 'L' when o_orderkey % 7 = 1 then 'P' else 'A' end",
            "empl_class": "case when o_orderkey % 9 = 0 then null when o_orderkey % 13 = 0 then 'K1' when o_orderkey % 13 = 1 then 'U' else 'R' end",
            "full_part_time": "case when o_orderkey % 6 = 5 then 'P' else 'F' end",
            "reg_temp": "case when o_orderkey % 17 = 5 then 'T' else 'R' end",
            "std_hours": "cast(20 + o_orderkey % 25 as decimal(6,2))",
            "last_hire_dt": f"{_O_DATE} - 500",
            "termination_dt": f"case when o_orderkey % 5 = 0 then {_O_DATE} + 10 end",
            "tax_location_cd": "concat('X', cast(o_custkey % 200 as string))",
            "location": "concat('L', lpad(cast(cast(floor(o_custkey / 3) as bigint) as string), 7, '0'))",
            "paygroup": "case when o_orderkey % 43 = 8 then 'NP' else 'WK' end",
            "annual_rt": "cast(cast(floor(o_totalprice) as decimal(18,3)) + cast(0.5 as decimal(18,3)) as decimal(18,3))",
        },
    ),
    "ps_t2_cloptn_effdt": (
        "customer",
        {
            "company": _C_COMPANY,
            "pf_client": _C_CLIENT,
            "effdt": "cast('1995-01-01' as date) + cast(c_custkey % 15 * 150 as int)",
            "t2_peo_id": "case when floor(c_custkey / 15) % 6 = 2 then 'PAS' else 'SOI' end",
            "pf_corp": "case when floor(c_custkey / 15) % 10 = 3 then 'PEOCN' else concat('PEO', cast(c_nationkey as string)) end",
            "t2_legal_name": "concat(c_name, ', Inc.')",
            "t2_comp_term_dt": "case when cast(floor(c_custkey / 15) as bigint) % 3 = 1 then cast('1997-06-01' as date) + cast(c_custkey % 1000 as int) end",
        },
    ),
    "ps_names": (
        "orders",
        {
            "emplid": _O_PERSON,
            "name_type": "case when o_orderkey % 4 = 1 then 'PRF' else 'PRI' end",
            "effdt": f"{_O_DATE} + 200",
            "first_name": "concat('First', cast(o_orderkey % 53 as string))",
            "last_name": "concat('Last', cast(o_orderkey % 89 as string))",
            "middle_name": "case when o_orderkey % 6 = 1 then null else concat('M', cast(o_orderkey % 9 as string)) end",
        },
    ),
    "ps_person": (
        "customer",
        {"emplid": _C_PERSON, "birthdate": "cast('1950-01-01' as date) + cast(c_custkey * 13 % 18000 as int)"},
    ),
    "ps_addresses": (
        "orders",
        {
            "emplid": _O_PERSON,
            "address_type": "case when o_orderkey % 3 = 1 then 'MAIL' else 'HOME' end",
            "effdt": f"{_O_DATE} - 100",
            "eff_status": "case when o_orderkey % 11 = 4 then 'I' else 'A' end",
            "country": "case when o_orderkey % 23 = 4 then 'CAN' else 'USA' end",
            "address1": "concat(cast(o_orderkey % 999 as string), ' Side St')",
            "address2": "case when o_orderkey % 3 = 0 then concat('Apt ', cast(o_orderkey % 10 as string)) end",
            "city": _CITY.format(k="o_orderkey"),
            "state": "case when o_orderkey % 2 = 0 then 'NY' else 'CA' end",
            "postal": "lpad(cast(o_orderkey % 90000 as string), 5, '0')",
        },
    ),
    "ps_tax_location1": (
        "customer",
        {"tax_location_cd": "concat('X', cast(c_custkey as string))", "city": _CITY.format(k="c_custkey")},
    ),
    "ps_personal_phone": (
        "customer",
        {
            "emplid": _C_PERSON,
            "phone": "concat('(', lpad(cast(c_custkey as string), 3, '2'), ') 555-', lpad(cast(c_custkey * 3 as string), 4, '0'), ' x', chr(92), chr(34), c_mktsegment)",
            "pref_phone_flag": "case when c_custkey % 10 = 6 then 'N' else 'Y' end",
        },
    ),
    "ps_pers_nid": (
        "customer",
        {
            "emplid": _C_PERSON,
            "national_id": "lpad(cast(c_custkey * 31 as string), 9, '0')",
            "primary_nid": "case when c_custkey % 12 = 6 then 'N' else 'Y' end",
        },
    ),
    "ps_pers_data_effdt": (
        "customer",
        {
            "emplid": _C_PERSON,
            "effdt": "cast('1994-01-01' as date) + cast(c_custkey % 800 as int)",
            "sex": "case when c_custkey % 13 = 5 then null when c_custkey % 13 = 6 then '' when c_custkey % 13 = 7 then 'U' "
            "when c_custkey % 2 = 0 then 'M' else 'F' end",
        },
    ),
    "ps_location_tbl": (
        "part",
        {
            "setid": "case when p_partkey % 50 = 17 then 'OTHER' else 'USPEO' end",
            "location": "concat('L', lpad(cast(cast(floor(p_partkey / 4) as bigint) as string), 7, '0'))",
            "descr": "case when p_partkey % 21 = 4 then null when floor(p_partkey / 4) % 3 = 1 then concat('Remote ', p_name) else concat('Office ', p_name) end",
            "address1": "case when p_partkey % 8 = 5 then ' ' else concat(cast(p_partkey as string), ' Wall St') end",
            "address2": "case when p_partkey % 5 = 1 then p_brand end",
            "city": "concat('City ', cast(p_size as string))",
            "state": "case when floor(p_partkey / 4) % 5 = 3 then 'NJ' else 'NY' end",
            "postal": "lpad(cast(p_partkey % 90000 as string), 5, '1')",
            "eff_status": "case when p_partkey % 9 = 7 then 'I' else 'A' end",
            "effdt": "cast('1995-01-01' as date) + cast(p_partkey % 4 * 600 as int)",
        },
    ),
    "ps_estab_tbl_usa": (
        "customer",
        {
            "estabid": _C_COMPANY,
            "naics": "lpad(cast(c_custkey * 17 % 900000 as string), 6, '4')",
            "effdt": "cast('1995-01-01' as date) + cast(floor(c_custkey % 15 / 2) * 300 as int)",
        },
    ),
    "ps_company_tbl": (
        "customer",
        {
            "company": _C_COMPANY,
            "pf_client": _C_CLIENT,
            "pf_corp": "concat('PEO', cast(c_nationkey as string))",
            "address1": "concat(cast(c_custkey as string), ' Main St')",
            "address2": "case when c_custkey % 3 = 0 then concat('Suite ', cast(c_custkey % 10 as string)) end",
            "city": "concat('Town ', cast(c_nationkey as string))",
            "state": "case when c_nationkey % 3 = 0 then 'NJ' else 'NY' end",
            "postal": "lpad(cast(c_custkey % 90000 as string), 5, '2')",
            "legal_type": "lpad(cast(c_custkey % 17 as string), 2, '0')",
            "eff_status": "case when c_custkey % 13 = 4 then 'I' else 'A' end",
            "effdt": "cast('1995-01-01' as date) + cast(c_custkey % 15 * 250 as int)",
            "pf_client_ein": "c_custkey * 7919",
        },
    ),
    # feed C: members and coverages
    "subscribers": (
        "customer",
        {
            "subscriber_id": "lpad(cast(c_custkey as string), 9, '0')",
            "member_seq": "0",
            "is_subscriber": "'Y'",
            "relationship": "'18'",
            "maintenance_type": "'030'",
            "maintenance_reason": "'XN'",
            "benefit_status": "case when c_custkey % 90 = 1 then 'C' else 'A' end",
            "employment_status": "case when c_custkey % 83 = 7 then null when c_custkey % 9 = 2 then 'TE' when c_custkey % 70 = 3 then 'L1' else 'FT' end",
            "student_status": "cast(null as string)",
            "member_code": "'00'",
            "last_name": "concat('Last', cast(c_custkey % 89 as string))",
            "first_name": "concat('First', cast(c_custkey % 53 as string))",
            "middle_name": "case when c_custkey % 4 = 1 then substr(c_mktsegment, 1, 1) end",
            "national_id": "lpad(cast(c_custkey * 31 as string), 9, '0')",
            "phone": "case when c_custkey % 3 > 0 then lpad(cast(c_custkey as string), 10, '5') end",
            "address1": "case when c_custkey % 17 <> 5 then concat(cast(c_custkey as string), ' Main St') end",
            "address2": "case when c_custkey % 17 <> 5 and c_custkey % 5 = 1 then concat('Unit ', cast(c_custkey % 10 as string)) end",
            "city": "concat('Town ', cast(c_nationkey as string))",
            "state": "case when c_custkey % 97 = 3 then 'NYS' when c_nationkey % 2 = 0 then 'NY' else 'CA' end",
            "postal": "lpad(cast(c_custkey % 90000 as string), 5, '0')",
            "birth_date": "cast('1950-01-01' as date) + cast(c_custkey * 13 % 18000 as int)",
            "sex": "case when c_custkey % 2 = 0 then 'M' else 'F' end",
            "maintenance_date": "case when c_custkey % 2 = 1 then cast('2020-01-01' as date) + cast(c_custkey % 300 as int) end",
        },
    ),
    "dependents": (
        "orders",
        {
            "subscriber_id": "lpad(cast(o_custkey as string), 9, '0')",
            "member_seq": "cast(o_orderkey + 1 as int)",
            "is_subscriber": "'N'",
            "relationship": "case when o_orderkey % 4 = 1 then '01' when o_orderkey % 90 = 3 then '53' else '19' end",
            "maintenance_type": "'030'",
            "maintenance_reason": "'XN'",
            "benefit_status": "case when o_orderkey % 300 = 1 then 'C' else 'A' end",
            "employment_status": "cast(null as string)",
            "student_status": "case when o_orderkey % 701 = 5 then 'U' when o_orderkey % 30 = 2 then 'F' when o_orderkey % 30 = 3 then 'P' else 'N' end",
            "member_code": "lpad(cast(o_orderkey % 100 as string), 2, '0')",
            "last_name": "concat('Last', cast(o_custkey % 89 as string))",
            "first_name": "concat('First', cast(o_orderkey % 53 as string))",
            "middle_name": "case when o_orderkey % 4 = 1 then 'Q' end",
            "national_id": "case when o_orderkey % 50 <> 7 then lpad(cast(o_orderkey * 17 % 900000000 as string), 9, '0') end",
            "phone": "cast(null as string)",
            "address1": "cast(null as string)",
            "address2": "cast(null as string)",
            "city": "case when o_orderkey % 1009 = 11 then 'Far Town' end",
            "state": "case when o_orderkey % 1009 = 11 then 'FARST' end",
            "postal": "cast(null as string)",
            "birth_date": "cast('1990-01-01' as date) + cast(o_orderkey * 7 % 9000 as int)",
            "sex": "case when o_orderkey % 2 = 0 then 'M' else 'F' end",
            "maintenance_date": "cast(null as date)",
        },
    ),
    "covers_own": (
        "customer",
        {
            "subscriber_id": "lpad(cast(c_custkey as string), 9, '0')",
            "member_seq": "0",
            "coverage_seq": "1",
            "maintenance_type": "'030'",
            "insurance_line": "'VIS'",
            "plan": "cast(null as string)",
            "coverage_level": "case when c_custkey % 3 = 0 then 'EMP' when c_custkey % 3 = 1 then 'FAM' else 'ECH' end",
            "benefit_begin": "cast('2019-01-01' as date) + cast(c_custkey % 300 as int)",
            "benefit_end": "case when c_custkey % 25 = 3 then cast('2020-01-01' as date) + cast(c_custkey % 90 as int) end",
        },
    ),
    "covers_second": (
        "supplier",
        {
            "subscriber_id": "lpad(cast(s_suppkey as string), 9, '0')",
            "member_seq": "0",
            "coverage_seq": "2",
            "maintenance_type": "'030'",
            "insurance_line": "'PPO'",
            "plan": "concat('PLAN', cast(s_nationkey as string))",
            "coverage_level": "'EMP'",
            "benefit_begin": "cast('2019-06-01' as date)",
            "benefit_end": "cast(null as date)",
        },
    ),
    "covers_dependents": (
        "orders",
        {
            "subscriber_id": "lpad(cast(o_custkey as string), 9, '0')",
            "member_seq": "cast(o_orderkey + 1 as int)",
            "coverage_seq": "1",
            "maintenance_type": "'030'",
            "insurance_line": "'VIS'",
            "plan": "cast(null as string)",
            "coverage_level": "case when o_custkey % 3 = 1 then 'FAM' else 'ECH' end",
            "benefit_begin": "cast('2019-01-01' as date) + cast(o_orderkey % 300 as int)",
            "benefit_end": "case when o_orderkey % 60 = 3 then cast('2020-01-01' as date) + cast(o_orderkey % 90 as int) end",
        },
    ),
    # feed C: the run ledger
    "file_definition": (
        "nation",
        {
            "file_definition_id": "n_nationkey",
            "vendor_id": "n_regionkey",
            "file_definition_name": "concat(case when n_nationkey % 3 = 1 then 'Vision ' else 'Dental ' end, n_name, ' 834')",
            "status": "case when n_nationkey % 7 = 5 then 'inactive' else 'active' end",
            "members_per_transaction_set_soft_limit": "990",
            "member_term_limit": "3",
        },
    ),
    # the same definitions with all their columns, as they are taken over at first and later
    **{
        name: ("nation", {"file_definition_id": "n_nationkey"} | {c: _filler(c, "n_nationkey", later) for c in _DEFINITION if c != "file_definition_id"})
        for name, later in (("definition_first", False), ("definition_later", True))
    },
    "whole_instance": (
        "orders",
        {
            "file_instance_id": "o_orderkey",
            "file_definition_id": "cast(o_custkey % 25 as int)",
            "file_instance_start_time": f"cast({_O_DATE} as timestamp)",
        }
        | {c: _filler(c, "o_orderkey", False) for c in _INSTANCE if c not in ("file_instance_id", "file_instance_start_time")},
    ),
    "whole_transfer": (
        "customer",
        {"file_instance_id": "c_custkey * 3"} | {c: _filler(c, "c_custkey", False) for c in _TRANSFER},
    ),
    "file_instance": (
        "orders",
        {
            "file_instance_id": "o_orderkey",
            "file_definition_id": "cast(o_custkey % 25 as int)",
            "file_instance_start_time": "o_orderdate",
            "file_instance_status": "case when o_orderstatus = 'F' then 'failed' else 'sent' end",
            "file_name": "concat('run-', cast(o_orderkey as string), '.x12')",
        },
    ),
    "file_event": (
        "lineitem",
        {
            "file_instance_id": "l_orderkey",
            "event_time": "cast(l_shipdate as date)",
            "event_no": "l_linenumber",
            "file_instance_status": "case when l_linestatus = 'O' then 'started' when l_returnflag = 'R' then 'failed' else 'sent' end",
        },
    ),
    "file_transfer": (
        "customer",
        {
            "file_instance_id": "c_custkey * 3",
            "file_instance_transfer_status_id": "c_custkey",
            "file_instance_transfer_status": "case when c_nationkey % 2 = 0 then 'sent' else 'failed' end",
            "return_code": "c_nationkey",
        },
    ),
    "file_exception": (
        "lineitem",
        {
            "file_instance_id": "l_orderkey",
            "file_record_id": "l_partkey",
            "exception_type": "'ERROR'",
            "category": "'DATA ELEMENT'",
            "sub_category": "case when l_returnflag = 'R' then 'Illegal element value.' when l_returnflag = 'A' then 'Invalid element length.' else 'Missing required element.' end",
            "detail": "concat('Element ', cast(l_linenumber as string))",
            "subscriber_id": "lpad(cast(l_suppkey as string), 9, '0')",
            "member_id": "lpad(cast(l_linenumber as string), 2, '0')",
        },
    ),
}


def _derived(source: DataFrame, name: str) -> DataFrame:
    return source.selectExpr(*[f"{text} as {column}" for column, text in STANDINS[name][1].items()])


def standin(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _derived(scan(spark, folder, STANDINS[name][0]), name)


def standins(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Several stand-ins; each driver table's footer is read once."""
    sources = {source: scan(spark, folder, source) for source in {STANDINS[name][0] for name in names}}
    return {name: _derived(sources[STANDINS[name][0]], name) for name in names}


def standin_sql(name: str) -> str:
    source, columns = STANDINS[name]
    return "select " + ", ".join(f"{text} as {column}" for column, text in columns.items()) + f" from {source}"


def with_standins(names: list[str], body: str, more: str = "") -> str:
    """Oracle text: the stand-ins as common table expressions, then ``more`` ones, then the query."""
    parts = [f"{name} as ({standin_sql(name)})" for name in names]
    if more.strip():
        parts.append(more.strip())
    return "with " + ",\n".join(parts) + "\n" + body.strip()


# --- pieces of oracle text ------------------------------------------------------------------


def newest(table: str, keys: str, counted: str | None = None, sequence: bool = False) -> str:
    """Rows of the newest date of each key, as a subquery with windows. ``counted`` limits the rows whose dates count.

    A row with an unknown key has no newest date. With ``sequence`` only the highest sequence of that date stays.
    """
    columns = keys.split()
    by, known = ", ".join(columns), " and ".join(f"{c} is not null" for c in columns)
    limit = f" filter (where {counted})" if counted else ""
    rows = f"select * from {table} where {known} qualify effdt = max(effdt){limit} over (partition by {by})"
    if sequence:
        rows = f"select * from ({rows}) qualify effseq = max(effseq) over (partition by {by})"
    return f"({rows})"


def legal_form(column: str) -> str:
    cases = " ".join(f"when '{code}' then '{form}'" for code, form in LEGAL_FORMS.items())
    return f"case {column} {cases} else '{LEGAL_FORM_DEFAULT}' end"


def phone_digits(column: str) -> str:
    listed = (DIGITS + PHONE_DROPPED).replace("'", "''")
    return f"translate({column}, '{listed}', '{DIGITS}')"


def out_of_town(column: str) -> str:
    """Not in the city with its own rules; an unknown city is elsewhere."""
    return f"coalesce(not (upper({column}) like 'SAN%FRAN%' or upper({column}) = 'SFO'), true)"
