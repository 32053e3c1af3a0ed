"""Queries over effective-dated selection, de-duplication, predicates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollkeep.checks.registry import query
from rollkeep.checks.standins import ASOF, EFFECTIVE, POLICY_START, newest, out_of_town, standin, with_standins
from rollkeep.functions import predicates as p
from rollkeep.operators import joins
from rollkeep.operators.asof import conditional_as_of, latest_as_of
from rollkeep.operators.dedupe import keep_best
from rollkeep.operators.sets import union_distinct
from rollkeep.sources.tables import scan

_STAFF = "select s.emplid, s.effdt, s.effseq, s.status, s.priority, s.amount, s.row_id from staff s "
_DAY = f"cast('{ASOF}' as date)"


# --- as-of -------------------------------------------------------------------------------


@query(
    with_standins(
        ["staff"],
        _STAFF + f"where s.effdt = (select max(m.effdt) from staff m where m.emplid = s.emplid and m.effdt <= {_DAY})",
    )
)
def asof_latest(spark, sf_dir):
    return latest_as_of(standin(spark, sf_dir, "staff"), ["emplid"], "effdt", ASOF)


@query(
    with_standins(
        ["staff_ties"],
        f"""select s.emplid, s.effdt, s.effseq, s.status, s.row_id from staff_ties s
        where s.effdt = (select max(m.effdt) from staff_ties m where m.emplid = s.emplid and m.effdt <= {_DAY})
        and s.effseq = (select max(m.effseq) from staff_ties m where m.emplid = s.emplid and m.effdt = s.effdt)""",
    )
)
def asof_seq(spark, sf_dir):
    return latest_as_of(standin(spark, sf_dir, "staff_ties"), ["emplid"], "effdt", ASOF, seq="effseq")


@query(
    with_standins(
        ["staff"],
        _STAFF
        + f"""where s.effdt = (select max(m.effdt) from staff m
        where m.emplid = s.emplid and m.priority = s.priority and m.effdt <= {_DAY})""",
    )
)
def asof_composite(spark, sf_dir):
    return latest_as_of(standin(spark, sf_dir, "staff"), ["emplid", "priority"], "effdt", ASOF)


@query(
    with_standins(
        ["staff"], _STAFF + "where s.effdt = (select max(m.effdt) from staff m where m.emplid = s.emplid)"
    )
)
def asof_unbounded(spark, sf_dir):
    return latest_as_of(standin(spark, sf_dir, "staff"), ["emplid"], "effdt")


@query(
    with_standins(
        ["staff"],
        _STAFF
        + f"""where s.status = 'F'
        and s.effdt = (select max(m.effdt) from staff m where m.emplid = s.emplid and m.effdt <= {_DAY})""",
    )
)
def asof_status_outside(spark, sf_dir):
    staff = standin(spark, sf_dir, "staff")
    return latest_as_of(staff, ["emplid"], "effdt", ASOF, status="status", status_value="F")


@query(
    with_standins(
        ["staff"],
        _STAFF
        + f"""where s.status = 'F' and s.effdt = (select max(m.effdt) from staff m
        where m.emplid = s.emplid and m.status = s.status and m.effdt <= {_DAY})""",
    )
)
def asof_status_inside(spark, sf_dir):
    staff = standin(spark, sf_dir, "staff")
    return latest_as_of(
        staff, ["emplid"], "effdt", ASOF, status="status", status_value="F", status_in_key=True
    )


@query(
    with_standins(
        ["staff"],
        _STAFF
        + """where s.effdt = (select max(m.effdt) from staff m
        where m.emplid = s.emplid and m.amount between 100000 and 200000)
        and s.effseq = (select max(m.effseq) from staff m where m.emplid = s.emplid and m.effdt = s.effdt)""",
    )
)
def asof_conditional(spark, sf_dir):
    staff = standin(spark, sf_dir, "staff")
    return conditional_as_of(staff, ["emplid"], "effdt", "effseq", F.col("amount").between(100000, 200000))


@query(
    with_standins(
        ["staff"],
        _STAFF
        + f"""where s.effdt = (select max(m.effdt) from staff m where m.emplid = s.emplid
        and m.status = s.status and m.priority = s.priority and m.effdt <= {_DAY})
        and s.effseq = (select max(m.effseq) from staff m where m.emplid = s.emplid
        and m.status = s.status and m.priority = s.priority and m.effdt = s.effdt)""",
    )
)
def asof_wide_key(spark, sf_dir):
    staff = standin(spark, sf_dir, "staff")
    return latest_as_of(staff, ["emplid", "status", "priority"], "effdt", ASOF, seq="effseq")


@query(
    with_standins(
        ["ps_company_tbl"],
        f"""select c.company, c.pf_client, c.effdt, c.eff_status, c.legal_type from ps_company_tbl c
        where c.eff_status = 'A' and c.effdt = (select max(m.effdt) from ps_company_tbl m
        where m.company = c.company and m.effdt <= {_DAY})""",
    )
)
def asof_company(spark, sf_dir):
    rows = latest_as_of(
        standin(spark, sf_dir, "ps_company_tbl"), ["company"], "effdt", ASOF, status="eff_status", status_value="A"
    )
    return rows.select("company", "pf_client", "effdt", "eff_status", "legal_type")


@query(
    with_standins(
        ["ps_estab_tbl_usa"],
        f"""select distinct e.estabid, e.naics, e.effdt from ps_estab_tbl_usa e
        where e.effdt = (select max(m.effdt) from ps_estab_tbl_usa m
        where m.estabid = e.estabid and m.effdt <= {_DAY})""",
    )
)
def asof_establishment(spark, sf_dir):
    return latest_as_of(standin(spark, sf_dir, "ps_estab_tbl_usa"), ["estabid"], "effdt", ASOF).distinct()


# --- de-duplication ----------------------------------------------------------------------

_CASCADE = """
r1 as (select a.* from assignments a where not (a.ended is not null and a.employee_id is not null and exists (
    select 1 from assignments b where b.employee_id = a.employee_id and b.ended is null))),
r2 as (select a.* from r1 a where a.employee_id is null or coalesce(
    a.ended = (select max(b.ended) from r1 b where b.employee_id = a.employee_id), true)),
r3 as (select a.* from r2 a where a.employee_id is null or coalesce(
    a.company_code = (select min(b.company_code) from r2 b where b.employee_id = a.employee_id), true)),
r4 as (select a.* from r3 a where a.employee_id is null or coalesce(
    a.location_code = (select min(b.location_code) from r3 b where b.employee_id = a.employee_id), true))"""


@query(
    with_standins(
        ["assignments"], "select employee_id, ended, company_code, location_code, row_id from r4", _CASCADE
    )
)
def dedupe_cascade(spark, sf_dir):
    rows = standin(spark, sf_dir, "assignments")
    return keep_best(rows, "employee_id", "ended", ["company_code", "location_code"])


# --- predicates --------------------------------------------------------------------------


@query(
    with_standins(
        ["ps_job"],
        """select emplid, empl_rcd, empl_status, empl_class, std_hours, paygroup from ps_job
        where empl_status in ('A','L','P','S') and (empl_class not in ('K1','K1E','K1D') or empl_class is null)
        and paygroup <> 'NP' and cast(std_hours as double) >= 30""",
    )
)
def null_safe_filter(spark, sf_dir):
    job = standin(spark, sf_dir, "ps_job")
    return job.where(
        p.in_list("empl_status", ["A", "L", "P", "S"])
        & p.not_in_or_null("empl_class", ["K1", "K1E", "K1D"])
        & (F.col("paygroup") != "NP")
        & (F.col("std_hours").cast("double") >= 30)
    ).select("emplid", "empl_rcd", "empl_status", "empl_class", "std_hours", "paygroup")


@query(
    with_standins(
        ["ps_job"],
        "select emplid, empl_rcd, empl_class from ps_job where empl_class not in ('K1','K1E','K1D')",
    )
)
def null_losing_filter(spark, sf_dir):
    job = standin(spark, sf_dir, "ps_job")
    return job.where(p.not_in("empl_class", ["K1", "K1E", "K1D"])).select("emplid", "empl_rcd", "empl_class")


@query(
    with_standins(
        ["ps_job", "ps_location_tbl"],
        """select 'job' as source, emplid as code from ps_job where emplid not like 'C%'
        union all select 'place', location from ps_location_tbl where upper(descr) like '%REMOTE%'
        union all select 'office', location from ps_location_tbl where upper(descr) not like '%REMOTE%'""",
    )
)
def like_filter(spark, sf_dir):
    job = standin(spark, sf_dir, "ps_job")
    place = standin(spark, sf_dir, "ps_location_tbl")
    pattern = "%REMOTE%"
    return (
        job.where(p.like("emplid", "C%", negate=True))
        .select(F.lit("job").alias("source"), F.col("emplid").alias("code"))
        .unionAll(place.where(p.like("descr", pattern, fold_case=True)).select(F.lit("place"), "location"))
        .unionAll(
            place.where(p.like("descr", pattern, negate=True, fold_case=True)).select(F.lit("office"), "location")
        )
    )


@query(
    with_standins(
        ["ps_addresses"],
        """select emplid, effdt, city from ps_addresses
        where """ + out_of_town("city"),
    )
)
def city_ok(spark, sf_dir):
    rows = standin(spark, sf_dir, "ps_addresses")
    return rows.where(p.city_ok("city", ["SAN%FRAN%"], ["SFO"])).select("emplid", "effdt", "city")


def _open_or_closed_sql(codes: str) -> str:
    return with_standins(
        ["syempyr", codes],
        f"""select empl_id, terminated, term_reason_code from syempyr
        where terminated is null or ((terminated >= cast('1998-02-01' as date) and terminated <= cast('1998-09-30' as date))
        and term_reason_code not in (select code_key_1 from {codes} where code_type in ('SOI_MIG_WSE','SOI_TERM_WSE')))""",
    )


def _open_or_closed(spark, sf_dir, codes):
    people = standin(spark, sf_dir, "syempyr").select("empl_id", "terminated", "term_reason_code")
    listed = standin(spark, sf_dir, codes).where(p.in_list("code_type", ["SOI_MIG_WSE", "SOI_TERM_WSE"]))
    flagged = joins.not_in_flag(people, "term_reason_code", listed, "code_key_1", "allowed")
    rule = p.open_or_closed_in("terminated", "1998-02-01", "1998-09-30", F.col("allowed"))
    return flagged.where(rule).drop("allowed")


@query(_open_or_closed_sql("sthccdira"))
def open_or_closed(spark, sf_dir):
    return _open_or_closed(spark, sf_dir, "sthccdira")


@query(_open_or_closed_sql("codes_with_null"))
def open_or_closed_null_in_list(spark, sf_dir):
    return _open_or_closed(spark, sf_dir, "codes_with_null")


@query(
    with_standins(
        ["syempyr", "sthccdira"],
        """select empl_id, term_reason_code from syempyr
        where term_reason_code not in (select code_key_1 from sthccdira where code_type = 'OTHER')""",
    )
)
def null_aware_not_in(spark, sf_dir):
    people = standin(spark, sf_dir, "syempyr").select("empl_id", "term_reason_code")
    codes = standin(spark, sf_dir, "sthccdira").where("code_type = 'OTHER'")
    return joins.null_aware_not_in(people, "term_reason_code", codes, "code_key_1")


@query(
    with_standins(
        ["ps_job"],
        f"""select emplid, effdt, termination_dt from ps_job
        where termination_dt between {_DAY} - 36 and {_DAY} - 1""",
    )
)
def trailing_days(spark, sf_dir):
    job = standin(spark, sf_dir, "ps_job")
    return job.where(p.trailing_days("termination_dt", ASOF)).select("emplid", "effdt", "termination_dt")


@query(
    with_standins(
        ["ps_t2_cloptn_effdt"],
        f"""select company, effdt, t2_comp_term_dt from ps_t2_cloptn_effdt
        where effdt <= cast('{EFFECTIVE}' as date)
        and (t2_comp_term_dt is null or t2_comp_term_dt > cast('{POLICY_START}' as date))""",
    )
)
def term_after(spark, sf_dir):
    rows = standin(spark, sf_dir, "ps_t2_cloptn_effdt")
    return rows.where(p.cutoff("effdt", EFFECTIVE) & p.term_after("t2_comp_term_dt", POLICY_START)).select(
        "company", "effdt", "t2_comp_term_dt"
    )


# --- joins -------------------------------------------------------------------------------


@query(
    with_standins(
        ["soemploc", "sthclocra", "syempyr"],
        f"""select e.empl_id, e.client_id, e.location_id, y.terminated, l.postal_zip
        from soemploc e join syempyr y on y.empl_id = e.empl_id
        join sthclocra l on l.client_id = e.client_id and l.location_id = e.location_id
        where case when y.terminated is null then {_DAY} else y.terminated end between e.effective_date and e.expiry_date
        and case when y.terminated is null then {_DAY} else y.terminated end between l.effective_date and l.expiry_date""",
    )
)
def interval_join(spark, sf_dir):
    people = standin(spark, sf_dir, "syempyr").select("empl_id", "terminated")
    places = standin(spark, sf_dir, "soemploc").select(
        "empl_id", "client_id", "location_id", "effective_date", "expiry_date"
    )
    zips = standin(spark, sf_dir, "sthclocra")
    at = F.coalesce("terminated", p.as_date(ASOF))
    span = ("1998-01-01", "1998-12-31")  # the as-of date and all end dates lie in it
    placed = joins.valid_at(people, places, ["empl_id"], at, "effective_date", "expiry_date", within=span).drop(
        "effective_date", "expiry_date"
    )
    zipped = joins.valid_at(
        placed, zips, ["client_id", "location_id"], at, "effective_date", "expiry_date", within=span, bucket_days=90
    )
    return zipped.select("empl_id", "client_id", "location_id", "terminated", "postal_zip")


@query(
    """select o.o_orderkey, l.l_linenumber, cast(l.l_shipdate as date) as shipped, o.o_orderpriority
    from orders o join lineitem l on l.l_orderkey = o.o_orderkey
    where cast(l.l_shipdate as date) between cast(o.o_orderdate as date) and cast(o.o_orderdate as date) + 30"""
)
def interval_join_facts(spark, sf_dir):
    lines = scan(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped")
    )
    day = F.col("o_orderdate").cast("date")
    orders = scan(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", day.alias("lo"), F.date_add(day, 30).alias("hi")
    )
    found = joins.valid_at(lines, orders, {"l_orderkey": "o_orderkey"}, "shipped", "lo", "hi")
    return found.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "shipped", "o_orderpriority")


def _nested_sql(connector: str) -> str:
    current = newest("ps_addresses", "emplid address_type", f"effdt <= {_DAY}")
    home = f"""select emplid from {current} where (eff_status, address_type, country) = ('A', 'HOME', 'USA')
        and coalesce(upper(city) <> 'SFO', true)"""
    taxed = "select t.tax_location_cd from ps_tax_location1 t where upper(t.city) not like 'SAN%' or t.city is null"
    return with_standins(
        ["ps_job", "ps_addresses", "ps_tax_location1"],
        f"""select emplid, empl_rcd, effdt, tax_location_cd from ps_job
        where emplid in ({home}) {connector} tax_location_cd in ({taxed})""",
    )


def _nested(spark, sf_dir, mode):
    job = standin(spark, sf_dir, "ps_job").select("emplid", "empl_rcd", "effdt", "tax_location_cd")
    current = latest_as_of(
        standin(spark, sf_dir, "ps_addresses"),
        ["emplid", "address_type"],
        "effdt",
        ASOF,
        status="eff_status",
        status_value="A",
    )
    home = current.where(
        (F.col("address_type") == "HOME") & p.in_list("country", ["USA"]) & p.city_ok("city", [], ["SFO"])
    )
    taxed = standin(spark, sf_dir, "ps_tax_location1").where(p.city_ok("city", ["SAN%"], []))
    return joins.in_keys(job, [(home, ["emplid"]), (taxed, ["tax_location_cd"])], mode)


@query(_nested_sql("and"))
def semi_nested_and(spark, sf_dir):
    return _nested(spark, sf_dir, "and")


@query(_nested_sql("or"))
def semi_nested_or(spark, sf_dir):
    return _nested(spark, sf_dir, "or")


@query(
    with_standins(
        ["ps_person", "ps_personal_phone", "ps_pers_nid", "ps_pers_data_effdt"],
        f"""select emplid, national_id, phone, sex from ps_person
        left join (select emplid, national_id from ps_pers_nid where primary_nid = 'Y') using (emplid)
        left join (select emplid, phone from ps_personal_phone where pref_phone_flag = 'Y') using (emplid)
        left join (select emplid, sex from {newest('ps_pers_data_effdt', 'emplid', f'effdt <= {_DAY}')}) using (emplid)""",
    )
)
def scalar_lookup(spark, sf_dir):
    people = standin(spark, sf_dir, "ps_person").select("emplid")
    nid = standin(spark, sf_dir, "ps_pers_nid").where("primary_nid = 'Y'")
    phone = standin(spark, sf_dir, "ps_personal_phone").where("pref_phone_flag = 'Y'")
    data = standin(spark, sf_dir, "ps_pers_data_effdt")
    found = joins.lookup_one(people, nid, ["emplid"], "national_id", "national_id")
    found = joins.lookup_one(found, phone, ["emplid"], "phone", "phone")
    return joins.lookup_as_of(found, data, ["emplid"], "sex", "sex", "effdt", ASOF)


@query(
    with_standins(
        ["ps_job", "ps_t2_cloptn_effdt", "ps_person"],
        f"""select emplid, empl_rcd, job.effdt, company, pf_corp, birthdate
        from ps_job job join ps_person using (emplid)
        join {newest('ps_t2_cloptn_effdt', 'company pf_client', f'effdt <= {_DAY}')} option using (company, pf_client)
        where pf_corp <> 'PEOCN' and t2_peo_id = 'SOI'""",
    )
)
def dimension_join(spark, sf_dir):
    job = standin(spark, sf_dir, "ps_job").select("emplid", "empl_rcd", "effdt", "company", "pf_client")
    option = latest_as_of(standin(spark, sf_dir, "ps_t2_cloptn_effdt"), ["company", "pf_client"], "effdt", ASOF)
    option = option.where("t2_peo_id = 'SOI' and pf_corp <> 'PEOCN'").select("company", "pf_client", "pf_corp")
    person = standin(spark, sf_dir, "ps_person")
    found = joins.inner(joins.inner(job, option, ["company", "pf_client"]), person, ["emplid"])
    return found.select("emplid", "empl_rcd", "effdt", "company", "pf_corp", "birthdate")


# both roles take home addresses
_HOMES = f"""(select emplid, address1, city, postal from {newest('ps_addresses', 'emplid address_type', f'effdt <= {_DAY}')}
          where (address_type, eff_status) = ('HOME', 'A'))"""


@query(
    with_standins(
        ["ps_person", "ps_addresses"],
        f"""select emplid, home.address1, home.city, home.postal as home_postal, role.postal as work_postal
        from ps_person join {_HOMES} home using (emplid) join {_HOMES} role using (emplid)""",
    )
)
def address_roles(spark, sf_dir):
    people = standin(spark, sf_dir, "ps_person").select("emplid")
    current = latest_as_of(
        standin(spark, sf_dir, "ps_addresses"),
        ["emplid", "address_type"],
        "effdt",
        ASOF,
        status="eff_status",
        status_value="A",
    )
    columns = ["address1", "city", F.col("postal").alias("home_postal")]
    return joins.address_roles(people, current, "emplid", columns)


@query(
    with_standins(
        ["ps_estab_tbl_usa", "ps_job"],
        """select distinct estabid, naics from ps_estab_tbl_usa
        where estabid in (select company from ps_job where empl_status = 'L')""",
    )
)
def restricted_dimension(spark, sf_dir):
    counted = standin(spark, sf_dir, "ps_job").where("empl_status = 'L'")
    dim = standin(spark, sf_dir, "ps_estab_tbl_usa")
    return joins.restrict_dim(dim, counted, {"estabid": "company"}, ["estabid", "naics"])


@query(
    """select c.c_custkey, c.c_name from customer c where not exists (
    select 1 from orders o join lineitem l on l.l_orderkey = o.o_orderkey
    where o.o_custkey = c.c_custkey and l.l_returnflag = 'R')"""
)
def not_exists_with_join(spark, sf_dir):
    customer = scan(spark, sf_dir, "customer").select("c_custkey", "c_name")
    returned = joins.semi(
        scan(spark, sf_dir, "orders"),
        scan(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"),
        {"o_orderkey": "l_orderkey"},
    )
    return joins.anti(customer, returned, {"c_custkey": "o_custkey"})


# --- set operations ----------------------------------------------------------------------


@query(
    """select o_custkey, o_orderpriority from orders where o_orderstatus = 'F' and o_totalprice > 250000
    union select o_custkey, o_orderpriority from orders where o_orderstatus = 'O'
    union select o_custkey, o_orderpriority from orders where o_totalprice < 60000"""
)
def union_three(spark, sf_dir):
    orders = scan(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderpriority"]
    return union_distinct(
        orders.where("o_orderstatus = 'F' and o_totalprice > 250000").select(*columns),
        orders.where("o_orderstatus = 'O'").select(*columns),
        orders.where("o_totalprice < 60000").select(*columns),
    )
