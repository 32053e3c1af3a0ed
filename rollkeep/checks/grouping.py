"""Queries over aggregation, ordering, scalar functions and layouts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeep.checks.registry import query
from rollkeep.checks.standins import ASOF, legal_form, phone_digits, standin, with_standins
from rollkeep.functions import scalars as s
from rollkeep.operators import aggregates as a
from rollkeep.operators import joins
from rollkeep.operators.asof import latest_as_of
from rollkeep.operators.layout import alias_copy, pad, to_layout
from rollkeep.operators.ordering import number_rows, running_before
from rollkeep.operators.sets import missing
from rollkeep.operators.changes import reconcile
from rollkeep.sources.tables import insert_select, literal_rows, scan

_DAY = f"cast('{ASOF}' as date)"

_ROLLUP = f"""counted as (
    select n.n_name as nation, c.c_mktsegment as segment, o.o_orderstatus as status,
      cast(o.o_totalprice as decimal(20,3)) as amount
    from orders o, customer c, nation n
    where o.o_custkey = c.c_custkey and c.c_nationkey = n.n_nationkey
    and cast(o.o_orderdate as date) = (select max(cast(m.o_orderdate as date)) from orders m
      where m.o_custkey = o.o_custkey and cast(m.o_orderdate as date) <= {_DAY}))
"""
_ROLLUP_MEASURES = """count(*) as total, count(case when status = 'F' or status = 'P' then 1 end) as closed,
    count(case when status = 'O' then 1 end) as open, cast(sum(amount) as decimal(20,3)) as amount"""


def _current_orders(spark, sf_dir):
    orders = scan(spark, sf_dir, "orders").select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("effdt"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(20,3)").alias("amount"),
    )
    customer = scan(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    nation = scan(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    current = latest_as_of(orders, ["o_custkey"], "effdt", ASOF)
    return joins.inner(joins.inner(current, customer, {"o_custkey": "c_custkey"}), nation, {"c_nationkey": "n_nationkey"})


def _rolled(spark, sf_dir):
    measures = {
        "total": F.count(F.lit(1)),
        "closed": a.count_when(F.col("status").isin("F", "P")),
        "open": a.count_when(F.col("status") == "O"),
        "amount": F.sum("amount"),
    }
    rolled = a.rollup_counts(_current_orders(spark, sf_dir), ["nation", "segment"], measures)
    return rolled.withColumn("amount", F.col("amount").cast("decimal(20,3)"))


@query(f"with {_ROLLUP} select nation, segment, {_ROLLUP_MEASURES} from counted group by rollup(nation, segment)")
def rollup_counts(spark, sf_dir):
    return _rolled(spark, sf_dir).drop("level")


@query(
    f"""with {_ROLLUP}, rolled as (select nation, segment, {_ROLLUP_MEASURES} from counted group by rollup(nation, segment))
    select nation, total, closed, open, amount from rolled where segment is null"""
)
def company_totals(spark, sf_dir):
    return a.subtotals(_rolled(spark, sf_dir), 1).drop("segment")


@query(
    with_standins(
        ["ps_job", "ps_location_tbl"],
        """select company, coalesce(office, remote) as location from (
          select company, min(location) filter (where not away) as office, min(location) filter (where away) as remote
          from used join (select location, upper(descr) like '%REMOTE%' as away from ps_location_tbl) using (location)
          group by company) where coalesce(office, remote) is not null""",
        "used as (select distinct company, location from ps_job)",
    )
)
def filing_location(spark, sf_dir):
    counted = a.distinct_tuples(standin(spark, sf_dir, "ps_job"), ["company", "location"])
    return a.choose_location(counted, standin(spark, sf_dir, "ps_location_tbl"))


@query("select user_id, event_type, count(*) as n from events group by 1, 2 having count(*) > 1")
def dup_keys(spark, sf_dir):
    return a.duplicated_keys(scan(spark, sf_dir, "events"), ["user_id", "event_type"])


@query("select user_id, event_type, cast(ts as date) as day from events group by 1, 2, 3")
def distinct_tuples(spark, sf_dir):
    events = scan(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return a.distinct_tuples(events, ["user_id", "event_type", "day"])


@query(
    """select l.l_suppkey, l.first_day, h.last_day from
    (select l_suppkey, min(cast(l_shipdate as date)) as first_day from lineitem group by 1) l
    join (select l_suppkey, max(cast(l_shipdate as date)) as last_day from lineitem group by 1) h
    on l.l_suppkey = h.l_suppkey"""
)
def min_max_per_key(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    lines = scan(spark, sf_dir, "lineitem").select("l_suppkey", day.alias("first_day"), day.alias("last_day"))
    return joins.inner(
        a.agg_min(lines, ["l_suppkey"], "first_day"), a.agg_max(lines, ["l_suppkey"], "last_day"), ["l_suppkey"]
    )


@query("select count(*) as n from lineitem")
def row_count(spark, sf_dir):
    return a.row_count(scan(spark, sf_dir, "lineitem"))


@query("select c_custkey from customer except select o_custkey from orders where o_orderstatus = 'P'")
def except_codes(spark, sf_dir):
    ours = scan(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return missing(scan(spark, sf_dir, "customer"), ours, ["c_custkey"])


@query(
    """(select o_custkey as code, 'extra' as side from orders except select s_suppkey, 'extra' from supplier)
    union all (select s_suppkey, 'missing' from supplier except select o_custkey, 'missing' from orders)"""
)
def reconcile_codes(spark, sf_dir):
    ours = scan(spark, sf_dir, "orders").select(F.col("o_custkey").alias("code"))
    theirs = scan(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("code"))
    return reconcile(ours, theirs, "code")


# --- order -------------------------------------------------------------------------------


@query(
    with_standins(
        ["staff"],
        """select row_number() over (order by emplid asc nulls last, status desc nulls first, row_id asc nulls last) as line,
        emplid, status, row_id from staff""",
    )
)
def ordered_extract(spark, sf_dir):
    staff = standin(spark, sf_dir, "staff").select("emplid", "status", "row_id")
    return number_rows(staff, ["emplid", ("status", False, "first"), "row_id"], "line")


@query(
    """select l_orderkey, l_linenumber, cast(coalesce(sum(cast(l_quantity as bigint)) over (
    order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    rows between unbounded preceding and 1 preceding), 0) as bigint) as quantity_before from lineitem"""
)
def running_totals(spark, sf_dir):
    lines = scan(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.col("l_quantity").cast("long").alias("quantity"),
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    running = running_before(lines, order, {"quantity_before": "quantity"})
    return running.select("l_orderkey", "l_linenumber", "quantity_before")


# --- scalar functions --------------------------------------------------------------------


@query(
    with_standins(
        ["ps_company_tbl"],
        f"select company, effdt, legal_type, {legal_form('legal_type')} as legal_status from ps_company_tbl",
    )
)
def legal_map(spark, sf_dir):
    rows = standin(spark, sf_dir, "ps_company_tbl").select("company", "effdt", "legal_type")
    return rows.withColumn("legal_status", s.legal_status("legal_type"))


@query(
    with_standins(
        ["ps_names"],
        """select emplid, effdt, middle_name, coalesce(substr(middle_name, 0, 1), '') as initial,
        coalesce(substr(middle_name, 1, 1), '') as intended from ps_names""",
    )
)
def initial(spark, sf_dir):
    rows = standin(spark, sf_dir, "ps_names").select("emplid", "effdt", "middle_name")
    return rows.withColumn("initial", s.initial("middle_name")).withColumn(
        "intended", s.initial("middle_name", mode="intended")
    )


@query(
    with_standins(
        ["ps_personal_phone"],
        f"select emplid, phone, {phone_digits('phone')} as digits from ps_personal_phone",
    )
)
def digits(spark, sf_dir):
    rows = standin(spark, sf_dir, "ps_personal_phone").select("emplid", "phone")
    return rows.withColumn("digits", s.digits("phone"))


@query(
    with_standins(
        ["ps_company_tbl"],
        """select company, effdt, pf_client_ein, ' ' || lpad(cast(pf_client_ein as varchar), 9, '0') as ein from ps_company_tbl""",
    )
)
def ein(spark, sf_dir):
    rows = standin(spark, sf_dir, "ps_company_tbl").select("company", "effdt", "pf_client_ein")
    return rows.withColumn("ein", s.ein("pf_client_ein"))


@query(
    with_standins(
        ["ps_pers_data_effdt", "ps_addresses", "syempyr"],
        """select 'sex' as source, emplid as id, coalesce(nullif(sex, ''), 'U') as value from ps_pers_data_effdt
        union all select 'line', emplid, coalesce(address2, '') from ps_addresses
        union all select 'flag', empl_id, case when terminated is null then 'Y' else 'N' end from syempyr""",
    )
)
def gender_and_flags(spark, sf_dir):
    person = standin(spark, sf_dir, "ps_pers_data_effdt")
    address = standin(spark, sf_dir, "ps_addresses")
    year = standin(spark, sf_dir, "syempyr")
    return (
        person.select(F.lit("sex").alias("source"), F.col("emplid").alias("id"), s.gender("sex").alias("value"))
        .unionAll(address.select(F.lit("line"), "emplid", s.blank_if_null("address2")))
        .unionAll(year.select(F.lit("flag"), "empl_id", s.flag(F.col("terminated").isNull())))
    )


@query(
    with_standins(
        ["ps_t2_cloptn_effdt", "ps_job"],
        f"""select company as id, effdt, strftime(effdt, '%m/%d/%Y') as shown, strftime(effdt, '%Y%m%d') as compact,
        case when t2_comp_term_dt < {_DAY} then 'CANCEL' else 'ADD' end as before,
        case when t2_comp_term_dt > {_DAY} then 'CANCEL' else 'ADD' end as after,
        case when t2_comp_term_dt < {_DAY} then 'Client''s Request' else ' ' end as reason,
        cast(null as bigint) as pay from ps_t2_cloptn_effdt
        union all select emplid, effdt, strftime(effdt, '%m/%d/%Y'), strftime(effdt, '%Y%m%d'), 'ADD', 'ADD', ' ',
        cast(round(annual_rt, 0) as bigint) from ps_job""",
    )
)
def rendering(spark, sf_dir):
    option = standin(spark, sf_dir, "ps_t2_cloptn_effdt")
    job = standin(spark, sf_dir, "ps_job")
    term = "t2_comp_term_dt"
    none = F.lit(None).cast("date")
    columns = [s.us_date("effdt").alias("shown"), s.compact_date("effdt").alias("compact")]
    return option.select(
        F.col("company").alias("id"),
        "effdt",
        *columns,
        s.filing_status(term, ASOF, "before").alias("before"),
        s.filing_status(term, ASOF, "after").alias("after"),
        s.cancel_reason(term, ASOF, "before").alias("reason"),
        F.lit(None).cast("long").alias("pay"),
    ).unionAll(
        job.select(
            "emplid",
            "effdt",
            *columns,
            s.filing_status(none, ASOF, "before"),
            s.filing_status(none, ASOF, "after"),
            s.cancel_reason(none, ASOF, "never"),
            s.whole_number("annual_rt"),
        )
    )


# --- layout ------------------------------------------------------------------------------


@query(
    """select cast(null as varchar) as record_type, c_name as employee, cast(c_custkey as varchar) as code, ' ' as filler,
    cast(c_custkey as varchar) as client, cast(c_acctbal as decimal(20,3)) as balance from customer"""
)
def layout_padding(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("record_type", T.StringType()),
            T.StructField("employee", T.StringType()),
            T.StructField("code", T.StringType()),
        ]
    )
    customer = scan(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    fixed = to_layout(customer, {"employee": F.col("c_name"), "code": F.col("c_custkey")}, schema)
    padded = alias_copy(pad(fixed, "filler", literal=" "), "code", "client")
    balance = customer.select(F.col("c_custkey").cast("string").alias("code"), "c_acctbal")
    return joins.inner(padded, balance, ["code"]).select(
        *padded.columns, F.col("c_acctbal").cast("decimal(20,3)").alias("balance")
    )


@query(
    """select cast(l_orderkey as varchar) as orderkey, cast(l_quantity as integer) as quantity,
    cast(l_extendedprice as decimal(20,3)) as price, cast(l_shipdate as date) as shipped from lineitem"""
)
def typed_staging(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("orderkey", T.StringType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("price", T.DecimalType(20, 3)),
            T.StructField("shipped", T.DateType()),
        ]
    )
    lines = scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return insert_select(lines, schema)


@query(
    """select v.rank, v.label, count(o_orderkey) as orders from (values ('1-URGENT', 1, 'now'), ('2-HIGH', 2, 'soon'),
      ('9-NONE', 9, null)) v(priority, rank, label) left join orders on o_orderpriority = v.priority group by v.rank, v.label"""
)
def literal_codes(spark, sf_dir):
    """Rows written in the program, looked up in a table."""
    schema = T.StructType(
        [
            T.StructField("priority", T.StringType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("label", T.StringType()),
        ]
    )
    codes = literal_rows(spark, [("1-URGENT", 1, "now"), ("2-HIGH", 2, "soon"), ("9-NONE", 9, None)], schema)
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    counted = joins.left(codes, orders, ["priority"]).groupBy("rank", "label")
    return counted.agg(F.count("o_orderkey").alias("orders"))
