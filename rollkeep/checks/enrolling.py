"""Queries over the enrolment file, its checks, the run ledger and the snapshot."""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.checks.registry import query
from rollkeep.checks.standins import STANDINS, standin, standins, with_standins
from rollkeep.plans import enrolment as e
from rollkeep.plans.runs import Ledger, definitions, record_definitions, recorded_run
from rollkeep.plans.sent import record_sent, sent_before
from rollkeep.plans.snapshot import read_snapshot, refresh_snapshot
from rollkeep.sources import ledger
from rollkeep.sources.segments import Separators, archive_segments, write_segments
from rollkeep.sources.staging import new_folder, staged
from rollkeep.sources.tables import scan

MEMBERS = ["subscribers", "dependents"]
COVERS = ["covers_own", "covers_second", "covers_dependents"]
ENVELOPE = e.Envelope(soft_limit=990, sets_per_interchange=4)
MAX_ERRORS = 1_000_000_000

_M = "m as (select * from subscribers union all select * from dependents)"
_C = "c as (select * from covers_own union all select * from covers_second union all select * from covers_dependents)"

# the three rules over the member rows themselves
_X = """x as (
  select 'Illegal element value.' as sub_category, 'Loop id 2000 Segment ID: INS Student Status Code [' || student_status
    || '] must equal one of P,F,N.' as detail, subscriber_id, member_code as member_id from m
    where student_status not in ('P', 'F', 'N')
  union all select 'Invalid element length.', 'Loop id 2100A Segment ID: N4 State Code [' || state || '] length of '
    || cast(length(state) as varchar) || ' exceeds the maximum length of 2', subscriber_id, member_code from m
    where length(state) > 2
  union all select 'Missing required element.', 'Loop id 2000 Segment ID: INS Employment Status Code', subscriber_id,
    member_code from m where is_subscriber = 'Y' and employment_status is null)"""
_GOOD = "good as (select * from m where subscriber_id not in (select subscriber_id from x))"

# families in order, their set and interchange
_F = """f as (select subscriber_id, family_size, members_before, cast(floor(members_before / 990) as bigint) as set_no,
    cast(floor(floor(members_before / 990) / 4) as bigint) as file
  from (select subscriber_id, family_size, cast(coalesce(sum(family_size) over (order by subscriber_id
      rows between unbounded preceding and 1 preceding), 0) as bigint) as members_before
    from (select subscriber_id, count(*) as family_size from m group by 1)))"""
# where each member stands in its file
_P = """p as (select m.*, f.set_no, cast(f.file as varchar) as file,
    dense_rank() over (partition by f.file order by f.set_no) as txn_id,
    row_number() over w as member_id,
    cast(sum(case when is_subscriber = 'Y' then 1 else 0 end) over w as bigint) as family_id
  from m join f on f.subscriber_id = m.subscriber_id
  window w as (partition by f.file order by f.set_no, m.subscriber_id, m.member_seq))"""

_WRITTEN: dict[tuple[str, str], DataFrame] = {}


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin(spark, sf_dir, "subscribers").unionAll(standin(spark, sf_dir, "dependents"))


def _covers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second, third = (standin(spark, sf_dir, name) for name in COVERS)
    return first.unionAll(second).unionAll(third)


def forget() -> None:
    """Let the next query write and read its file again, as the timed ones do."""
    _WRITTEN.clear()


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All members written as interchanges and read back, once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = new_folder(spark, "edi")
        e.write_edi(_members(spark, sf_dir), _covers(spark, sf_dir), path, ENVELOPE)
        _WRITTEN[key] = e.read_edi(spark, path)
    return _WRITTEN[key]


def _text(tag: str, *elements: str) -> str:
    """A segment's text in SQL: elements joined, trailing separators cut."""
    joined = " || '*' || ".join(f"coalesce(cast({x} as varchar), '')" for x in elements)
    return f"rtrim('{tag}*' || {joined}, '*')"


_INS = _text(
    "INS",
    "is_subscriber",
    "relationship",
    "maintenance_type",
    "maintenance_reason",
    "benefit_status",
    "''",
    "''",
    "employment_status",
    "student_status",
    *["''"] * 7,
    "case when is_subscriber = 'N' then member_seq end",
)
_NM1 = _text(
    "NM1",
    "'IL'",
    "'1'",
    "last_name",
    "first_name",
    "middle_name",
    "''",
    "''",
    "case when national_id is not null then '34' end",
    "national_id",
)
_COMPACT = "strftime({0}, '%Y%m%d')"
_OWN_LINES = [
    (_INS, "true"),
    (_text("REF", "'0F'", "subscriber_id"), "true"),
    (_text("REF", "'23'", "member_code"), "true"),
    (_text("DTP", "'303'", "'D8'", _COMPACT.format("maintenance_date")), "maintenance_date is not null"),
    (_NM1, "true"),
    (_text("PER", "'IP'", "''", "'HP'", "phone"), "phone is not null"),
    (_text("N3", "address1", "address2"), "coalesce(address1, address2) is not null"),
    (_text("N4", "city", "state", "postal"), "coalesce(city, state, postal) is not null"),
    (_text("DMG", "'D8'", _COMPACT.format("birth_date"), "sex"), "true"),
]
_COVER_LINES = [
    (_text("HD", "c.maintenance_type", "''", "c.insurance_line", "c.plan", "c.coverage_level"), "true"),
    (_text("DTP", "'348'", "'D8'", _COMPACT.format("c.benefit_begin")), "c.benefit_begin is not null"),
    (_text("DTP", "'349'", "'D8'", _COMPACT.format("c.benefit_end")), "c.benefit_end is not null"),
]
_HEADER_LINES = [
    _text("ST", "'834'", "control", "'005010X220A1'"),
    _text("BGN", "'00'", "control", "'20200101'", "'0000'", "'LT'", "''", "''", "'4'"),
    _text("REF", "'38'", "'POLICY'"),
    _text("DTP", "'007'", "'D8'", "'20200101'"),
    _text("QTY", "'DT'", "dependents"),
    _text("QTY", "'ET'", "employees"),
    _text("QTY", "'TO'", "total"),
    _text("N1", "'P5'", "'SPONSOR'", "'FI'", "'00-0000000'"),
    _text("N1", "'IN'", "'INSURER'", "'FI'", "'99-9999999'"),
]


def _lines_sql() -> str:
    """Every line of every file, in SQL."""
    parts = [
        f"select file, set_no, 1 as part, subscriber_id, member_seq, 0 as coverage_seq, {i} as line, {text} as value from p where {present}"
        for i, (text, present) in enumerate(_OWN_LINES)
    ]
    parts += [
        f"""select p.file, p.set_no, 1, c.subscriber_id, c.member_seq, c.coverage_seq, {i}, {text}
        from c join p on p.subscriber_id = c.subscriber_id and p.member_seq = c.member_seq where {present}"""
        for i, (text, present) in enumerate(_COVER_LINES)
    ]
    head = [
        f"select file, set_no, 0, '', 0, 0, {i}, {text} from t" for i, text in enumerate(_HEADER_LINES)
    ]
    number = "lpad(cast(cast(file as bigint) + 1 as varchar), 9, '0')"
    isa = "'ISA*00*          *00*          *30*SENDER         *30*RECEIVER       *200101*0000*^*00501*' || {n} || '*0*P*>'"
    return f"""body as ({' union all '.join(parts)}),
t as (select file, set_no, lpad(cast(set_no + 1 as varchar), 9, '0') as control, count(*) as total,
    count(case when is_subscriber = 'N' then 1 end) as dependents, count(case when is_subscriber = 'Y' then 1 end) as employees
  from p group by file, set_no),
size as (select set_no, count(*) as n from body group by set_no),
framed as (select file, 1 as section, * exclude (file) from body
  union all select file, 1, * exclude (file) from ({' union all '.join(head)})
  union all select t.file, 1, t.set_no, 2, '', 0, 0, 0, 'SE*' || cast(s.n + {len(_HEADER_LINES)} + 1 as varchar) || '*' || control
    from t join size s on s.set_no = t.set_no
  union all select distinct file, 0, 0, 0, '', 0, 0, 0, {isa.format(n=number)} from t
  union all select distinct file, 0, 0, 0, '', 0, 0, 1, 'GS*BE*SENDER*RECEIVER*20200101*0000*' || {number} || '*X*005010X220A1' from t
  union all select file, 2, 0, 0, '', 0, 0, 0, 'GE*' || cast(count(*) as varchar) || '*' || {number} from t group by file
  union all select distinct file, 2, 0, 0, '', 0, 0, 1, 'IEA*1*' || {number} from t)"""


@query(
    with_standins(
        MEMBERS + COVERS,
        """select file, row_number() over (partition by file
        order by section, set_no, part, subscriber_id, member_seq, coverage_seq, line) as pos, value from framed""",
        ",\n".join([_M, _C, _F, _P, _lines_sql()]),
    )
)
def edi_segments(spark, sf_dir):
    segments = _segments(spark, sf_dir)
    return segments.select("file", "pos", F.concat_ws("*", "elements").alias("value"))


_MEMBER_COLUMNS = [c for c in STANDINS["subscribers"][1] if c != "member_seq"]


@query(
    with_standins(
        MEMBERS,
        f"""select file, txn_id, family_id, member_id, nullif(member_seq, 0) as member_seq, {', '.join(_MEMBER_COLUMNS)} from p""",
        ",\n".join([_M, _F, _P]),
    )
)
def edi_members(spark, sf_dir):
    found = e.members(_segments(spark, sf_dir))
    return found.select("file", "txn_id", "family_id", "member_id", "member_seq", *_MEMBER_COLUMNS)


_COVER_COLUMNS = [c for c in STANDINS["covers_own"][1] if c not in ("subscriber_id", "member_seq", "coverage_seq")]


@query(
    with_standins(
        MEMBERS + COVERS,
        f"""select p.file, p.txn_id, p.family_id, p.member_id, row_number() over (partition by p.file
        order by p.member_id, c.coverage_seq) as coverage_id, {', '.join('c.' + x for x in _COVER_COLUMNS)}
        from c join p on p.subscriber_id = c.subscriber_id and p.member_seq = c.member_seq""",
        ",\n".join([_M, _C, _F, _P]),
    )
)
def edi_coverages(spark, sf_dir):
    found = e.coverages(_segments(spark, sf_dir))
    return found.drop("maintenance_date", "other_segments", "own_segments", "segment_order")


_TOTALS = """select file, txn_id, count(case when is_subscriber = 'N' then 1 end) as dependents,
    count(case when is_subscriber = 'Y' then 1 end) as employees, count(*) as total from p group by file, txn_id"""


@query(with_standins(MEMBERS, _TOTALS, ",\n".join([_M, _F, _P])))
def edi_totals(spark, sf_dir):
    return e.txn_totals(_segments(spark, sf_dir))


@query(
    with_standins(
        MEMBERS,
        f"""select file, txn_id, dependents, employees, total, dependents as stated_dependents,
        employees as stated_employees, total as stated_total, true as ok from ({_TOTALS})""",
        ",\n".join([_M, _F, _P]),
    )
)
def edi_check_totals(spark, sf_dir):
    return e.check_totals(_segments(spark, sf_dir))


@query(
    with_standins(
        MEMBERS + COVERS,
        """select l.file, 'SE' as tag, cast(null as bigint) as group_id, q.txn_id, count(*) as stated, count(*) as counted, true as same_control, true as ok
        from framed l join (select distinct file, set_no, txn_id from p) q on q.set_no = l.set_no
        where l.section = 1 group by l.file, q.txn_id
        union all select file, 'GE', 1, null, count(*), count(*), true, true from t group by file
        union all select distinct file, 'IEA', null, null, 1, 1, true, true from t""",
        ",\n".join([_M, _C, _F, _P, _lines_sql()]),
    )
)
def edi_envelope(spark, sf_dir):
    return e.check_envelope(_segments(spark, sf_dir))


@query(
    with_standins(
        MEMBERS,
        f"""select l.file, cast(1 as bigint) as group_id, q.txn_id, cast(q.txn_id as bigint) as txn_in_group, control, '005010X220A1' as version,
        '00' as purpose, control as reference, date '2020-01-01' as created, '0000' as created_time, cast(null as varchar) as original_reference,
        '4' as action, 'POLICY' as policy, date '2020-01-01' as effective_date, cast(null as date) as report_start, cast(null as date) as report_end,
        cast(null as date) as maintenance_effective, cast(null as date) as enrolment_date, 'SPONSOR' as sponsor_name, 'FI' as sponsor_id_qualifier,
        '00-0000000' as sponsor_id, 'INSURER' as insurer_name, 'FI' as insurer_id_qualifier, '99-9999999' as insurer_id,
        {', '.join(f"cast(null as varchar) as {who}_{part}" for who in ("broker", "administrator") for part in ("name", "id_qualifier", "id"))},
        'BE' as functional_id, 'SENDER' as sender_code, 'RECEIVER' as receiver_code, lpad(cast(cast(l.file as bigint) + 1 as varchar), 9, '0') as group_control,
        '005010X220A1' as group_version
        from (select distinct file, set_no, lpad(cast(set_no + 1 as varchar), 9, '0') as control from p) l
        join (select distinct file, set_no, txn_id from p) q on q.file = l.file and q.set_no = l.set_no""",
        ",\n".join([_M, _F, _P]),
    )
)
def edi_transactions(spark, sf_dir):
    return e.transactions(_segments(spark, sf_dir))


# A file of another writer: named segments between others, and a second party with an address of its own. (line, when there)
_FOREIGN = [
    ("concat('INS*', is_subscriber, '*18*030**A***FT')", "true"),
    ("concat('REF*0F*', subscriber_id)", "true"),
    ("concat('REF*DX*', member_code)", "true"),
    ("concat('REF*23*', member_code)", "member_seq <> 1"),
    ("'DTP*336*D8*20190101'", "is_subscriber = 'Y'"),
    ("'DTP*303*D8*20200102'", "true"),
    ("'DTP*356*D8*20200105'", "true"),
    ("concat('NM1*IL*1*', last_name, '*', first_name)", "true"),
    ("concat('N3*', cast(member_seq as string), ' Way')", "member_seq <> 2"),
    ("'N4*Town*NY*10001'", "true"),
    ("'DMG*D8*19800102*F'", "true"),
    ("'NM1*31*1'", "true"),
    ("'N3*PO Box 9'", "true"),
    ("'N4*Other*NJ*07001'", "true"),
    ("'HD*030**VIS*PLANX*EMP'", "is_subscriber = 'Y'"),
    ("'REF*1L*G9'", "is_subscriber = 'Y'"),
    ("'DTP*348*D8*20200301'", "is_subscriber = 'Y'"),
    ("'DTP*300*D8*20200302'", "is_subscriber = 'Y'"),
    ("'DTP*349*D8*20201231'", "is_subscriber = 'Y'"),
]
_FOREIGN_SQL = " union all ".join(
    f"select subscriber_id, member_seq, {i} as line, {text} as value from m where {there}" for i, (text, there) in enumerate(_FOREIGN)
)


def _with_places(segments: DataFrame) -> DataFrame:
    """member_id, its segments' places from 1, and their texts."""
    own = segments.where("member_id is not null and tag <> 'SE'")
    return own.select("member_id", (F.col("pos") - F.col("member_pos") + 1).alias("place"), F.concat_ws("*", "elements").alias("value"))


@query(
    with_standins(
        MEMBERS,
        f"""select dense_rank() over (order by subscriber_id, member_seq) as member_id,
        row_number() over (partition by subscriber_id, member_seq order by line) as place, value from ({_FOREIGN_SQL})""",
        _M,
    )
)
def edi_in_place(spark, sf_dir):
    """A file of another writer read and written again: every segment where it was."""
    path, again = new_folder(spark, "edi-foreign"), new_folder(spark, "edi-again")
    m = _members(spark, sf_dir)
    lines = F.array_compact(F.array(*[F.expr(f"case when {there} then {text} end") for text, there in _FOREIGN]))
    body = m.select(F.lit(0).alias("interchange"), F.lit(1).alias("section"), "subscriber_id", "member_seq", F.array_join(lines, "~").alias("value"))
    isa = f"ISA*00*{'':10}*00*{'':10}*30*{'A':15}*30*{'B':15}*200101*0000*^*00501*000000001*0*P*>~GS*BE*A*B*20200101*0000*1*X*V~ST*834*0001*V"
    ends = spark.createDataFrame([(0, 0, "", 0, isa), (0, 2, "", 0, "SE*0*0001~GE*1*1~IEA*1*000000001")], "interchange int, section int, subscriber_id string, member_seq int, value string")
    write_segments(body.unionByName(ends), path, ["section", "subscriber_id", "member_seq"], "value")
    segments = e.read_edi(spark, path)
    keys = ["file", "txn_id", "family_id", "member_id"]
    # a member's number comes by the keys that members are gathered on, so that no exchange carries the gathered once more
    ins = segments.where("tag = 'INS'").select(*keys)
    first = ins.groupBy(F.col("family_id").alias("_f")).agg(F.min("member_id").alias("_first"))
    numbers = ins.join(first, F.col("family_id") == F.col("_f")).select(*keys, (F.col("member_id") - F.col("_first")).cast("int").alias("member_seq"))
    # the coverages and the writer, which reads its rows several times, take them from there
    found = staged(e.members(segments).drop("member_seq", "pos").join(numbers, keys), "read-members")
    who = found.select("file", "member_id", "subscriber_id", "member_seq")
    covers = e.coverages(segments).join(who, ["file", "member_id"]).withColumn("coverage_seq", F.lit(1))
    e.write_edi(found.drop(*keys), staged(covers.drop(*keys, "coverage_id"), "read-coverages"), again)
    return _with_places(e.read_edi(spark, again))


_STYLES = (Separators(), Separators("\n", "|", "!", ":"), Separators("'", "+", "^", ";"))


@query(
    with_standins(
        MEMBERS + COVERS,
        """select cast(member_seq as int) as style, p.subscriber_id, p.last_name, p.first_name, p.phone, p.address1, p.city, p.birth_date,
          (select count(*) from c where c.subscriber_id = p.subscriber_id and c.member_seq = p.member_seq) as covers
        from (select * from m where member_seq < 3) p""",
        f"{_M},\n{_C}",
    )
)
def edi_separators(spark, sf_dir):
    """One folder of files that state three styles of separators, read together."""
    path, members, covers = new_folder(spark, "edi-styles"), _members(spark, sf_dir), _covers(spark, sf_dir)
    for number, style in enumerate(_STYLES):
        envelope = e.Envelope(separators=style, first_control=1 + number)
        e.write_edi(members.where(F.col("member_seq") == number), covers.where(F.col("member_seq") == number), f"{path}/style{number}", envelope)
    segments = e.read_edi(spark, path)
    counts = e.coverages(segments).groupBy("file", "member_id").agg(F.count(F.lit(1)).alias("covers"))
    columns = ["subscriber_id", "last_name", "first_name", "phone", "address1", "city", "birth_date"]
    found = e.members(segments).join(counts, ["file", "member_id"], "left")
    return found.select(F.col("file").cast("int").alias("style"), *columns, F.coalesce("covers", F.lit(0)).alias("covers"))


# --- validation and rejects ----------------------------------------------------------------

_EXCEPTIONS = "select 'ERROR' as exception_type, 'DATA ELEMENT' as category, * from x"


@query(with_standins(MEMBERS, _EXCEPTIONS, f"{_M},\n{_X}"))
def edi_exceptions(spark, sf_dir):
    return e.validate(e.member_elements(_members(spark, sf_dir)))


@query(with_standins(MEMBERS, _EXCEPTIONS, f"{_M},\n{_X}"))
def edi_file_exceptions(spark, sf_dir):
    """The same rules over a file that was read."""
    return e.validate(e.file_elements(_segments(spark, sf_dir)))


@query(
    with_standins(
        MEMBERS,
        "select 'DATA ELEMENT' as category, sub_category, count(*) as n from x group by sub_category",
        f"{_M},\n{_X}",
    )
)
def edi_exception_counts(spark, sf_dir):
    return e.exception_counts(e.validate(e.member_elements(_members(spark, sf_dir))))


@query(
    with_standins(
        MEMBERS, "select subscriber_id, member_seq, is_subscriber from good", f"{_M},\n{_X},\n{_GOOD}"
    )
)
def edi_accepted(spark, sf_dir):
    rows = _members(spark, sf_dir)
    kept = e.reject_families(rows, e.validate(e.member_elements(rows)))
    return kept.select("subscriber_id", "member_seq", "is_subscriber")


@query(
    with_standins(
        MEMBERS,
        """select (select count(*) from m where is_subscriber = 'Y') as loaded,
        (select count(*) from good where is_subscriber = 'Y') as kept, (select count(*) from x) as errors""",
        f"{_M},\n{_X},\n{_GOOD}",
    )
)
def edi_run(spark, sf_dir):
    """A whole run: validate, reject, gate, write; its counts."""
    path = new_folder(spark, "edi-run")
    counts, _ = e.run_file(_members(spark, sf_dir), _covers(spark, sf_dir), path, ENVELOPE, max_errors=MAX_ERRORS)
    return counts


@query(
    with_standins(
        MEMBERS + COVERS,
        """select tag, cast(sum(n) as bigint) as n from (
        select 'INS' as tag, count(*) as n from good union all
        select 'HD', count(*) from c join good g on g.subscriber_id = c.subscriber_id and g.member_seq = c.member_seq union all
        select 'ST', count(distinct floor(before / 990)) from (select sum(size) over (order by subscriber_id
          rows between unbounded preceding and current row) - size as before
          from (select subscriber_id, count(*) as size from good group by 1))) group by tag""",
        f"{_M},\n{_C},\n{_X},\n{_GOOD}",
    )
)
def edi_run_archive(spark, sf_dir):
    """What the compressed copy of a run's file holds."""
    path, copy = new_folder(spark, "edi-run"), new_folder(spark, "edi-archive")
    e.run_file(_members(spark, sf_dir), _covers(spark, sf_dir), path, ENVELOPE, max_errors=MAX_ERRORS)
    archive_segments(spark, path, copy)
    tags = e.read_edi(spark, copy).where("tag in ('INS', 'HD', 'ST')")
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    with_standins(
        MEMBERS, "select count(*) as errors, 5 as max_errors, count(*) <= 5 as passed from x", f"{_M},\n{_X}"
    )
)
def edi_gate(spark, sf_dir):
    return e.gate(e.validate(e.member_elements(_members(spark, sf_dir))), max_errors=5)


@query(with_standins(MEMBERS, "select subscriber_id, family_size, members_before, set_no from f", f"{_M},\n{_F}"))
def edi_split(spark, sf_dir):
    return e.split_sets(_members(spark, sf_dir), 990)


@query(
    "with recursive "
    + with_standins(
        MEMBERS,
        """select subscriber_id, family_size, members_before, set_no from walk""",
        f"""{_M},
        families as (select subscriber_id, count(*) as family_size, row_number() over (order by subscriber_id) as n,
            cast(coalesce(sum(count(*)) over (order by subscriber_id rows between unbounded preceding and 1 preceding), 0) as bigint) as members_before
          from m group by subscriber_id),
        walk as (select subscriber_id, family_size, members_before, n, family_size as load, cast(0 as bigint) as set_no from families where n = 1
          union all
          select f.subscriber_id, f.family_size, f.members_before, f.n,
            case when w.load + f.family_size <= 50 then w.load + f.family_size else f.family_size end,
            w.set_no + case when w.load + f.family_size <= 50 then 0 else 1 end
          from walk w join families f on f.n = w.n + 1)""",
    ).removeprefix("with ")
)
def edi_split_restart(spark, sf_dir):
    """Sets that are counted anew: none over the limit but for a larger family."""
    return e.split_sets_restart(_members(spark, sf_dir), 50)


_RUN_DAYS = ("2019-02-01", "2019-06-15", "2020-01-01", "2020-06-01")


@query(
    with_standins(
        COVERS,
        f"""select * exclude (reopened), times_sent from (
          select *, cast((benefit_begin < date '{_RUN_DAYS[0]}' and not reopened)::int
            + (benefit_begin < date '{_RUN_DAYS[1]}' and not reopened)::int + (benefit_begin < date '{_RUN_DAYS[2]}')::int as bigint) as sent_before
          from (select *, subscriber_id like '%7' as reopened from c)) t,
          lateral (select case when benefit_end is null then cast(0 as bigint) else sent_before end as times_sent)
        where benefit_begin < date '{_RUN_DAYS[3]}' and (benefit_end is null or times_sent < 3)""".replace(
            "select * exclude (reopened), times_sent", "select * exclude (reopened, sent_before)"
        ),
        _C,
    )
)
def edi_limits_replayed(spark, sf_dir):
    """Four runs: an ended coverage goes out three times, unless it was sent open in between (in the second run)."""
    path, covers = new_folder(spark, "sent"), _covers(spark, sf_dir)
    for run, day in enumerate(_RUN_DAYS, 1):
        sent = covers.where(F.col("benefit_begin") < F.lit(day).cast("date"))
        if run == 2:
            sent = sent.withColumn("benefit_end", F.when(~F.col("subscriber_id").like("%7"), F.col("benefit_end")))
        rows = e.limit_members(sent, member_term_limit=3, times_sent=sent_before(spark, path, run, sent))
        if run < len(_RUN_DAYS):
            record_sent(rows, path, run)
    return rows


@query(
    with_standins(
        COVERS,
        """select * from (select *, coverage_seq as times_sent from c) where benefit_begin >= cast('2019-03-01' as date)
        and (benefit_end is null or (benefit_end >= cast('2020-01-20' as date) and times_sent < 3))""",
        _C,
    )
)
def edi_limits(spark, sf_dir):
    rows = _covers(spark, sf_dir).withColumn("times_sent", F.col("coverage_seq"))
    return e.limit_members(rows, "2019-03-01", "2020-01-20", 3, changed="benefit_begin")


@query(
    with_standins(
        COVERS,
        """select coverage_seq as file_instance_id, count(case when benefit_end is not null then 1 end) as terminations,
        count(*) as members from c group by coverage_seq""",
        _C,
    )
)
def edi_terminations(spark, sf_dir):
    return e.termination_counts(_covers(spark, sf_dir).withColumnRenamed("coverage_seq", "file_instance_id"))


# --- run ledger ------------------------------------------------------------------------------

LEDGER = ["file_definition", "file_instance", "file_transfer", "file_exception"]
_VIEW = {
    "file_exception": "file_record_id exception_type category sub_category detail subscriber_id member_id".split(),
    "file_definition": "vendor_id file_definition_name status members_per_transaction_set_soft_limit member_term_limit".split(),
    "file_instance": "file_instance_id file_definition_id file_instance_start_time file_instance_status file_name".split(),
    "file_transfer": "file_instance_transfer_status_id file_instance_transfer_status return_code".split(),
}
_VIEW_SELECT = ", ".join(
    f"{table}.{column}" for table, columns in _VIEW.items() for column in columns
).replace("file_instance.file_instance_start_time", "cast(file_instance_start_time as date) as file_instance_start_time")


@query(
    with_standins(
        LEDGER,
        f"""select {_VIEW_SELECT} from file_exception
        join file_instance on file_instance.file_instance_id = file_exception.file_instance_id
        join file_definition on file_definition.file_definition_id = file_instance.file_definition_id
        left join file_transfer on file_transfer.file_instance_id = file_instance.file_instance_id""",
    )
)
def exception_view(spark, sf_dir):
    tables = standins(spark, sf_dir, *LEDGER)
    view = ledger.exception_view(
        tables["file_exception"], tables["file_definition"], tables["file_instance"], tables["file_transfer"]
    )
    columns = [column for columns in _VIEW.values() for column in columns]
    return view.withColumn("file_instance_start_time", F.col("file_instance_start_time").cast("date")).select(*columns)


_TIMES = [c.name for c in ledger.EXCEPTION_VIEW.fields if c.dataType.simpleString() == "timestamp"]
_TAKEN_OVER, _CHANGED = "1992-01-01 00:00:00", "1995-06-01 00:00:00"


def _whole_view_sql() -> str:
    """All columns of the view; times and the period as text, which both engines write alike."""
    definition = [c for c in STANDINS["definition_later"][1]]
    same = " and ".join(f"a.{c} is not distinct from b.{c}" for c in definition)
    own = {c: f"x.{c}" for c in STANDINS["file_exception"][1]} | {c: f"d.{c}" for c in (*definition, "sys_period")}
    own |= {c: f"i.{c}" for c in STANDINS["whole_instance"][1] if c != "file_definition_id"}
    own |= {c: f"t.{c}" for c in STANDINS["whole_transfer"][1] if c != "file_instance_id"}
    text = lambda c: f"strftime({own[c]}, '%Y-%m-%d %H:%M:%S')" if c in _TIMES else own.get(c, "cast(null as bigint)")
    columns = ", ".join(f"{text(c)} as {c}" for c in ledger.EXCEPTION_VIEW_COLUMNS)
    return with_standins(
        ["definition_first", "definition_later", "whole_instance", "whole_transfer", "file_exception"],
        f"""select {columns} from file_exception x join whole_instance i on i.file_instance_id = x.file_instance_id
        join d on d.file_definition_id = i.file_definition_id and d.lower <= i.file_instance_start_time
          and (d.upper is null or i.file_instance_start_time < d.upper)
        left join whole_transfer t on t.file_instance_id = i.file_instance_id""",
        f"""changed as (select a.file_definition_id from definition_first a join definition_later b using (file_definition_id) where not ({same})),
        d as (
          select a.*, timestamp '{_TAKEN_OVER}' as lower, case when file_definition_id in (select * from changed) then timestamp '{_CHANGED}' end as upper,
            '[{_TAKEN_OVER},' || case when file_definition_id in (select * from changed) then '{_CHANGED}' else '' end || ')' as sys_period
          from definition_first a
          union all
          select b.*, timestamp '{_CHANGED}', null, '[{_CHANGED},)' from definition_later b where file_definition_id in (select * from changed))""",
    )


@query(_whole_view_sql())
def exception_view_history(spark, sf_dir):
    """The whole view, over definitions that changed between two runs: each run with the one of its time."""
    tables = standins(spark, sf_dir, "definition_first", "definition_later", "whole_instance", "whole_transfer", "file_exception")
    path = new_folder(spark, "definitions")
    for name, time in (("definition_first", _TAKEN_OVER), ("definition_later", _CHANGED)):
        record_definitions(tables[name], path, dt.datetime.fromisoformat(time).replace(tzinfo=dt.timezone.utc))
    view = ledger.exception_view(tables["file_exception"], definitions(spark, path), tables["whole_instance"], tables["whole_transfer"])
    said = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    ends = [F.coalesce(said(F.col("sys_period")[end]), F.lit("")) for end in ("lower", "upper")]
    period = F.concat(F.lit("["), ends[0], F.lit(","), ends[1], F.lit(")"))
    return view.withColumns({c: said(F.col(c)) for c in _TIMES} | {"sys_period": period})


@query(
    with_standins(
        MEMBERS,
        """select run as file_instance_id, attempt, status as file_instance_status, loaded, kept, errors, events, n as exceptions, n as numbered, records from (
          select (select count(*) from m where is_subscriber = 'Y') as loaded, (select count(*) from good where is_subscriber = 'Y') as kept,
            (select count(*) from x) as errors, (select count(*) from x) as n, (select count(distinct subscriber_id || member_id) from x) as records),
        (values (cast(1 as bigint), 2, 'stopped', cast(6 as bigint)), (cast(2 as bigint), 1, 'sent', cast(3 as bigint))) v(run, attempt, status, events)""",
        f"{_M},\n{_X},\n{_GOOD}",
    )
)
def edi_recorded_runs(spark, sf_dir):
    """A run stopped by its gate, twice, and one that was sent: what the ledger has of them."""
    log = Ledger(spark, new_folder(spark, "run-ledger"))
    members, covers = _members(spark, sf_dir), _covers(spark, sf_dir)
    for run, limit in ((1, 0), (1, 0), (2, MAX_ERRORS)):
        with contextlib.suppress(e.TooManyErrors):
            recorded_run(log, run, 7, members, covers, new_folder(spark, "edi-recorded"), ENVELOPE, limit)
    events = log.events().groupBy("file_instance_id").agg(F.count(F.lit(1)).alias("events"))
    found = log.exceptions().groupBy("file_instance_id").agg(
        F.count(F.lit(1)).alias("exceptions"), F.count_distinct("exception_id").alias("numbered"), F.count_distinct("file_record_id").alias("records")
    )
    runs = log.instances().select("file_instance_id", "attempt", "file_instance_status", "loaded", "kept", "errors")
    return runs.join(events, "file_instance_id").join(found, "file_instance_id")


@query(
    with_standins(
        ["file_exception"],
        """select row_number() over (order by file_instance_id nulls last, subscriber_id nulls last, member_id nulls last,
        detail nulls last, file_record_id nulls last) + 100 as exception_id, file_instance_id, subscriber_id, member_id,
        detail, file_record_id from file_exception""",
    )
)
def exception_numbers(spark, sf_dir):
    rows = standin(spark, sf_dir, "file_exception").select(
        "file_instance_id", "subscriber_id", "member_id", "detail", "file_record_id"
    )
    return ledger.number_exceptions(rows, start=100)


@query(
    with_standins(
        LEDGER[:2],
        """select * from file_instance where file_definition_id in (
        select file_definition_id from file_definition where file_definition_name like '%Vision%')""",
    )
)
def runs_like(spark, sf_dir):
    tables = standins(spark, sf_dir, *LEDGER[:2])
    return ledger.runs_like(tables["file_definition"], tables["file_instance"], "%Vision%")


@query(
    with_standins(
        ["file_event"],
        """select v.* from file_event v
        where v.event_time = (select max(w.event_time) from file_event w where w.file_instance_id = v.file_instance_id)
        and v.event_no = (select max(w.event_no) from file_event w
          where w.file_instance_id = v.file_instance_id and w.event_time = v.event_time)""",
    )
)
def run_status(spark, sf_dir):
    return ledger.current_status(standin(spark, sf_dir, "file_event"))


@query(with_standins(["file_exception"], "select * from file_exception where file_instance_id = 77"))
def run_rows(spark, sf_dir):
    return ledger.run_rows(standin(spark, sf_dir, "file_exception"), 77)


@query(
    with_standins(
        ["file_instance"],
        "select file_instance_id, file_name, file_instance_status from file_instance",
    )
)
def ledger_append(spark, sf_dir):
    """Runs appended in two batches and read back whole."""
    rows = standin(spark, sf_dir, "file_instance").select("file_instance_id", "file_name", "file_instance_status")
    path = new_folder(spark, "ledger")
    failed = F.col("file_instance_status") == "failed"
    ledger.ledger_append(rows.where(failed), path)
    ledger.ledger_append(rows.where(~failed), path)
    return ledger.load_ledger(spark, path)


# --- snapshot --------------------------------------------------------------------------------


@query(
    """select s.member, s.source, s.company, r.n_name as group_number from (
      select c_name as member, 'first' as source, c_nationkey as company from customer
      union all select s_name, 'second', s_nationkey from supplier) s
    left join (select n_nationkey, n_name from nation where n_regionkey <> 2) r on r.n_nationkey = s.company"""
)
def refresh_of_snapshot(spark, sf_dir):
    """Every member of a snapshot after its second refresh."""
    first = scan(spark, sf_dir, "customer").select(F.col("c_name").alias("member"), F.col("c_nationkey").alias("company"))
    second = scan(spark, sf_dir, "supplier").select(F.col("s_name").alias("member"), F.col("s_nationkey").alias("company"))
    named = scan(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("company"), F.col("n_name").alias("group_number"), "n_regionkey")
    path = new_folder(spark, "snapshot")
    refresh_snapshot(first, second, named.where("n_regionkey = 2").drop("n_regionkey"), path)
    refresh_snapshot(first, second, named.where("n_regionkey <> 2").drop("n_regionkey"), path)
    return read_snapshot(spark, path).select("member", "source", "company", "group_number")
