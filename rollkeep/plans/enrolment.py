"""The enrolment file: members to segments and back, checks, rejects, the error gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.functions.predicates import DateLike, as_date
from rollkeep.functions.scalars import element, parse_compact_date
from rollkeep.operators import joins
from rollkeep.operators.next_fit import next_fit
from rollkeep.operators.ordering import running_before
from rollkeep.plans.sent import with_times_sent
from rollkeep.sources.segments import (
    DATE,
    USUAL,
    Named,
    Segment,
    Separators,
    dated,
    fields_of,
    joined,
    looped_segments,
    number_of,
    write_segments,
)
from rollkeep.sources.staging import discard, scope, staged

# --- reading -------------------------------------------------------------------------------

_MEMBER_KEY = ["file", "txn_id", "family_id", "member_id"]


def read_edi(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Segments with positions and loop ids, staged because every later step reads them."""
    return looped_segments(spark, path)


# What a member's and a coverage's own columns hold: (tag, qualifier in the first element). Of each, the first segment is
# read into columns and kept whole in own_segments; all others are kept as they are, in order.
_MEMBER_NAMED = ("INS", "REF|0F", "REF|23", "DTP|303", "NM1|IL", "PER|IP", "N3", "N4", "DMG")
_COVERAGE_NAMED = ("HD", "DTP|303", "DTP|348", "DTP|349")


# Of these, only segments in the loop of the member's own name count as the member's.
_OF_MEMBER = ("PER", "N3", "N4", "DMG")


def _gathered(segments: DataFrame, keys: Sequence[str], named: Sequence[str]) -> DataFrame:
    """One row per group with its segments in order: those of ``named`` by name, with all their elements in the map
    ``own_segments``, the others as a list of elements, and in ``segment_order`` the names as they stand, ``#`` for others.

    A group is a member or a coverage, which holds a few dozen segments.
    """
    full = F.concat_ws("|", "tag", F.try_element_at("elements", F.lit(2)))
    plain = [n for n in named if "|" not in n]
    name = F.when(full.isin(*[n for n in named if "|" in n]), full).when(F.col("tag").isin(*plain), F.col("tag"))
    own_party = ~F.col("tag").isin(*_OF_MEMBER) | F.coalesce(F.col("party") == "IL", F.lit(False))
    rows = segments.select(*keys, "pos", F.when(own_party, name).alias("_name"), "elements")
    own = F.sort_array(F.collect_list(F.struct("pos", F.col("_name").alias("name"), "elements")))
    # Made as part of the aggregate and named inside lambdas: as columns over each other these are put into every
    # condition on a column, and into each other once per segment.
    parts = _named_once(own, lambda own: _named_once(_first_names(own["name"]), lambda order: _split_by_name(own, order)))
    return rows.groupBy(*keys).agg(F.min("pos").alias("pos"), parts.alias("_parts")).select(*keys, "pos", "_parts.*")


def _named_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _first_names(names: Column) -> Column:
    """The names with each only at its first place, ``#`` at the others."""

    def of(names: Column) -> Column:
        return F.transform(names, lambda name, at: F.when(F.array_position(names, name) == at + 1, name).otherwise("#"))

    return _named_once(names, of)


def _split_by_name(own: Column, order: Column) -> Column:
    others = F.filter(own, lambda _, at: F.get(order, at) == "#")
    first = F.filter(own, lambda _, at: F.get(order, at) != "#")
    return F.struct(
        order.alias("segment_order"),
        others["elements"].alias("other_segments"),
        F.map_from_arrays(first["name"], first["elements"]).alias("own_segments"),
    )


def _picked(named: str, position: int) -> Column:
    """An element of the group's first segment of this name; null when there is none."""
    return element(F.col("own_segments")[named], position)


# The kinds of contact in PER03 that are telephones; a number without a kind is taken for one.
_PHONES = ("", "AP", "BN", "CP", "HP", "TE", "WP")


def members(segments: DataFrame) -> DataFrame:
    """One row per member from the segments before its first coverage, those without a column in ``other_segments``.

    ``own_segments`` has every element of the segments that columns come from, ``segment_order`` the order of all;
    :func:`write_edi` writes them back as they were.
    """
    own = segments.where(F.col("member_id").isNotNull() & F.col("coverage_id").isNull())
    # a coverage id runs on through the following members, so their own segments carry none
    return _gathered(own, _MEMBER_KEY, _MEMBER_NAMED).select(
        *_MEMBER_KEY,
        "pos",
        _picked("INS", 1).alias("is_subscriber"),
        _picked("INS", 2).alias("relationship"),
        _picked("INS", 3).alias("maintenance_type"),
        _picked("INS", 4).alias("maintenance_reason"),
        _picked("INS", 5).alias("benefit_status"),
        _picked("INS", 8).alias("employment_status"),
        _picked("INS", 9).alias("student_status"),
        _picked("INS", 17).cast("int").alias("member_seq"),
        _picked("REF|0F", 2).alias("subscriber_id"),
        _picked("REF|23", 2).alias("member_code"),
        _picked("NM1|IL", 3).alias("last_name"),
        _picked("NM1|IL", 4).alias("first_name"),
        _picked("NM1|IL", 5).alias("middle_name"),
        _picked("NM1|IL", 6).alias("name_prefix"),
        _picked("NM1|IL", 7).alias("name_suffix"),
        _picked("NM1|IL", 9).alias("national_id"),
        F.when(F.coalesce(_picked("PER|IP", 3), F.lit("")).isin(*_PHONES), _picked("PER|IP", 4)).alias("phone"),
        _picked("N3", 1).alias("address1"),
        _picked("N3", 2).alias("address2"),
        _picked("N4", 1).alias("city"),
        _picked("N4", 2).alias("state"),
        _picked("N4", 3).alias("postal"),
        parse_compact_date(_picked("DMG", 2)).alias("birth_date"),
        _picked("DMG", 3).alias("sex"),
        _picked("DMG", 4).alias("marital_status"),
        parse_compact_date(_picked("DTP|303", 3)).alias("maintenance_date"),
        "other_segments",
        "own_segments",
        "segment_order",
    )


def coverages(segments: DataFrame) -> DataFrame:
    """One row per coverage; a member may have several."""
    inside = segments.where(F.col("coverage_id").isNotNull())
    return _gathered(inside, [*_MEMBER_KEY, "coverage_id"], _COVERAGE_NAMED).select(
        *_MEMBER_KEY,
        "coverage_id",
        _picked("HD", 1).alias("maintenance_type"),
        _picked("HD", 3).alias("insurance_line"),
        _picked("HD", 4).alias("plan"),
        _picked("HD", 5).alias("coverage_level"),
        parse_compact_date(_picked("DTP|303", 3)).alias("maintenance_date"),
        parse_compact_date(_picked("DTP|348", 3)).alias("benefit_begin"),
        parse_compact_date(_picked("DTP|349", 3)).alias("benefit_end"),
        "other_segments",
        "own_segments",
        "segment_order",
    )


# --- checks on a file ----------------------------------------------------------------------


def txn_totals(segments: DataFrame) -> DataFrame:
    """Members per transaction: dependents, employees and both."""
    ins = segments.where("tag = 'INS'")
    return ins.groupBy("file", "txn_id").agg(
        F.count_if(element("elements", 1) == "N").alias("dependents"),
        F.count_if(element("elements", 1) == "Y").alias("employees"),
        F.count(F.lit(1)).alias("total"),
    )


def check_totals(segments: DataFrame) -> DataFrame:
    """Stated quantities against counted members; a quantity the file does not state passes."""
    stated = segments.where("tag in ('QTY', 'ST')").groupBy("file", "txn_id").agg(
        *[
            F.max(F.when(element("elements", 1) == code, element("elements", 2).try_cast("long"))).alias(f"stated_{name}")
            for code, name in (("DT", "dependents"), ("ET", "employees"), ("TO", "total"))
        ]
    )
    both = joins.left(stated, txn_totals(segments), ["file", "txn_id"])
    names = ["dependents", "employees", "total"]
    counted = both.select(
        "file", "txn_id", *[f"stated_{n}" for n in names], *[F.coalesce(n, F.lit(0)).alias(n) for n in names]
    )
    ok = F.lit(True)
    for name in names:
        ok = ok & F.coalesce(F.col(f"stated_{name}") == F.col(name), F.col(f"stated_{name}").isNull())
    return counted.select("*", ok.alias("ok"))


def check_envelope(segments: DataFrame) -> DataFrame:
    """Control counts and numbers: segments per transaction, transactions per group, groups per file."""
    number = element("elements", 1).try_cast("long")

    def stated(tag: str) -> Column:
        return F.max(F.when(F.col("tag") == tag, number))

    def control(tag: str) -> Column:
        return F.max(F.when(F.col("tag") == tag, element("elements", 2)))

    per_txn = (
        segments.where(F.col("txn_id").isNotNull())
        .groupBy("file", "txn_id")
        .agg(
            stated("SE").alias("stated"),
            F.count(F.lit(1)).alias("counted"),
            F.coalesce(control("ST") == control("SE"), F.lit(False)).alias("same_control"),
        )
        .select("file", F.lit("SE").alias("tag"), "txn_id", "stated", "counted", "same_control")
    )
    ends = segments.where("tag in ('GS', 'GE', 'ISA', 'IEA', 'ST')")
    per_group = (
        ends.where("tag in ('GS', 'GE', 'ST') and group_id is not null")
        .groupBy("file", "group_id")
        .agg(
            stated("GE").alias("_ge"),
            F.count_if(F.col("tag") == "ST").alias("_st"),
            F.coalesce(F.max(F.when(F.col("tag") == "GS", element("elements", 6))) == control("GE"), F.lit(False)).alias("_ok"),
        )
    )
    file_control = F.max(F.when(F.col("tag") == "ISA", element("elements", 13))) == control("IEA")
    per_file = ends.groupBy("file").agg(
        stated("IEA").alias("_iea"), F.count_if(F.col("tag") == "GS").alias("_gs"), F.coalesce(file_control, F.lit(False)).alias("_ok")
    )
    none = F.lit(None).cast("long")
    rows = per_txn.select("file", "tag", none.alias("group_id"), "txn_id", "stated", "counted", "same_control")
    rows = rows.unionAll(per_group.select("file", F.lit("GE"), "group_id", none, "_ge", "_st", "_ok"))
    rows = rows.unionAll(per_file.select("file", F.lit("IEA"), none, none, "_iea", "_gs", "_ok"))
    return rows.select("*", (F.coalesce(F.col("stated") == F.col("counted"), F.lit(False)) & F.col("same_control")).alias("ok"))


def transactions(segments: DataFrame) -> DataFrame:
    """One row per transaction: its file, group and place in the group, what its header says, and what its group states.

    Only the segments before the first member count, one row of them per transaction. A code that a header holds several
    times gives its first one.
    """
    at = F.col("pos")

    def first(tag: str, position: int, qualifier: str | None = None) -> Column:
        mine = F.col("tag") == tag
        if qualifier is not None:
            mine = mine & (element("elements", 1) == qualifier)
        return F.min_by(element("elements", position), F.when(mine, at))

    def day(qualifier: str) -> Column:
        return parse_compact_date(first("DTP", 3, qualifier))

    parties = {"sponsor": "P5", "insurer": "IN", "broker": "BO", "administrator": "TV"}
    header = segments.where("txn_id is not null and member_id is null and tag <> 'SE'")
    found = header.groupBy("file", "group_id", "txn_id").agg(
        first("ST", 2).alias("control"),
        first("ST", 3).alias("version"),
        first("BGN", 1).alias("purpose"),
        first("BGN", 2).alias("reference"),
        parse_compact_date(first("BGN", 3)).alias("created"),
        first("BGN", 4).alias("created_time"),
        first("BGN", 6).alias("original_reference"),
        first("BGN", 8).alias("action"),
        first("REF", 2, "38").alias("policy"),
        day("007").alias("effective_date"),
        day("090").alias("report_start"),
        day("091").alias("report_end"),
        day("303").alias("maintenance_effective"),
        day("382").alias("enrolment_date"),
        *[
            first("N1", position, code).alias(f"{name}_{part}")
            for name, code in parties.items()
            for part, position in (("name", 2), ("id_qualifier", 3), ("id", 4))
        ],
    )
    groups = segments.where("tag in ('GS', 'ST')").groupBy("file", "group_id").agg(
        F.min("txn_id").alias("_first"),
        *[
            F.max(F.when(F.col("tag") == "GS", element("elements", position))).alias(name)
            for position, name in ((1, "functional_id"), (2, "sender_code"), (3, "receiver_code"), (6, "group_control"), (8, "group_version"))
        ],
    )
    # A transaction outside of any group keeps its row.
    keys = ["file", "group_id"]
    joined_rows = joins.left(found, groups.where("group_id is not null"), keys)
    place = (F.col("txn_id") - F.col("_first") + 1).alias("txn_in_group")
    return joined_rows.select(*keys, "txn_id", place, *[c for c in joined_rows.columns if c not in (*keys, "txn_id", "_first")])


# --- validation ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Checks on an element: ``allowed`` values, a ``max_length`` and ``required``, each on its own.

    ``of`` limits it to subscribers (``Y``) or dependents (``N``).
    """

    loop: str
    tag: str
    position: int
    name: str
    allowed: tuple[str, ...] = ()
    max_length: int | None = None
    required: bool = False
    of: str | None = None


# The rules seen in the exception reports.
RULES = (
    Rule("2000", "INS", 9, "Student Status Code", allowed=("P", "F", "N")),
    Rule("2100A", "N4", 2, "State Code", max_length=2),
    Rule("2000", "INS", 8, "Employment Status Code", required=True, of="Y"),
)

# Fixed value, as the texts in the conditions are: what the exception reports say.
MISSING = "Missing required element."


def _conditions(rule: Rule) -> list[tuple[Column, str, Column]]:
    """Each condition that the rule sets: when it fails, the kind of failure and its text."""
    value, where = element("elements", rule.position), f"Loop id {rule.loop} Segment ID: {rule.tag} {rule.name}"
    stated, found = F.concat(F.lit(f"{where} ["), value, F.lit("]")), []
    if rule.required:
        found.append((value.isNull(), MISSING, F.lit(where)))
    if rule.max_length is not None:
        limit = F.lit(f" exceeds the maximum length of {rule.max_length}")
        detail = F.concat(stated, F.lit(" length of "), F.length(value).cast("string"), limit)
        found.append((F.length(value) > rule.max_length, "Invalid element length.", detail))
    if rule.allowed:
        listed = F.lit(f" must equal one of {','.join(rule.allowed)}.")
        found.append((~value.isin(*rule.allowed), "Illegal element value.", F.concat(stated, listed)))
    return found


# what an exception says of the member; the last two are there when a run numbers its records
_WHO = ("subscriber_id", "member_code", "is_subscriber", "file_instance_id", "file_record_id")


def validate(elements: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Exceptions for rows ``subscriber_id, member_code, is_subscriber, tag, elements``, and with the run's and the record's
    number where the rows have them.

    The rules are few and become columns: each segment is tested against the rules of its tag
    in place, so the input is read once and only failures are widened to rows. A required element
    of a segment that a member does not have at all is missing too, where the rows show the member.
    """
    who = [c for c in _WHO if c in elements.columns]

    def applies(rule: Rule) -> Column:
        return F.lit(True) if rule.of is None else F.col("is_subscriber") == rule.of

    found = [
        F.when((F.col("tag") == rule.tag) & applies(rule) & failed, F.struct(F.lit(kind).alias("sub_category"), detail.alias("detail")))
        for rule in rules
        for failed, kind, detail in _conditions(rule)
    ]
    tags = sorted({rule.tag for rule in rules})
    failures = elements.where(F.col("tag").isin(*tags)).select(*who, F.explode(F.array_compact(F.array(*found))).alias("_e"))
    # the INS segment is there for every member, so only other tags can be absent
    absent = [rule for rule in rules if rule.required and rule.tag not in ("INS", "HD")]
    if absent:
        present = elements.groupBy(*who).agg(F.collect_set("tag").alias("_tags"))
        lacking = [
            F.when(
                applies(rule) & ~F.array_contains("_tags", rule.tag),
                F.struct(F.lit(MISSING).alias("sub_category"), F.lit(f"Loop id {rule.loop} Segment ID: {rule.tag} {rule.name}").alias("detail")),
            )
            for rule in absent
        ]
        failures = failures.unionAll(present.select(*who, F.explode(F.array_compact(F.array(*lacking))).alias("_e")))
    return failures.select(
        F.lit("ERROR").alias("exception_type"),
        F.lit("DATA ELEMENT").alias("category"),
        "_e.sub_category",
        "_e.detail",
        "subscriber_id",
        F.col("member_code").alias("member_id"),
        *who[3:],
    )


def file_elements(segments: DataFrame) -> DataFrame:
    """The element rows of a file that was read, with the member they belong to."""
    who = members(segments).select(*_MEMBER_KEY, "subscriber_id", "member_code", "is_subscriber")
    own = segments.where(F.col("member_id").isNotNull()).select(*_MEMBER_KEY, "tag", "elements")
    return joins.inner(own, who, _MEMBER_KEY).drop(*_MEMBER_KEY)


def exception_counts(exceptions: DataFrame) -> DataFrame:
    return exceptions.groupBy("category", "sub_category").agg(F.count(F.lit(1)).alias("n"))


def reject_families(rows: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Rows whose subscriber has no exception; one bad member removes its whole family."""
    return joins.anti(rows, exceptions, ["subscriber_id"])


def run_counts(loaded: DataFrame, kept: DataFrame, exceptions: DataFrame) -> DataFrame:
    """One row: subscribers loaded and kept, and errors."""

    def subscribers(rows: DataFrame, name: str) -> Column:
        return rows.agg(F.count_if(F.col("is_subscriber") == "Y")).scalar().alias(name)

    errors = exceptions.agg(F.count(F.lit(1)).alias("errors"))
    return errors.select(subscribers(loaded, "loaded"), subscribers(kept, "kept"), "errors")


def gate(exceptions: DataFrame, max_errors: int = 0) -> DataFrame:
    """One row: the error count, the maximum and whether the run may be published."""
    return exceptions.agg(F.count(F.lit(1)).alias("errors")).select(
        "errors", F.lit(max_errors).alias("max_errors"), (F.col("errors") <= max_errors).alias("passed")
    )


class TooManyErrors(RuntimeError):
    """The error gate is closed; ``exceptions`` are the rows that closed it."""

    def __init__(self, message: str, exceptions: DataFrame | None = None) -> None:
        super().__init__(message)
        self.exceptions = exceptions


def enforce_gate(exceptions: DataFrame, max_errors: int = 0) -> int:
    """Stop before publishing when there are more errors than allowed; returns the error count."""
    return _gate_check(gate(exceptions, max_errors).first()["errors"], max_errors, exceptions)


def _gate_check(errors: int, max_errors: int, exceptions: DataFrame) -> int:
    if errors > max_errors:
        raise TooManyErrors(f"the number of errors ({errors}) exceeds the maximum of {max_errors}", exceptions)
    return errors


# --- selection and splitting ---------------------------------------------------------------


def limit_members(
    rows: DataFrame,
    lookback_min: DateLike | None = None,
    termination_min: DateLike | None = None,
    member_term_limit: int | None = None,
    changed: str = "maintenance_date",
    ended: str = "benefit_end",
    times_sent: str | DataFrame = "times_sent",
    keys: Sequence[str] = ("subscriber_id", "member_seq", "coverage_seq"),
) -> DataFrame:
    """Members a run sends: open ones, and ended ones that ended on or after ``termination_min`` and
    were sent as ended fewer than ``member_term_limit`` times; with ``lookback_min``, changed since then
    or at an unknown time.

    ``times_sent`` is a column, or the ledger of what earlier runs sent, by ``keys`` (:mod:`rollkeep.plans.sent`); the
    column of that name is then part of the result.

    The meaning of the three limits is inferred from their names; leave one out to skip it.
    """
    if isinstance(times_sent, DataFrame):
        rows, times_sent = with_times_sent(rows, times_sent, keys, ended), "times_sent"
    closed_ok = F.lit(True)
    if termination_min is not None:
        closed_ok = closed_ok & (F.col(ended) >= as_date(termination_min))
    if member_term_limit is not None:
        closed_ok = closed_ok & (F.col(times_sent) < member_term_limit)
    keep = F.col(ended).isNull() | closed_ok
    if lookback_min is not None:
        keep = keep & (F.col(changed).isNull() | (F.col(changed) >= as_date(lookback_min)))
    return rows.where(keep)


def termination_counts(rows: DataFrame, run: str = "file_instance_id") -> DataFrame:
    return rows.groupBy(run).agg(
        F.count_if(F.col("benefit_end").isNotNull()).alias("terminations"), F.count(F.lit(1)).alias("members")
    )


def split_sets(rows: DataFrame, soft_limit: int) -> DataFrame:
    """Transaction set per family: ``subscriber_id, family_size, members_before, set_no``.

    Families go in subscriber order and stay whole. A family belongs to the set in which its
    first member falls, so a set may run over the limit by the rest of one family. A member
    without a subscriber id has no place in a file and stops the job.
    """
    known = F.coalesce("subscriber_id", F.raise_error(F.lit("a member has no subscriber id")))
    families = rows.groupBy(known.alias("subscriber_id")).agg(F.count(F.lit(1)).alias("family_size"))
    placed = running_before(families, ["subscriber_id"], {"members_before": "family_size"})
    return placed.select("*", F.expr(f"members_before div {soft_limit}").alias("set_no"))


def split_sets_restart(rows: DataFrame, soft_limit: int) -> DataFrame:
    """The same by the other reading of the soft limit: a set is closed before the family that would take it over the
    limit, and the count starts again with the next; only a family that is larger by itself makes a set that is."""
    counted = split_sets(rows, soft_limit).drop("set_no")
    return next_fit(counted, ["subscriber_id"], "family_size", soft_limit, "set_no")


# --- writing -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Envelope:
    """What the run states about itself; invented defaults.

    ``sets_per_interchange``: left out, a run is one interchange; stated, it becomes as many as it takes.
    ``restart``: count anew for each set (:func:`split_sets_restart`). ``first_control``: control number of the first
    interchange, of its group and of the first set; folders are numbered from it too, less one.
    """

    sender: str = "SENDER"
    receiver: str = "RECEIVER"
    policy: str = "POLICY"
    sponsor: str = "SPONSOR"
    sponsor_id: str = "00-0000000"
    insurer: str = "INSURER"
    insurer_id: str = "99-9999999"
    stamp: dt.datetime = dt.datetime(2020, 1, 1)
    version: str = "005010X220A1"
    purpose: str = "00"
    action: str = "4"
    soft_limit: int = 990
    sets_per_interchange: int | None = None
    restart: bool = False
    first_control: int = 1
    separators: Separators = USUAL

    def __post_init__(self) -> None:
        for name in (self.sender, self.receiver):
            if len(name) > 15:
                raise ValueError(f"the envelope has room for 15 characters: {name}")


def _text(value: str) -> str:
    """A setting as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _plain(value: str) -> str:
    """A setting without separators, for segments that are not built from elements."""
    return value.translate(str.maketrans("*~>^", "    "))


_ORDER = ["section", "set_no", "turn", "subscriber_id", "member_seq", "coverage_seq"]


def _filled(*columns: str) -> str:
    return "(" + " or ".join(f"coalesce({c}, '') <> ''" for c in columns) + ")"


_KNOWN = f"(birth_date is not null or {_filled('sex', 'marital_status')})"

def _as_read(places: dict[int, str]) -> dict[int, tuple[str, str]]:
    return {place: (column, "nullif({raw}, '')") for place, column in places.items()}


_PER = "own_segments['PER|IP']"
_TELEPHONE = f"coalesce(get({_PER}, 3), '') in ({', '.join(repr(kind) for kind in _PHONES)})"
# a phone that comes to another kind of contact goes before it
_CONTACTS = f"slice({_PER}, case when {_TELEPHONE} or phone is null then 6 else 4 end, size({_PER}))"

# the segments of a member before its coverages, and of a coverage
MEMBER_SEGMENTS = (
    Named(
        "INS",
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
        read=_as_read(
            {
                1: "is_subscriber",
                2: "relationship",
                3: "maintenance_type",
                4: "maintenance_reason",
                5: "benefit_status",
                8: "employment_status",
                9: "student_status",
            }
        ),
    ),
    Named("REF|0F", "REF", "'0F'", "subscriber_id", read=_as_read({2: "subscriber_id"})),
    Named("REF|23", "REF", "'23'", "member_code", when=_filled("member_code"), read=_as_read({2: "member_code"})),
    dated("DTP", "303", "maintenance_date"),
    Named(
        "NM1|IL",
        "NM1",
        "'IL'",
        "'1'",
        "last_name",
        "first_name",
        "middle_name",
        "name_prefix",
        "name_suffix",
        "case when national_id is not null then '34' end",
        "national_id",
        read=_as_read({3: "last_name", 4: "first_name", 5: "middle_name", 6: "name_prefix", 7: "name_suffix", 9: "national_id"}),
        along={8: 9},
    ),
    Named(
        "PER|IP",
        "PER",
        "'IP'",
        "''",
        "case when phone is not null then 'HP' end",
        "phone",
        when=_filled("phone"),
        read={4: ("phone", f"case when {_TELEPHONE} then nullif({{raw}}, '') end")},
        along={3: 4},
        rest=_CONTACTS,
    ),
    Named("N3", "N3", "address1", "address2", when=_filled("address1", "address2"), read=_as_read({1: "address1", 2: "address2"})),
    Named(
        "N4",
        "N4",
        "city",
        "state",
        "postal",
        when=_filled("city", "state", "postal"),
        read=_as_read({1: "city", 2: "state", 3: "postal"}),
    ),
    Named(
        "DMG",
        "DMG",
        "'D8'",
        "date_format(birth_date, 'yyyyMMdd')",
        "sex",
        "marital_status",
        when=_KNOWN,
        read={2: ("birth_date", DATE)} | _as_read({3: "sex", 4: "marital_status"}),
        along={1: 2},
    ),
)
COVERAGE_SEGMENTS = (
    Named(
        "HD",
        "HD",
        "maintenance_type",
        "''",
        "insurance_line",
        "plan",
        "coverage_level",
        read=_as_read({1: "maintenance_type", 3: "insurance_line", 4: "plan", 5: "coverage_level"}),
    ),
    dated("DTP", "303", "maintenance_date"),
    dated("DTP", "348", "benefit_begin"),
    dated("DTP", "349", "benefit_end"),
)


# columns that members and coverages may come without
_KEPT = {"other_segments": "array<array<string>>", "own_segments": "map<string, array<string>>", "segment_order": "array<string>"}
_MEMBER_OPTIONAL = {"name_prefix": "string", "name_suffix": "string", "marital_status": "string"}
_COVERAGE_OPTIONAL = {"maintenance_date": "date"}


def _was_read(rows: DataFrame) -> bool:
    return "own_segments" in rows.columns


def _complete(rows: DataFrame, optional: dict[str, str]) -> DataFrame:
    """Rows with all columns that segments are made of; those that only reading gives all or none."""
    wanted = optional | (_KEPT if _was_read(rows) or "other_segments" in rows.columns else {})
    return rows.withColumns({name: F.lit(None).cast(kind) for name, kind in wanted.items() if name not in rows.columns})


def _segments_of(rows: DataFrame, segments: Sequence[Named]) -> Sequence[Segment]:
    """The segments of these rows: rows that were never read need no comparison with what was read."""
    return segments if _was_read(rows) else [s.new for s in segments]


def _elements(rows: DataFrame, segments: Sequence[Named], rules: Sequence[Rule]) -> DataFrame:
    who, ruled = [c for c in _WHO if c in rows.columns], {rule.tag for rule in rules}
    # the first segment shows that the member is there
    wanted = [s for i, s in enumerate(_segments_of(rows, segments)) if i == 0 or s.tag in ruled]
    every = fields_of(*wanted)
    if "other_segments" in rows.columns:
        every = F.concat(every, F.coalesce("other_segments", F.array().cast("array<array<string>>")))
    lines = rows.select(*who, F.explode(every).alias("elements"))
    return lines.select(*who, F.element_at("elements", 1).alias("tag"), "elements")


def member_elements(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The element rows of members that are about to be written, for :func:`validate`. Only
    segments that have a rule are made, and the first."""
    return _elements(_complete(rows, _MEMBER_OPTIONAL), MEMBER_SEGMENTS, rules)


def coverage_elements(rows: DataFrame, covers: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same for the coverages of these members."""
    key = ["subscriber_id", "member_seq"]
    who = rows.select(*key, *[c for c in _WHO if c in rows.columns and c != "subscriber_id"])
    return _elements(joins.inner(_complete(covers, _COVERAGE_OPTIONAL), who, key), COVERAGE_SEGMENTS, rules)


def all_exceptions(rows: DataFrame, covers: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Exceptions of every rule, on members and on coverages."""
    of_covers = [rule for rule in rules if rule.loop.startswith("23") or rule.tag == "HD"]
    of_members = [rule for rule in rules if rule not in of_covers]
    found = validate(member_elements(rows, of_members), of_members) if of_members else None
    if of_covers:
        more = validate(coverage_elements(rows, covers, of_covers), of_covers)
        found = more if found is None else found.unionAll(more)
    return found


def _header(envelope: Envelope) -> tuple[Segment, ...]:
    """The segments that open a transaction, over its ``control`` and quantities."""
    day, time = f"'{envelope.stamp:%Y%m%d}'", f"'{envelope.stamp:%H%M}'"
    return (
        Segment("ST", "'834'", "control", _text(envelope.version)),
        Segment("BGN", _text(envelope.purpose), "control", day, time, "'LT'", "''", "''", _text(envelope.action)),
        Segment("REF", "'38'", _text(envelope.policy)),
        Segment("DTP", "'007'", "'D8'", day),
        Segment("QTY", "'DT'", "dependents"),
        Segment("QTY", "'ET'", "employees"),
        Segment("QTY", "'TO'", "total"),
        Segment("N1", "'P5'", _text(envelope.sponsor), "'FI'", _text(envelope.sponsor_id)),
        Segment("N1", "'IN'", _text(envelope.insurer), "'FI'", _text(envelope.insurer_id)),
    )


def _opening(envelope: Envelope) -> str:
    """The two segments before the transactions of an interchange, the first of fixed width."""
    stamp = envelope.stamp
    isa = (
        f"ISA*00*{'':10}*00*{'':10}*30*{_plain(envelope.sender):15}*30*{_plain(envelope.receiver):15}"
        f"*{stamp:%y%m%d}*{stamp:%H%M}*^*00501*"
    )
    gs = f"~GS*BE*{_plain(envelope.sender)}*{_plain(envelope.receiver)}*{stamp:%Y%m%d}*{stamp:%H%M}*"
    return f"concat({_text(isa)}, control, '*0*P*>', {_text(gs)}, control, {_text('*X*' + _plain(envelope.version))})"


def edi_units(rows: DataFrame, covers: DataFrame, envelope: Envelope) -> tuple[DataFrame, int]:
    """What the output is made of, one row each: the interchange's ends, a transaction's ends,
    a member, a coverage. ``kind`` tells them apart; each has the columns its segments need, and ``part``, the number of
    the output partition that it belongs to: as many members each, in the order of the file. With the number of those."""
    rows, covers = _complete(rows, _MEMBER_OPTIONAL), _complete(covers, _COVERAGE_OPTIONAL)
    split = split_sets_restart if envelope.restart else split_sets
    sets_of = staged(split(rows, envelope.soft_limit), "sets")
    n = sets_of.agg(F.coalesce(F.max(F.col("members_before") + F.col("family_size")), F.lit(0))).first()[0]
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // MEMBERS_PER_PART))
    per_part = max(1, -(-n // parts))
    placed = sets_of.select("subscriber_id", "set_no", F.expr(f"cast(members_before div {per_part} as int)").alias("part"))
    member = joins.inner(rows, placed, ["subscriber_id"])
    kept = joins.semi(covers, rows, ["subscriber_id", "member_seq"])
    cover = joins.inner(kept, placed, ["subscriber_id"])

    zero, first = F.lit(0), envelope.first_control
    # counted before they are joined, so that no exchange carries what was read
    sizes = rows.select(
        "subscriber_id",
        (number_of(*_segments_of(rows, MEMBER_SEGMENTS)) + _more(rows)).alias("lines"),
        F.expr("case when is_subscriber = 'N' then 1 else 0 end").alias("dependent"),
        F.expr("case when is_subscriber = 'Y' then 1 else 0 end").alias("employee"),
        F.lit(1).alias("one"),
    ).unionAll(kept.select("subscriber_id", number_of(*_segments_of(covers, COVERAGE_SEGMENTS)) + _more(covers), zero, zero, zero))
    sets = staged(
        joins.inner(sizes, placed, ["subscriber_id"]).groupBy("set_no").agg(
            F.sum("dependent").alias("dependents"),
            F.sum("employee").alias("employees"),
            F.sum("one").alias("total"),
            (F.sum("lines") + len(_header(envelope)) + 1).alias("lines"),
            F.expr(f"lpad(cast(set_no + {first} as string), 9, '0')").alias("control"),
            F.min("part").alias("first_part"),
            F.max("part").alias("last_part"),
        ),
        "set-counts",
    )
    per_file = envelope.sets_per_interchange
    number = "0L" if per_file is None else f"set_no div {per_file}"
    files = (
        sets.groupBy(F.expr(number).alias("number"))
        .agg(F.count(F.lit(1)).alias("sets"), F.min("first_part").alias("first_part"), F.max("last_part").alias("last_part"))
        .select(
            F.expr(f"number * {per_file or 1}").alias("set_no"),
            "sets",
            F.expr(f"lpad(cast(number + {first} as string), 9, '0')").alias("control"),
            "first_part",
            "last_part",
        )
    )

    def units(source: DataFrame, kind: str, section: int, part: int) -> DataFrame:
        missing = [c for c in ("member_seq", "coverage_seq") if c not in source.columns]
        ends = {"opening": "first_part", "header": "first_part", "trailer": "last_part", "closing": "last_part"}
        placed_in = source.withColumnRenamed(ends[kind], "part").drop("first_part", "last_part") if kind in ends else source
        return placed_in.select(
            F.lit(kind).alias("kind"),
            F.lit(section).alias("section"),
            F.lit(part).alias("turn"),
            *[zero.alias(c) for c in missing],
            "*",
        )

    everything = units(files, "opening", 0, 0)
    for more in (
        units(sets, "header", 1, 0),
        units(member, "member", 1, 1),
        units(cover, "coverage", 1, 1),
        units(sets, "trailer", 1, 2),
        units(files, "closing", 2, 0),
    ):
        everything = everything.unionByName(more, allowMissingColumns=True)
    return everything.select(F.expr(f"{number} + {first - 1}").alias("interchange"), "*"), parts


# a partition of the output holds about so many members, or fewer where the session asks for more partitions
MEMBERS_PER_PART = 20_000


def _more(rows: DataFrame) -> Column:
    return F.coalesce(F.size("other_segments"), F.lit(0)) if "other_segments" in rows.columns else F.lit(0)


def unit_text(envelope: Envelope, rows: DataFrame, covers: DataFrame) -> str:
    """The segments of a unit of these members and coverages, as a SQL expression."""

    def own(source: DataFrame, segments: Sequence[Named]) -> str:
        if "other_segments" not in source.columns:
            return joined(*_segments_of(source, segments))
        order = "segment_order" if _was_read(source) else None
        return joined(*_segments_of(source, segments), others="other_segments", order=order)

    texts = {
        "opening": _opening(envelope),
        "header": joined(*_header(envelope)),
        "member": own(rows, MEMBER_SEGMENTS),
        "coverage": own(covers, COVERAGE_SEGMENTS),
        "trailer": joined(Segment("SE", "lines", "control")),
        "closing": joined(Segment("GE", "sets", "control"), Segment("IEA", "1", "control")),
    }
    return "case kind " + " ".join(f"when '{kind}' then {text}" for kind, text in texts.items()) + " end"


def write_edi(rows: DataFrame, covers: DataFrame, path: str, envelope: Envelope = Envelope()) -> None:
    """Write members (one row each) and their coverages as enrolment interchanges.

    Members have ``subscriber_id, member_seq`` (0 for the subscriber, then 1, 2, ..) and the
    columns :func:`members` returns; coverages have ``subscriber_id, member_seq, coverage_seq``. Of rows that were read,
    a segment keeps its place and its elements but those whose column was changed, and INS17 stays as it was read.
    Without members an empty folder is written.
    """
    with scope(rows.sparkSession):
        units, parts = edi_units(rows, covers, envelope)
        write_segments(units, path, _ORDER, unit_text(envelope, rows, covers), envelope.separators, ("part", parts))


# --- a whole run ---------------------------------------------------------------------------


def run_file(
    rows: DataFrame,
    covers: DataFrame,
    path: str,
    envelope: Envelope = Envelope(),
    max_errors: int = 0,
    rules: Sequence[Rule] = RULES,
) -> tuple[DataFrame, DataFrame]:
    """Validate, reject families, close the gate if need be, and write.

    Returns the one-row counts of the run and its exceptions. Without subscribers nothing is
    written. A closed gate raises before anything is written; its error carries the exceptions.

    Members and coverages are evaluated once, when they are staged; checks, counts and the writer read
    the columns they need of that. Counts are not taken as metrics along the way: those count a task's
    rows again when its executor is lost and it runs once more.
    """
    rows, covers = staged(rows, "run-members"), staged(covers, "run-coverages")
    exceptions = staged(all_exceptions(rows, covers, rules), "exceptions")
    kept = reject_families(rows, exceptions)
    counts = run_counts(rows, kept, exceptions)
    found = counts.first()
    counts = rows.sparkSession.createDataFrame([tuple(found)], counts.schema)
    if found["loaded"] == 0:
        return counts, exceptions
    _gate_check(found["errors"], max_errors, exceptions)
    write_edi(kept, covers, path, envelope)
    discard(rows, covers)
    return counts, exceptions
