"""Enrolment files: reading in blocks, round trips, checks, rejects and the gate."""

import datetime as dt
import glob
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollkeep.checks import enrolling as q
from rollkeep.operators import next_fit, ordering
from rollkeep.plans import enrolment as e
from rollkeep.plans.snapshot import read_snapshot, refresh_snapshot
from rollkeep.plans import runs
from rollkeep.plans.sent import fold_sent, record_sent, sent_before, with_times_sent
from rollkeep.plans.snapshot import drop_snapshots
from rollkeep.sources import ledger, segments as sg, staging
from rollkeep.sources.segments import Separators, read_segments, separators_of
from rollkeep.sources.versions import new_version, newest, versions

FILE = (
    "ISA*00*x*00*x*30*S*30*R*200101*0000*^*00501*000000007*0*P*>~GS*BE*S*R*20200101*0000*7*X*V~"
    "ST*834*0001*V~BGN*00*1*20200101*0000*LT***4~REF*38*P~QTY*DT*1~QTY*ET*2~QTY*TO*3~"
    "INS*Y*18*030*XN*A***FT~REF*0F*S1~REF*23*00~NM1*IL*1*Doe*Al~N4*Town*NY*1~DMG*D8*19900101*M~"
    "HD*030**VIS**EMP~DTP*348*D8*20200101~HD*030**PPO**EMP~DTP*348*D8*20200201~DTP*349*D8*20200301~"
    "INS*N*19*030*XN*A****U********1~REF*0F*S1~REF*23*01~NM1*IL*1*Doe*Bo~DMG*D8*20100101*F~HD*030**VIS**EMP~"
    "INS*Y*18*030*XN*A~REF*0F*S2~REF*23*00~NM1*IL*1*Roe*Cy~N4*Town*NYS*1~DMG*D8*19900101*M~HD*030**VIS**EMP~"
    "SE*31*0001~"
    "ST*834*0002*V~BGN*00*2*20200101*0000*LT***4~REF*38*P~QTY*DT*5~QTY*ET*1~"
    "INS*Y*18*030*XN*A***TE~REF*0F*S3~REF*23*00~NM1*IL*1*Poe*Di~DMG*D8*bad*M~"
    "SE*99*0003~GE*2*7~IEA*1*000000008~"
)


@pytest.fixture(params=["64m", "60"], ids=["one-block", "many-blocks"])
def segments(spark, conf, tmp_path, request):
    conf(spark__sql__files__maxPartitionBytes=request.param, spark__sql__files__openCostInBytes="1")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.x12").write_text(FILE.replace("~", "~\n"))
    raw = read_segments(spark, str(tmp_path / "in"))
    if request.param == "60":
        assert raw.select("block").distinct().count() > 5
    return e.read_edi(spark, str(tmp_path / "in"))


def test_positions_and_loops(segments):
    found = segments.orderBy("pos").collect()
    texts = FILE.split("~")[:-1]
    assert ["*".join(r["elements"]) for r in found] == texts
    assert [r["pos"] for r in found] == list(range(1, len(texts) + 1))
    txn = member = family = coverage = 0
    inside = None
    for r in found:
        tag = r["tag"]
        if tag in ("ST", "INS", "HD", "SE"):
            inside = tag
        txn += tag == "ST"
        member += tag == "INS"
        family += tag == "INS" and r["elements"][1] == "Y"
        coverage += tag == "HD"
        outside = tag in ("ISA", "GS", "GE", "IEA")
        in_member = inside in ("INS", "HD") and not outside
        assert r["txn_id"] == (None if outside else txn)
        assert r["member_id"] == (member if in_member else None)
        assert r["family_id"] == (family if in_member else None)
        assert r["coverage_id"] == (coverage if in_member and inside == "HD" else None)


def test_members_and_coverages(segments):
    who = rows(e.members(segments), "member_id", "subscriber_id", "first_name", "employment_status", "birth_date")
    assert who == [
        (1, "S1", "Al", "FT", dt.date(1990, 1, 1)),
        (2, "S1", "Bo", None, dt.date(2010, 1, 1)),
        (3, "S2", "Cy", None, dt.date(1990, 1, 1)),
        (4, "S3", "Di", "TE", None),
    ]
    covers = rows(e.coverages(segments), "member_id", "coverage_id", "insurance_line", "benefit_end")
    assert covers == [(1, 1, "VIS", None), (1, 2, "PPO", dt.date(2020, 3, 1)), (2, 3, "VIS", None), (3, 4, "VIS", None)]


def test_wrong_counts_are_found(segments):
    assert rows(e.check_totals(segments), "txn_id", "dependents", "employees", "total", "ok") == [
        (1, 1, 2, 3, True),
        (2, 0, 1, 1, False),
    ]
    checks = rows(e.check_envelope(segments), "tag", "txn_id", "stated", "counted", "same_control", "ok")
    assert checks == [
        ("GE", None, 2, 2, True, True),
        ("IEA", None, 1, 1, False, False),
        ("SE", 1, 31, 31, True, True),
        ("SE", 2, 99, 11, False, False),
    ]


def test_rules(segments):
    found = rows(e.validate(e.file_elements(segments)), "sub_category", "detail", "subscriber_id", "member_id")
    assert found == [
        ("Illegal element value.", "Loop id 2000 Segment ID: INS Student Status Code [U] must equal one of P,F,N.", "S1", "01"),
        ("Invalid element length.", "Loop id 2100A Segment ID: N4 State Code [NYS] length of 3 exceeds the maximum length of 2", "S2", "00"),
        ("Missing required element.", "Loop id 2000 Segment ID: INS Employment Status Code", "S2", "00"),
    ]


def test_bad_member_removes_the_family(spark):
    members = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 0)], "subscriber_id string, member_seq int")
    bad = spark.createDataFrame([("a", "01"), ("a", "00"), ("c", "00")], "subscriber_id string, member_id string")
    assert rows(e.reject_families(members, bad)) == [("b", 0)]


def test_gate(spark):
    errors = spark.createDataFrame([("x",)] * 3, "detail string")
    assert tuple(e.gate(errors, 3).first()) == (3, 3, True)
    assert e.enforce_gate(errors, 3) == 3
    with pytest.raises(e.TooManyErrors, match=r"errors \(3\) exceeds the maximum of 2"):
        e.enforce_gate(errors, 2)


@pytest.mark.parametrize("limit, sets", [(2, [0, 1, 1, 3]), (3, [0, 0, 1, 2]), (100, [0, 0, 0, 0])])
def test_families_stay_whole(spark, limit, sets):
    sizes = {"a": 2, "b": 1, "c": 3, "d": 1}
    members = spark.createDataFrame([(k,) for k, n in sizes.items() for _ in range(n)], "subscriber_id string")
    found = e.split_sets(members, limit).orderBy("subscriber_id").collect()
    assert [r["members_before"] for r in found] == [0, 2, 3, 6]
    assert [r["set_no"] for r in found] == sets


def test_member_without_subscriber_stops_the_job(spark):
    members = spark.createDataFrame([("a",), (None,)], "subscriber_id string")
    with pytest.raises(PySparkException, match="no subscriber id"):
        e.split_sets(members, 10).collect()


def _written(spark, tmp_path, **options):
    path = str(tmp_path / "out")
    envelope = e.Envelope(**options)
    e.write_edi(q._members(spark, SMALL), q._covers(spark, SMALL), path, envelope)
    return path


def test_written_parts_make_the_file(spark, conf, tmp_path):
    conf(spark__sql__shuffle__partitions="9", spark__sql__adaptive__coalescePartitions__enabled="false")
    path = _written(spark, tmp_path, soft_limit=100, sets_per_interchange=100)
    parts = sorted(glob.glob(f"{path}/interchange=0/part-*"))
    assert len(parts) > 1
    text = "".join(open(part).read() for part in parts)
    lines = text.split("~")
    assert lines[0].startswith("ISA*") and len(lines[0]) == 105
    assert lines[-2].startswith("IEA*1*") and lines[-1] == ""
    back = e.read_edi(spark, path).orderBy("pos").select(F.concat_ws("*", "elements").alias("v")).collect()
    assert [r["v"] for r in back] == [line.strip() for line in lines[:-1]]


def test_separators_inside_values_become_blanks(spark, tmp_path):
    members = q._members(spark, SMALL).where("subscriber_id = '000000001'").withColumn("last_name", F.lit("O*Neil~x"))
    path = str(tmp_path / "out")
    e.write_edi(members, q._covers(spark, SMALL), path)
    segments = e.read_edi(spark, path)
    assert rows(e.members(segments).select("last_name").distinct()) == [("O Neil x",)]
    assert e.check_totals(segments).where("not ok").count() == 0
    assert e.check_envelope(segments).where("not ok").count() == 0


def test_run_without_subscribers_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    counts, exceptions = e.run_file(q._members(spark, SMALL).where("false"), q._covers(spark, SMALL), path)
    assert tuple(counts.first()) == (0, 0, 0)
    assert exceptions.count() == 0
    assert not (tmp_path / "out").exists()


def test_closed_gate_writes_nothing(spark, tmp_path):
    with pytest.raises(e.TooManyErrors):
        e.run_file(q._members(spark, SMALL), q._covers(spark, SMALL), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_snapshot_is_replaced(spark, tmp_path):
    path = str(tmp_path / "snap")
    one = spark.createDataFrame([("m1", "A"), ("m2", "Z")], "member string, company string")
    two = spark.createDataFrame([("m3", "A")], "member string, company string")
    groups = spark.createDataFrame([("A", "G1")], "company string, group_number string")
    for _ in range(2):
        found = refresh_snapshot(one, two, groups, path)
        assert rows(found) == [("first", 2, 1), ("groups", 1, 1), ("second", 1, 1)]
    members = read_snapshot(spark, path)
    assert rows(members, "member", "group_number") == [("m1", "G1"), ("m2", None), ("m3", "G1")]


def test_failed_refresh_leaves_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "snap")
    one = spark.createDataFrame([("m1", "A")], "member string, company string")
    groups = spark.createDataFrame([("A", "G1")], "company string, group_number string")
    refresh_snapshot(one, one.limit(0), groups, path)
    with pytest.raises(Exception, match="more than one row"):
        refresh_snapshot(one, one, groups.union(groups), path)
    assert rows(read_snapshot(spark, path), "member", "group_number") == [("m1", "G1")]


# Invented members in the shapes that files of other writers have.
_FOREIGN = "~".join(
    [
        "ISA*00*          *00*          *30*A              *30*B              *200101*0000*^*00501*000000001*0*P*>",
        "GS*BE*A*B*20200101*0000*1*X*005010X220A1", "ST*834*0001*005010X220A1", "BGN*00*1*20200101*0000*LT***4", "REF*38*P1",
        "INS*Y*18*030**A***FT", "REF*0F*S1", "REF*DX*77", "REF*17*K5", "REF*1L*G9", "DTP*356*D8*20200105", "DTP*336*D8*20190101",
        "NM1*IL*1*Doe*Jo*Q*Dr*Jr*34*000000001", "N3*1 Way", "N4*Town*NY*10001", "DMG*D8*19800102*F*M", "LUI*LE*ENG*A>B",
        "HD*030**VIS*PLANX*EMP", "DTP*303*D8*20200203", "DTP*348*D8*20200301", "REF*1L*G9", "COB*P*890111",
        "INS*N*01*030**A", "REF*0F*S1", "NM1*IL*1*Doe*Al", "SE*22*0001", "GE*1*1",
        "GS*BE*A*B*20200101*0000*2*X*005010X220A1", "ST*834*0002*005010X220A1", "SE*3*0002", "GE*4*3", "IEA*2*000000001", "",
    ]
)


def test_members_of_other_writers_lose_nothing(spark, tmp_path):
    (tmp_path / "in.x12").write_text(_FOREIGN)
    segments = e.read_edi(spark, str(tmp_path / "in.x12"))
    found = e.members(segments).orderBy("pos").collect()
    first = found[0]
    assert (first["name_prefix"], first["name_suffix"], first["marital_status"], first["maintenance_date"]) == ("Dr", "Jr", "M", None)
    assert [s[:2] for s in first["other_segments"]] == [
        ["REF", "DX"], ["REF", "17"], ["REF", "1L"], ["DTP", "356"], ["DTP", "336"], ["LUI", "LE"],
    ]
    cover = e.coverages(segments).first()
    assert str(cover["maintenance_date"]) == "2020-02-03" and cover["other_segments"] == [["REF", "1L", "G9"], ["COB", "P", "890111"]]

    member = e.members(segments).withColumn("member_seq", F.col("member_id") - 1).drop("pos", "file", "txn_id", "family_id", "member_id")
    covers = e.coverages(segments).withColumns({"subscriber_id": F.lit("S1"), "member_seq": F.lit(0).cast("long"), "coverage_seq": F.lit(1)})
    out = str(tmp_path / "out")
    e.write_edi(member, covers.drop("file", "txn_id", "family_id", "member_id", "coverage_id"), out)
    again = e.read_edi(spark, out)

    def inside(table):
        kept = table.where("member_id is not null and tag not in ('SE', 'INS')")
        return rows(kept.select("member_id", "coverage_id", F.array_join("elements", "*").alias("text")))

    assert inside(again) == inside(segments)
    assert all(r["ok"] for r in e.check_envelope(again).collect())


def test_checks_are_made_per_group(spark, tmp_path):
    (tmp_path / "in.x12").write_text(_FOREIGN)
    checks = {(r["tag"], r["group_id"], r["txn_id"]): r for r in e.check_envelope(e.read_edi(spark, str(tmp_path / "in.x12"))).collect()}
    assert checks["GE", 1, None]["ok"] and not checks["GE", 2, None]["ok"] and not checks["GE", 2, None]["same_control"]
    assert checks["IEA", None, None]["ok"] and not checks["SE", None, 2]["ok"]


def test_every_condition_of_every_rule_runs(spark):
    member = q._members(spark, SMALL).limit(3).withColumns({"city": F.lit(None).cast("string"), "state": F.lit(None).cast("string"), "postal": F.lit(None).cast("string")})
    member = spark.createDataFrame(member.toArrow())
    covers = spark.createDataFrame(q._covers(spark, SMALL).join(member, ["subscriber_id", "member_seq"], "left_semi").toArrow())
    rules = (
        e.Rule("2100A", "N4", 1, "City Name", required=True),
        e.Rule("2300", "HD", 3, "Insurance Line Code", allowed=("NONE",), max_length=1),
    )
    found = rows(e.all_exceptions(member, covers, rules).groupBy("sub_category").count())
    n = covers.count()
    assert found == [("Illegal element value.", n), ("Invalid element length.", n), ("Missing required element.", 3)]


def test_closed_gate_names_its_exceptions(spark, tmp_path):
    with pytest.raises(e.TooManyErrors) as closed:
        e.run_file(q._members(spark, SMALL), q._covers(spark, SMALL), str(tmp_path / "out"))
    assert closed.value.exceptions.count() > 0


def test_settings_are_text(spark, tmp_path):
    with pytest.raises(ValueError):
        e.Envelope(sender="S" * 16)
    out = str(tmp_path / "out")
    e.write_edi(q._members(spark, SMALL), q._covers(spark, SMALL), out, e.Envelope(sponsor="O'Brien*Co", sender="A~B"))
    names = [r["elements"] for r in e.read_edi(spark, out).where("tag = 'N1'").collect()]
    assert ["N1", "P5", "O'Brien Co", "FI", "00-0000000"] in names


def test_files_of_one_part_keep_their_order(spark, tmp_path, conf):
    conf(spark__sql__files__maxRecordsPerFile="50")
    for run in ("one", "two"):
        e.write_edi(q._members(spark, SMALL), q._covers(spark, SMALL), str(tmp_path / run))
    segments = e.read_edi(spark, str(tmp_path / "one"))
    assert all(r["ok"] for r in e.check_envelope(segments).collect())
    both = e.read_edi(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert both.count() == 2 * segments.count() and both.select("file").distinct().count() == 2


_WHOLE = "~".join(
    [
        "ISA*00*          *00*          *30*A              *30*B              *200101*0000*^*00501*000000001*0*P*>",
        "GS*BE*A*B*20200101*0000*1*X*005010X220A1", "ST*834*0001*005010X220A1",
        "INS*Y*18*030*XN*A*E*1*FT**R*D8*20200202*U*Town*NY*US*2", "REF*0F*S1*note", "REF*23*00*more", "DTP*303*RD8*20200101-20200131",
        "NM1*IL*2*Doe*Jo****ZZ*N1*01*E", "PER*IP*Jo*EM*jo@mail.example*CP*5550101", "N3*1 Way**X", "N4*Town*ON*K1A*CA*CY*11",
        "DMG*D6*800102*F*M*A>B^C*1*CA", "HD*030*002*VIS*PLANX*EMP*7**Y", "DTP*303*DT*202002030400", "DTP*348*RD8*20200301-20200331",
        "DTP*349*D8*20201231", "INS*N*01*030**A************3", "REF*0F*S1", "NM1*IL*1*Doe*Al", "PER*IP**TE*5550102*EM*al@mail.example",
        "N4****CA", "SE*19*0001", "GE*1*1", "IEA*1*000000001", "",
    ]
)


def _read_whole(spark, tmp_path):
    (tmp_path / "in.x12").write_text(_WHOLE)
    segments = e.read_edi(spark, str(tmp_path / "in.x12"))
    member = e.members(segments).withColumn("member_seq", F.col("member_id") - 1).drop("pos", "file", "txn_id", "family_id", "member_id")
    covers = e.coverages(segments).withColumns({"subscriber_id": F.lit("S1"), "member_seq": F.lit(0).cast("long"), "coverage_seq": F.lit(1)})
    return segments, member, covers.drop("file", "txn_id", "family_id", "member_id", "coverage_id")


def _own_texts(segments):
    kept = segments.where("member_id is not null and tag <> 'SE'")
    return rows(kept.select("member_id", "coverage_id", F.array_join("elements", "*").alias("text")))


def test_elements_without_a_column_come_back(spark, tmp_path):
    segments, member, covers = _read_whole(spark, tmp_path)
    assert rows(member, "member_seq", "phone") == [(0, None), (1, "5550102")]
    e.write_edi(member, covers, str(tmp_path / "out"))
    again = e.read_edi(spark, str(tmp_path / "out"))
    assert _own_texts(again) == _own_texts(segments)
    assert all(r["ok"] for r in e.check_envelope(again).collect())


def test_a_changed_column_changes_its_element_only(spark, tmp_path):
    _, member, covers = _read_whole(spark, tmp_path)
    day = F.lit("2020-05-06").cast("date")
    member = member.withColumns({"phone": F.when(F.col("member_seq") == 0, F.lit("5550199")), "city": F.lit("A>b"), "birth_date": day})
    covers = covers.withColumns({"benefit_begin": day, "benefit_end": F.lit(None).cast("date")})
    e.write_edi(member, covers, str(tmp_path / "out"))
    again = e.read_edi(spark, str(tmp_path / "out"))
    texts = {r[2] for r in _own_texts(again)}
    assert "PER*IP*Jo*HP*5550199*EM*jo@mail.example*CP*5550101" in texts
    assert "PER*IP****EM*al@mail.example" in texts  # a phone taken away leaves the other contact
    assert {"N4*A b*ON*K1A*CA*CY*11", "N4*A b***CA", "DMG*D8*20200506*F*M*A>B^C*1*CA", "DTP*348*D8*20200506"} <= texts
    assert not any(t.startswith("DTP*349") for t in texts)
    assert all(r["ok"] for r in e.check_envelope(again).collect())


def _in_order(segments):
    """The texts of each member's own segments and coverages as lists, in the order of the file."""
    kept = segments.where("member_id is not null and tag <> 'SE'").orderBy("file", "pos").collect()
    out = {}
    for r in kept:
        out.setdefault(r["member_id"], []).append("*".join(r["elements"]))
    return out


def _again(spark, text, tmp_path, member_change=None, cover_change=None):
    (tmp_path / "in.x12").write_text(text)
    segments = e.read_edi(spark, str(tmp_path / "in.x12"))
    member = e.members(segments).withColumn("member_seq", F.col("member_id") - 1).drop("pos", "file", "txn_id", "family_id", "member_id")
    covers = e.coverages(segments).withColumns({"subscriber_id": F.lit("S1"), "member_seq": F.lit(0).cast("long"), "coverage_seq": F.col("coverage_id")})
    member = member.withColumns(member_change or {})
    covers = covers.drop("file", "txn_id", "family_id", "member_id", "coverage_id").withColumns(cover_change or {})
    e.write_edi(member, covers, str(tmp_path / "out"))
    again = e.read_edi(spark, str(tmp_path / "out"))
    assert all(r["ok"] for r in e.check_envelope(again).collect())
    return _in_order(segments), _in_order(again)


# A mailing address after the member's own loop, and lines before it that have no column.
_TWO_PARTIES = _FOREIGN.replace("LUI*LE*ENG*A>B~", "LUI*LE*ENG*A>B~NM1*31*1~N3*PO Box 9~N4*Other*NJ*07001~").replace("SE*22*", "SE*25*")


@pytest.mark.parametrize("text", [_FOREIGN, _WHOLE, _TWO_PARTIES], ids=["foreign", "whole", "two parties"])
def test_unchanged_segments_keep_their_places(spark, tmp_path, text):
    read, written = _again(spark, text, tmp_path)
    assert written == read and len(read[1]) > 10


def test_a_changed_added_or_removed_column_moves_nothing_else(spark, tmp_path):
    first = F.col("member_seq") == 0
    change = {
        "member_code": F.when(first, F.lit("M1")),  # there was no REF*23: after the other REF with a column
        "phone": F.when(first, F.lit("5550100")),  # no PER: before N3
        "birth_date": F.lit(None).cast("date"), "sex": F.lit(None).cast("string"), "marital_status": F.lit(None).cast("string"),  # no DMG any more
        "maintenance_date": F.when(first, F.lit("2020-07-08").cast("date")),  # no DTP*303: before NM1
        "city": F.when(first, F.lit("Elsewhere")),
    }
    read, written = _again(spark, _TWO_PARTIES, tmp_path, change, {"benefit_end": F.lit("2020-12-31").cast("date")})
    expected = list(read[1])
    expected.remove("DMG*D8*19800102*F*M")
    expected[expected.index("N4*Town*NY*10001")] = "N4*Elsewhere*NY*10001"
    expected.insert(expected.index("REF*0F*S1") + 1, "REF*23*M1")
    name = expected.index("NM1*IL*1*Doe*Jo*Q*Dr*Jr*34*000000001")
    expected.insert(name, "DTP*303*D8*20200708")
    expected.insert(name + 2, "PER*IP**HP*5550100")
    expected.insert(expected.index("DTP*348*D8*20200301") + 1, "DTP*349*D8*20201231")
    assert written[1] == expected


def test_addresses_of_other_parties_are_not_the_members(spark, tmp_path):
    text = _FOREIGN.replace("N3*1 Way~N4*Town*NY*10001~DMG*D8*19800102*F*M~", "DMG*D8*19800102*F*M~NM1*31*1~N3*PO Box 9~N4*Other*NJ*07001~")
    (tmp_path / "in.x12").write_text(text)
    found = e.members(e.read_edi(spark, str(tmp_path / "in.x12"))).orderBy("pos").first()
    assert (found["address1"], found["city"], found["sex"]) == (None, None, "F")
    assert [s[0] for s in found["other_segments"]][-4:] == ["NM1", "N3", "N4", "LUI"]
    read, written = _again(spark, text, tmp_path)
    assert read == written


def test_groups_and_transactions(spark, tmp_path, conf):
    header = "BGN*22*REF7*20200203*1122*LT*OLD1**2~REF*38*P1~DTP*007*D8*20200401~DTP*382*D8*20200501~N1*P5*Spon*FI*1~N1*IN*Ins*XV*2~N1*BO*Brok*94*3~N1*TV*Adm*FI*4~"
    text = _FOREIGN.replace("BGN*00*1*20200101*0000*LT***4~REF*38*P1~", header).replace("SE*3*0002~GE", "SE*3*0002~ST*834*0003*V~SE*2*0003~GE")
    (tmp_path / "in.x12").write_text(text)
    conf(spark__sql__files__maxPartitionBytes="60", spark__sql__files__openCostInBytes="1")
    segments = e.read_edi(spark, str(tmp_path / "in.x12"))
    outside = {r["tag"]: r["group_id"] for r in segments.where("tag in ('ISA', 'IEA')").collect()}
    assert outside == {"ISA": None, "IEA": None}
    assert rows(segments.where("tag in ('GS', 'GE')"), "tag", "group_id") == [("GE", 1), ("GE", 2), ("GS", 1), ("GS", 2)]
    found = e.transactions(segments).orderBy("txn_id").collect()
    assert [(r["group_id"], r["txn_id"], r["txn_in_group"], r["control"]) for r in found] == [(1, 1, 1, "0001"), (2, 2, 1, "0002"), (2, 3, 2, "0003")]
    one = found[0]
    assert (one["purpose"], one["reference"], one["original_reference"], one["action"], one["policy"]) == ("22", "REF7", "OLD1", "2", "P1")
    assert (str(one["effective_date"]), str(one["enrolment_date"]), one["report_start"]) == ("2020-04-01", "2020-05-01", None)
    assert (one["sponsor_name"], one["insurer_id_qualifier"], one["broker_name"], one["administrator_id"]) == ("Spon", "XV", "Brok", "4")
    assert (one["sender_code"], one["group_control"], found[1]["group_control"]) == ("A", "1", "2")


def test_files_state_their_separators(spark, tmp_path):
    isa = _WHOLE[:106]
    assert separators_of(isa) == Separators() and separators_of(isa[:105]) is None and separators_of("X" + isa[1:]) is None
    assert separators_of(isa.replace("^", "U")).repetition == "^"  # an old version names a standard there
    assert separators_of(isa.replace(">~", "*~")) is None
    with pytest.raises(ValueError):
        Separators(element="A")
    (tmp_path / "in").mkdir()
    signs = {"usual": "~*^>", "lines": "\n|!:", "others": "'+%;"}
    for name, (segment, element, repetition, component) in signs.items():
        text = _WHOLE.translate(str.maketrans("~*^>", segment + element + repetition + component))
        (tmp_path / "in" / f"{name}.x12").write_text(text)
    found = e.read_edi(spark, str(tmp_path / "in"))
    texts = {}
    for r in found.where("tag <> 'ISA'").orderBy("file", "pos").collect():
        texts.setdefault(r["file"].rsplit("/", 1)[1], []).append("*".join(r["elements"]))
    assert len(texts) == 3 and all(t == _WHOLE.split("~")[1:-1] for t in texts.values())


def test_values_that_hold_another_files_signs_are_written(spark, tmp_path):
    members = q._members(spark, SMALL).where("subscriber_id = '000000001'").withColumn("last_name", F.lit("O|Neil*x"))
    style = Separators("\n", "|", "!", ":")
    e.write_edi(members, q._covers(spark, SMALL), str(tmp_path / "out"), e.Envelope(separators=style, first_control=7))
    segments = e.read_edi(spark, str(tmp_path / "out"))
    assert rows(e.members(segments).select("last_name").distinct()) == [("O Neil x",)]
    assert rows(segments.select("file").distinct()) == [("6",)] and all(r["ok"] for r in e.check_envelope(segments).collect())


def _plain_next_fit(sizes, limit):
    load, group, out = 0, 0, []
    for size in sizes:
        if load and load + size > limit:
            load, group = 0, group + 1
        load += size
        out.append(group)
    return out


def test_next_fit_equals_a_plain_loop(spark, monkeypatch):
    rng = random.Random(3)
    for limit in (1, 7, 40):
        for _ in range(40):
            sizes = [rng.choice([1, 1, 2, 3, 5, 9, 41]) for _ in range(rng.randint(0, 30))]
            exits, starts = next_fit.entry_function(np.array(sizes, dtype=np.int64), limit)
            for load in range(limit + 1):
                now, begun = load, 0
                for size in sizes:
                    if now and now + size > limit:
                        now, begun = 0, begun + 1
                    now += size
                assert (min(now, limit), begun) == (exits[load], starts[load]), (sizes, limit, load)
    monkeypatch.setattr(ordering, "PARTITION_BYTES", 1)
    monkeypatch.setattr(ordering, "partitions_for", lambda table: 5)
    sizes = [rng.choice([1, 2, 3, 4, 12]) for _ in range(300)]
    members = spark.createDataFrame([(f"{i:04d}",) for i, n in enumerate(sizes) for _ in range(n)], "subscriber_id string")
    found = e.split_sets_restart(members, 10).orderBy("subscriber_id").collect()
    assert [r["family_size"] for r in found] == sizes and [r["set_no"] for r in found] == _plain_next_fit(sizes, 10)
    assert e.split_sets_restart(members.limit(0), 10).count() == 0


def test_a_run_evaluates_its_members_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    members = spark.createDataFrame(q._members(spark, SMALL).toArrow())
    watched = members.withColumn("last_name", counted.asNondeterministic()("last_name"))
    counts, _ = e.run_file(watched, q._covers(spark, SMALL), str(tmp_path / "out"), max_errors=10**6)
    assert seen.value == members.count() and counts.first()["kept"] > 0


def test_an_attempt_that_was_lost_is_not_read(spark, tmp_path):
    log, days = runs.Ledger(spark, str(tmp_path / "ledger")), iter(dt.datetime(2020, 1, d, tzinfo=dt.timezone.utc) for d in range(1, 28))
    members, covers = q._members(spark, SMALL), q._covers(spark, SMALL)
    assert log.instances().count() == log.exceptions().count() == log.events().count() == 0
    log.event(5, 1, 1, "started", next(days))  # an attempt that wrote its exceptions and was lost
    lost = spark.createDataFrame([(1, 1, 5, "ERROR", "c", "s", "d", "x", "00")], "exception_id long, file_record_id long, file_instance_id long, exception_type string, category string, sub_category string, detail string, subscriber_id string, member_id string")
    log.record_exceptions(5, 1, lost)
    assert log.exceptions().count() == 0
    assert runs.recorded_run(log, 5, 1, members, covers, str(tmp_path / "one"), max_errors=10**6, clock=lambda: next(days)) == "sent"
    assert rows(log.instances(), "file_instance_id", "attempt", "file_instance_status") == [(5, 2, "sent")]
    assert rows(log.exceptions().select("attempt", "file_instance_id").distinct()) == [(2, 5)]
    assert log.exceptions().where("file_record_id is null").count() == 0
    with pytest.raises(e.TooManyErrors):
        runs.recorded_run(log, 6, 1, members, covers, str(tmp_path / "two"), clock=lambda: next(days))
    assert runs.recorded_run(log, 7, 1, members.limit(0), covers, str(tmp_path / "three"), clock=lambda: next(days)) == "empty"
    assert rows(log.statuses(), "file_instance_id", "attempt", "file_instance_status") == [(5, 2, "sent"), (6, 1, "stopped"), (7, 1, "empty")]
    assert rows(log.events().where("file_instance_id = 5"), "attempt", "event_no", "file_instance_status") == [
        (1, 1, "started"), (2, 1, "started"), (2, 2, "validated"), (2, 3, "sent"),
    ]


def test_definitions_keep_their_history(spark, tmp_path):
    at = lambda day: dt.datetime(2020, 1, day, tzinfo=dt.timezone.utc)
    table = lambda *r: spark.createDataFrame(list(r), "file_definition_id int, name string, term int")
    path = str(tmp_path / "definitions")
    runs.record_definitions(table((1, "a", 3), (2, "b", None)), path, at(1))
    runs.record_definitions(table((1, "a", 4), (2, "b", None), (3, "c", 1)), path, at(5))
    runs.record_definitions(table((1, "a", 4)), path, at(9))
    day = lambda c: F.dayofmonth(F.col("sys_period")[c])
    found = runs.definitions(spark, path).select("file_definition_id", "term", day("lower").alias("lo"), day("upper").alias("hi"))
    assert rows(found) == [(1, 3, 1, 5), (1, 4, 5, None), (2, None, 1, None), (3, 1, 5, None)]


def test_the_exception_view_moves_no_definition_columns_with_its_runs(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    time = lambda day: dt.datetime(2020, 1, day)
    period = "sys_period struct<lower: timestamp, upper: timestamp>"
    definitions = spark.createDataFrame(
        [(1, "old", (time(1), time(5))), (1, "new", (time(5), None)), (1, "new", (time(5), None)), (None, "none", (time(1), None))],
        f"file_definition_id int, plan_sponsor_name string, {period}",
    )
    instances = spark.createDataFrame(
        [(10, 1, time(4)), (11, 1, time(5)), (12, 2, time(5)), (13, None, time(5)), (14, 1, None), (None, 1, time(4))],
        "file_instance_id long, file_definition_id int, file_instance_start_time timestamp",
    )
    transfers = spark.createDataFrame([(10, 0), (10, 1), (12, 2), (None, 3)], "file_instance_id long, return_code int")
    exceptions = spark.createDataFrame([(run, f"{run}") for run in (10, 11, 11, 12, 13, 14, 15, None)], "file_instance_id long, detail string")
    view = ledger.exception_view(exceptions, definitions, instances, transfers)
    assert view.schema.names == ledger.EXCEPTION_VIEW.names
    assert rows(view, "file_instance_id", "detail", "plan_sponsor_name", "return_code") == [
        (10, "10", "old", 0), (10, "10", "old", 1), *[(11, "11", "new", None)] * 4,
    ]
    plan = spark._jvm.PythonSQLUtils.explainString(view._jdf.queryExecution(), "formatted")
    by_run = [part for part in plan.split("\n\n") if re.search(r"\) Exchange\n(.|\n)*hashpartitioning\((file_instance_id|_r0#\d+L)", part)]
    assert len(by_run) >= 3 and not any("plan_sponsor_name" in part for part in by_run)


def test_times_sent_are_folded_forward(spark, tmp_path):
    table = lambda *r: spark.createDataFrame(list(r), "subscriber_id string, member_seq int, coverage_seq int, benefit_end string").withColumn("benefit_end", F.to_date("benefit_end"))
    path, ended = str(tmp_path / "sent"), ("a", 0, 1, "2020-01-31")
    for run in (1, 2, 2):  # the second run is repeated
        record_sent(table(ended, ("b", 0, 1, None), ("c", 0, 1, "2020-01-31"), ended), path, run)
    record_sent(table(ended, ("c", 0, 1, "2020-02-29")), path, 3)
    state = sent_before(spark, path, 4, table(ended))
    assert rows(state, "subscriber_id", "times_sent") == [("a", 3), ("c", 1)]
    known = with_times_sent(table(ended, ("c", 0, 1, "2020-01-31"), ("c", 0, 1, None), ("d", 0, 1, None)), state)
    assert rows(known, "subscriber_id", "benefit_end", "times_sent") == [
        ("a", dt.date(2020, 1, 31), 3), ("c", None, 0), ("c", dt.date(2020, 1, 31), 0), ("d", None, 0),
    ]
    assert fold_sent(state, table(("a", 0, 1, None))).count() == 1


def test_old_versions_go_by_age(spark, tmp_path):
    path, later = str(tmp_path / "snap"), dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=1)
    one = spark.createDataFrame([("m1", "A")], "member string, company string")
    groups = spark.createDataFrame([("A", "G1")], "company string, group_number string")
    for _ in range(3):
        refresh_snapshot(one, one.limit(0), groups, path)
    new_version(spark, path).write("groups", groups)  # a refresh that was lost
    assert drop_snapshots(spark, path, dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)) == []
    assert drop_snapshots(spark, path, later) == [1, 2]
    assert [v.number for v in versions(spark, path)] == [3] and newest(spark, path, below=3) is None
    assert len(glob.glob(f"{path}/version=*")) == 1 and read_snapshot(spark, path).count() == 1


def test_scopes_free_what_they_own(spark):
    before, table = set(staging.folders(spark)), spark.range(3)
    with staging.scope(spark) as outer:
        staging.staged(table, "one")
        with staging.scope(spark) as inner:
            two = staging.staged(table, "two")
            kept = inner.keep(two.where("id > 0"), "kept")
            assert len(set(staging.folders(spark)) - before) == 3
        assert kept.count() == 2 and len(set(staging.folders(spark)) - before) == 2
        three = staging.staged(table, "three")
        staging.discard(three)
        with pytest.raises(ValueError):
            staging.discard(three)
        assert len(outer.folders) == 2
    assert set(staging.folders(spark)) == before


def test_a_condition_on_a_read_column_gathers_once(spark, segments):
    """Pushed into the gathering, it made each of a member's segments anew for every other one."""
    for found, column in ((e.members(segments), "subscriber_id"), (e.coverages(segments), "plan")):
        plan = found.where(F.col(column).isNotNull())._jdf.queryExecution().optimizedPlan().toString()
        assert "lambdafunction" in plan
        assert not [line for line in plan.splitlines() if "Filter " in line and "lambdafunction" in line]


def test_files_are_scanned_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in.x12").write_text(FILE)
    plans, kept = [], staging.staged

    def staged(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, label)

    monkeypatch.setattr("rollkeep.sources.segments.staged", staged)
    e.read_edi(spark, str(tmp_path / "in.x12"))
    scans = [plan for plan in plans if " text" in plan]
    assert len(scans) == 1 and scans[0].count("Relation ") == 1
    assert "regexp" not in scans[0]


def test_blocks_are_counted_where_they_are_read(spark, tmp_path, monkeypatch):
    (tmp_path / "in.x12").write_text(FILE)
    plans, kept = {}, staging.staged

    def staged(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, label)

    monkeypatch.setattr("rollkeep.sources.segments.staged", staged)
    e.read_edi(spark, str(tmp_path / "in.x12"))
    assert not [step for step in ("Exchange", "Sort", "Window") if step in plans["loops"]]


def test_a_members_segments_know_its_first(segments):
    place = start = None
    for place, r in enumerate(segments.orderBy("pos").collect(), 1):
        start = place if r["tag"] == "INS" else start
        assert r["member_pos"] == (start if r["member_id"] else None)
    assert place == len(FILE.split("~")) - 1


def test_counts_are_carried_over_batches():
    """Blocks of several files, cut into batches at any row, against a plain loop."""
    draw = random.Random(5)
    tags = ["ISA", "GS", "ST", "INS", "INS", "NM1", "NM1", "HD", "REF", "SE", "GE", "IEA"]
    kinds = {**sg._KINDS, "REF": 0}
    given, expected = [], []
    for unit in range(40):
        path, block = f"f{unit // 3}", unit % 3 * 100
        counts, within, envelope, party, start = [0] * 6, None, None, None, None
        for i in range(size := draw.choice([1, 2, 7, 30])):
            tag = draw.choice(tags)
            of_subscriber, name = tag == "INS" and draw.random() < 0.4, draw.choice(["IL", "31", ""])
            code = name if tag == "NM1" else "" if tag in sg.BOUNDARY_TAGS else None
            row, first = unit * 1000 + i, unit * 1000
            given.append((path, block, row, f"{tag}*{row}", sg._SUBSCRIBER if of_subscriber else kinds[tag], code))
            marks = (True, tag == "GS", tag == "ST", of_subscriber, tag == "INS", tag == "HD")
            counts = [n + m for n, m in zip(counts, marks)]
            within = kinds[tag] if tag in sg.BOUNDARY_TAGS else within
            envelope = kinds[tag] if tag in sg.ENVELOPE_TAGS else envelope
            party, start = party if code is None else code, counts[0] if tag == "INS" else start
            at = (path, block) if i == size - 1 else (None, None)
            expected.append((first, *at, f"{tag}*{row}", *counts, within, envelope, party, start))
    columns = ("path", "block", "row", "text", "kind", "code")
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string())
    for most in (1, 2, 5, 1000):
        batches, rest = [], given
        while rest:
            n = draw.randint(0, most)
            batches.append(pa.RecordBatch.from_arrays([pa.array([r[i] for r in rest[:n]], t) for i, t in enumerate(types)], columns))
            rest = rest[n:]
        found = pa.Table.from_batches(sg._count_in_blocks(iter(batches)))
        assert [tuple(r.values()) for r in found.to_pylist()] == expected
    assert list(sg._count_in_blocks(iter([]))) == []


def test_a_foreign_file_gathers_its_members_once(spark, monkeypatch):
    gathered, kept = {}, staging.staged

    def staged(df, label):
        gathered[label] = df._jdf.queryExecution().optimizedPlan().toString().count("collect_list(")
        return kept(df, label)

    monkeypatch.setattr("rollkeep.checks.enrolling.staged", staged)
    q.edi_in_place(spark, SMALL)
    assert gathered == {"read-members": 1, "read-coverages": 1}


def test_sizes_move_nothing_that_was_read(spark, tmp_path, monkeypatch):
    _, member, covers = _read_whole(spark, tmp_path)
    read = staging.staged(member, "m"), staging.staged(covers, "c")
    plans, kept = {}, staging.staged

    def staged(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return kept(df, label)

    monkeypatch.setattr("rollkeep.plans.enrolment.staged", staged)
    e.edi_units(*read, e.Envelope())
    steps = plans["set-counts"].splitlines()
    assert [s for s in steps if "own_segments" in s] and [s for s in steps if "set_no" in s]
    assert not [s for s in steps if "own_segments" in s and "set_no" in s]
