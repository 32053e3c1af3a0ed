"""The filing on invented companies, its file and the change feed."""

import datetime as dt
import glob

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from rollkeep.checks.filings import NAMES
from rollkeep.checks.standins import EFFECTIVE, POLICY_START, standins
from rollkeep.operators.aggregates import choose_location, duplicated_keys, rollup_counts, subtotals
from rollkeep.operators.changes import diff_against_sent, reconcile
from rollkeep.plans import filing as f
from rollkeep.plans.filing_sql import register_filing_function
from rollkeep.sources.filing_csv import HEADER_LINE, read_filing_csv, write_filing_csv
from rollkeep.sources.tables import code_list


@pytest.fixture
def locations(spark):
    places = [
        ("L1", "Remote East", "1 Road"),
        ("L2", "Head office", "2 Road"),
        ("L3", "remote west", " "),
        ("L4", None, "4 Road"),
        ("L5", "Annex", "5 Road"),
    ]
    return spark.createDataFrame(places, "location string, descr string, address1 string")


def test_location_choice(spark, locations):
    data = [("both", "L1"), ("both", "L5"), ("both", "L2"), ("far", "L3"), ("far", "L1"), ("blank", "L3"), ("none", "L4"), ("gone", "L9")]
    counts = spark.createDataFrame(data, "company string, location string")
    assert rows(choose_location(counts, locations)) == [("blank", "L3"), ("both", "L2"), ("far", "L1")]
    assert rows(choose_location(counts, locations, blank_address_ok=False)) == [("both", "L2"), ("far", "L1")]


def test_subtotals_keep_the_grand_total(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", None)], "c string, l string")
    rolled = rollup_counts(df, ["c", "l"], {"n": F.count(F.lit(1))})
    assert rows(subtotals(rolled, 1), "c", "n") == [("a", 3), ("b", 1), (None, 4)]
    assert rows(duplicated_keys(df, ["c", "l"])) == [("a", "x", 2)]


def _row(spark, **changes):
    values = {
        "ny_dbl_record_id": 1,
        "pf_corp": "PEO1",
        "company": "K1",
        "legal_name": 'The "Best", Inc.',
        "dba_name": " ",
        "company_address1": "1 Road",
        "company_address2": None,
        "naics": "123456",
        "federal_ein": " 000000123",
        "company_zip": "01234",
        "dbl_males": 1,
        "dbl_females": 2,
        "pfl_males": 1,
        "pfl_females": 2,
        "covered_annual_payroll": 1000,
        "status": "ADD",
        "status_date": dt.date(2018, 1, 23),
        "cancel_reason": " ",
    } | changes
    return spark.createDataFrame([tuple(values.get(n) for n in f.RESULT.names)], f.RESULT)


def _text(path):
    return "".join(open(part).read() for part in sorted(glob.glob(f"{path}/part-*")))


def test_file_text(spark, tmp_path):
    path = str(tmp_path / "out")
    write_filing_csv(_row(spark), path)
    header, line = _text(path).splitlines()
    assert header == HEADER_LINE
    assert line == (
        '"PEO1","K1","The ""Best"", Inc."," ","1 Road",,,,01234,"123456", 000000123,,,,,,,,,,,,1,2,1,2,1000,"ADD",01/23/2018," "'
    )
    back = read_filing_csv(spark, path).first()
    assert back["LEGAL_NAME"] == 'The "Best", Inc.'
    assert back["FEDERAL_EIN"] == " 000000123"
    assert back["ADDRESS2"] is None
    assert back["STATUS_DATE"] == dt.date(2018, 1, 23)


def test_file_without_rows_holds_the_header(spark, tmp_path):
    path = str(tmp_path / "out")
    write_filing_csv(_row(spark).where("false"), path)
    assert _text(path).splitlines() == [HEADER_LINE]
    assert read_filing_csv(spark, path).count() == 0


def test_file_keeps_record_order_over_many_parts(spark, tmp_path):
    path = str(tmp_path / "out")
    many = _row(spark).crossJoin(spark.range(1, 301).withColumnRenamed("id", "n"))
    many = many.withColumn("ny_dbl_record_id", F.col("n")).withColumn("dbl_males", F.col("n").cast("int")).drop("n")
    write_filing_csv(many.repartition(5), path)
    lines = _text(path).splitlines()
    assert lines[0] == HEADER_LINE
    assert [int(line.split(",")[-8]) for line in lines[1:]] == list(range(1, 301))


@pytest.mark.parametrize("days, variant, status", [(-1, "commit", "CANCEL"), (0, "commit", "ADD"), (1, "commit", "ADD"), (1, "v1", "CANCEL"), (-1, "master", "ADD")])
def test_status_by_variant(spark, days, variant, status):
    effective = dt.date(2018, 1, 23)
    df = spark.createDataFrame([(effective + dt.timedelta(days),)], "t date")
    rule = f.VARIANTS[variant].cancel
    assert df.select(f.s.filing_status("t", effective, rule)).first()[0] == status


def test_schema_and_numbering(spark):
    rows_ = f.filing(standins(spark, SMALL, *NAMES), POLICY_START, EFFECTIVE)
    assert [(x.name, x.dataType) for x in rows_.schema] == [(x.name, x.dataType) for x in f.RESULT]
    numbers = [r[0] for r in rows_.select("ny_dbl_record_id").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_change_feed(spark):
    sent = spark.createDataFrame([("same", "1", None), ("moved", "1", "x"), ("gone", "1", None), ("empty", None, None)], "company string, a string, b string")
    now = spark.createDataFrame([("same", "1", None), ("moved", "1", None), ("new", "2", None), ("empty", None, None)], "company string, a string, b string")
    found = diff_against_sent(now, sent, "company", ["a", "b"])
    assert rows(found, "company", "status") == [("gone", "CANCEL"), ("moved", "ADDRESS"), ("new", "ADD")]
    assert diff_against_sent(now, now, "company", ["a", "b"]).count() == 0


def test_reconcile_with_a_code_list(spark, tmp_path):
    (tmp_path / "codes.txt").write_text("A1\n B2 \n\nA1\n")
    theirs = code_list(spark, str(tmp_path / "codes.txt"))
    ours = spark.createDataFrame([("B2",), ("C3",)], "company string")
    assert rows(reconcile(ours, theirs, "company")) == [("A1", "missing"), ("C3", "extra")]


def test_the_sql_function_is_replaced(spark):
    tables = standins(spark, SMALL, *NAMES)
    for variant in ("commit", "v1", "master"):
        register_filing_function(spark, tables, "filing_in_test", variant)
        found = spark.sql(f"select * from filing_in_test(date'{POLICY_START}', date'{EFFECTIVE}')")
        expected = f.filing(tables, POLICY_START, EFFECTIVE, variant).drop("ny_dbl_record_id")
        assert found.columns == expected.columns and rows(found) == rows(expected)


def test_a_repeated_change_run_says_the_same(spark, tmp_path):
    tables, path = standins(spark, SMALL, *NAMES), str(tmp_path / "sent")
    now, before = f.filing(tables, POLICY_START, EFFECTIVE), f.filing(tables, POLICY_START, "1998-01-31")
    first = rows(f.change_run(before, path, 1, "1998-01-31"))
    assert first == rows(f.change_run(before, path, 1, "1998-01-31")) and len(first) == before.count()
    second = rows(f.change_run(now, path, 2, EFFECTIVE))
    assert second == rows(f.change_run(now, path, 2, EFFECTIVE)) == rows(f.change_filing(now, before, EFFECTIVE))
    assert rows(f.change_run(now, path, 3, EFFECTIVE)) == []
