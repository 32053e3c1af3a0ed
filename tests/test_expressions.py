import datetime as dt
import itertools

import duckdb
import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollkeep.functions import predicates as p
from rollkeep.functions import scalars as s
from rollkeep.operators import joins
from rollkeep.operators.ordering import number_rows, ordered, running_before
from rollkeep.sources import staging


def _one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


@pytest.mark.parametrize(
    "value, reference, intended", [("abc", "", "a"), ("", "", ""), (None, "", "")]
)
def test_initial(spark, value, reference, intended):
    assert _one(spark, s.initial("x"), value) == reference
    assert _one(spark, s.initial("x", mode="intended"), value) == intended


def test_digits_drops_listed_characters_only(spark):
    assert _one(spark, s.digits("x"), '(555) 12-3\\4"a[Z]') == "(555)1234[]"


@pytest.mark.parametrize("value, shown", [(123, " 000000123"), (123456789, " 123456789"), (-5, "-000000005"), (None, None)])
def test_ein(spark, value, shown):
    assert _one(spark, s.ein("x"), value, "long") == shown


@pytest.mark.parametrize("value, whole", [("2.500", 3), ("-2.500", -3), ("2.499", 2), ("0.500", 1)])
def test_halves_round_away_from_zero(spark, value, whole):
    df = spark.sql(f"select cast('{value}' as decimal(20,3)) as x")
    assert df.select(s.whole_number("x")).first()[0] == whole


def test_gender_and_legal_status(spark):
    assert [_one(spark, s.gender("x"), v) for v in (None, "", "M")] == ["U", "U", "M"]
    shown = [_one(spark, s.legal_status("x"), v) for v in ("01", "99", "77", None)]
    assert shown == ["Individual", "Other", "Corporation", "Corporation"]


def test_city_rule(spark):
    values = [None, "San Francisco", "south san fran", "SFO", "sfo", "Albany"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    kept = df.where(p.city_ok("x", ["SAN%FRAN%"], ["SFO"]))
    assert [r[0] for r in kept.collect()] == [None, "south san fran", "Albany"]


def test_trailing_days_includes_both_ends(spark):
    asof = dt.date(2020, 3, 1)
    days = [asof - dt.timedelta(n) for n in (37, 36, 1, 0)]
    df = spark.createDataFrame([(d,) for d in days], "x date")
    assert [r[0] for r in df.where(p.trailing_days("x", asof)).collect()] == days[1:3]


def test_interval_ends_count(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, d)) for d in (1, 2, 5, 6)], "k string, at date")
    spans = spark.createDataFrame([("a", dt.date(2020, 1, 2), dt.date(2020, 1, 5))], "k string, lo date, hi date")
    found = joins.valid_at(df, spans, ["k"], "at", "lo", "hi")
    span = (dt.date(2020, 1, 1), dt.date(2020, 1, 6))
    assert rows(joins.valid_at(df, spans, ["k"], "at", "lo", "hi", within=span)) == rows(found)
    assert [r[1].day for r in rows(found, "k", "at")] == [2, 5]


@pytest.mark.parametrize("bucket_days", [1, 7, 400])
def test_date_buckets_change_nothing(spark, bucket_days):
    first = dt.date(1969, 12, 1)  # day numbers change sign in the range
    days = [first + dt.timedelta(n) for n in range(0, 60, 3)]
    df = spark.createDataFrame([("ab"[i % 2], d) for i, d in enumerate(days)] + [(None, first), ("a", None)], "k string, at date")
    ends = [(0, 9), (5, 5), (10, 4), (-100, 30), (20, 40000), (59, 80), (70, 90), (None, 20), (3, None)]
    spans = [
        (k, *[None if n is None else first + dt.timedelta(n) for n in pair], f"{k}{pair}") for pair in ends for k in "ab"
    ]
    intervals = spark.createDataFrame(spans, "k string, lo date, hi date, name string")
    within = (first, first + dt.timedelta(60))
    plain = joins.valid_at(df, intervals, ["k"], "at", "lo", "hi")
    assert plain.count() > 20
    assert rows(joins.valid_at(df, intervals, ["k"], "at", "lo", "hi", within=within)) == rows(plain)
    bucketed = joins.valid_at(df, intervals, ["k"], "at", "lo", "hi", within=within, bucket_days=bucket_days)
    assert rows(bucketed) == rows(plain)


@pytest.mark.parametrize("codes", [[], ["a"], ["a", None], [None], ["b", "b"]])
def test_not_in_keeps_three_valued_logic(spark, codes):
    left = [("a",), ("b",), (None,)]
    df = spark.createDataFrame(left, "x string")
    listed = spark.createDataFrame([(c,) for c in codes], "c string")
    con = duckdb.connect()
    con.execute("create table l as select * from (values ('a'), ('b'), (null)) v(x)")
    con.execute("create table r(c varchar)")
    for code in codes:
        con.execute("insert into r values (?)", [code])
    expected = con.sql("select x, x not in (select c from r) from l").fetchall()
    flagged = joins.not_in_flag(df, "x", listed, "c", "out")
    assert rows(flagged) == sorted(expected, key=repr)
    kept = joins.null_aware_not_in(df, "x", listed, "c")
    assert rows(kept) == sorted([(x,) for x, out in expected if out], key=repr)


def test_anti_join_keeps_what_not_in_loses(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    listed = spark.createDataFrame([("a",), (None,)], "x string")
    assert rows(joins.anti(df, listed, ["x"])) == [("b",)]
    assert rows(joins.null_aware_not_in(df, "x", listed, "x")) == []


def test_lookup_stops_on_a_second_partner(spark):
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    phones = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3")], "k string, phone string")
    assert rows(joins.lookup_one(df, phones, ["k"], "phone", "phone")) == [("a", "1"), ("z", None)]
    with pytest.raises(PySparkException, match="more than one row for phone"):
        joins.lookup_one(spark.createDataFrame([("b",)], "k string"), phones, ["k"], "phone", "phone").collect()


def test_keys_with_other_names(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    other = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "code string, v string")
    assert rows(joins.inner(df, other, {"k": "code"})) == [("a", 1, "x"), ("a", 1, "y")]
    assert rows(joins.semi(df, other, {"k": "code"})) == [("a", 1)]
    assert rows(joins.anti(df, other, {"k": "code"})) == [("b", 2), (None, 3)]
    assert rows(joins.flag_keys(df, other, {"k": "code"}, "f"), "k", "f") == [("a", True), ("b", False), (None, False)]


def test_columns_with_like_names_survive_joins(spark):
    df = spark.createDataFrame([("a", 1)], "k string, _r int")
    other = spark.createDataFrame([("a", 2, 3)], "k string, _remote int, _rate int")
    for joined in (joins.inner(df, other, ["k"]), joins.left(df, other, ["k"]), joins.left(df, other, ["k"], hot=True)):
        assert joined.columns == ["k", "_r", "_remote", "_rate"]
        assert rows(joined) == [("a", 1, 2, 3)]


def test_end_on_the_limit_is_dropped(spark):
    limit = dt.date(2018, 1, 1)
    ends = [None, limit - dt.timedelta(1), limit, limit + dt.timedelta(1)]
    df = spark.createDataFrame([(d,) for d in ends], "t date")
    assert [r[0] for r in df.where(p.term_after("t", limit)).collect()] == [None, limit + dt.timedelta(1)]


def test_order_follows_the_database_default(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", None), ("a", 3)], "x string, y int")
    found = [tuple(r) for r in ordered(df, ["x", ("y", False, "first")]).collect()]
    assert found == [("a", None), ("a", 3), ("b", 1), (None, 2)]


def test_numbers_and_running_sums_span_partitions(spark, conf):
    conf(spark__sql__shuffle__partitions="7")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), (F.col("id") % 5).alias("n"))
    numbered = number_rows(df, ["x"], "line")
    assert numbered.where("line <> x + 1").count() == 0
    values = {r[0]: r[1] for r in df.collect()}
    before = dict(zip(sorted(values), itertools.accumulate([0] + [values[x] for x in sorted(values)])))
    found = {r["x"]: r["b"] for r in running_before(df, ["x"], {"b": "n"}).collect()}
    assert found == before


def test_release_deletes_what_was_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    assert staging.staged(spark.range(3), "x").count() == 3
    assert list(tmp_path.glob("rollkeep/*/x-*"))
    staging.release(spark)
    assert not list(tmp_path.glob("rollkeep/*"))


def test_shared_folder_is_the_sessions(spark):
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
