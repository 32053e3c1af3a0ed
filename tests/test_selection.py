"""As-of selection and de-duplication: literal SQL against the rewrite on random tables."""

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from rollkeep.operators.asof import conditional_as_of, latest_as_of
from rollkeep.operators import joins
from rollkeep.operators.dedupe import keep_best
from rollkeep.session import ADAPTIVE

DAYS = [None] + [dt.date(2020, 1, d) for d in range(1, 7)]
CUTOFF = dt.date(2020, 1, 4)


def _history(seed, n=60):
    pick = random.Random(seed)
    return [
        (
            pick.choice([None, "a", "b", "c", "d"]),
            pick.choice(DAYS),
            pick.choice([None, 0, 1, 2]),
            pick.choice(["A", "I"]),
            pick.choice([None, 10, 20, 30]),
            i,
        )
        for i in range(n)
    ]


SCHEMA = "k string, effdt date, seq int, status string, amount int, id long"


def _both(spark, data, sql, schema=SCHEMA):
    df = spark.createDataFrame(data, schema)
    con = duckdb.connect()
    con.register("arrow_t", df.toArrow())
    con.execute("create table t as select * from arrow_t")
    return df, sorted((row[0] for row in con.sql(sql).fetchall()), key=repr)


_LATEST = "select t.id from t where t.effdt = (select max(m.effdt) from t m where m.k = t.k{keys}{cut})"
_SEQ = " and t.seq = (select max(m.seq) from t m where m.k = t.k and m.effdt = t.effdt)"
_CUT = f" and m.effdt <= date '{CUTOFF}'"


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize(
    "sql, select",
    [
        (_LATEST.format(keys="", cut=_CUT), lambda df: latest_as_of(df, ["k"], "effdt", CUTOFF)),
        (_LATEST.format(keys="", cut=_CUT) + _SEQ, lambda df: latest_as_of(df, ["k"], "effdt", CUTOFF, seq="seq")),
        (_LATEST.format(keys="", cut=""), lambda df: latest_as_of(df, ["k"], "effdt")),
        (
            _LATEST.format(keys="", cut=_CUT) + " and t.status = 'A'",
            lambda df: latest_as_of(df, ["k"], "effdt", CUTOFF, status="status", status_value="A"),
        ),
        (
            _LATEST.format(keys=" and m.status = t.status", cut=_CUT) + " and t.status = 'A'",
            lambda df: latest_as_of(
                df, ["k"], "effdt", CUTOFF, status="status", status_value="A", status_in_key=True
            ),
        ),
        (
            _LATEST.format(keys="", cut=" and m.amount >= 20") + _SEQ,
            lambda df: conditional_as_of(df, ["k"], "effdt", "seq", F.col("amount") >= 20),
        ),
        (
            _LATEST.format(keys=" and m.status = t.status and m.amount = t.amount", cut=_CUT),
            lambda df: latest_as_of(df, ["k", "status", "amount"], "effdt", CUTOFF),
        ),
    ],
    ids=["date", "date-seq", "unbounded", "status-outside", "status-inside", "conditional", "wide-key"],
)
def test_selection_equals_correlated_form(spark, seed, sql, select):
    df, expected = _both(spark, _history(seed), sql)
    assert [r[0] for r in rows(select(df), "id")] == expected


def test_sequence_of_other_types(spark):
    """Timestamps and long sequences take the struct order; the result is the same."""
    df, expected = _both(spark, _history(11), _LATEST.format(keys="", cut=_CUT) + _SEQ)
    wide = df.withColumn("effdt", F.col("effdt").cast("timestamp")).withColumn("seq", F.col("seq").cast("long"))
    assert [r[0] for r in rows(latest_as_of(wide, ["k"], "effdt", CUTOFF, seq="seq"), "id")] == expected


def _cascade(con):
    """The clean-up as literal deletes, one statement per pass."""
    con.execute("""delete from t where ended is not null and k in (select k from t where ended is null)""")
    for column, best in (("ended", "max"), ("company", "min"), ("location", "min")):
        con.execute(f"create or replace temp table best as select k, {best}({column}) as b from t group by k")
        con.execute(f"delete from t where not {column} = (select b from best where best.k = t.k) and k in (select k from best)")


@pytest.mark.parametrize("seed", range(12))
def test_dedupe_equals_literal_deletes(spark, seed):
    pick = random.Random(seed)
    data = [
        (
            pick.choice([None, "a", "b", "c", "d", "e"]),
            pick.choice(DAYS[1:4]) if pick.random() < 0.7 else None,
            pick.choice([None, "x", "y", "z"]),
            pick.choice([None, "1", "2", "3"]),
            i,
        )
        for i in range(40)
    ]
    df = spark.createDataFrame(data, "k string, ended date, company string, location string, id long")
    con = duckdb.connect()
    con.register("arrow_t", df.toArrow())
    con.execute("create table t as select * from arrow_t")
    _cascade(con)
    expected = sorted((r[0] for r in con.sql("select id from t").fetchall()), key=repr)
    assert [r[0] for r in rows(keep_best(df, "k", "ended", ["company", "location"]), "id")] == expected


# --- a key that holds a large part of the table ---------------------------------------------


def _skewed(spark):
    """One key with a third of the rows, all on one date, so that all of them tie."""
    hot = F.col("id") % 3 == 0
    return spark.range(60000).select(
        F.when(hot, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(hot, F.lit("2020-01-01")).otherwise(F.lit("2020-01-02")).cast("date").alias("effdt"),
        F.lit(1).alias("seq"),
        F.col("id"),
        F.repeat(F.lit("x"), 40).alias("payload"),
    )


def _skew_options(conf):
    conf(
        **{name.replace(".", "__"): value for name, value in ADAPTIVE.items()},
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__shuffle__partitions="12",
    )


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_in_as_of(spark, conf):
    _skew_options(conf)
    kept = latest_as_of(_skewed(spark), ["k"], "effdt", "2020-01-05", seq="seq")
    plan = _final_plan(kept)
    assert "skew=true" in plan
    assert "Window" not in plan
    assert kept.count() == 60000


def test_hot_key_is_split_in_dedupe(spark, conf):
    _skew_options(conf)
    ended = F.when(F.col("id") % 3 == 1, F.col("effdt")).alias("ended")
    df = _skewed(spark).select("k", ended, F.lit("c").alias("company"), F.lit("l").alias("location"), "id", "payload")
    kept = keep_best(df, "k", "ended", ["company", "location"])
    plan = _final_plan(kept)
    assert "skew=true" in plan
    assert "Window" not in plan
    assert kept.count() == 60000


def test_hot_key_is_split_in_lookups(spark, conf):
    _skew_options(conf)
    df = _skewed(spark)
    codes = spark.range(-1, 60000, 2).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    for joined in (
        joins.flag_keys(df, codes, ["k"], "hit", hot=True).where("hit"),
        joins.not_in_flag(df, "k", codes, "k", "out", hot=True).where("not out"),
        joins.lookup_one(df, codes, ["k"], "v", "v", hot=True).where("v is not null"),
        joins.semi(df, codes, ["k"]),
        joins.inner(df, codes, ["k"]),
    ):
        assert "skew=true" in _final_plan(joined)
        assert joined.count() == 40000


def test_hot_key_is_split_in_a_chain_of_joins(spark, conf):
    """Two joins on the same key: the second would reuse the partitioning of the first."""
    _skew_options(conf)
    codes = spark.range(-1, 60000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    chain = joins.lookup_one(joins.lookup_one(_skewed(spark), codes, ["k"], "v", "a", hot=True), codes, ["k"], "v", "b", hot=True)
    assert _final_plan(chain).count("skew=true") >= 2
    assert chain.where("a = b").count() == 60000


def test_null_keys_are_spread(spark, conf):
    """Rows without a key match nothing and must not gather in one partition of a left join."""
    _skew_options(conf)
    conf(spark__sql__adaptive__enabled="false")
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("2020-01-01")).cast("date").alias("ended"),
        F.lit("c").alias("company"),
        F.lit("l").alias("location"),
        "id",
    )
    codes = spark.range(40000).select(F.col("id").alias("k"))
    for joined in (
        joins.flag_keys(df, codes, ["k"], "hit", hot=True),
        joins.not_in_flag(df, "k", codes, "k", "out", hot=True),
        joins.lookup_one(df, codes, ["k"], "k", "v", hot=True),
        keep_best(df, "k", "ended", ["company", "location"]),
    ):
        table = joined.select("*", F.spark_partition_id().alias("part")).toArrow()  # all columns, so the join stays
        assert table.num_rows == 40000
        assert max(Counter(table["part"].to_pylist()).values()) < 8000


def test_lookups_on_one_key_share_an_exchange(spark, conf):
    _skew_options(conf)
    conf(spark__sql__adaptive__enabled="false")
    codes = spark.range(500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    chain = _skewed(spark)
    for name in ("a", "b", "c"):
        chain = joins.lookup_one(chain, codes, ["k"], "v", name)
    plan = chain._jdf.queryExecution().executedPlan().toString()
    assert sum("payload" not in line and "hashpartitioning" in line for line in plan.splitlines()) <= 4
    assert plan.count("Exchange hashpartitioning") <= 4


def test_rows_outside_the_stated_range_stop_the_join(spark):
    rows = spark.createDataFrame([("a", "2020-05-01")], "k string, day string").selectExpr("k", "cast(day as date) as day")
    spans = spark.sql("select 'a' as k, date'2020-01-01' as lo, date'2020-12-31' as hi")
    assert joins.valid_at(rows, spans, ["k"], "day", "lo", "hi", within=("2020-01-01", "2020-12-31")).count() == 1
    with pytest.raises(Exception, match="outside the stated range"):
        joins.valid_at(rows, spans, ["k"], "day", "lo", "hi", within=("2020-06-01", "2020-12-31")).collect()
