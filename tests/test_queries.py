"""Every registered query against its oracle SQL on the smallest tables."""

from collections import Counter

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from rollkeep.checks import QUERIES


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, small_duck, name):
    df = queries()[name](spark, SMALL)
    assert "void" not in [f.dataType.simpleString() for f in df.schema.fields]
    found = _bag([tuple(row) for row in df.collect()], df.columns)
    oracle = small_duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(oracle.columns)
    assert found == _bag(oracle.fetchall(), oracle.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    assert entry(spark).count() > 0
