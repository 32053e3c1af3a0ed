"""The commuter extract's population rules."""

from conftest import SMALL, rows

from rollkeep.checks import commuting
from rollkeep.checks.commuting import SOURCE2
from rollkeep.checks.standins import ASOF, standins
from rollkeep.plans import commuter as c


def test_second_branch_contains_the_others(spark):
    tables = standins(spark, SMALL, *SOURCE2)
    jobs = c.job_rows(tables, c.current_addresses(tables, ASOF), ASOF)
    assert jobs.where("(b1 or b3) and not coalesce(b2, false)").count() == 0
    assert jobs.where("b2").count() > 0


def test_both_populations_in_one_pass(spark):
    tables = standins(spark, SMALL, *SOURCE2)
    apart = c.source2(tables, ASOF, eligible=True).union(c.source2(tables, ASOF, eligible=False)).distinct()
    assert rows(c.source2(tables, ASOF)) == rows(apart)


def test_layout(spark):
    df = c.source2(standins(spark, SMALL, *SOURCE2), ASOF)
    assert len(df.columns) == 39
    assert [f.dataType for f in df.schema] == [f.dataType for f in c.LAYOUT]


def test_branches_share_their_joins(spark):
    """Each branch with joins of its own held three times the sort buffers in a task."""
    plan = commuting.union_branches(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation ") == 3
