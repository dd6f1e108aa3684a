"""Every registered query equals its SQL, and the agreed figures hold."""

import pytest

from checks import compare, oracles, registry
from checks.fixtures import Study

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    actual = registry.queries()[name](spark, SF).toArrow()
    expected = con.execute(oracles.oracle_sql()[name]).to_arrow_table()
    assert compare.difference(actual, expected) is None


def test_agreed_figures(spark):
    st = Study(spark, SF)
    sums = registry.scores(st).groupBy("prs_id").agg({"total_score": "sum", "variant_count": "sum"})
    assert {r["prs_id"]: (r["sum(total_score)"], r["sum(variant_count)"]) for r in sums.collect()} == {
        "PGSA": (-5.96875, 858), "PGSB": (2.890625, 1255), "PGSC": (-28.9375, 369)
    }
    assert registry.members(st).count() == 110
