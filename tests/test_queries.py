"""Every registered query with a SQL counterpart gives its rows and values."""

import sys

import pytest
from compare import connect, same
from conftest import ROOT

sys.path.insert(0, ROOT)
import __spark_entry__ as contract  # noqa: E402

from loadcast.plans.queries import ORACLES, QUERIES  # noqa: E402

@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    """All but the fitted values of model queries, whose digests have it."""
    assert {name for name in QUERIES if not name.endswith("_values")} == set(ORACLES)
    assert {name.removesuffix("_values") for name in QUERIES} == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert len(want) > 0, "an empty result proves nothing"
    assert same(got, want) is None


def test_entry_points_register_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
