"""Every query with a DuckDB twin, and that the others run."""

import pytest

from pyrelith.plans import ORACLES, QUERIES
from tests.oracle import check


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sf, name):
    check(spark, sf, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 25
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
