"""Every registered query against its oracle, and never on an empty result."""

import conftest
import oracle
import pytest

import __spark_entry__ as entry

from formflow.plans import catalog

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(conftest.SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLES, "every query has an oracle"
    equal, message, rows = oracle.compare(QUERIES[name](spark, conftest.SF_DIR), con, ORACLES[name])
    assert equal, message
    assert rows > 0, "an empty result would equal anything"


def test_entry_registers_the_catalog():
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["site_id", "catchment_id", "case_id", "status", "priority", "segment", "reason", "order_dt"]
    assert df.count() > 0
