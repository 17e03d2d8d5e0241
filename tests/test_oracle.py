"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

from weatherlake.plans.oracle import ORACLE
from weatherlake.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry_file

    frame = entry_file.entry(spark)
    assert frame.columns[:2] == ["window_start", "window_end"]
    assert frame.count() > 0
