"""Every query of the library against its SQL, on a whole small scale factor.

The training-data operators, which may be absent, have tests of their own.
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from compare import connect, difference, plan

QUERIES, SQL = (
    {name: value for name, value in found.items() if not re.fullmatch(r"op\d+_\w+|pipeline", name)}
    for found in (contract.queries(), contract.oracle_sql())
)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, con, SQL[name]) is None
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate"):
        assert node not in plan(df)


def test_entry_gives_rates(spark):
    result = contract.entry(spark)
    assert result.columns == ["period_start", "period_end", "organization_id", "churn_rate", "retention_rate"]
    assert result.count() > 0
