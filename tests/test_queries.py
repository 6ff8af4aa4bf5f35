"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences, oracle_rows, spark_rows
from tests.conftest import SF_DIR

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, duck, name):
    """A query without SQL is only asked for rows here; see the operator's own tests."""
    have = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert have[1], "no rows"
    if name in ORACLES:
        assert differences(have, oracle_rows(duck, ORACLES[name])) == []


@pytest.mark.parametrize(
    "name, found",
    [
        ("quality_report_faulty", "failed"),
        ("constraint_report_faulty", "violations"),
        ("reconcile_faulty", "abs(difference)"),
    ],
)
def test_checks_can_fail(spark, name, found):
    """Every rule finds some planted fault; stock is the one table that lands whole."""
    report = entry.queries()[name](spark, SF_DIR)
    quiet = report.where(f"{found} = 0").collect()
    assert [r.table_name for r in quiet] == (["stock_quant"] if name == "reconcile_faulty" else [])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["territory", "manager", "orders", "sales"] and df.count() > 0
