"""Every registered query against its DuckDB oracle."""

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry
from oracles import ORACLES
from subpulse.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    outcome = compare(spark, duck, SMALL, name)
    assert outcome.startswith("OK"), outcome


def test_the_comparison_notices_differences(spark, duck, monkeypatch):
    wrong = {**entry.oracle_sql(), "late_platform": entry.oracle_sql()["late_platform"].replace("0.95", "0.9")}
    monkeypatch.setattr(entry, "oracle_sql", lambda: wrong)
    assert compare(spark, duck, SMALL, "late_platform").startswith("FAIL")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
