"""Every registered query with a SQL check gives the same rows as DuckDB."""

import math

import pytest
from conftest import SMALL

import __spark_entry__ as contract
from frostline.catalog import all_checks, all_queries

QUERIES, CHECKS = all_queries(), all_checks()


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, (bool, int, float)):
        return (1, "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value)))
    return (2, str(value))


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_equals_sql(name, spark, duck):
    frame = QUERIES[name](spark, SMALL)
    result = duck.execute(CHECKS[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    order = sorted(columns)
    expected = sorted(tuple(_plain(row[columns.index(c)]) for c in order) for row in result.fetchall())
    found = sorted(tuple(_plain(row[c]) for c in order) for row in frame.collect())
    assert found == expected


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
