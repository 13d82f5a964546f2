"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import oracle
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from siltstone.workload import ORACLES, QUERIES
from siltstone.workload.scratch import drop_namespaces

SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, name):
    result = entry_points.queries()[name](spark, SMALL)
    relation = connection.sql(entry_points.oracle_sql()[name])
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SPARK_TO_SQL[t] for c, t in result.dtypes} == expected_types
    assert oracle.differences(result.toPandas(), relation.df()) is None
    drop_namespaces(spark)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns[0] == "song_id"
    assert result.count() > 0
