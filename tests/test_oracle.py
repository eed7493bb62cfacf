"""Every registered query against DuckDB on the same tables."""

import pytest
from compare import duckdb_result, open_tables, spark_result

import __spark_entry__ as contract
from millrace.plans.batch_queries import BATCH
from millrace.plans.stream_queries import STREAM
from sql_checks import ORACLE

QUERIES = contract.queries()


@pytest.fixture(scope="module")
def connections():
    return {}


@pytest.mark.parametrize("tables", ["sf_dir", "harsh_dir"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, request, connections, name, tables):
    folder = request.getfixturevalue(tables)
    if folder not in connections:
        connections[folder] = open_tables(folder)
    columns, rows = spark_result(QUERIES[name](spark, folder))
    expected_columns, expected_rows = duckdb_result(connections[folder], ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected_rows)
    assert rows == expected_rows


def test_every_query_has_sql():
    assert set(BATCH) | set(STREAM) == set(ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() == 7
