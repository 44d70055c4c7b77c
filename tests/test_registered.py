"""Registered queries against their SQL twins, and the shape of their plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracle_monitoring
import oracle_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "supplier", "lineitem", "orders", "conversations")
#: The queries of the library itself; operators installed beside it have tests of their own.
SQL = oracle_queries.all_queries() | oracle_monitoring.all_queries()
QUERIES = {name: query for name, query in entry.queries().items() if name in SQL}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not there")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    twin = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})")
    assert sorted(map(repr, (tuple(r) for r in frame.select(columns).collect()))) == sorted(map(repr, twin.fetchall()))


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_of_all_rows_and_no_python_in_the_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in plan


def _hash_exchanges(frame):
    return _plan(frame).count("Exchange hashpartitioning")


@pytest.mark.parametrize("name, exchanges", [
    ("sequence_summary_b", 4),             # typed blocks, blocks, sequences, registry
    ("event_type_frequency_b", 4),         # serials, (sequence, type), sequence, type
    ("key_coverage_b", 1),
    ("ordering_violations_b", 3),          # serials, stretches, sequences
])
def test_number_of_shuffles(spark, name, exchanges):
    # Without broadcasts, as for a registry too large for one.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _hash_exchanges(QUERIES[name](spark, SF_DIR)) == exchanges
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_scans_read_needed_columns_only(spark):
    plan = QUERIES["first_serial_distribution_b"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_registries_are_read_whole(spark):
    plan = QUERIES["segment_counts_b"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: []" in plan


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
