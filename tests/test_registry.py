"""Every registered query against its SQL on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as spark_entry
import benchmark_queries
from tools.compare import TABLES, compare

# The operator ids a query must exist for.
IDS = (
    [f"s{i}" for i in range(1, 7)] + [f"k{i}" for i in range(1, 5)] + [f"v{i}" for i in range(1, 8)]
    + [f"b{i}" for i in range(1, 8)] + [f"l{i}" for i in range(1, 14)] + [f"g{i}" for i in range(1, 7)]
    + [f"j{i}" for i in range(1, 10)] + [f"a{i}" for i in range(1, 10)] + [f"w{i}" for i in range(1, 5)]
    + [f"o{i}" for i in range(1, 5)] + ["so1", "so2"] + [f"c{i}" for i in range(1, 12)] + [f"d{i}" for i in range(1, 9)]
    + ["js1", "u1", "u2"] + [f"q{i}" for i in range(1, 8)] + [f"m{i}" for i in range(1, 13)]
    + [f"t{i}" for i in range(1, 17)] + [f"p{i}" for i in range(1, 7)] + ["x1", "st1", "st2"]
)


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def test_every_operator_has_a_query():
    named = {part.rstrip("ab") if re.fullmatch(r"j5[ab]", part) else part for key in spark_entry.queries() for part in key.split("_")}
    assert [i for i in IDS if i not in named] == []


def test_every_query_has_sql():
    assert set(benchmark_queries.QUERIES) == set(benchmark_queries.ORACLES)
    assert set(benchmark_queries.QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(benchmark_queries.QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    result = compare(spark, con, name, sf_dir)
    assert re.fullmatch(r"ok \(\d+\) [\d.]+s", result), result


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns[0] == "partner" and result.count() > 0
