"""Every query against its DuckDB oracle: names, types, rows and exact values."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tripflow.workload.oracle import ORACLE
from tripflow.workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir_module):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir_module}/{table}.parquet'"
        )
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def sf_dir_module():
    from conftest import SF_DIR

    return SF_DIR


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    found = sorted(repr([row[c] for c in columns]) for row in result.collect())

    sql = oracle_sql()[name]
    types = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema} == types

    answer = duck.execute(sql)
    places = [[d[0] for d in answer.description].index(c) for c in columns]
    wanted = sorted(repr([row[i] for i in places]) for row in answer.fetchall())
    assert found == wanted


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
