"""Every query with an oracle against it, and the columns of all."""

from __future__ import annotations

import duckdb
import pytest

from tripflow.llm.workload import ORACLE, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    folder = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    answer = duck.execute(ORACLE[name])
    columns = [d[0] for d in answer.description]
    wanted = sorted(map(repr, answer.fetchall()))
    found = QUERIES[name](spark, folder).select(*columns)
    assert sorted(repr(tuple(r)) for r in found.collect()) == wanted
