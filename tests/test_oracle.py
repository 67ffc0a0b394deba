"""Every registered query against its SQL in another engine."""

from __future__ import annotations

import duckdb
import pytest

from oracle_queries import ORACLES
from termloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, SF)
    cursor = engine.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    expected = sorted((tuple(row) for row in cursor.fetchall()), key=repr)
    names = list(types)
    assert sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr) == expected
    assert expected, "an empty result proves nothing"
