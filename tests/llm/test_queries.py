"""Registered queries of llm against their SQL, on whole tables."""

from pathlib import Path

import duckdb
import pytest

from lakeferry.llm.queries import ORACLE, QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows, names):
    places = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", ORACLE)
def test_query_gives_what_its_sql_gives(spark, oracle, name):
    frame = QUERIES[name](spark, str(SF))
    result = oracle.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert ordered(frame.collect(), frame.columns) == ordered(result.fetchall(), names)
