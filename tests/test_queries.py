"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from marketlake import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def database(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield con
    con.close()


def ordered(rows, columns):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(repr(r[i] + 0.0) if isinstance(r[i], float) else repr(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, database, folder, name):
    result = catalog.queries()[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "ArrowEval", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node
    rows = [tuple(r) for r in result.collect()]
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    answer = database.execute(sql)
    columns = [d[0] for d in answer.description]
    types = {d[0]: str(d[1]) for d in answer.description}
    assert sorted(columns) == sorted(result.columns)
    assert {c: SPARK_TO_SQL[t] for c, t in result.dtypes} == types
    assert ordered(rows, result.columns) == ordered(answer.fetchall(), columns)


def test_only_the_json_document_lacks_sql():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"indicator_document"}
