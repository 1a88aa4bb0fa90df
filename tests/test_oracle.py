"""Every linkage query against its SQL in DuckDB, and against itself with other partitions."""

import os

import duckdb
import pytest

from namewright.plans import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
    return con


def shown(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = duck.execute(queries.SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(shown(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert sorted(tuple(shown(row[c]) for c in columns) for row in df.collect()) == expected


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_partitions_do_not_matter(spark, partitions):
    expected = {tuple(r) for r in queries.QUERIES["final"](spark, FOLDER).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    queries.forget()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert {tuple(r) for r in queries.QUERIES["final"](spark, FOLDER).collect()} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        queries.forget()
