"""Every registered query against DuckDB on the same parquet files."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
import viewmart as vm
from viewmart.operators.profile import row_text
from viewmart.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


SQL_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(QUERIES) - set(SQL) == set()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = db.sql(SQL[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    ours = Counter(tuple(r[c] for c in columns) for r in result.collect())
    order = [expected.columns.index(c) for c in columns]
    kinds = dict(result.dtypes)
    assert [SQL_TYPE.get(kinds[c]) for c in columns] == [str(expected.types[i]) for i in order]
    theirs = Counter(tuple(r[i] for i in order) for r in expected.fetchall())
    assert ours == theirs
    assert ours, "the fixture should give rows"


def test_content_hash_sees_moved_nulls_and_reads_maps(spark):
    kind = "a string, b string, m map<string,int>"
    hashes = {
        vm.fingerprint(spark.createDataFrame([row], kind), content=True).first().content_hash
        for row in [("a", None, {}), (None, "a", {}), ("a", "", {}), ("", "a", {}), ("a", None, {"x": 1}), ("a", None, None)]
    }
    assert len(hashes) == 6
    two = spark.createDataFrame([({"x": 1, "y": 2},), ({"y": 2, "x": 1},)], "m map<string,int>")
    assert two.select(row_text(two.schema)).distinct().count() == 1


def test_entry(spark):
    assert driver.entry(spark).count() > 0
