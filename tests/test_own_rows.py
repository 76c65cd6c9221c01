"""Queries on rows made here, which the given tables don't have, against their SQL in DuckDB."""

from collections import Counter
from datetime import datetime

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from viewmart import queries
from viewmart.functions.text import day_from_path
from viewmart.llm.common import tokenizer_path
from viewmart.llm.level_packing import Encoder
from viewmart.queries import QUERIES, SQL
from viewmart.sources.dumps import read_dump


def same_as_sql(spark, folder, name, **tables):
    db = duckdb.connect()
    for table, rows in tables.items():
        rows.write.parquet(f"{folder}/{table}.parquet")
        db.sql(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    expected = db.sql(SQL[name])
    columns = sorted(expected.columns)
    ours = Counter(tuple(r[c] for c in columns) for r in QUERIES[name](spark, str(folder)).collect())
    order = [expected.columns.index(c) for c in columns]
    assert ours == Counter(tuple(r[i] for i in order) for r in expected.fetchall())
    return ours


def test_content_kept_with_an_appended_row_of_key_zero(spark, tmp_path):
    orders = spark.createDataFrame(
        [(0, 3, "O", "1-URGENT"), (1, 6, "F", "5-LOW"), (2, 7, "P", None)],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    ).selectExpr("*", "1.0d as o_totalprice", "timestamp_ntz'1997-01-01' as o_orderdate")
    lineitem = spark.createDataFrame(
        [(0, "R", "O", datetime(1997, 1, 2)), (1, "A", "F", datetime(1997, 1, 3)), (5, "N", "O", datetime(1997, 1, 4))],
        "l_orderkey bigint, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    )
    assert same_as_sql(spark, tmp_path, "content_kept", orders=orders, lineitem=lineitem)


@pytest.fixture
def uneven_tasks(spark):
    """Small shuffle partitions stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_list_assets_writes_its_days_in_several_tasks(spark, tmp_path, monkeypatch, uneven_tasks):
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, label: str(tmp_path / label))
    events = spark.range(1, 400).selectExpr("id as event_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 20)) as ts")
    assert len(same_as_sql(spark, tmp_path, "list_assets", events=events)) == 20
    tasks = {f.name.split("-")[1] for f in (tmp_path / "assets/events").glob("day=*/part-*.txt")}
    assert len(tasks) > 3


def test_tasks_do_not_multiply_the_files_of_a_year(spark, tmp_path):
    lines = spark.range(0, 400, numPartitions=8).selectExpr(
        "id as l_partkey", "int(id % 7) as l_linenumber", "double(id % 50 + 1) as l_quantity",
        "if(id % 2 = 0, 'O', 'F') as l_linestatus", "timestamp_ntz'1995-01-02' + make_interval(int(id % 5)) as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    queries.year_dump(spark, str(tmp_path), f"{tmp_path}/dump")
    assert len(list((tmp_path / "dump").glob("day=*/*.bz2"))) == 5


def test_the_day_and_origin_of_odd_paths(spark, tmp_path):
    folder = tmp_path / "a+b 100%25 ü"
    for name in ["pageviews-20240102-user.bz2.txt", "x y+z%41-pageviews-20240103-user"]:
        (folder / "in:side").mkdir(parents=True, exist_ok=True)
        (folder / "in:side" / name).write_text("l\n")
    rows = read_dump(spark, str(folder), glob="*user*").collect()
    assert {(r.date, r.source) for r in rows} == {
        ("2024-01-02", "in:side/pageviews-20240102-user.bz2.txt"),
        ("2024-01-03", "in:side/x y+z%41-pageviews-20240103-user"),
    }
    paths = spark.createDataFrame([("a-1-2-",), ("b",), (None,), ("a--2-3",), ("x a-1-2-3 a-4-5-6",)], "p string")
    days = paths.select(day_from_path(F.col("p"), r"a-(\d?)-(\d)-(\d?)").alias("d")).collect()
    assert [r.d for r in days] == ["1-2-", None, None, None, "1-2-3"]


def test_unknown_words_are_encoded_together():
    encode = Encoder(tokenizer_path())
    tokenizer, taken = encode._tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            taken.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    encode._tokenizer = Counting()
    texts = [" ".join(f"wörd{i}x{j}" for j in range(60)) + "\n\n  odd <|endoftext|> 's" for i in range(20)]
    ids = [np.frombuffer(x, "<u4").tolist() for x in encode.encode(texts)]
    assert ids == [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert len(taken) < 100
