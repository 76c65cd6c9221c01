"""Checks, contracts and profiles on small tables."""

import re

import pytest
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.operators import quality as q


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def bad_rows(df, check):
    return q.violations(df, [check]).first().bad_rows


TEXTS = [
    None, "", "2024", "2024\n", "2024\r", "20245", "٢٠٢٤", "2024-Q1", "2024-Q5", "2024-01",
    "2024-13", "2024-W53", "2024-W54", "2024-W00", "2024-02-31", "2024-02-32", "2024-2-1",
    "2024-01-01x", " 2024", "x2024",
]


@pytest.mark.parametrize(
    "make, patterns",
    [
        (q.valid_year, [q.YEAR]),
        (q.valid_quarter, [q.QUARTER]),
        (q.valid_month, [q.MONTH]),
        (q.valid_week, [q.WEEK]),
        (q.valid_date, [q.DATE]),
        (q.valid_date_any, q.ANY_DATE),
        (lambda c: q.matches_pattern(c, r"20|x"), ["20|x"]),
        (lambda c: q.matches_pattern(c, r"\s?\d+$"), [r"\s?\d+$"]),
    ],
)
def test_patterns_like_python(spark, make, patterns):
    expected = sum(
        not any(re.match(p, t) for p in patterns) for t in TEXTS if t is not None
    )
    assert bad_rows(column(spark, TEXTS), make("v")) == expected


def test_lengths_count_code_points(spark):
    df = column(spark, [None, "", "abc", "\U0001f600é中", "abcd"])
    assert bad_rows(df, q.max_length("v", 3)) == 1
    assert bad_rows(df, q.min_length("v", 3)) == 1
    assert bad_rows(df, q.exact_length("v", 3)) == 2
    assert bad_rows(column(spark, [1, 22, 333], "int"), q.max_length("v", 2)) == 1


def test_numbers(spark):
    df = column(spark, [None, -1.0, 0.0, 50.0, 100.0, 100.5, float("nan"), float("inf")], "double")
    assert bad_rows(df, q.positive("v")) == 1
    assert bad_rows(df, q.positive("v", allow_zero=False)) == 2
    assert bad_rows(df, q.in_range("v", 0, 100)) == 3
    assert bad_rows(df, q.in_range("v", low=0)) == 1
    assert bad_rows(df, q.in_range("v", high=100)) == 2
    assert bad_rows(df, q.in_range("v")) == 0
    assert bad_rows(df, q.percentage("v")) == 3


def test_sets(spark):
    df = column(spark, [None, "a", "b", "b", "c"])
    assert bad_rows(df, q.in_set("v", ["a", "b"])) == 1
    row = q.not_in_table(df, "v", column(spark, ["a", "c", None]))
    assert tuple(row.first()) == ("in_set", "v", 2)
    assert q.not_in_table(df, "v", column(spark, ["a", "b", "c"])).first().bad_rows == 0


def test_samples_are_bounded_and_real(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    row = q.violations(df, [q.max_length("v", 2)]).first()
    assert row.bad_rows == 900 and len(row["sample"]) == 5
    assert all(len(v) == 3 for v in row["sample"])
    assert q.violations(df, [q.max_length("v", 3)]).first()["sample"] == []
    assert q.violations(df, [q.max_length("v", 2)], samples=0).first()["sample"] == []


def test_all_checks_run_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b")).write.parquet(path)
    df = q.violations(spark.read.parquet(path), [q.positive("a"), q.max_length("b", 1), q.percentage("a")])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_expect(spark):
    df = column(spark, ["2024", "x"])
    q.expect(df, [q.max_length("v", 4)])
    with pytest.raises(AssertionError, match=r"column 'v' fails valid_year: 1 rows, e.g. \['x'\]"):
        q.expect(df, [q.max_length("v", 4), q.valid_year("v")])


CONTRACTS = [
    ({"min_rows": 3}, None),
    ({"min_rows": 4}, "min_rows"),
    ({"min_rows": 0}, None),
    ({"max_rows": 3}, None),
    ({"max_rows": 2}, "max_rows"),
    ({"max_rows": 0}, "max_rows"),
    ({"columns": {"k": "int", "s": "string", "d": "double", "l": "list", "t": "timestamp"}}, None),
    ({"columns": {"k": "int64"}}, None),
    ({"columns": {"k": "int32"}}, "column k"),
    ({"columns": {"nope": "int"}}, "column nope"),
    ({"not_null": ["k", "d"]}, None),
    ({"not_null": ["s"]}, "not_null s"),
    ({"not_null": ["nope"]}, "not_null nope"),
    ({"unique": "k"}, "unique k"),
    ({"unique": ["k", "s"]}, None),
    ({"unique": "s"}, None),
    ({"unique": ["k", "nope"]}, "unique k, nope"),
    ({}, None),
]


@pytest.mark.parametrize("spec, failure", CONTRACTS)
def test_contract(spark, spec, failure):
    rows = [(1, "a", 1.0, [1], None), (1, "b", 2.0, [2], None), (2, None, 3.0, [], None)]
    df = spark.createDataFrame(rows, "k bigint, s string, d double, l array<int>, t timestamp")
    if failure is None:
        q.validate(df, spec)
    else:
        with pytest.raises(AssertionError, match=failure):
            q.validate(df, spec)


def test_arrow_names_are_those_of_arrow(spark):
    kinds = (
        "a tinyint, b smallint, c int, d bigint, e float, f double, g string, h binary, i boolean, "
        "j date, k timestamp, l timestamp_ntz, m decimal(10,2), n array<bigint>"
    )
    df = spark.createDataFrame([], kinds)
    arrow = df.toArrow().schema
    for field in df.schema:
        ours, theirs = q.arrow_name(field.dataType), str(arrow.field(field.name).type)
        assert ours == theirs.replace("Etc/UTC", "UTC")
    nested = spark.createDataFrame([], "p map<string,int>, q struct<x:int>").schema
    assert [q.arrow_name(f.dataType) for f in nested] == ["map<string, int32>", "struct<x: int32>"]


def test_profile(spark):
    df = spark.createDataFrame(
        [("é", 1, [1.0, None], {"a": "bc"}, (1, "xy")), (None, None, None, None, None)],
        "s string, n int, l array<double>, m map<string,string>, t struct<i:bigint,u:string>",
    )
    got = {r.column: (r.type, r.rows, r.nulls, r.bytes) for r in vm.profile(df).collect()}
    assert got == {
        "s": ("string", 2, 1, 2),
        "n": ("int", 2, 1, 4),
        "l": ("array<double>", 2, 1, 8),
        "m": ("map<string,string>", 2, 1, 3),
        "t": ("struct<i:bigint,u:string>", 2, 1, 10),
    }


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    other = spark.createDataFrame([(2, "b"), (1, "z")], "k int, v string")
    same = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    tag = lambda d, **k: tuple(vm.fingerprint(d, **k).first())
    assert tag(df) == tag(other) != tag(df.limit(1))
    assert tag(df) != tag(df.withColumnRenamed("v", "w"))
    assert tag(df, content=True) == tag(same, content=True) != tag(other, content=True)


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "a")], "k int, v string")
    assert tuple(vm.duplicate_keys(df, ["k", "v"]).first()) == (4, 3, 1)
    assert tuple(vm.duplicate_keys(df, "v").first()) == (4, 2, 2)
    assert tuple(vm.duplicate_keys(df.where("false"), "v").first()) == (0, 0, 0)
