"""Dump lines against Python's own split, and the ingest jobs over real bzip2 files."""

import bz2

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.sources.facts import read_origins
from viewmart.functions.text import (
    CONTROL_BLANKS,
    WIDE_BLANKS,
    day_from_path,
    split_fields,
    to_count,
)

LINES = [
    "aa.site Main_Page 15 desktop 100 A1B2",
    "aa.site Main_Page 15 mobile 7 C3",
    "aa.site No_Id null desktop 5 A1",
    "bb.site Other 15 desktop 9 A1",
    "aa.site short",
    "aa.site Two\xa0words 3 desktop 4 A1",
    "   aa.site\tPadded  16   desktop 12 Z9  　",
    "aa.site A\x1cB 17 desktop 4 A1",
    "aa.site Bad 18 desktop x4 A1",
    "aa.site Grouped 19 desktop 1_000 A1",
    "aa.site Signed 20 desktop +5 A1",
    "",
    "   ",
]


def as_lines(spark, values):
    rows = [("2024-01-01", "f", v) for v in values]
    return spark.createDataFrame(rows, "date string, source string, value string")


def python_parse(values, project):
    kept = []
    for value in values:
        fields = value.strip().split()
        if len(fields) == 6 and fields[0] == project and fields[2] != "null":
            try:
                kept.append((fields[1], fields[2], int(fields[4])))
            except ValueError:
                pass
    return sorted(kept)


def test_blanks_are_those_of_python():
    found = {chr(i) for i in range(0x110000) if chr(i).isspace()} - {" "}
    assert found == set(CONTROL_BLANKS + WIDE_BLANKS)


def test_split_every_blank(spark):
    values = [f"{b}a{b}{b}b c{b}" for b in CONTROL_BLANKS + WIDE_BLANKS + " ​﻿"]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(split_fields(F.col("v")))
    assert [r[0] for r in got.collect()] == [v.strip().split() for v in values]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.text(alphabet="ab1_-+é中\U0001f600 \t\x1c\x1f\x85\xa0  　", max_size=40),
        min_size=1,
        max_size=60,
    )
)
def test_split_like_python(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "v string").select(split_fields(F.col("v")))
    assert [r[0] for r in got.collect()] == [v.strip().split() for v in values]


def test_facts_like_python(spark):
    facts = vm.dump_facts(as_lines(spark, LINES), "aa.site", strict=False)
    got = sorted((r.entity, r.page_id, r.views) for r in facts.collect())
    assert got == python_parse(LINES, "aa.site")
    assert ("Grouped", "19", 1000) in got and ("Signed", "20", 5) in got


@pytest.mark.parametrize("text", ["5", "+5", "-7", "1_000", "1__0", "_1", "1_", "5.7", "x", "", "+", "1_2_3"])
def test_count_like_int(spark, text):
    try:
        expected = int(text)
    except ValueError:
        expected = None
    row = spark.createDataFrame([(text,)], "t string").select(to_count(F.col("t")).alias("n")).first()
    assert row.n == expected


def test_count_beyond_bigint_is_rejected(spark):
    lines = as_lines(spark, ["aa.site P 1 d 9223372036854775808 x"])
    assert vm.dump_facts(lines, "aa.site", strict=False).isEmpty()
    assert [r.reason for r in vm.parse_rejects(lines, "aa.site").collect()] == ["count"]


def test_rejects(spark):
    rejects = vm.parse_rejects(as_lines(spark, LINES), "aa.site").collect()
    got = sorted((r.reason, r.value) for r in rejects)
    assert got == [
        ("count", "aa.site Bad 18 desktop x4 A1"),
        ("fields", "aa.site A\x1cB 17 desktop 4 A1"),
        ("fields", "aa.site Two\xa0words 3 desktop 4 A1"),
        ("fields", "aa.site short"),
    ]


def test_strict_fails_on_a_bad_count_of_the_project_only(spark):
    fine = as_lines(spark, ["aa.site P 1 d 4 x", "bb.site P 1 d x4 x"])
    assert vm.dump_facts(fine, "aa.site").count() == 1
    with pytest.raises(Exception, match="not an integer"):
        vm.dump_facts(as_lines(spark, ["aa.site P 1 d x4 x"]), "aa.site").collect()


def test_broken_utf8(spark):
    lines = as_lines(spark, ["aa.site P 1 d 4 x", "aa.site Q 2 d 4 x"]).withColumn(
        "value",
        F.when(F.contains("value", F.lit("Q")), F.concat(F.col("value").cast("binary"), F.unhex(F.lit("FF"))).cast("string"))
        .otherwise(F.col("value")),
    )
    assert [r.page_id for r in vm.dump_facts(lines, "aa.site", strict=False).collect()] == ["1"]
    assert [r.reason for r in vm.parse_rejects(lines, "aa.site").collect()] == ["encoding"]
    with pytest.raises(Exception, match="UTF-8"):
        vm.dump_facts(lines, "aa.site").collect()


def test_day_text(spark):
    row = spark.range(1).select(
        day_from_path(F.lit("file:/x/2024/pageviews-20240229-user.bz2")).alias("day"),
        day_from_path(F.lit("file:/x/other.bz2")).alias("none"),
    ).first()
    assert row == ("2024-02-29", None)


def write_dump(folder, day, lines):
    month = folder / day[:4] / f"{day[:4]}-{day[4:6]}"
    month.mkdir(parents=True, exist_ok=True)
    (month / f"pageviews-{day}-user.bz2").write_bytes(bz2.compress("\n".join(lines).encode()))


def stored(spark, path):
    return sorted(tuple(r) for r in vm.read_facts(spark, str(path)).collect())


def test_stream_loads_each_file_once_and_resumes(spark, tmp_path):
    dump, facts, checkpoint = tmp_path / "dump", tmp_path / "facts", tmp_path / "checkpoint"
    run = lambda: vm.ingest_stream(
        spark, str(dump), str(facts), str(checkpoint), "aa.site", files_per_batch=1,
        rejects_path=str(tmp_path / "rejects"),
    )
    write_dump(dump, "20240101", LINES)
    write_dump(dump, "20240102", ["aa.site Main_Page 15 d 3 x"])
    (dump / "pageviews-20240101-bot.bz2").write_bytes(bz2.compress(b"aa.site Bot 99 d 1 x"))
    assert run() == 2
    first = stored(spark, facts)
    assert [r[3] for r in first if r[0] == "2024-01-02"] == [3]
    assert not [r for r in first if r[2] == "99"]
    assert sorted((e, p, v) for d, e, p, v in first if d == "2024-01-01") == python_parse(LINES, "aa.site")
    assert run() == 0
    assert stored(spark, facts) == first
    write_dump(dump, "20240103", ["aa.site Main_Page 15 d 4 x"])
    assert run() == 1
    assert stored(spark, facts) == first + [("2024-01-03", "Main_Page", "15", 4)]
    reasons = spark.read.parquet(str(tmp_path / "rejects")).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in reasons} == {"fields": 3, "count": 1}


def test_outcomes_of_files(spark, tmp_path):
    dump, paths = tmp_path / "dump", {n: str(tmp_path / n) for n in ("facts", "rejects", "outcomes")}
    run = lambda: vm.ingest_stream(
        spark, str(dump), paths["facts"], str(tmp_path / "c"), "aa.site", files_per_batch=40, allow_empty=True,
        rejects_path=paths["rejects"], outcomes_path=paths["outcomes"],
    )
    expected = {}
    for k in range(1, 41):  # as many files as a batch may have, of every length
        day = f"2024{1 + k // 28:02}{1 + k % 28:02}"
        lines = ["aa.site P 1 d 3 x"] * (k % 7) + ["bb.site P 1 d 3 x"] * k + ["aa.site P 1"] * (k % 3)
        write_dump(dump, day, lines)
        expected[f"{day[:4]}-{day[4:6]}-{day[6:]}"] = (len(lines), k % 7, k % 3)
    assert run() == 1
    found = vm.read_outcomes(spark, paths["outcomes"]).collect()
    assert {r.date: (r.lines, r.kept, r.rejected) for r in found} == expected and len(found) == 40
    assert {r.source for r in found if r.date == "2024-01-05"} == {"2024/2024-01/pageviews-20240105-user.bz2"}
    write_dump(dump, "20240401", ["aa.site P 1 d 3 x", "", ""])
    assert run() == 1
    found = vm.read_outcomes(spark, paths["outcomes"])
    assert found.count() == 41 and found.where("date = '2024-04-01'").first()[2:] == (2, 1, 0)
    with pytest.raises(ValueError, match="rejects_path"):
        vm.ingest_stream(spark, str(dump), paths["facts"], "c", "aa.site", outcomes_path=paths["outcomes"])


def test_batch_ingest_replaces_a_reissued_file(spark, tmp_path):
    dump, facts = tmp_path / "dump", tmp_path / "facts"
    write_dump(dump, "20240101", ["aa.site P 1 d 3 x"])
    write_dump(dump, "20240102", ["aa.site P 1 d 4 x"])
    vm.ingest(spark, str(dump), str(facts), "aa.site")
    again = tmp_path / "again"
    write_dump(again, "20240102", ["aa.site P 1 d 40 x", "aa.site Q 2 d 1 x"])
    vm.ingest(spark, str(again), str(facts), "aa.site")
    assert stored(spark, facts) == [
        ("2024-01-01", "P", "1", 3),
        ("2024-01-02", "P", "1", 40),
        ("2024-01-02", "Q", "2", 1),
    ]


def test_a_day_in_several_files_keeps_them_all(spark, tmp_path):
    dump, facts = tmp_path / "dump", tmp_path / "facts"
    dump.mkdir()
    for part in ("a", "b"):
        text = f"aa.site P{part} 1 d 3 x".encode()
        (dump / f"pageviews-20240101-user.{part}.bz2").write_bytes(bz2.compress(text))
    args = dict(glob="*.bz2", files_per_batch=1)
    assert vm.ingest_stream(spark, str(dump), str(facts), str(tmp_path / "c"), "aa.site", **args) == 2
    assert [r[1] for r in stored(spark, facts)] == ["Pa", "Pb"]


def test_files_of_one_name_in_several_folders(spark, tmp_path):
    dump = tmp_path / "dump"
    for part in ("a", "b c"):
        (dump / part).mkdir(parents=True)
        text = f"aa.site P{part[0]} 1 d 3 x".encode()
        (dump / part / "pageviews-20240101-user.bz2").write_bytes(bz2.compress(text))
    vm.ingest(spark, str(dump), str(tmp_path / "batch"), "aa.site")
    assert vm.ingest_stream(
        spark, str(dump), str(tmp_path / "stream"), str(tmp_path / "c"), "aa.site", files_per_batch=1
    ) == 2
    assert [r[1] for r in stored(spark, tmp_path / "stream")] == ["Pa", "Pb"]
    assert stored(spark, tmp_path / "batch") == stored(spark, tmp_path / "stream")
    origins = {tuple(r) for r in read_origins(spark, str(tmp_path / "stream")).collect()}
    assert origins == {("2024-01-01", f"{p}/pageviews-20240101-user.bz2") for p in ("a", "b c")}


def test_bad_lines_fail_unless_they_are_kept(spark, tmp_path):
    dump = tmp_path / "dump"
    write_dump(dump, "20240101", LINES)
    with pytest.raises(Exception, match="not an integer"):
        vm.ingest(spark, str(dump), str(tmp_path / "f1"), "aa.site")
    with pytest.raises(Exception, match="not an integer"):
        vm.ingest_stream(spark, str(dump), str(tmp_path / "f2"), str(tmp_path / "c"), "aa.site")
    vm.ingest(spark, str(dump), str(tmp_path / "f3"), "aa.site", rejects_path=str(tmp_path / "bad"))
    assert sorted((e, p, v) for _, e, p, v in stored(spark, tmp_path / "f3")) == python_parse(LINES, "aa.site")
    kept = spark.read.parquet(str(tmp_path / "bad")).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in kept} == {"fields": 3, "count": 1}


def test_a_day_without_facts_is_an_error(spark, tmp_path):
    dump = tmp_path / "dump"
    write_dump(dump, "20240101", ["bb.site P 1 d 3 x"])
    with pytest.raises(ValueError, match="2024-01-01"):
        vm.ingest(spark, str(dump), str(tmp_path / "facts"), "aa.site")
    with pytest.raises(Exception, match="2024-01-01"):
        vm.ingest_stream(spark, str(dump), str(tmp_path / "f2"), str(tmp_path / "c2"), "aa.site")
    vm.ingest(spark, str(dump), str(tmp_path / "facts"), "aa.site", allow_empty=True)


def test_a_file_without_a_day_is_an_error(spark, tmp_path):
    (tmp_path / "x.bz2").write_bytes(bz2.compress(b"aa.site P 1 d 3 x"))
    with pytest.raises(Exception, match="no day in the path of x.bz2"):
        vm.ingest(spark, str(tmp_path), str(tmp_path / "facts"), "aa.site", glob="*.bz2")


def test_flat_daily_files(spark, tmp_path):
    rows = [("2024-01-01", "P", "1", 3)]
    df = spark.createDataFrame(rows, "date string, entity string, page_id string, views bigint")
    df.toPandas().to_parquet(tmp_path / "page_views_20240101.parquet")
    df.toPandas().to_parquet(tmp_path / "other.parquet")
    assert [tuple(r) for r in vm.read_daily_files(spark, str(tmp_path)).collect()] == rows


def test_recent_window_prunes_partitions(spark, tmp_path):
    rows = [(f"2024-01-{d:02d}", "P", "1", d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "date string, entity string, page_id string, views bigint")
    vm.write_facts(df, str(tmp_path / "facts"))
    recent = vm.read_recent(vm.read_facts(spark, str(tmp_path / "facts")), "2024-01-09", 3)
    assert sorted(r.views for r in recent.collect()) == [7, 8, 9]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    with pytest.raises(ValueError):
        vm.read_recent(df, "2024-01-09", 0)
