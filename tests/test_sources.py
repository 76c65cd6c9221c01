"""Raw assets, calendars and dimension sync."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.functions.storage import scratch_folder
from viewmart.queries import QUERIES


def test_asset_round_trips(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "é")], "k bigint, v string")
    for fmt, options in [
        ("parquet", {}),
        ("json", {}),
        ("json", {"compression": "gzip"}),
        ("csv", {"header": True}),
    ]:
        name = f"{fmt}-{len(options)}"
        vm.write_asset(df, base, name, fmt, **options)
        read = {"schema": df.schema} if fmt == "csv" else {}
        if fmt == "csv":
            read["header"] = True
        assert sorted(vm.read_asset(spark, base, name, fmt, **read).collect()) == sorted(df.collect())
    path = vm.write_asset(df.select("v"), base, "lines", "text", compression="bzip2")
    assert path.endswith("lines.txt.bz2")
    lines = vm.read_asset(spark, base, "lines", "text", extension="txt.bz2")
    assert sorted(r.value for r in lines.collect()) == ["a", "é"]


def test_json_documents(spark, tmp_path):
    rows = [{"k": 1, "v": "a"}, {"k": 2, "v": "b"}]
    (tmp_path / "plain.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "packed.json.gz").write_bytes(gzip.compress(json.dumps(rows).encode()))
    for name in ("plain", "packed"):
        got = vm.read_asset(spark, str(tmp_path), name, "json").collect()
        assert sorted((r.k, r.v) for r in got) == [(1, "a"), (2, "b")]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, rows)))
    got = vm.read_asset(spark, str(tmp_path), "lines", "json", multiLine=False)
    assert got.count() == 2


def test_binary_and_errors(spark, tmp_path):
    (tmp_path / "blob.zip").write_bytes(b"\x00\xff")
    got = vm.read_asset(spark, str(tmp_path), "blob", "binary", extension="zip")
    assert bytes(got.first().content) == b"\x00\xff"
    with pytest.raises(FileNotFoundError, match="none"):
        vm.read_asset(spark, str(tmp_path), "none", "json")
    with pytest.raises(ValueError):
        vm.read_asset(spark, str(tmp_path), "blob", "xml")
    path = vm.write_asset(got, str(tmp_path), "x", "binary")
    assert (tmp_path / "x.bin").read_bytes() == b"\x00\xff" and path.endswith("x.bin")
    for rows in ([], [(b"1",), (b"2",)], [(None,)]):
        with pytest.raises(ValueError):
            vm.write_asset(spark.createDataFrame(rows, "content binary"), str(tmp_path), "y", "binary")
    with pytest.raises(ValueError):
        vm.write_asset(got, str(tmp_path), "x", "xml")


def test_list_and_freshness(spark, tmp_path):
    items = tmp_path / "items"
    items.mkdir()
    for name in ("b.json", "a.json", "c.txt", "with space.json"):
        (items / name).write_text("{}")
    old = items / "b.json"
    os.utime(old, (old.stat().st_mtime - 3 * 86_400,) * 2)
    base = str(tmp_path)
    listed = vm.list_assets(spark, base, "items/*.json").collect()
    assert [r.name for r in listed][:2] == ["items/a.json", "items/b.json"] and len(listed) == 3
    assert {r.length for r in listed} == {2}
    assert vm.list_assets(spark, base, "none/*.json").isEmpty()
    fresh = [r.name for r in vm.fresh_assets(spark, base, "items/[ab].json", 2).collect()]
    assert fresh == ["items/a.json"]
    assert vm.fresh_assets(spark, base, "items/[ab].json").count() == 2
    exists = lambda n, **k: vm.asset_exists(spark, base, f"items/{n}", "json", **k)
    assert exists("b") and not exists("z")
    assert exists("b", max_age_days=4) and not exists("b", max_age_days=3)
    vm.delete_asset(spark, base, "items/a", "json")
    vm.delete_asset(spark, base, "items/a", "json")
    assert not exists("a")


def test_spark_written_assets_have_an_age(spark, tmp_path):
    vm.write_asset(spark.range(3), str(tmp_path), "r")
    assert vm.asset_exists(spark, str(tmp_path), "r", max_age_days=1)


def test_sql_over_assets(spark, tmp_path):
    vm.write_asset(spark.range(3), str(tmp_path), "one")
    vm.write_asset(spark.range(5), str(tmp_path), "two")
    vm.register_assets(spark, str(tmp_path), {"both": ["one", "two"], "single": "one"})
    assert spark.sql("select count(*) from both").first()[0] == 8
    assert vm.raw(spark, str(tmp_path), "two").count() == 5


def dates(df):
    return [r.date for r in df.collect()]


def test_calendars(spark):
    days = spark.createDataFrame([("2024-02-28",), ("2024-03-01",), ("2024-03-01",)], "date string")
    assert dates(vm.calendar(spark, "2024-02-28", "2024-03-01")) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert dates(vm.calendar(spark, "2024-03-02", "2024-03-01")) == []
    assert dates(vm.pending_dates(spark, "2024-02-27", "2024-03-02", days)) == [
        "2024-02-27", "2024-02-29", "2024-03-02",
    ]
    assert dates(vm.pending_dates(spark, "2024-03-02", "2024-03-01", days)) == []
    assert dates(vm.missing_dates(days)) == ["2024-02-29"]
    assert dates(vm.missing_dates(days, "2024-02-26", "2024-02-29")) == ["2024-02-26", "2024-02-27", "2024-02-29"]
    assert dates(vm.missing_dates(days, end="2024-03-02")) == ["2024-02-29", "2024-03-02"]
    assert dates(vm.missing_dates(days.where("false"))) == []
    assert vm.last_ingested(days).first().last_ingested == "2024-03-01"


def test_dimension_sync(spark):
    schema = "id string, title string, metadata map<string,string>, status string, reason string, node string"
    current = spark.createDataFrame(
        [
            ("kept", "Old", {"u": "1"}, "active", None, "n"),
            ("nostatus", "Old", None, None, "why", None),
            ("gone", "Gone", {"g": "1"}, None, None, "m"),
        ],
        schema,
    )
    upstream = spark.createDataFrame(
        [("kept", "New", None), ("nostatus", "New", {"u": "2"}), ("fresh", "Fresh", {"f": "1"})],
        "id string, title string, metadata map<string,string>",
    )
    synced = {r.id: tuple(r)[1:] for r in vm.sync_dimension(current, upstream).collect()}
    assert synced == {
        "kept": ("New", None, "active", None, "n"),
        "nostatus": ("New", {"u": "2"}, "disabled", "why", None),
        "gone": ("Gone", {"g": "1"}, None, None, "m"),
        "fresh": ("Fresh", {"f": "1"}, "disabled", "awaiting curation", None),
    }
    assert vm.sync_dimension(current, upstream).columns == current.columns
    changes = {r.id: r.change for r in vm.dimension_changes(current, upstream).collect()}
    assert changes == {"kept": "common", "nostatus": "common", "gone": "removed", "fresh": "new"}
    assert tuple(vm.change_counts(current, upstream).first()) == (3, 1, 1)
    first = vm.sync_dimension(current.where("false"), upstream)
    assert {r.status for r in first.collect()} == {"disabled"}


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (scratch_folder(spark, "x") for _ in range(2))
    assert first.startswith(f"{shared}/viewmart/x-") and first != second


def test_files_of_single_rows_are_written_by_their_tasks(spark, tmp_path, monkeypatch):
    def one_value(*_):
        raise AssertionError("a value passed through the driver")

    monkeypatch.setattr("viewmart.sources.assets.storage.write_bytes", one_value)
    rows = [(f"f{k}", bytes([k % 256, 10, 0]) * k) for k in range(1, 51)]
    frame = spark.createDataFrame(rows, "name string, content binary").repartition(4)
    for _ in range(2):  # the second write replaces the first
        vm.write_files(frame, str(tmp_path), "many")
        got = vm.read_asset(spark, str(tmp_path), "many", "binary").collect()
        assert sorted((r.path.rsplit("/", 1)[1], bytes(r.content)) for r in got) == sorted(rows)
    assert QUERIES["asset_document"](spark, "/root/testdata/sf0.001").count() and QUERIES["asset_binary"](spark, "/root/testdata/sf0.001").count() == 40
    with pytest.raises(ValueError, match="not unique"):
        vm.write_files(frame.withColumn("name", F.lit("same")), str(tmp_path), "twice")
    with pytest.raises(ValueError, match="mounted"):
        vm.write_files(frame, "hdfs://host/x", "far")


def test_a_failed_write_of_files_leaves_the_old_ones(spark, tmp_path):
    base = str(tmp_path)
    good = spark.createDataFrame([("a", b"1"), ("b", b"2")], "name string, content binary")
    vm.write_files(good, base, "set")
    for rows in ([("a", b"3"), ("a", b"4")], [("c", b"5"), (None, b"6")]):
        with pytest.raises(Exception):  # noqa: B017
            vm.write_files(spark.createDataFrame(rows, "name string, content binary"), base, "set")
        found = vm.read_asset(spark, base, "set", "binary").select("content").collect()
        assert sorted(bytes(r.content) for r in found) == [b"1", b"2"]
    vm.write_files(good.where("name = 'b'"), base, "set")
    assert vm.read_asset(spark, base, "set", "binary").count() == 1
    assert [x.name for x in tmp_path.iterdir()] == ["set.bin"]
