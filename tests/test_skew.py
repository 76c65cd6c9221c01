"""A value that holds a third of all rows is split over tasks, and results stay whole."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.operators import rank


@contextmanager
def settings(spark, **values):
    """Set Spark SQL options (``__`` for a dot) and put the old values back."""
    old = {}
    for key, value in values.items():
        name = "spark.sql." + key.replace("__", ".")
        old[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SMALL = dict(
    autoBroadcastJoinThreshold="-1",
    adaptive__autoBroadcastJoinThreshold="-1",
    adaptive__advisoryPartitionSizeInBytes="64KB",
    adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
    adaptive__skewJoin__skewedPartitionFactor="2",
)


@pytest.fixture
def facts(spark, tmp_path):
    """90,000 facts in several files; page ``hot`` and day 2024-01-01 hold a third each."""
    rows = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 1, "2024-01-01")
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        .alias("date"),
        F.concat(F.lit("Title "), F.xxhash64("id")).alias("entity"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("page_id"),
        (F.col("id") % 7).alias("views"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def final_plan(df):
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return rows, plan.split("== Initial Plan ==")[0]


def test_hot_day_is_written_as_several_files(spark, facts, tmp_path):
    path = str(tmp_path / "facts")
    with settings(spark, **SMALL | {"adaptive__advisoryPartitionSizeInBytes": "512KB"}):
        vm.write_facts(facts, path)
    files = (
        spark.read.parquet(path)
        .select(F.col("date").cast("string").alias("date"), "_metadata.file_path")
        .distinct()
        .groupBy("date")
        .agg(F.count("*").alias("files"))
    )
    by_day = {r.date: r.files for r in files.collect()}
    # Days that share the hot day's shuffle partition are split with it, the others are not.
    assert by_day.pop("2024-01-01") > 3
    assert sum(files == 1 for files in by_day.values()) > 14
    assert vm.read_facts(spark, path).exceptAll(facts.select("date", "entity", "page_id", "views")).isEmpty()
    assert vm.read_facts(spark, path).count() == 90_000


def test_merge_splits_a_hot_target_key(spark, facts):
    target = facts.select(F.col("page_id").alias("k"), "entity", "views")
    pages = facts.groupBy(F.col("page_id").alias("k")).agg(F.lit(-1).cast("bigint").alias("views"))
    source = pages.unionByName(spark.range(5).select(F.concat(F.lit("new"), "id").alias("k"), F.lit(-2).cast("bigint").alias("views")))
    with settings(spark, **SMALL):
        rows, plan = final_plan(vm.merge_rows(target, source, "k"))
    assert "skew=true" in plan
    assert len(rows) == 90_005
    assert {r.views for r in rows} == {-1, -2} and sum(r.k == "hot" for r in rows) == 30_000


def test_daily_rows_of_a_hot_page_are_whole_under_a_shuffled_join(spark, facts, monkeypatch):
    monkeypatch.setattr(rank, "BROADCAST_ROWS", 0)
    with settings(spark, **SMALL):
        rows, plan = final_plan(vm.top_pages_daily(facts, "2024-02-28", 60, 2, allow_gaps=True))
    hot = [r for r in rows if r.page_id == "hot"]
    assert len(hot) == 30_000 and len({r.entity for r in hot}) == 1


@pytest.fixture
def equal_facts(spark, tmp_path):
    """120,000 facts; a third of all rows are one and the same fact."""
    rows = spark.range(0, 120_000, 1, 8).select(
        F.lit("2024-02-01").alias("date"),
        F.lit("T").alias("entity"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias("page_id"),
        F.lit(1).cast("bigint").alias("views"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def test_equal_facts_of_a_hot_page_spread_over_tasks(spark, equal_facts):
    titles = equal_facts.groupBy("page_id").agg(F.max("entity").alias("entity"))
    small = SMALL | {"adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB", "adaptive__advisoryPartitionSizeInBytes": "1KB"}
    with settings(spark, **small, adaptive__coalescePartitions__enabled="false"):
        joined = vm.restrict_to_top(equal_facts, titles).where("page_id = 'hot'")
        joined = joined.withColumn("task", F.spark_partition_id())
        per_task = {}
        for row in joined.collect():
            per_task[row.task] = per_task.get(row.task, 0) + 1
    assert len(per_task) >= 6 and sum(per_task.values()) == 40_000


def test_equal_facts_are_sorted_as_one_row(spark, equal_facts, monkeypatch):
    for bound in (rank.BROADCAST_ROWS, 0):
        monkeypatch.setattr(rank, "BROADCAST_ROWS", bound)
        df = vm.top_pages_daily(equal_facts, "2024-02-01", 1, 2)
        rows, _ = final_plan(df)
        assert [r.page_id for r in rows] == ["hot"] * 40_000 + ["p1"]
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode(array_repeat") < plan.index("Sort [page_id")


def test_copies_are_repeated_exactly(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2500), ("c", 1000), ("d", 0)], "k string, n bigint")
    got = {r.k: r["count"] for r in rank.repeated(counts, "n").groupBy("k").count().collect()}
    assert got == {"a": 1, "b": 2500, "c": 1000}


def test_top_pages_beyond_the_broadcast_bound(spark, facts, monkeypatch):
    expected = vm.top_pages(facts, 50).collect()
    monkeypatch.setattr(rank, "BROADCAST_ROWS", 0)
    assert vm.top_pages(facts, 50).collect() == expected


def test_totals_of_a_hot_page_shuffle_one_row_per_task(spark, facts):
    """Each of the tasks sends its sum of the page: far fewer rows than it has facts."""
    hot = facts.where("page_id = 'hot'")
    df = vm.page_sums(hot)
    (row,), _ = final_plan(df)
    expected = sum(i % 7 for i in range(0, 90_000, 3))
    assert row.total_views == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_try_sum" in plan or "partial_sum" in plan
