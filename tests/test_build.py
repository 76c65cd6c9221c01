"""The gate and the build of both reports."""

import pytest

import viewmart as vm
from viewmart.plans.reports import STATE

FACT = "date string, entity string, page_id string, views bigint"


def facts_until(spark, last):
    rows = [(f"2024-01-{d:02d}", f"T{p}", str(p), d * p) for d in range(1, last + 1) for p in range(1, 6)]
    return spark.createDataFrame(rows, FACT)


def test_gate(spark):
    facts = facts_until(spark, 10)
    gate = lambda *a: tuple(vm.needs_build(facts, *a).first())
    assert gate("2024-01-11") == ("2024-01-10", 0, True, "new data")
    assert gate("2024-01-11", "2024-01-09") == ("2024-01-10", 0, True, "new data")
    assert gate("2024-01-11", "2024-01-10") == ("2024-01-10", 0, False, "up to date")
    assert gate("2024-01-13", "2024-01-09") == ("2024-01-10", 2, False, "behind")
    assert gate("2024-01-05") == ("2024-01-10", 0, True, "new data")
    nothing = vm.needs_build(facts.where("false"), "2024-01-11").first()
    assert (nothing.last_ingested, nothing.build, nothing.reason) == (None, False, "no data")


def test_build_stores_both_reports_once_per_day_of_data(spark, tmp_path):
    root = str(tmp_path)
    args = dict(top_monthly=3, top_daily=2, window_days=4, min_rows=1)
    late = vm.build_all(facts_until(spark, 10), root, today="2024-01-13", **args)
    assert late.reason == "behind" and not vm.table_exists(spark, root, "top_pages_monthly")

    done = vm.build_all(facts_until(spark, 10), root, today="2024-01-11", **args)
    assert (done.reason, done.monthly.rows, done.daily.rows) == ("new data", 3, 8)
    monthly = vm.read_table(spark, root, "top_pages_monthly")
    assert sorted(tuple(r) for r in monthly.collect()) == [
        ("2024-01", str(p), f"T{p}", 55 * p) for p in (3, 4, 5)
    ]
    daily = vm.read_table(spark, root, "top_pages_daily_recent").collect()
    assert {r.date for r in daily} == {f"2024-01-{d:02d}" for d in (7, 8, 9, 10)}

    again = vm.build_all(facts_until(spark, 10), root, today="2024-01-11", **args)
    assert again.reason == "up to date" and again.monthly is None
    more = vm.build_all(facts_until(spark, 11), root, today="2024-01-12", **args)
    assert more.monthly.version == 2 and more.daily.version == 2


def test_a_failed_check_stores_nothing(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(AssertionError, match="min_rows"):
        vm.build_all(facts_until(spark, 10), root, today="2024-01-11", window_days=4)
    for name in ("top_pages_monthly", "top_pages_daily_recent", STATE):
        assert not vm.table_exists(spark, root, name)


def test_a_gap_in_the_window(spark, tmp_path):
    root = str(tmp_path)
    facts = facts_until(spark, 10).where("date <> '2024-01-08'")
    args = dict(today="2024-01-11", top_monthly=3, top_daily=2, window_days=4, min_rows=1)
    with pytest.raises(ValueError, match="2024-01-08"):
        vm.build_all(facts, root, **args)
    assert not vm.table_exists(spark, root, STATE)
    done = vm.build_all(facts, root, allow_gaps=True, **args)
    assert done.missing == ("2024-01-08",) and done.daily.rows == 6


def test_recent_facts_want_every_day(spark, tmp_path):
    facts = facts_until(spark, 10).where("date <> '2024-01-08'")
    with pytest.raises(ValueError, match="2024-01-08"):
        vm.read_recent(facts, "2024-01-10", 4)
    assert vm.read_recent(facts, "2024-01-10", 4, allow_gaps=True).count() == 15
    assert vm.read_recent(facts, "2024-01-10", 2).count() == 10
    path = str(tmp_path / "facts")
    vm.write_facts(facts, path)
    days = vm.read_days(spark, path)
    assert sorted(r.date for r in days.collect()) == [f"2024-01-{d:02d}" for d in range(1, 11) if d != 8]
    with pytest.raises(ValueError, match="2024-01-08"):
        vm.read_recent(vm.read_facts(spark, path), "2024-01-10", 4, present=days)


def test_the_gate_reads_no_fact(spark, tmp_path):
    """Gate, gaps and last day of a stored table come from its folders."""
    path = str(tmp_path / "facts")
    vm.write_facts(facts_until(spark, 10), path)
    days = vm.read_days(spark, path)
    for frame in (vm.last_ingested(days), vm.missing_dates(days), vm.needs_build(days, "2024-01-11")):
        assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString()
    assert vm.last_ingested(days).first().last_ingested == "2024-01-10"
    root = str(tmp_path / "tables")
    done = vm.build_all(
        vm.read_facts(spark, path), root, today="2024-01-11", days=days, window_days=4, min_rows=1
    )
    assert done.reason == "new data" and done.missing == ()
