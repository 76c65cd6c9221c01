"""Sums kept up to date against the facts they stand for."""

import random
import re

import pytest

import viewmart as vm
from viewmart.functions.storage import delete
from viewmart.plans.rollups import Refresh, WindowUpdate
from viewmart.sources.facts import FACT


def day(k):
    return f"2024-{1 + k // 28:02d}-{1 + k % 28:02d}"


def some_facts(rng, date, n=30):
    titles = ["old", "new", "other", None]
    return [
        (date, rng.choice(titles), rng.choice(["1", "2", "3", "10", "11", None]), rng.choice([0, 1, 5, -3, None]))
        for _ in range(n)
    ]


def store(spark, path, rows, source="batch"):
    vm.write_facts(spark.createDataFrame(rows, FACT), path, source=source)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def same_as_facts(spark, path, root, n):
    facts = vm.read_facts(spark, path)
    sums = vm.read_month_sums(spark, root)
    columns = ["page_id", "entity", "total_views"]
    assert rows_of(vm.totals_from_sums(sums).select(columns)) == rows_of(vm.page_totals(facts).select(columns))
    assert vm.monthly_from_sums(sums, n).collect() == vm.top_pages_monthly(facts, n).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_follow_loads_replacements_and_deletions(spark, tmp_path, seed):
    rng, path, root = random.Random(seed), f"{tmp_path}/facts", str(tmp_path)
    first = sorted(rng.sample(range(100), 6))
    store(spark, path, [r for k in first for r in some_facts(rng, day(k))])
    assert vm.refresh_sums(spark, path, root) == Refresh(tuple(day(k) for k in first))
    assert vm.refresh_sums(spark, path, root) == Refresh()
    same_as_facts(spark, path, root, 3)
    again, late, gone = day(first[0]), day(101), day(first[-1])
    store(spark, path, some_facts(rng, again))
    store(spark, path, some_facts(rng, day(first[1])), source="second file")
    store(spark, path, some_facts(rng, late))
    delete(spark, f"{path}/date={gone}")
    done = vm.refresh_sums(spark, path, root)
    assert done == Refresh(tuple(sorted([again, day(first[1]), late])), (gone,))
    same_as_facts(spark, path, root, 4)
    assert not any(gone in f for f in vm.read_day_sums(spark, root).inputFiles())


def test_facts_without_a_day(spark, tmp_path):
    path, root = f"{tmp_path}/facts", str(tmp_path)
    store(spark, path, [(None, "a", "1", 2), ("2024-01-01", "b", "1", 3), ("2024-01-01", None, "2", 0)])
    assert vm.refresh_sums(spark, path, root) == Refresh(("2024-01-01", None))
    same_as_facts(spark, path, root, 5)
    store(spark, path, [(None, "a", "1", 4)])
    assert vm.refresh_sums(spark, path, root) == Refresh((None,))
    same_as_facts(spark, path, root, 5)


def test_the_report_reads_no_fact(spark, tmp_path):
    path, root = f"{tmp_path}/facts", str(tmp_path)
    rng = random.Random(5)
    store(spark, path, [r for k in range(3) for r in some_facts(rng, day(k))])
    vm.refresh_sums(spark, path, root)
    report = vm.monthly_from_sums(vm.read_month_sums(spark, root), 3)
    assert report.inputFiles() and all("/month_sums/" in f for f in report.inputFiles())


def window_of(spark, path, last, days):
    facts = vm.read_recent(vm.read_facts(spark, path), last, days, allow_gaps=True)
    return rows_of(vm.page_totals(facts).select("page_id", "entity", "total_views"))


def test_a_window_moves_by_difference(spark, tmp_path):
    rng, path, root = random.Random(8), f"{tmp_path}/facts", str(tmp_path)
    rows = [r for k in range(12) if k != 5 for r in some_facts(rng, day(k), 12)]
    rows += [(day(2), "only here", "97", 7), (day(2), "titled", "99", 7), (day(3), None, "99", 1), (day(3), "t", "98", 4), (day(6), None, "98", -4)]
    rows += [(day(2), "t", "96", 6), (day(3), "u", "96", None)]
    store(spark, path, rows)
    vm.refresh_sums(spark, path, root)
    assert vm.update_window(spark, root, day(6), 5).how == "summed"
    assert rows_of(vm.read_window(spark, root)) == window_of(spark, path, day(6), 5)
    assert vm.update_window(spark, root, day(6), 5) == WindowUpdate("same")
    assert vm.update_window(spark, root, day(7), 5) == WindowUpdate("moved", (day(7),), (day(2),))
    assert rows_of(vm.read_window(spark, root)) == window_of(spark, path, day(7), 5)
    titles = {r.page_id: r.entity for r in vm.read_window(spark, root).collect()}
    assert "97" not in titles and titles["99"] is None and titles["98"] == "t"
    assert vm.update_window(spark, root, day(6), 5).how == "summed"  # back
    assert rows_of(vm.read_window(spark, root)) == window_of(spark, path, day(6), 5)
    store(spark, path, some_facts(rng, day(4)))  # stays in the window, so its difference is unknown
    vm.refresh_sums(spark, path, root)
    assert vm.update_window(spark, root, day(7), 5).how == "summed"
    assert rows_of(vm.read_window(spark, root)) == window_of(spark, path, day(7), 5)
    store(spark, path, some_facts(rng, day(4)))  # leaves the window, but what it was is gone
    vm.refresh_sums(spark, path, root)
    assert vm.update_window(spark, root, day(9), 5).how == "summed"
    assert rows_of(vm.read_window(spark, root)) == window_of(spark, path, day(9), 5)
    assert vm.update_window(spark, root, day(60), 5).how == "summed"
    assert vm.read_window(spark, root).count() == 0
    assert vm.update_window(spark, root, day(11), 3).how == "summed"
    assert rows_of(vm.read_window(spark, root)) == window_of(spark, path, day(11), 3)


def test_a_moved_window_reads_two_days(spark, tmp_path, monkeypatch):
    from viewmart.plans import rollups

    rng, path, root = random.Random(9), f"{tmp_path}/facts", str(tmp_path)
    store(spark, path, [r for k in range(9) for r in some_facts(rng, day(k), 5)])
    vm.refresh_sums(spark, path, root)
    vm.update_window(spark, root, day(7), 6)
    plans = []

    def watched(frame, *args, **kwargs):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return original(frame, *args, **kwargs)

    original = rollups.overwrite
    monkeypatch.setattr(rollups, "overwrite", watched)
    assert vm.update_window(spark, root, day(8), 6).how == "moved"
    scans = re.findall(r"PartitionFilters: \[[^]]*date#\d+ = ([0-9-]+)", plans[0])
    assert sorted(scans) == [day(2), day(8)]


def test_reports_from_totals_equal_those_from_facts(spark, tmp_path):
    rng, path, root = random.Random(4), f"{tmp_path}/facts", str(tmp_path)
    store(spark, path, [r for k in range(8) for r in some_facts(rng, day(k))])
    vm.refresh_sums(spark, path, root)
    vm.update_window(spark, root, day(7), 4)
    facts, totals = vm.read_facts(spark, path), vm.read_window(spark, root)
    for aggregate in (False, True):
        plain = vm.top_pages_daily(facts, day(7), 4, 3, aggregate=aggregate)
        kept = vm.top_pages_daily(facts, day(7), 4, 3, aggregate=aggregate, totals=totals)
        assert rows_of(plain) == rows_of(kept)
