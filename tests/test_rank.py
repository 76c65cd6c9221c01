"""Ranking and reports against plain Python on small facts."""

from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import viewmart as vm
from viewmart.operators import rank

FACT = "date string, entity string, page_id string, views bigint"


def facts_of(spark, rows):
    return spark.createDataFrame(rows, FACT)


def brute_top(rows, n):
    totals, last = defaultdict(int), {}
    for date, entity, page, views in rows:
        totals[page] += views
        last.setdefault(page, None)
        if entity is not None and (last[page] is None or (date, entity) > last[page]):
            last[page] = (date, entity)
    ranked = sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:n]
    return [(page, last[page] and last[page][1], total) for page, total in ranked]


def brute_periods(rows, n, length):
    top = {page: title for page, title, _ in brute_top(rows, n)}
    sums = defaultdict(int)
    for date, _, page, views in rows:
        if page in top:
            sums[page, date[:length]] += views
    return [(period, page, top[page], v) for (page, period), v in sorted(sums.items())]


ROWS = st.lists(
    st.tuples(
        st.sampled_from(["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02", "2024-03-01"]),
        st.one_of(st.none(), st.sampled_from("ABC")),
        st.sampled_from(["9", "10", "11", "2"]),
        st.integers(0, 5),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=6, deadline=None)
@given(ROWS, st.integers(1, 5))
def test_ranking_like_python(spark, rows, n):
    facts = facts_of(spark, rows)
    assert [tuple(r) for r in vm.top_pages(facts, n).collect()] == brute_top(rows, n)
    totals = [tuple(r) for r in vm.page_totals(facts).collect()]
    assert sorted(totals) == sorted(brute_top(rows, 99))
    monthly = vm.top_pages_monthly(facts, n)
    assert monthly.columns == ["month", "page_id", "entity", "views"]
    assert [tuple(r) for r in monthly.collect()] == brute_periods(rows, n, 7)
    window = [r for r in rows if "2024-01-31" <= r[0] <= "2024-02-02"]
    daily = vm.top_pages_daily(facts, "2024-02-02", 3, n, aggregate=True, allow_gaps=True)
    assert [tuple(r) for r in daily.collect()] == brute_periods(window, n, 10)
    top = {page: title for page, title, _ in brute_top(window, n)}
    single = vm.top_pages_daily(facts, "2024-02-02", 3, n, allow_gaps=True)
    assert single.columns == ["date", "page_id", "entity", "views"]
    got = [tuple(r) for r in single.collect()]
    assert sorted(got, key=repr) == sorted(
        ((d, p, top[p], v) for d, _, p, v in window if p in top), key=repr
    )
    assert [r[1::-1] for r in got] == sorted(r[1::-1] for r in got)


@settings(max_examples=5, deadline=None)
@given(ROWS, st.integers(1, 5))
def test_every_join_and_cut_gives_the_same(spark, rows, n):
    facts = facts_of(spark, rows)
    expected = [tuple(r) for r in vm.top_pages_monthly(facts, n).collect()]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(rank, "BROADCAST_ROWS", 0)
        assert [tuple(r) for r in vm.top_pages_monthly(facts, n).collect()] == expected
        assert [tuple(r) for r in vm.top_pages(facts, n).collect()] == brute_top(rows, n)


TOTALS = st.one_of(
    st.none(), st.integers(-3, 40), st.integers(-(2**63), 2**63 - 1), st.just(2**62), st.just(2**62 + 1)
)


@settings(max_examples=15, deadline=None)
@given(st.lists(TOTALS, max_size=60), st.integers(1, 70))
def test_histogram_cut_is_exact(spark, totals, n):
    df = spark.createDataFrame([(f"{i:03d}", v) for i, v in enumerate(totals)], "id string, v bigint")
    got = [r.id for r in vm.top_rows(df, n, "v", "id").collect()]
    order = sorted(enumerate(totals), key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    assert got == [f"{i:03d}" for i, _ in order[:n]]


NUMBERS = st.one_of(
    st.none(),
    st.floats(),
    st.floats(-1, 1),
    st.sampled_from([0.5, 0.25, -0.5, 0.0, -0.0, 5e-324, float("inf"), float("-inf"), float("nan")]),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(NUMBERS, max_size=60), st.integers(0, 70))
def test_any_double_is_ranked_exactly(spark, values, n):
    """NULL last and NaN first, as Spark sorts; fractions, negatives and infinities in between."""
    df = spark.createDataFrame([(f"{i:03d}", v) for i, v in enumerate(values)], "id string, v double")
    got = [r.id for r in vm.top_rows(df, n, "v", "id").collect()]

    def place(x):
        i, v = x
        nan = v is not None and v != v
        return v is None, not nan, 0 if v is None or nan else -v, i

    assert got == [f"{i:03d}" for i, _ in sorted(enumerate(values), key=place)[:n]]


def test_many_equal_fractions_and_decimals(spark):
    half = spark.range(2000).select(F.format_string("%05d", "id").alias("id"), F.lit(0.5).alias("v"))
    zero = spark.range(3000).select(F.format_string("z%05d", "id").alias("id"), F.lit(0.0).alias("v"))
    assert vm.top_rows(half, 5000, "v", "id").count() == 2000
    top = vm.top_rows(half.union(zero), 1500, "v", "id")
    assert [r.id for r in top.collect()] == [f"{i:05d}" for i in range(1500)]
    exact = half.select("id", (F.col("id").cast("decimal(20,0)") / 10**12).cast("decimal(30,18)").alias("v"))
    assert [r.id for r in vm.top_rows(exact, 3, "v", "id").collect()] == ["01999", "01998", "01997"]


def test_rows_above_the_cut_stay_in_their_tasks(spark):
    """One task gets rows of the last step only."""
    df = spark.range(100_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    plan = plan_of(vm.top_rows(df, 50_000, "v", "k"))
    assert "Union" in plan and "rangepartitioning" in plan


def test_steps_never_fall(spark):
    values = [*range(-5, 5000), *(2**k + d for k in range(12, 63) for d in (-1, 0, 1)), 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in sorted(set(values))], "v bigint")
    steps = [r.s for r in df.select(rank._step(F.col("v")).alias("s"), "v").orderBy("v").collect()]
    assert steps == sorted(steps)
    assert len(set(steps)) > 300


def test_ties_and_renames(spark):
    rows = [
        ("2024-01-01", "Old", "9", 5),
        ("2024-01-02", "New", "9", 5),
        ("2024-01-02", "Newer", "9", 0),
        ("2024-01-03", None, "9", 0),
        ("2024-01-01", "Ten", "10", 10),
        ("2024-01-01", None, "8", 1),
    ]
    top = [tuple(r) for r in vm.top_pages(facts_of(spark, rows), 3).collect()]
    assert top == [("10", "Ten", 10), ("9", "Newer", 10), ("8", None, 1)]


def test_a_null_page_ranks_but_never_joins(spark):
    rows = [("2024-01-01", "None", None, 50), ("2024-01-01", "A", "1", 5), ("2024-01-01", "B", "2", 3)]
    facts = facts_of(spark, rows)
    assert [tuple(r) for r in vm.top_pages(facts, 2).collect()] == [(None, "None", 50), ("1", "A", 5)]
    assert [tuple(r) for r in vm.top_pages_monthly(facts, 2).collect()] == [("2024-01", "1", "A", 5)]


def test_sums_fail_on_overflow(spark):
    rows = [("2024-01-01", "A", "1", 2**62), ("2024-01-01", "A", "1", 2**62)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="beyond BIGINT"):
                vm.page_sums(facts_of(spark, rows)).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    nothing = facts_of(spark, [("2024-01-01", "A", "1", None)])
    assert vm.page_sums(nothing).first().total_views is None


def test_restrict_and_monthly(spark):
    facts = facts_of(spark, [("2024-01-01", "Old", "1", 2), ("2024-01-05", "Old", "1", 3), ("2024-01-01", "X", "2", 1)])
    top = spark.createDataFrame([("1", "New")], "page_id string, entity string")
    kept = vm.restrict_to_top(facts, top)
    assert sorted(tuple(r) for r in kept.collect()) == [("2024-01-01", "1", "New", 2), ("2024-01-05", "1", "New", 3)]
    assert [tuple(r) for r in vm.monthly_views(kept).collect()] == [("2024-01", "1", "New", 5)]


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def stored_facts(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).cast("string").alias("date"),
        F.concat(F.lit("T"), F.col("id") % 7).alias("entity"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 3000).cast("string")).alias("page_id"),
        F.lit(1).cast("bigint").alias("views"),
    )
    vm.write_facts(rows, str(tmp_path / "facts"))
    return vm.read_facts(spark, str(tmp_path / "facts"))


def test_monthly_plan(stored_facts):
    """Ranking reads two columns; facts meet the ranking by broadcast, not by shuffle."""
    df = vm.top_pages_monthly(stored_facts, 50)
    plan = plan_of(df)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<page_id:string,views:bigint>" in df._jdf.queryExecution().sparkPlan().toString()


def test_daily_plan(stored_facts):
    plan = plan_of(vm.top_pages_daily(stored_facts, "2024-02-29", 7, 50))
    assert "SortMergeJoin" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("date#" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_cut_reuses_the_totals(stored_facts):
    """The histogram and the ranking share one shuffle of the totals."""
    plan = plan_of(vm.top_pages_monthly(stored_facts, 1500))
    assert "ReusedExchange" in plan


def test_many_pages_are_summed_before_the_join(stored_facts, monkeypatch):
    monkeypatch.setattr(rank, "BROADCAST_ROWS", 10)
    df = vm.top_pages_monthly(stored_facts, 20)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "Aggregate [page_id" in plan[join:]
    assert len(df.collect()) == 21


def test_hot_page_is_combined_before_the_shuffle(spark, stored_facts):
    """A page with a third of all facts leaves each task as one row per month."""
    df = vm.top_pages_monthly(stored_facts, 5)
    rows = [r for r in df.collect() if r.page_id == "hot"]
    assert sum(r.views for r in rows) == 6667 and len(rows) == 2
