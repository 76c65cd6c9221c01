"""The Bloom filter that thins facts before their shuffle."""

import viewmart as vm
from viewmart.operators.bloom import MOST_BITS, filter_bits, thinned
from viewmart.sources.facts import FACT


def test_no_value_is_lost_and_few_others_stay(spark):
    values = spark.range(0, 40_000, 2).selectExpr("cast(id as string) as x")
    rows = spark.range(40_000).selectExpr("cast(id as string) as x", "id")
    kept = {r.id for r in thinned(rows, "x", values, 20_000).collect()}
    assert set(range(0, 40_000, 2)) <= kept and len(kept) < 20_400
    # far more values than said make it useless, not wrong
    assert thinned(rows, "x", values, 10).where("id % 2 = 0").count() == 20_000
    assert thinned(rows, "x", values.limit(0), 10).count() == 0
    assert filter_bits(1) == 64 and filter_bits(10**12) == MOST_BITS


def test_facts_are_thinned_below_the_exchange(spark):
    rows = [(f"2024-01-{1 + k % 28:02d}", "t", str(k % 500), 500 - k % 500) for k in range(5000)]
    facts = spark.createDataFrame(rows + [("2024-01-01", None, None, 1)], FACT)
    top = spark.createDataFrame([(r.page_id, r.entity) for r in vm.top_pages(facts, 20).collect()], "page_id string, entity string")
    plain = vm.restrict_to_top(facts, top)
    thin = vm.restrict_to_top(facts, top.hint("merge"), pages_rows=20)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, thin.collect()))
    plan = thin._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    joined = plan[plan.index("SortMergeJoin") :]
    assert joined.index("Exchange hashpartitioning(page_id") < joined.index("getbit(")
