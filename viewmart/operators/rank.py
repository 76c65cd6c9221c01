"""Totals, latest titles, exact top-n and views per period over daily facts.

Facts are ``date, entity, page_id, views``, the dates as text. A page may change its
title (``entity``); the latest one is the title of its last day, the greatest title
where that day has several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewmart.functions.text import month_of
from viewmart.operators.bloom import thinned

# A ranking is broadcast only if its limit proves it has at most this many rows of one
# id and one title. Beyond it, facts are summed before they meet the ranking.
BROADCAST_ROWS = 200_000

# Steps per power of two in the histogram of a metric; the step of the least positive
# double is 1, those of negative values mirror the positive ones.
STEPS = 32
OFFSET = 1075 * STEPS
INFINITE, NOT_A_NUMBER, NOTHING = 2101 * STEPS, 2102 * STEPS, -2102 * STEPS

# Copies of a row that one explode makes at once.
COPIES = 1_000


def total(column: str) -> Column:
    """Aggregate: the BIGINT sum; fails on overflow whatever the ANSI mode."""
    summed = F.try_sum(column)
    overflow = F.raise_error(F.lit(f"the sum of {column} is beyond BIGINT")).cast("bigint")
    return F.when(summed.isNull() & (F.count(column) > 0), overflow).otherwise(summed)


def page_sums(facts: DataFrame) -> DataFrame:
    """``page_id, total_views``. Reads two columns; summed per task before the shuffle."""
    return facts.groupBy("page_id").agg(total("views").alias("total_views"))


def latest() -> Column:
    """Aggregate: the last ``struct(date, entity)`` that has both.

    Kept per task before the shuffle, so a page with many facts and titles leaves each
    task as one row.
    """
    both = F.col("date").isNotNull() & F.col("entity").isNotNull()
    return F.max(F.when(both, F.struct("date", "entity")))


def page_totals(facts: DataFrame) -> DataFrame:
    """``page_id, entity, total_views`` for every page, with its latest title."""
    return facts.groupBy("page_id").agg(
        latest()["entity"].alias("entity"), total("views").alias("total_views")
    )


def _step(metric: Column) -> Column:
    """Histogram step of a number; never falls as the number grows.

    NULL is least and NaN greatest, as in descending order with NULL last. A value's step follows its double,
    so equal steps may hold different values but never the wrong way round.
    """
    value = metric.cast("double")
    size = F.abs(value)
    step = F.when(size == float("inf"), INFINITE).otherwise(F.floor(F.log2(size) * STEPS) + OFFSET)
    signed = F.when(F.isnan(value), NOT_A_NUMBER).when(value > 0, step).when(value < 0, -step)
    return F.when(value.isNull(), NOTHING).otherwise(F.coalesce(signed, F.lit(0))).cast("bigint")


def top_rows(df: DataFrame, n: int, metric: str, tie: str) -> DataFrame:
    """The ``n`` rows with the greatest ``metric`` (a number, NULL last), ties by ascending ``tie``,
    in this order.

    A histogram of the metric finds the step in which the result ends. Rows of higher steps are
    all in the result and stay spread over their tasks; only rows of that step are ranked, and at
    most ``n`` of them meet in one task.
    """
    order = [F.col(metric).desc_nulls_last(), F.col(tie).asc_nulls_last()]
    if n < 1:
        return df.limit(0)
    step = _step(F.col(metric))
    counts = df.groupBy(step.alias("step")).agg(F.count("*").alias("rows"))
    # One row per step: the unpartitioned window sees some 135,000 rows at most.
    reached = counts.withColumn("reached", F.sum("rows").over(Window.orderBy(F.desc("step"))))
    ends = reached.where(F.col("reached") >= n)
    last = F.coalesce(ends.agg(F.max("step")).scalar(), F.lit(NOTHING - 1))
    left = ends.agg(F.max_by(n - F.col("reached") + F.col("rows"), "step")).scalar()
    ranked = df.where(step == last).orderBy(*order).limit(n)
    ranked = ranked.withColumn("__rank", F.row_number().over(Window.orderBy(*order)))
    chosen = ranked.where(F.col("__rank") <= left).drop("__rank")
    return df.where(step > last).union(chosen).orderBy(*order)


def is_small(rows: int | None) -> bool:
    """True if a bound on the rows of a ranking is known and allows a broadcast."""
    return rows is not None and rows <= BROADCAST_ROWS


def repeated(rows: DataFrame, count: str) -> DataFrame:
    """Each row as often as its column ``count`` says, without that column.

    A count is taken apart first, so no row makes a long array.
    """
    whole = F.floor(F.col(count) / COPIES).cast("int")
    parts = F.concat(
        F.array_repeat(F.lit(COPIES), whole),
        F.array((F.col(count) - whole * F.lit(COPIES).cast("bigint")).cast("int")),
    )
    columns = [c for c in rows.columns if c != count]
    apart = rows.select(*columns, F.explode(parts).alias(count))
    return apart.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col(count))).alias(count)).drop(count)


def top_ids(facts: DataFrame, n: int) -> DataFrame:
    """``page_id, total_views`` of the ``n`` pages with the most views."""
    return top_rows(page_sums(facts), n, "total_views", "page_id")


def top_pages(facts: DataFrame, n: int) -> DataFrame:
    """``page_id, entity, total_views`` of the ``n`` pages with the most views, in order.

    Ranks on ids alone, then looks up titles for the ranked pages only.
    """
    if is_small(n):
        ranked = F.broadcast(top_ids(facts, n).withColumnRenamed("page_id", "ranked_id"))
        found = facts.join(ranked, F.col("page_id").eqNullSafe(F.col("ranked_id")))
        titled = found.groupBy("page_id", "total_views").agg(latest()["entity"].alias("entity"))
    else:
        titled = top_rows(page_totals(facts), n, "total_views", "page_id")
    return titled.select("page_id", "entity", "total_views").orderBy(
        F.col("total_views").desc_nulls_last(), F.col("page_id").asc_nulls_last()
    )


def own_exchange(ranking: DataFrame) -> DataFrame:
    """The ranking with its page ids made anew.

    A ranking that comes out of an aggregation by page is laid out for a join already, and AQE splits hot pages of
    the other side only where both sides are shuffled for the join itself.
    """
    return ranking.withColumn("page_id", F.concat("page_id", F.lit("")))


def restrict_to_top(facts: DataFrame, top: DataFrame, *, pages_rows: int | None = None) -> DataFrame:
    """Facts of the pages in ``top`` (``page_id, entity``), under the title given there.

    A plain join: Spark broadcasts ``top`` if its size allows it, and AQE splits a page with very
    many facts otherwise, equal facts included. ``pages_rows``, about how many pages ``top`` has, lets
    a Bloom filter of their ids drop most other facts before that shuffle; ``top`` is read once more for it.
    """
    titles = top.select("page_id", F.col("entity").alias("title"))
    if pages_rows is not None:
        facts = thinned(facts, "page_id", top, pages_rows)
    return facts.join(own_exchange(titles), "page_id").select(
        "date", "page_id", F.col("title").alias("entity"), "views"
    )


def with_month(facts: DataFrame) -> DataFrame:
    return facts.withColumn("month", month_of(F.col("date")))


def monthly_views(facts: DataFrame) -> DataFrame:
    """``month, page_id, entity, views``, summed, sorted by page and month."""
    sums = with_month(facts).groupBy("month", "page_id", "entity").agg(total("views").alias("views"))
    return sums.orderBy(F.col("page_id").asc_nulls_last(), F.col("month").asc_nulls_last())


def ranked_titles(facts: DataFrame, pages: DataFrame, pages_rows: int | None) -> DataFrame:
    """``page_id, entity``: the latest title of each of the given pages."""
    ids = pages.select("page_id")
    if is_small(pages_rows):
        facts = facts.join(F.broadcast(ids), "page_id")
    titles = facts.groupBy("page_id").agg(latest()["entity"].alias("entity"))
    return titles if is_small(pages_rows) else titles.join(ids, "page_id")


def period_views(
    facts: DataFrame, pages: DataFrame, period: str, of_date: Column, *, pages_rows: int | None
) -> DataFrame:
    """``<period>, page_id, entity, views`` of the given pages: one row per page and period
    (``of_date``) under the page's latest title, sorted by page and period.

    Sums and titles come out of one aggregation. The window then sees one row per
    period of a page, so it stays small however many facts a page has.
    """
    ids = pages.select("page_id")
    if is_small(pages_rows):
        facts = facts.join(F.broadcast(ids), "page_id")
    per_period = facts.withColumn(period, of_date).groupBy("page_id", period).agg(
        total("views").alias("views"), latest().alias("last")
    )
    if not is_small(pages_rows):
        # Sums per task go into this shuffle instead of facts, so no page is a hot key in it.
        per_period = per_period.join(ids, "page_id")
    last_title = F.max("last").over(Window.partitionBy("page_id"))["entity"]
    return per_period.select(period, "page_id", last_title.alias("entity"), "views").orderBy(
        F.col("page_id").asc_nulls_last(), F.col(period).asc_nulls_last()
    )
