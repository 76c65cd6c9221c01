"""The two ranked reports over daily facts, and the gated build that stores both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmart.functions.text import month_of
from viewmart.operators.calendars import missing_dates, needs_build
from viewmart.operators.rank import (
    is_small,
    own_exchange,
    period_views,
    ranked_titles,
    repeated,
    top_ids,
    top_rows,
)
from viewmart.plans.rollups import monthly_from_sums
from viewmart.sources.facts import read_recent, window_start
from viewmart.sources.tables import WriteResult, overwrite, read_table, table_exists

# Sizes of the reports and the window, and the least rows they must have.
TOP_MONTHLY = 100_000
TOP_DAILY = 10_000
WINDOW_DAYS = 90
MIN_ROWS = 1_000

STATE = "build_state"


def top_pages_monthly(facts: DataFrame, n: int = TOP_MONTHLY) -> DataFrame:
    """``month, page_id, entity, views`` of the ``n`` pages with the most views over all facts,
    sorted by page and month.

    The first scan reads ids and views to rank. The second keeps the ranked pages by a
    broadcast join, so only their monthly sums are shuffled.
    """
    month = month_of(F.col("date"))
    return period_views(facts, top_ids(facts, n), "month", month, pages_rows=n)


def top_pages_daily(
    facts: DataFrame,
    last: str,
    days: int = WINDOW_DAYS,
    n: int = TOP_DAILY,
    *,
    aggregate: bool = False,
    allow_gaps: bool = False,
    present: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """``date, page_id, entity, views`` of the ``n`` pages with the most views in the ``days``
    days ending at ``last``, sorted by page and date.

    ``totals`` (``page_id, entity, total_views`` of the window, such as
    :func:`viewmart.plans.rollups.read_window`) spare the scan that ranks and the one for titles.

    One row per fact; a page with several facts on a day has several rows, which
    ``aggregate`` sums up. Days of the window without facts raise, see
    :func:`viewmart.sources.facts.read_recent`.
    """
    recent = read_recent(facts, last, days, allow_gaps=allow_gaps, present=present)
    pages = top_ids(recent, n) if totals is None else top_rows(totals, n, "total_views", "page_id")
    if aggregate:
        return period_views(recent, pages, "date", F.col("date"), pages_rows=n)
    titles = ranked_titles(recent, pages, n) if totals is None else pages.select("page_id", "entity")
    # Equal facts are one row with a count until they are sorted, so no task gets all copies.
    copies = F.count("*").alias("copies")
    if is_small(n):
        found = recent.join(F.broadcast(titles), "page_id")
        rows = found.groupBy("date", "page_id", titles["entity"], "views").agg(copies)
    else:
        rows = recent.groupBy("date", "page_id", "views").agg(copies).join(own_exchange(titles), "page_id")
    rows = rows.orderBy(F.col("page_id").asc_nulls_last(), F.col("date").asc_nulls_last(), "views")
    return repeated(rows.select("date", "page_id", "entity", "views", "copies"), "copies")


@dataclass(frozen=True)
class BuildResult:
    """Outcome of :func:`build_all`; the two writes are None if nothing was built.

    ``missing`` lists the days of the window that have no facts.
    """

    reason: str
    last_ingested: str | None
    monthly: WriteResult | None = None
    daily: WriteResult | None = None
    missing: tuple[str, ...] = ()


def build_all(
    facts: DataFrame,
    root: str,
    *,
    monthly_name: str = "top_pages_monthly",
    daily_name: str = "top_pages_daily_recent",
    today: str | None = None,
    top_monthly: int = TOP_MONTHLY,
    top_daily: int = TOP_DAILY,
    window_days: int = WINDOW_DAYS,
    min_rows: int = MIN_ROWS,
    aggregate: bool = False,
    allow_gaps: bool = False,
    days: DataFrame | None = None,
    sums: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> BuildResult:
    """Build, check and store both reports if the facts reach yesterday and are new.

    Days of the window without facts raise ValueError; with ``allow_gaps`` they are reported.
    ``days`` (``date``) gives the days that have facts, such as
    :func:`viewmart.sources.facts.read_days`; the gate then reads no fact. ``sums``
    (:func:`viewmart.plans.rollups.read_month_sums`) make the monthly report without reading facts, ``totals``
    (:func:`viewmart.plans.rollups.read_window`, of this window) the daily one with one scan of its days.

    Each report is written, checked on the written files and only then made visible. The
    day it was built from is stored last, so a build that failed runs again.
    """
    spark = facts.sparkSession
    last_built = None
    if table_exists(spark, root, STATE):
        last_built = read_table(spark, root, STATE).first()["last_ingested"]
    days = facts.select("date") if days is None else days
    gate = needs_build(days, today, last_built).first()
    if not gate.build:
        return BuildResult(gate.reason, gate.last_ingested)

    start = window_start(gate.last_ingested, window_days)
    recent = days.where(F.col("date").between(start, gate.last_ingested))
    gaps = missing_dates(recent, start, gate.last_ingested).collect()  # window_days rows at most
    missing = tuple(r.date for r in gaps)
    if missing and not allow_gaps:
        raise ValueError(f"no facts for {len(missing)} days of the window, e.g. {missing[:5]}")

    columns = ["page_id", "entity", "views"]
    monthly = overwrite(
        top_pages_monthly(facts, top_monthly) if sums is None else monthly_from_sums(sums, top_monthly),
        root,
        monthly_name,
        clustered_by=["page_id", "month"],
        expect={"not_null": ["month", *columns], "min_rows": min_rows},
    )
    daily = overwrite(
        top_pages_daily(
            facts, gate.last_ingested, window_days, top_daily,
            aggregate=aggregate, allow_gaps=True, totals=totals,
        ),  # fmt: skip  # gaps are told above
        root,
        daily_name,
        clustered_by=["page_id", "date"],
        expect={"not_null": ["date", *columns], "min_rows": min_rows},
    )
    state = spark.range(1).select(F.lit(gate.last_ingested).alias("last_ingested"))
    overwrite(state, root, STATE)
    return BuildResult(gate.reason, gate.last_ingested, monthly, daily, missing)
