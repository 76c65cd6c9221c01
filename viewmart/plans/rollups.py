"""Sums of the facts that are kept up to date day by day, and reports from them that read no old fact.

Three levels lie under one root folder::

    day_sums/date=...      page_id, views, counted, rows, entity    a page's day: sum, facts with views, all facts,
                                                                    greatest title
    month_sums/month=...   page_id, views, rows, last               a page's month: sum, facts, last titled day
    window_totals          page_id, views, counted, rows, last      a page's sliding window (a table of its own)

Every level can be merged: sums and counts add up, the title of a page is that of its last day that has one. A
re-issued, late or deleted day changes the files of its facts; :func:`refresh_sums` compares file names and sizes with
those it has seen and replaces the folders of these days and of their months, nothing else. So a month is read from
30 small folders and history from 12 a year, and titles come out right whichever day is replaced.

A window is moved by difference: the sums of the days that enter are added, those of the days that leave are
subtracted. A title needs no subtraction, since a page whose last titled day leaves has no later one. If a day that
stays, or one that leaves, was replaced meanwhile, or the window moves back, it is summed anew from its days.

Versions are written last: a refresh that breaks off is repeated by the next one, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmart.functions.storage import delete, list_directories
from viewmart.functions.text import month_of
from viewmart.operators.rank import is_small, own_exchange, top_rows, total
from viewmart.sources.facts import read_facts, window_start
from viewmart.sources.tables import overwrite, read_table, table_exists

DAY_SUMS, MONTH_SUMS = "day_sums", "month_sums"
VERSIONS, WINDOW, WINDOW_DAYS_SEEN = "sum_versions", "window_totals", "window_state"

LAST = "struct<date:string,entity:string>"
STORED_DAY = "page_id string, views bigint, counted bigint, rows bigint, entity string, date string"
STORED_MONTH = f"page_id string, views bigint, rows bigint, last {LAST}, month string"
#: Folder name of a missing partition value; fixed by Spark.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Refresh:
    """Days whose sums were replaced (None: facts without a day) and those that have no facts any more."""

    days: tuple[str | None, ...] = ()
    gone: tuple[str | None, ...] = ()


@dataclass(frozen=True)
class WindowUpdate:
    """How a window was made: ``same``, ``moved`` or ``summed``, and the days that were read for it."""

    how: str
    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()


def _among(column: str, values: list[str | None]) -> Column:
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def _present(spark: SparkSession, path: str, column: str) -> set[str | None]:
    """Values of a partition column that have a folder."""
    values = [n.partition("=")[2] for n in list_directories(spark, path) if n.startswith(f"{column}=")]
    return {None if v == NO_VALUE else v for v in values}


def _replace(rows: DataFrame, path: str, column: str, gone: list[str | None]) -> None:
    """Write the partitions that ``rows`` has in place of the old ones, and remove those that are gone."""
    (
        rows.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(column)
        .parquet(path)
    )
    for value in gone:
        delete(rows.sparkSession, f"{path}/{column}={NO_VALUE if value is None else value}")


def fact_versions(spark: SparkSession, facts_path: str) -> DataFrame:
    """``date, version`` of the stored facts; the version tells the day's files by name and size. Reads no fact."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(facts_path)
    )
    date = F.regexp_extract("path", "/date=([^/]*)/", 1)
    inner = F.regexp_extract("path", "/(date=[^/]*/.*)$", 1)
    version = F.sum(F.xxhash64(inner, "length").cast("decimal(38,0)")).cast("string")
    return files.groupBy(F.when(date != NO_VALUE, date).alias("date")).agg(version.alias("version"))


def day_sums(facts: DataFrame) -> DataFrame:
    """One row per page and day: sum, facts and greatest title."""
    return facts.groupBy("page_id", "date").agg(
        total("views").alias("views"),
        F.count("views").alias("counted"),
        F.count("*").alias("rows"),
        F.max("entity").alias("entity"),
    )


def _last_titled() -> Column:
    both = F.col("date").isNotNull() & F.col("entity").isNotNull()
    return F.when(both, F.struct("date", "entity"))


def month_sums(days: DataFrame) -> DataFrame:
    """One row per page and month, from :func:`day_sums`."""
    return days.groupBy("page_id", month_of(F.col("date")).alias("month")).agg(
        total("views").alias("views"), F.sum("rows").alias("rows"), F.max(_last_titled()).alias("last")
    )


def read_day_sums(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED_DAY).parquet(f"{root}/{DAY_SUMS}")


def read_month_sums(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED_MONTH).parquet(f"{root}/{MONTH_SUMS}")


def refresh_sums(spark: SparkSession, facts_path: str, root: str) -> Refresh:
    """Bring day and month sums up to the stored facts; reads the facts of changed days only.

    One name and one version per day pass through the driver.
    """
    now = fact_versions(spark, facts_path)
    if table_exists(spark, root, VERSIONS):
        seen = read_table(spark, root, VERSIONS)
    else:
        seen = spark.createDataFrame([], "date string, version string")
    both = now.alias("now").join(seen.alias("seen"), F.expr("now.date <=> seen.date"), "full")
    changed = both.where(~F.expr("now.version <=> seen.version")).select(
        F.coalesce("now.date", "seen.date").alias("date"), F.col("now.version").isNull().alias("gone")
    )
    rows = sorted(changed.collect(), key=lambda r: (r.date is None, r.date))
    if not rows:
        return Refresh()
    gone = [r.date for r in rows if r.gone]
    days = [r.date for r in rows if not r.gone]
    day_path, month_path = f"{root}/{DAY_SUMS}", f"{root}/{MONTH_SUMS}"
    _replace(day_sums(read_facts(spark, facts_path).where(_among("date", days))), day_path, "date", gone)
    months = sorted({None if r.date is None else r.date[:7] for r in rows}, key=lambda m: (m is None, m))
    left = {None if d is None else d[:7] for d in _present(spark, day_path, "date")}
    of_month = month_of(F.col("date"))
    touched = read_day_sums(spark, root).where(
        of_month.isin([m for m in months if m]) | (F.col("date").isNull() if None in months else F.lit(False))
    )
    _replace(month_sums(touched), month_path, "month", [m for m in months if m not in left])
    # as it was before the facts were read: a day that changed since is taken again
    overwrite(spark.createDataFrame(now.collect(), "date string, version string"), root, VERSIONS)
    return Refresh(tuple(days), tuple(gone))


def totals_from_sums(sums: DataFrame) -> DataFrame:
    """``page_id, entity, total_views`` of every page, as :func:`viewmart.operators.rank.page_totals` of the facts."""
    return sums.groupBy("page_id").agg(F.max("last")["entity"].alias("entity"), total("views").alias("total_views"))


def monthly_from_sums(sums: DataFrame, n: int) -> DataFrame:
    """``month, page_id, entity, views`` of the ``n`` pages with the most views, from :func:`read_month_sums`.

    The rows of :func:`viewmart.plans.reports.top_pages_monthly` over the facts.
    """
    totals = sums.groupBy("page_id").agg(
        total("views").alias("total_views"), F.max("last")["entity"].alias("entity")
    )
    top = top_rows(totals, n, "total_views", "page_id").select("page_id", "entity")
    top = F.broadcast(top) if is_small(n) else own_exchange(top)
    return sums.join(top, "page_id").select("month", "page_id", "entity", "views").orderBy(
        F.col("page_id").asc_nulls_last(), F.col("month").asc_nulls_last()
    )


def _window_sums(days: DataFrame, sign: int) -> DataFrame:
    last = _last_titled() if sign > 0 else F.lit(None).cast(LAST)
    signed = [(F.col(c) * sign).alias(c) for c in ("views", "counted", "rows")]
    return days.select("page_id", *signed, last.alias("last"))


def update_window(spark: SparkSession, root: str, last: str, days: int) -> WindowUpdate:
    """Bring the window totals to the ``days`` days that end at ``last``, from :func:`refresh_sums`' day sums."""
    start = window_start(last, days)
    seen = read_table(spark, root, VERSIONS)
    current = {r.date: r.version for r in seen.where("date is not null").collect()}  # one row per day
    wanted = {d: v for d, v in current.items() if start <= d <= last}
    held: dict[str, str] = {}
    if table_exists(spark, root, WINDOW_DAYS_SEEN) and table_exists(spark, root, WINDOW):
        held = {r.date: r.version for r in read_table(spark, root, WINDOW_DAYS_SEEN).collect()}
    added = sorted(d for d in wanted if d not in held)
    removed = sorted(d for d in held if d not in wanted)
    if held and held == wanted:
        return WindowUpdate("same")
    # a day that was replaced, or one that leaves at the end, can't be taken away
    as_held = all(current.get(d) == v for d, v in held.items()) and all(d < start for d in removed)
    every = read_day_sums(spark, root)
    if held and as_held and len(added) + len(removed) < len(wanted):
        how = "moved"
        rows = (
            read_table(spark, root, WINDOW)
            .unionByName(_window_sums(every.where(F.col("date").isin(added)), 1))
            .unionByName(_window_sums(every.where(F.col("date").isin(removed)), -1))
        )
    else:
        how, added, removed = "summed", sorted(wanted), []
        rows = _window_sums(every.where(F.col("date").between(start, last)), 1)
    title = F.max(F.when(F.col("last.date") >= start, F.col("last")))
    totals = (
        rows.groupBy("page_id")
        .agg(total("views").alias("views"), F.sum("counted").alias("counted"), F.sum("rows").alias("rows"),
             title.alias("last"))
        .where(F.col("rows") > 0)
        .withColumn("views", F.when(F.col("counted") > 0, F.col("views")))
    )
    # a window without its state is summed anew
    delete(spark, f"{root}/{WINDOW_DAYS_SEEN}")
    if overwrite(totals, root, WINDOW) is None:
        delete(spark, f"{root}/{WINDOW}")
    else:
        overwrite(spark.createDataFrame(sorted(wanted.items()), "date string, version string"), root, WINDOW_DAYS_SEEN)
    return WindowUpdate(how, tuple(added), tuple(removed))


def read_window(spark: SparkSession, root: str) -> DataFrame:
    """``page_id, entity, total_views`` of the window as last updated; no row if it had no facts."""
    if not table_exists(spark, root, WINDOW):
        return spark.createDataFrame([], "page_id string, entity string, total_views bigint")
    return read_table(spark, root, WINDOW).select(
        "page_id", F.col("last.entity").alias("entity"), F.col("views").alias("total_views")
    )
