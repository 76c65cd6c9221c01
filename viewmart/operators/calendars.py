"""Day sequences: gaps in the facts, days still to load, and the build gate."""

from __future__ import annotations

from datetime import date as Day

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, ``date`` as ``YYYY-MM-DD``; empty if ``start`` is after ``end``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = spark.range(1).where(first <= last).select(F.explode(F.sequence(first, last)).alias("day"))
    return days.select(F.col("day").cast("string").alias("date"))


def pending_dates(spark: SparkSession, start: str, end: str, completed: DataFrame) -> DataFrame:
    """Days from ``start`` to ``end`` that are not in ``completed`` (``date``), ascending."""
    done = completed.select("date").distinct()
    return calendar(spark, start, end).join(done, "date", "left_anti").orderBy("date")


def missing_dates(facts: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Days without facts between ``start`` and ``end``; by default between the first and
    last day of the facts."""
    present = facts.select("date").distinct()
    if start and end:
        wanted = calendar(facts.sparkSession, start, end)
    else:
        first = F.lit(start).cast("date") if start else F.min("date").cast("date")
        last = F.lit(end).cast("date") if end else F.max("date").cast("date")
        bounds = present.agg(first.alias("first"), last.alias("last")).where(F.col("first") <= F.col("last"))
        days = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
        wanted = days.select(F.col("day").cast("string").alias("date"))
    return wanted.join(present, "date", "left_anti").orderBy("date")


def last_ingested(facts: DataFrame) -> DataFrame:
    """One row: the last day that has facts."""
    return facts.agg(F.max("date").alias("last_ingested"))


def needs_build(facts: DataFrame, today: str | None = None, last_built: str | None = None) -> DataFrame:
    """One row ``last_ingested, days_behind, build, reason``: build only if there is data, it
    reaches yesterday, and it ends on another day than the data of the last build.

    ``days_behind`` counts the days missing up to yesterday (0 if none).
    """
    yesterday = F.date_sub(F.lit(today or Day.today().isoformat()).cast("date"), 1)
    last = F.col("last_ingested")
    behind = F.greatest(F.date_diff(yesterday, last.cast("date")), F.lit(0))
    reason = (
        F.when(last.isNull(), "no data")
        .when(behind > 0, "behind")
        .when(last == F.lit(last_built).cast("string"), "up to date")
        .otherwise("new data")
    )
    return last_ingested(facts).select(
        last,
        behind.alias("days_behind"),
        (reason == "new data").alias("build"),
        reason.alias("reason"),
    )
