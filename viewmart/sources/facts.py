"""The daily fact table: ``date, entity, page_id, views``, partitioned by day and origin."""

from __future__ import annotations

from datetime import date as Day
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewmart.functions.storage import list_directories
from viewmart.operators.calendars import missing_dates

FACT = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("views", T.LongType()),
    ]
)


# As stored: the two partition columns come last.
STORED = T.StructType(FACT.fields + [T.StructField("source", T.StringType())])


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """All facts written by :func:`write_facts`.

    The schema is given, so no file is opened to infer it and ``date`` stays text.
    """
    return spark.read.schema(STORED).parquet(path).select(*FACT.names)


def _values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values right under a folder."""
    prefix = f"{column}="
    names = [n for n in list_directories(spark, path) if n.startswith(prefix)]
    return [unquote(n.removeprefix(prefix)) for n in names]


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """``date`` of every day that the stored facts have a folder for; reads no fact.

    Gate, gaps and last day can be told from it as from the facts. One name per day passes
    through the driver.
    """
    days = [(d,) for d in _values(spark, path, "date")]
    return spark.createDataFrame(days, "date string")


def read_origins(spark: SparkSession, path: str) -> DataFrame:
    """``date, source`` of the stored facts, from the names of their folders; reads no fact."""
    root = path.rstrip("/")
    pairs = [
        (unquote(folder.removeprefix("date=")), source)
        for folder in list_directories(spark, root)
        if folder.startswith("date=")
        for source in _values(spark, f"{root}/{folder}", "source")
    ]
    return spark.createDataFrame(pairs, "date string, source string")


def read_daily_files(spark: SparkSession, path: str, glob: str = "page_views_*.parquet") -> DataFrame:
    """Facts kept as one flat parquet file per day, the date being a column inside."""
    return spark.read.schema(FACT).option("pathGlobFilter", glob).parquet(path)


def write_facts(facts: DataFrame, path: str, *, source: str = "batch", rebalance: bool = True) -> None:
    """Write facts by ``date`` and ``source``; the pairs present replace what they held.

    Writing the same pair again is therefore idempotent, and a day delivered in
    several files keeps them all. ``source`` names the origin where ``facts`` has no
    such column. Rebalancing gives each pair files of even size: AQE splits a pair that
    is too large for one task and joins small ones; skip it if the input is already
    laid out by day.
    """
    if "source" not in facts.columns:
        facts = facts.withColumn("source", F.lit(source))
    facts = facts.select("entity", "page_id", "views", "date", "source")
    if rebalance:
        facts = facts.hint("rebalance", "date", "source")
    (
        facts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("date", "source")
        .parquet(path)
    )


def window_start(last: str, days: int) -> str:
    """First day of the window of ``days`` days that ends at ``last``."""
    if days < 1:
        raise ValueError("days must be at least 1")
    return (Day.fromisoformat(last) - timedelta(days=days - 1)).isoformat()


def read_recent(
    facts: DataFrame,
    last: str,
    days: int,
    *,
    allow_gaps: bool = False,
    present: DataFrame | None = None,
) -> DataFrame:
    """Facts of the ``days`` days ending at ``last``, both ends included.

    On the partitioned table this prunes to the partitions of those days. A day without facts
    raises ValueError, unless ``allow_gaps``. ``present`` (``date``) gives the days that have facts,
    such as :func:`read_days`; without it they are told from the facts of the window.
    """
    start = window_start(last, days)
    recent = facts.where(F.col("date").between(start, last))
    if not allow_gaps:
        gaps = [r.date for r in missing_dates(recent if present is None else present, start, last).collect()]
        if gaps:
            raise ValueError(f"no facts for {len(gaps)} of {days} days, e.g. {gaps[:5]}")
    return recent
