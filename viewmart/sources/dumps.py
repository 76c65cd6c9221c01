"""Page-count dumps: compressed text, one line per page, one or more files per day.

A line holds six fields: project, entity, page id, unused, view count, unused.
The day stands in the file path only.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewmart.functions.storage import absolute
from viewmart.functions.text import DUMP_DAY, DUMP_GLOB, day_from_path, split_fields, to_count

FIELDS = 6


def origin(spark: SparkSession, root: str) -> Column:
    """Path of a row's file relative to the dump's root: files of one name in several folders differ."""
    uri = F.col("_metadata.file_path")
    # this runs for every line: a plain test spares most of them the decoding
    whole = F.when(F.contains(uri, F.lit("%")), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)
    path = F.regexp_replace(whole, "^[a-zA-Z0-9+.-]+:(//[^/]*)?", "")
    prefix = absolute(spark, root).rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(path)


def _with_origin(spark: SparkSession, lines: DataFrame, root: str, day_pattern: str) -> DataFrame:
    return lines.select(
        day_from_path(F.col("_metadata.file_path"), day_pattern).alias("date"),
        origin(spark, root).alias("source"),
        "value",
    )


def read_dump(
    spark: SparkSession, path: str, *, glob: str = DUMP_GLOB, day_pattern: str = DUMP_DAY
) -> DataFrame:
    """Lines of all dump files under ``path``: ``date, source, value``; ``source`` is the file's path there.

    bzip2 files are splittable, so one large day is read by several tasks.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return _with_origin(spark, reader.text(path), path, day_pattern)


def stream_dump(
    spark: SparkSession,
    path: str,
    *,
    glob: str = DUMP_GLOB,
    day_pattern: str = DUMP_DAY,
    files_per_batch: int = 32,
) -> DataFrame:
    """Streaming form of :func:`read_dump`; each file is delivered once."""
    reader = (
        spark.readStream.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    return _with_origin(spark, reader.text(path), path, day_pattern)


def _with_fields(lines: DataFrame) -> DataFrame:
    """Lines with their fields ``f``.

    The explode of one array keeps the optimizer from moving filters on fields below the
    split, which would then run once for the filter and once for its output.
    """
    fields = F.explode(F.array(split_fields(F.col("value")))).alias("f")
    return lines.select("date", "source", "value", fields)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines with exactly six fields, split: ``date, source, project, entity, page_id,
    view_count`` (the count still as text)."""
    fields = _with_fields(lines).where(F.size("f") == FIELDS)
    return fields.select(
        "date",
        "source",
        F.col("f")[0].alias("project"),
        F.col("f")[1].alias("entity"),
        F.col("f")[2].alias("page_id"),
        F.col("f")[4].alias("view_count"),
    )


def _is_kept(project: str) -> Column:
    return (F.col("project") == project) & (F.col("page_id") != "null")


def filter_project(parsed: DataFrame, project: str) -> DataFrame:
    """Rows of one project that carry a page id (the text ``null`` means none)."""
    return parsed.where(_is_kept(project))


def to_facts(kept: DataFrame, *, strict: bool = True) -> DataFrame:
    """Typed facts ``date, source, entity, page_id, views``.

    A count that is no integer fails the job. Without ``strict`` it drops the row; keep such rows with
    :func:`parse_rejects`.
    """
    views = to_count(F.col("view_count"))
    if strict:
        views = F.coalesce(
            views,
            F.raise_error(F.concat(F.lit("not an integer: "), F.col("view_count"))).cast("bigint"),
        )
    facts = kept.select("date", "source", "entity", "page_id", views.alias("views"))
    return facts if strict else facts.where(F.col("views").isNotNull())


def dump_facts(lines: DataFrame, project: str, *, strict: bool = True) -> DataFrame:
    """Facts of one project straight from dump lines; ``strict`` as in :func:`to_facts`, for bad bytes too.

    A plain substring test drops most foreign lines before any of them is split.
    """
    valid = F.is_valid_utf8("value")
    if strict:
        broken = F.raise_error(F.lit("line is not valid UTF-8")).cast("boolean")
        lines = lines.where(F.when(valid, True).otherwise(broken))
    else:
        lines = lines.where(valid)
    candidates = lines.where(F.contains("value", F.lit(project)))
    return to_facts(filter_project(parse_lines(candidates), project), strict=strict)


def parse_once(
    lines: DataFrame, project: str, *, seen: Observation | None = None, files: int = 0
) -> DataFrame:
    """Lines that give a fact or a reject, from one pass: ``date, source, fact, value, reason``.

    ``fact`` (entity, page_id, views) is NULL for rejects, ``value`` and ``reason`` for facts. Reasons:
    ``encoding``: not valid UTF-8; ``fields``: not six fields (blank lines are none);
    ``count``: a kept row whose count is no integer. ``seen`` counts the lines of at most ``files``
    files on the way, for :func:`file_outcomes`.
    """
    kept = (F.get("f", F.lit(0)) == project) & (F.get("f", F.lit(2)) != "null")
    count = to_count(F.get("f", F.lit(4)))
    reason = (
        F.when(~F.is_valid_utf8("value"), "encoding")
        .when(F.size("f").between(1, FIELDS - 1) | (F.size("f") > FIELDS), "fields")
        .when(kept & count.isNull(), "count")
    )
    fact = F.struct(
        F.get("f", F.lit(1)).alias("entity"), F.get("f", F.lit(2)).alias("page_id"), count.alias("views")
    )
    rows = _with_fields(lines).select(
        "date", "source", F.when(reason.isNull() & kept, fact).alias("fact"), "value", reason.alias("reason")
    )
    if seen is not None:
        kind = F.when(F.col("fact").isNotNull(), "kept").when(F.col("reason").isNotNull(), "rejected")
        item = F.concat_ws(" ", F.coalesce(kind, F.lit("foreign")), "date", "source")
        # a sketch that tracks as many items as there can be counts each exactly
        most = F.lit(3 * files)
        rows = rows.observe(seen, F.call_function("approx_top_k", item, most, most).alias("items"))
    return rows.where(F.col("fact").isNotNull() | F.col("reason").isNotNull()).withColumn(
        "value", F.when(F.col("reason").isNotNull(), F.col("value"))
    )


def file_outcomes(seen: Observation) -> list[tuple[str, str, int, int, int]]:
    """``date, source, lines, kept, rejected`` of each file whose lines :func:`parse_once` counted."""
    counts: dict[tuple[str, str], Counter] = {}
    for item in seen.get["items"]:
        kind, date, source = item["item"].split(" ", 2)
        counts.setdefault((date, source), Counter())[kind] = item["count"]
    return [(*file, n.total(), n["kept"], n["rejected"]) for file, n in sorted(counts.items())]


def parse_rejects(lines: DataFrame, project: str) -> DataFrame:
    """Lines that give no fact though they are not merely foreign: ``date, source, value,
    reason`` as in :func:`parse_once`."""
    rejects = parse_once(lines, project).where(F.col("reason").isNotNull())
    return rejects.select("date", "source", "value", "reason")
