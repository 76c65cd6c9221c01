"""Dump files to daily facts, each file once, resumable."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from viewmart.functions.storage import delete, scratch_folder
from viewmart.functions.text import DUMP_DAY, DUMP_GLOB, day_from_path
from viewmart.sources.dumps import dump_facts, file_outcomes, origin, parse_once, read_dump, stream_dump
from viewmart.sources.facts import read_origins, write_facts


OUTCOME = "lines bigint, kept bigint, rejected bigint, date string, source string"


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """``date, source, lines, kept, rejected`` of every file loaded with ``outcomes_path``."""
    return spark.read.schema(OUTCOME).parquet(path).select("date", "source", "lines", "kept", "rejected")


def _store(
    lines: DataFrame,
    facts_path: str,
    project: str,
    rejects_path: str | None,
    outcomes_path: str | None = None,
    files: int = 0,
) -> None:
    """Write the facts of lines, and with ``rejects_path`` what gave none; without, bad lines fail.

    ``outcomes_path`` takes a row for each of the ``files`` files at most, once their facts are there.
    """
    unknown = F.raise_error(F.concat(F.lit("no day in the path of "), F.col("source")))
    lines = lines.withColumn("date", F.coalesce("date", unknown.cast("string")))
    if rejects_path is None:
        write_facts(dump_facts(lines, project), facts_path)
        return
    # The files are read and parsed once; what they gave is parted afterwards.
    spark = lines.sparkSession
    parsed = scratch_folder(spark, "parsed")
    # counted in the tasks that write, behind no shuffle: each line once, whatever tasks are repeated
    seen = Observation() if outcomes_path else None
    try:
        parse_once(lines, project, seen=seen, files=files).write.parquet(parsed)
        rows = spark.read.parquet(parsed)
        write_facts(rows.where("reason is null").select("date", "source", "fact.*"), facts_path)
        _by_file(rows.where("reason is not null").select("date", "source", "value", "reason"), rejects_path)
        if seen is not None:
            columns = "date string, source string, lines bigint, kept bigint, rejected bigint"
            _by_file(spark.createDataFrame(file_outcomes(seen), columns), outcomes_path)
    finally:
        delete(spark, parsed)


def _by_file(rows: DataFrame, path: str) -> None:
    """Replace what a folder held of the files (``date``, ``source``) of these rows."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date", "source").parquet(path)


def files_without_facts(
    spark: SparkSession,
    dump_path: str,
    facts_path: str,
    *,
    glob: str = DUMP_GLOB,
    day_pattern: str = DUMP_DAY,
) -> DataFrame:
    """``date, source`` of the dump files that left nothing in the fact table.

    Compares names only: the listing of the dump with the folders of the facts. No file is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(dump_path)
        .select(
            day_from_path(F.col("_metadata.file_path"), day_pattern).alias("date"),
            origin(spark, dump_path).alias("source"),
        )
    )
    loaded = read_origins(spark, facts_path)
    return files.join(loaded, ["date", "source"], "left_anti")


def _check_files(spark: SparkSession, dump_path: str, facts_path: str, glob: str, day_pattern: str) -> None:
    missing = files_without_facts(
        spark, dump_path, facts_path, glob=glob, day_pattern=day_pattern
    )
    shown = missing.orderBy("date", "source").limit(5).collect()
    if shown:
        raise ValueError("no facts found for " + ", ".join(f"{r.date} ({r.source})" for r in shown))


def ingest(
    spark: SparkSession,
    dump_path: str,
    facts_path: str,
    project: str,
    *,
    glob: str = DUMP_GLOB,
    day_pattern: str = DUMP_DAY,
    allow_empty: bool = False,
    rejects_path: str | None = None,
) -> None:
    """Batch ingest of all matching dump files, replacing what these files gave before.

    Use it to load re-issued files, which the stream does not read again. Lines with bad bytes and kept
    rows with a bad count fail the job, unless ``rejects_path`` is given, where they are kept by day
    and file with the lines that have not six fields. A file that gives no facts raises ValueError at the
    end, unless ``allow_empty``.
    """
    lines = read_dump(spark, dump_path, glob=glob, day_pattern=day_pattern)
    _store(lines, facts_path, project, rejects_path)
    if not allow_empty:
        _check_files(spark, dump_path, facts_path, glob, day_pattern)


def ingest_stream(
    spark: SparkSession,
    dump_path: str,
    facts_path: str,
    checkpoint: str,
    project: str,
    *,
    glob: str = DUMP_GLOB,
    day_pattern: str = DUMP_DAY,
    files_per_batch: int = 32,
    allow_empty: bool = False,
    rejects_path: str | None = None,
    outcomes_path: str | None = None,
) -> int:
    """Load every dump file not loaded yet, ``files_per_batch`` at a time, then stop.

    Returns the number of batches run. The checkpoint remembers finished batches. A batch
    that is repeated after a failure replaces its own partitions, so no fact is doubled.
    ``rejects_path`` as in :func:`ingest`; with it, ``outcomes_path`` takes the number of lines of each
    file, and how many were kept and rejected, counted while the batch is parsed (a file without lines
    has no row); see :func:`read_outcomes`. A file that gave no facts raises ValueError at the end
    of a run that loaded something, unless ``allow_empty``; a run without new files checks nothing.
    """
    if outcomes_path and not rejects_path:
        raise ValueError("outcomes_path needs rejects_path")
    done = []

    def store(batch: DataFrame, batch_id: int) -> None:
        _store(batch, facts_path, project, rejects_path, outcomes_path, files_per_batch)
        done.append(batch_id)

    lines = stream_dump(
        spark, dump_path, glob=glob, day_pattern=day_pattern, files_per_batch=files_per_batch
    )
    query = (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if done and not allow_empty:
        _check_files(spark, dump_path, facts_path, glob, day_pattern)
    return len(done)
