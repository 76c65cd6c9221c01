"""Named parquet tables under a root folder: overwrite, append, merge, read.

Every write goes to a new folder and becomes visible when its note (schema, partition
columns, rows) is renamed into place, so readers see whole writes only and a failed or
lost job leaves the table as it was::

    <root>/<name>/full=00000003/_part=00000003/   the last overwrite
    <root>/<name>/full=00000003/_part=00000004/   appended or merged since

A merge writes the rows of the files that it changes, with the new rows, as one more part; its note names
the old files that no longer count. Rows, NULLs and the content hash of a write are observed while it runs, so its
files are not read again for them. One writer per table at a time; :func:`drop_versions` removes what
the table no longer reads.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewmart.functions import storage
from viewmart.operators.changes import as_list, check_keys, clashing_updates, conform, merged_parts
from viewmart.operators.profile import content_sum, quoted
from viewmart.operators.quality import contract_measures, contract_report, key_report, raise_failed, validate

NOTE = "_note.json"


@dataclass(frozen=True)
class WriteResult:
    """Where a write went, its version, a tag of its source and the rows in the table now."""

    uri: str
    version: int
    hash: str
    rows: int


@dataclass(frozen=True)
class _State:
    """Visible parts of a table, and the highest number used so far by any write."""

    used: int
    full: int | None
    parts: tuple[str, ...]
    schema: T.StructType | None
    partition_by: tuple[str, ...]
    rows: int
    #: Content hash of all rows, if the table keeps one.
    content: int | None = None
    #: Files of the parts that merges have replaced, relative to the table's folder.
    removed: frozenset[str] = frozenset()


def _uri(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    names = storage.list_directories(spark, folder)
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))


def _full_folder(uri: str, full: int) -> str:
    return f"{uri}/full={full:08d}"


def _part_folder(uri: str, full: int, part: int) -> str:
    return f"{_full_folder(uri, full)}/_part={part:08d}"


def _state(spark: SparkSession, uri: str) -> _State:
    used = 0
    for full in reversed(_numbers(spark, uri, "full=")):
        folder = _full_folder(uri, full)
        used = max([used, full, *_numbers(spark, folder, "_part=")])
        notes = storage.glob(spark, f"{folder}/_part=*/{NOTE}")
        visible = [int(note.split("/")[-2].removeprefix("_part=")) for note in notes]
        if full in visible:
            last = json.loads(storage.read_note(spark, f"{_part_folder(uri, full, visible[-1])}/{NOTE}"))
            return _State(
                used,
                full,
                tuple(_part_folder(uri, full, n) for n in visible),
                T.StructType.fromJson(last["schema"]),
                tuple(last["partition_by"]),
                last["rows"],
                None if last.get("content") is None else int(last["content"]),
                frozenset(last.get("removed", ())),
            )
    return _State(used, None, (), None, (), 0)


def _files(spark: SparkSession, uri: str, state: _State) -> list[str]:
    """Visible files, where some of the parts' files have been replaced."""
    base = storage.absolute(spark, uri)
    every = [f for part in state.parts for f in storage.list_files(spark, part)]
    return [f for f in every if f.removeprefix(f"{base}/") not in state.removed]


def _rows_of(spark: SparkSession, uri: str, state: _State, paths: list[str]) -> DataFrame:
    """Stored rows with the columns of the folders and Spark's hidden file columns."""
    stored = T.StructType(state.schema.fields + [T.StructField("_part", T.StringType())])
    reader = spark.read.schema(stored).option("basePath", _full_folder(uri, state.full))
    return reader.parquet(*paths)


def _paths(spark: SparkSession, uri: str, state: _State) -> list[str]:
    return _files(spark, uri, state) if state.removed else list(state.parts)


def _only(rows: DataFrame, state: _State) -> DataFrame:
    return rows.select(*[F.col(quoted(c)) for c in state.schema.names])


def _read(spark: SparkSession, uri: str, state: _State) -> DataFrame:
    return _only(_rows_of(spark, uri, state, _paths(spark, uri, state)), state)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return _state(spark, _uri(root, name)).full is not None


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table as of its last write."""
    uri = _uri(root, name)
    state = _state(spark, uri)
    if state.full is None:
        raise FileNotFoundError(f"no table at {uri}")
    return _read(spark, uri, state)


def table_rows(spark: SparkSession, root: str, name: str) -> int:
    """Rows in the table, from its note."""
    uri = _uri(root, name)
    state = _state(spark, uri)
    if state.full is None:
        raise FileNotFoundError(f"no table at {uri}")
    return state.rows


def table_content(spark: SparkSession, root: str, name: str) -> str | None:
    """Content hash of all rows as :func:`viewmart.operators.profile.fingerprint` gives it, from the table's note.

    None if the table keeps none. Appends and merges update it from the rows that they write and replace.
    """
    uri = _uri(root, name)
    state = _state(spark, uri)
    if state.full is None:
        raise FileNotFoundError(f"no table at {uri}")
    return None if state.content is None else str(state.content)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def _write(
    df: DataFrame,
    uri: str,
    state: _State,
    *,
    schema: T.StructType,
    partition_by: list[str],
    append_to: int | None = None,
    replaced: list[str] | None = None,
    clustered_by: list[str] | None = None,
    expect: dict[str, Any] | None = None,
    content_hash: bool = False,
) -> tuple[int, int, int] | None:
    """Write ``df`` as the next part; ``(version, rows written, rows in table)``, None if empty.

    ``replaced`` are files that the new part stands for. A content hash is made if ``content_hash`` asks for it, and
    carried on if the table has one: that of replaced rows is subtracted, that of the new part added.
    """
    spark = df.sparkSession
    before = state.rows if append_to is not None else 0
    removed = state.removed if append_to is not None else frozenset()
    content = 0 if append_to is None and content_hash else state.content if append_to is not None else None
    if content is not None and append_to is not None and state.schema.names != schema.names:
        # every row has another text now
        wider = T.StructType(schema.fields)
        content = int(_read(spark, uri, state).agg(content_sum(wider, state.schema.names)).first()[0])
    if replaced:
        old = _rows_of(spark, uri, state, replaced)
        if content is None:
            before -= old.count()  # from their footers
        else:
            gone = old.agg(F.count("*"), content_sum(schema, state.schema.names)).first()
            before, content = before - gone[0], content - int(gone[1])
        base = storage.absolute(spark, uri)
        removed |= {f.removeprefix(f"{base}/") for f in replaced}
    version = state.used + 1
    full = append_to if append_to is not None else version
    folder = _part_folder(uri, full, version)
    if clustered_by:
        df = cluster(df, clustered_by)
    elif partition_by:
        # One shuffle by partition value; AQE splits large values over several tasks.
        df = df.hint("rebalance", *partition_by)
    # observed right before the rows are written, after the last shuffle: each row once, whatever tasks are repeated
    measures = contract_measures(df.schema, expect or {}) | {"rows": F.count(F.lit(1))}
    if content is not None:
        measures["content"] = content_sum(schema, df.columns)
    seen = Observation()
    writer = df.observe(seen, *[m.alias(n) for n, m in measures.items()]).write.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    got = seen.get
    written = got["rows"]
    if written == 0:
        storage.delete(spark, folder)
        return None
    rows = written + before
    if expect:
        counts = spark.range(1).select(*[F.lit(got[n]).alias(n) for n in measures if n != "content"])
        raise_failed(contract_report(counts, schema, expect))
        if expect.get("unique"):  # needs a shuffle, so it's told from the files
            draft = _State(version, full, (folder,), schema, tuple(partition_by), 0)
            validate(_read(spark, uri, draft), {"unique": expect["unique"]})
    note = {"schema": schema.jsonValue(), "partition_by": partition_by, "rows": rows, "removed": sorted(removed)}
    if content is not None:
        note["content"] = str(content + int(got["content"]))
    storage.write_note(spark, f"{folder}/{NOTE}", json.dumps(note))
    return version, written, rows


def _hash(rows: int, schema: T.StructType) -> str:
    """The tag of :func:`viewmart.operators.profile.fingerprint`, for a row count at hand."""
    return hashlib.md5(f"{rows}{schema.simpleString()}".encode()).hexdigest()[:16]


def overwrite(
    source: DataFrame,
    root: str,
    name: str,
    *,
    partition_by: list[str] | None = None,
    clustered_by: list[str] | None = None,
    expect: dict[str, Any] | None = None,
    content_hash: bool = False,
) -> WriteResult | None:
    """Replace the table, schema included. An empty source changes nothing and gives None.

    ``clustered_by`` sorts the files by these columns (see :func:`cluster`). ``expect``
    is a contract as in :func:`viewmart.operators.quality.validate`; it is checked on what is
    written, and if it fails the old table stays. ``content_hash`` makes the table keep one, see
    :func:`table_content`; appends and merges then carry it on.
    """
    spark, uri = source.sparkSession, _uri(root, name)
    if partition_by and clustered_by:
        raise ValueError("give partition_by or clustered_by, not both")
    schema = _nullable(source.schema)
    done = _write(
        source,
        uri,
        _state(spark, uri),
        schema=schema,
        partition_by=list(partition_by or []),
        clustered_by=clustered_by,
        expect=expect,
        content_hash=content_hash,
    )
    if done is None:
        return None
    version, written, rows = done
    return WriteResult(uri, version, _hash(written, schema), rows)


def append(
    source: DataFrame, root: str, name: str, *, partition_by: list[str] | None = None
) -> WriteResult | None:
    """Add rows without deduplication; new columns join the schema. Writes only the new rows.

    An empty source changes nothing and gives None. Columns the table has take its types; the job fails where
    a value does not fit exactly (see :func:`viewmart.operators.changes.conform`).
    """
    spark, uri = source.sparkSession, _uri(root, name)
    state = _state(spark, uri)
    if state.full is None:
        return overwrite(source, root, name, partition_by=partition_by)
    if partition_by is not None and list(partition_by) != list(state.partition_by):
        raise ValueError(f"table is partitioned by {list(state.partition_by)}, not {list(partition_by)}")
    conformed = conform(source, state.schema)
    known = set(state.schema.names)
    added = [f for f in _nullable(conformed.schema) if f.name not in known]
    lacking = [c for c in state.partition_by if c not in conformed.columns]
    if lacking:
        raise ValueError(f"source lacks partition columns {lacking}")
    done = _write(
        conformed,
        uri,
        state,
        schema=T.StructType(state.schema.fields + added),
        partition_by=list(state.partition_by),
        append_to=state.full,
    )
    if done is None:
        return None
    version, written, rows = done
    return WriteResult(uri, version, _hash(written, source.schema), rows)


def merge(
    source: DataFrame,
    root: str,
    name: str,
    *,
    key: str | list[str],
    partition_by: list[str] | None = None,
    validate: bool = True,
) -> WriteResult | None:
    """Upsert ``source`` into the table by ``key`` (see :func:`merge_rows`); creates the table.

    Columns take the table's types first (see :func:`viewmart.operators.changes.conform`); with ``validate`` the
    key must then exist, be non-null and unique. Without it, NULL keys are added, and a key that
    occurs twice in the source and once in the table is an error. An empty source changes nothing
    and gives None.

    The source is computed once and kept in scratch space meanwhile. Only files with a row to update are written
    anew, with the added rows; all other files stay where they are.
    """
    keys = as_list(key)
    spark, uri = source.sparkSession, _uri(root, name)
    state = _state(spark, uri)
    folder = storage.scratch_folder(spark, "merge-source")
    try:
        if not set(keys) <= set(source.columns):
            check_keys(source, keys, name)  # raises, or the source is empty
            return None
        unknown = [] if state.full is None else [c for c in source.columns if c not in state.schema.names]
        if unknown:
            raise ValueError(f"columns not in the target: {unknown}")
        conformed = source if state.full is None else conform(source, state.schema)
        conformed.write.parquet(folder)
        staged = spark.read.schema(_nullable(conformed.schema)).parquet(folder)
        source_rows = staged.count()
        if not source_rows:
            return None
        if validate:
            check_keys(staged, keys, name)
        if state.full is None:
            return overwrite(staged, root, name, partition_by=partition_by)
        return _merge_staged(staged, uri, name, state, keys, source_rows, source.schema)
    finally:
        storage.delete(spark, folder)


def _merge_staged(
    staged: DataFrame,
    uri: str,
    name: str,
    state: _State,
    keys: list[str],
    source_rows: int,
    source_schema: T.StructType,
) -> WriteResult:
    spark = staged.sparkSession
    rows = _rows_of(spark, uri, state, _paths(spark, uri, state))
    placed = rows.select(
        *[F.col(quoted(k)).alias(f"__t{i}") for i, k in enumerate(keys)], F.col("_metadata.file_path").alias("__file")
    )
    wanted = staged.select(*[F.col(quoted(k)).alias(f"__s{i}") for i, k in enumerate(keys)])
    same = reduce(and_, [F.col(f"__t{i}") == F.col(f"__s{i}") for i in range(len(keys))])
    found = placed.join(wanted, same, "left_semi").select("__file").distinct()
    touched = [storage.plain_path(spark, r["__file"]) for r in found.toLocalIterator()]
    if touched:
        target = _only(_rows_of(spark, uri, state, touched), state)
        if not clashing_updates(target, staged, keys).isEmpty():
            raise ValueError(f"[{name}] several source rows update the same row")
        kept, added = merged_parts(target, staged, keys)
        merged = kept.unionByName(added, allowMissingColumns=True)
    else:
        nothing = spark.createDataFrame([], state.schema)
        merged = nothing.unionByName(staged, allowMissingColumns=True)
    version, _, rows_now = _write(
        merged,
        uri,
        state,
        schema=state.schema,
        partition_by=list(state.partition_by),
        append_to=state.full,
        replaced=touched,
    )
    return WriteResult(uri, version, _hash(source_rows, source_schema), rows_now)


def drop_versions(spark: SparkSession, root: str, name: str) -> int:
    """Delete what the table no longer reads: older overwrites and files that merges have replaced.

    Returns the number of folders and files deleted. No reader of an older version may be running.
    """
    uri = _uri(root, name)
    state = _state(spark, uri)
    if state.full is None:
        return 0
    old = [_full_folder(uri, n) for n in _numbers(spark, uri, "full=") if n < state.full]
    gone = [f"{uri}/{f}" for f in sorted(state.removed) if storage.exists(spark, f"{uri}/{f}")]
    for path in [*old, *gone]:
        storage.delete(spark, path)
    return len(old) + len(gone)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def cluster(df: DataFrame, columns: list[str]) -> DataFrame:
    """Range-partition and sort by ``columns``, so that file and row-group statistics of the
    first one serve point lookups.

    The ranges are cut on all of ``columns`` and then on a hash of the row's other columns (those with
    maps, which have no hash, left out), so the rows of one frequent first value spread over several files.
    """
    keys = [F.col(quoted(c)) for c in columns]
    hashed = [F.col(quoted(f.name)) for f in df.schema if not _has_map(f.dataType)]
    rest = [F.xxhash64(*hashed)] if hashed else []
    return df.repartitionByRange(*keys, *rest).sortWithinPartitions(*keys)


def write_clustered(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write parquet files clustered by ``columns``."""
    cluster(df, columns).write.mode("overwrite").option("compression", "snappy").parquet(path)


@dataclass(frozen=True)
class Finding:
    """Something wrong with a stored table: ``absent`` columns, ``null`` or ``repeated`` keys."""

    kind: str
    columns: tuple[str, ...]
    rows: int | None = None


@dataclass(frozen=True)
class TableReport:
    """State of a stored table; ``needs_cleanup`` if there is any finding."""

    name: str
    row_count: int
    columns: tuple[str, ...]
    findings: tuple[Finding, ...]

    @property
    def needs_cleanup(self) -> bool:
        return bool(self.findings)


def validate_asset(
    spark: SparkSession,
    root: str,
    name: str,
    *,
    key: str | list[str] | None = None,
    expected_columns: list[str] | None = None,
) -> TableReport:
    """Report on a stored table: its columns against those expected, and the health of a key.

    Without a key nothing but the table's note is read.
    """
    stored = read_table(spark, root, name)
    columns = tuple(stored.columns)
    wanted = dict.fromkeys([*(expected_columns or []), *(as_list(key) if key else [])])
    absent = tuple(c for c in wanted if c not in columns)
    findings = [Finding("absent", absent)] if absent else []
    if key is None:
        return TableReport(name, table_rows(spark, root, name), columns, tuple(findings))
    row = key_report(stored, key).first()
    findings += [Finding("null", (k,), n) for k, n in sorted((row.key_nulls or {}).items())]
    if row.key_duplicates:
        findings.append(Finding("repeated", tuple(as_list(key)), row.key_duplicates))
    return TableReport(name, row.row_count, columns, tuple(findings))
