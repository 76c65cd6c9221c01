"""Raw assets: files addressed by (asset id, extension) under one base folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from viewmart.functions import storage

EXTENSION = {"parquet": "parquet", "json": "json", "csv": "csv", "text": "txt", "binary": "bin"}
CODEC_SUFFIX = {"gzip": "gz", "bzip2": "bz2"}


def asset_path(base: str, asset_id: str, extension: str) -> str:
    return f"{base.rstrip('/')}/{asset_id}.{extension}"


def _locate(spark: SparkSession, base: str, asset_id: str, extensions: list[str]) -> str:
    for extension in extensions:
        path = asset_path(base, asset_id, extension)
        if storage.exists(spark, path):
            return path
    raise FileNotFoundError(f"asset '{asset_id}' ({' or '.join(extensions)}) not found in {base}")


def read_asset(
    spark: SparkSession,
    base: str,
    asset_id: str,
    fmt: str = "parquet",
    *,
    extension: str | None = None,
    schema=None,
    **options,
) -> DataFrame:
    """One asset as a DataFrame: parquet, json, csv, text (``value``) or binary (``content``).

    JSON without an extension tries ``.json``, then ``.json.gz``. A single JSON file is
    taken as one document (an object or an array of them), a folder as JSON lines;
    pass ``multiLine`` to say otherwise. gzip and bzip2 are read by suffix.
    """
    if fmt not in EXTENSION:
        raise ValueError(f"unknown format '{fmt}'")
    if extension is None and fmt == "json":
        extensions = ["json", "json.gz"]
    else:
        extensions = [extension or EXTENSION[fmt]]
    path = _locate(spark, base, asset_id, extensions)
    if fmt == "json":
        options.setdefault("multiLine", not storage.is_directory(spark, path))
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format("binaryFile" if fmt == "binary" else fmt).load(path)


def write_asset(
    df: DataFrame,
    base: str,
    asset_id: str,
    fmt: str = "parquet",
    *,
    extension: str | None = None,
    compression: str | None = None,
    **options,
) -> str:
    """Write an asset, replacing one of the same name; returns its path.

    parquet is snappy by default. json, csv and text take ``gzip`` or ``bzip2``, which
    is added to the extension (``json.gz``). binary takes one row, whose ``content`` becomes
    a single file.
    """
    if fmt == "binary":
        path = asset_path(base, asset_id, extension or EXTENSION[fmt])
        rows = df.select("content").limit(2).collect()  # a file is one value
        if len(rows) != 1 or rows[0].content is None:
            raise ValueError("a binary asset is one row with content")
        storage.write_bytes(df.sparkSession, path, bytes(rows[0].content))
        return path
    if fmt not in ("parquet", "json", "csv", "text"):
        raise ValueError(f"cannot write format '{fmt}'")
    if fmt == "parquet":
        extension, compression = extension or "parquet", compression or "snappy"
    elif extension is None:
        suffix = CODEC_SUFFIX.get(compression)
        extension = f"{EXTENSION[fmt]}.{suffix}" if suffix else EXTENSION[fmt]
    if fmt in ("json", "csv"):  # Spark would cut microseconds off
        options.setdefault("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        options.setdefault("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if compression:
        options["compression"] = compression
    path = asset_path(base, asset_id, extension)
    df.write.mode("overwrite").options(**options).format(fmt).save(path)
    return path


def write_files(df: DataFrame, base: str, asset_id: str, *, extension: str = "bin") -> str:
    """Write an asset as a folder with one file per row (``name``, ``content``); returns its path.

    Each file is written by the task that holds its row, so no value reaches the driver. The folder must lie on
    a file system that all executors mount (no scheme, or ``file``). Names are plain and differ, or it raises; the
    files become visible together, and if a task fails the old asset stays.
    Empty values become empty files, which Spark's ``binaryFile`` does not list.
    """
    spark, path = df.sparkSession, asset_path(base, asset_id, extension)
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"files of single rows need a mounted file system, not '{parts.scheme}'")
    folder = storage.absolute(spark, path)
    made = f"{folder}.{uuid.uuid4().hex}.draft"
    os.makedirs(made)

    def write(rows: Iterator[Row]) -> Iterator[int]:
        for row in rows:
            if row.content is None or not row.name or row.name[0] in "_." or "/" in row.name:
                raise ValueError(f"no file can be written for the name {row.name!r}")
            draft = f"{made}/.{uuid.uuid4().hex}"
            with open(draft, "wb") as file:
                file.write(row.content)
            os.replace(draft, f"{made}/{row.name}")
            yield 1

    try:
        rows = df.select("name", F.col("content").cast("binary").alias("content")).rdd.mapPartitions(write).sum()
        files = sum(1 for x in os.scandir(made) if x.name[0] != ".")
        if rows != files:
            raise ValueError(f"{rows} rows gave {files} files: names are not unique")
        storage.delete(spark, path)
        os.replace(made, folder)
    except BaseException:
        storage.delete(spark, made)
        raise
    return path


def raw(spark: SparkSession, base: str, assets: str | list[str]) -> DataFrame:
    """One or several parquet assets of the same columns as one DataFrame."""
    names = [assets] if isinstance(assets, str) else list(assets)
    return spark.read.parquet(*[asset_path(base, name, "parquet") for name in names])


def register_assets(spark: SparkSession, base: str, views: dict[str, str | list[str]]) -> None:
    """Make parquet assets queryable by name in ``spark.sql``: ``{view: asset or assets}``."""
    for view, assets in views.items():
        raw(spark, base, assets).createOrReplaceTempView(view)


def list_assets(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """Files whose path relative to ``base`` matches a glob, sorted: ``name, modified, length``.

    A folder that matches stands for the files in it. Only the listing is read; the
    content column is pruned.
    """
    root = base.rstrip("/")
    if not storage.any_match(spark, f"{root}/{pattern}"):
        return spark.createDataFrame([], "name string, modified timestamp, length bigint")
    prefix = storage.absolute(spark, root).rstrip("/") + "/"
    path = F.regexp_replace("path", "^[a-zA-Z0-9+.-]+:(//[^/]*)?", "")
    found = spark.read.format("binaryFile").load(f"{root}/{pattern}")
    return found.select(
        F.substring(path, len(prefix) + 1, F.length(path)).alias("name"),
        F.col("modificationTime").alias("modified"),
        "length",
    ).orderBy("name")


def fresh_assets(spark: SparkSession, base: str, pattern: str, max_age_days: float | None = None) -> DataFrame:
    """Files as in :func:`list_assets`, younger than ``max_age_days`` where that is given."""
    found = list_assets(spark, base, pattern)
    if max_age_days is None:
        return found
    age = F.unix_micros(F.current_timestamp()) - F.unix_micros("modified")
    return found.where(age < F.lit(int(max_age_days * 86_400_000_000)))


def asset_exists(
    spark: SparkSession,
    base: str,
    asset_id: str,
    extension: str = "parquet",
    *,
    max_age_days: float | None = None,
) -> bool:
    """True if the asset is there and, where asked, younger than ``max_age_days``."""
    path = asset_path(base, asset_id, extension)
    if not storage.exists(spark, path):
        return False
    if max_age_days is None:
        return True
    inner = f"{asset_id}.{extension}" + ("/part-*" if storage.is_directory(spark, path) else "")
    return not fresh_assets(spark, base, inner, max_age_days).isEmpty()


def delete_asset(spark: SparkSession, base: str, asset_id: str, extension: str = "parquet") -> None:
    """Remove an asset; nothing happens if it is absent."""
    storage.delete(spark, asset_path(base, asset_id, extension))
