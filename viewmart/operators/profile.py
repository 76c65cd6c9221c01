"""Counts about a DataFrame, each in one aggregation: rows, NULLs, duplicates, size, tags."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes per value of the fixed-width types.
WIDTH = {
    "boolean": 1,
    "tinyint": 1,
    "smallint": 2,
    "int": 4,
    "bigint": 8,
    "float": 4,
    "double": 8,
    "date": 4,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def quoted(name: str) -> str:
    """A column name as Spark reads it whole, dots included."""
    return "`" + name.replace("`", "``") + "`"


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``rows``. On parquet this reads no column."""
    return df.agg(F.count("*").alias("rows"))


def unpivot_row(row: DataFrame, items: list[tuple[str, Column]], name: str, value: str) -> DataFrame:
    """A one-row DataFrame as ``name, value`` pairs."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name), v.alias(value)) for n, v in items])
    return row.select(F.inline(pairs))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, nulls`` for the given columns (all by default), in one pass."""
    columns = df.columns if columns is None else list(columns)
    counts = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    items = [(c, F.col(f"c{i}")) for i, c in enumerate(columns)]
    return unpivot_row(counts, items, "column", "nulls")


def key_counts(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row ``rows, distinct_keys, duplicates, nulls``; ``nulls`` maps each key column to its
    NULL count. NULLs count as one value of a key.

    Keys are counted per task before the one shuffle, so a key that fills a third of the
    table arrives as one row per task; all else is told from the distinct keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    copies, zero = F.col("__copies"), F.lit(0)
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("__copies"))
    nulls = [F.coalesce(F.sum(F.when(F.col(quoted(k)).isNull(), copies)), zero) for k in keys]
    pairs = [F.struct(F.lit(k).alias("key"), n.alias("nulls")) for k, n in zip(keys, nulls)]
    return per_key.agg(
        F.coalesce(F.sum(copies), zero).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(copies - 1), zero).alias("duplicates"),
        F.map_from_entries(F.array(*pairs)).alias("nulls"),
    )


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row ``rows, distinct_keys, duplicates``; NULLs count as one value."""
    return key_counts(df, key).select("rows", "distinct_keys", "duplicates")


def _size(column: Column, kind: T.DataType) -> Column:
    """Bytes of one value (0 if NULL): fixed widths, lengths of text, sums for nested types."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType):
        zero = F.lit(0).cast("bigint")
        size = F.aggregate(column, zero, lambda total, x: total + _size(x, kind.elementType))
        if kind.elementType.simpleString() in WIDTH:
            valid = F.size(column) if not kind.containsNull else F.size(F.array_compact(column))
            size = valid * WIDTH[kind.elementType.simpleString()]
    elif isinstance(kind, T.MapType):
        keys = T.ArrayType(kind.keyType, False)
        values = T.ArrayType(kind.valueType, kind.valueContainsNull)
        size = _size(F.map_keys(column), keys) + _size(F.map_values(column), values)
    elif isinstance(kind, T.StructType):
        size = reduce(add, [_size(column.getField(f.name), f.dataType) for f in kind], F.lit(0))
    elif isinstance(kind, T.DecimalType):
        size = F.lit(16)
    else:
        size = F.lit(WIDTH.get(kind.simpleString(), 8))
    return F.when(column.isNotNull(), size.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def profile(df: DataFrame) -> DataFrame:
    """``column, type, rows, nulls, bytes`` for every column, in one pass.

    ``bytes`` is the size of the values themselves, without offsets or compression.
    """
    aggregates = [F.count("*").alias("rows")]
    for i, field in enumerate(df.schema):
        column = F.col(quoted(field.name))
        aggregates.append(F.count_if(column.isNull()).alias(f"n{i}"))
        size = F.sum(_size(column, field.dataType))
        aggregates.append(F.coalesce(size, F.lit(0)).alias(f"b{i}"))
    counts = df.agg(*aggregates)
    described = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("rows").alias("rows"),
                F.col(f"n{i}").alias("nulls"),
                F.col(f"b{i}").alias("bytes"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.inline(described))


def tag(rows: Column, schema: T.StructType) -> Column:
    """First 16 hex digits of the md5 of row count and schema text."""
    return F.substring(F.md5(F.concat(rows.cast("string"), F.lit(schema.simpleString()))), 1, 16)


def _canonical(column: Column, kind: T.DataType) -> Column:
    """Value as text; maps as their entries in the order of keys, nested values as JSON."""
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)))
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(column)
    return column.cast("string")


def row_text(schema: T.StructType, present: list[str] | None = None) -> Column:
    """The row as one text: of each value its length, a colon and the value, or ``-`` for NULL.

    Rows differ in it wherever they differ, also where a NULL or a separator moves. Columns that are not
    among ``present`` are NULL.
    """
    parts = []
    for field in schema:
        if present is not None and field.name not in present:
            parts.append(F.lit("-"))
            continue
        text = _canonical(F.col(quoted(field.name)), field.dataType)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts) if parts else F.lit("")


def content_sum(schema: T.StructType, present: list[str] | None = None) -> Column:
    """Aggregate: the sum over all rows of the first 60 bits of the md5 of :func:`row_text`, 0 without rows.

    It does not depend on the order of rows, and those of two sets of rows add up to that of both.
    """
    digits = F.conv(F.substring(F.md5(row_text(schema, present)), 1, 15), 16, 10)
    return F.coalesce(F.sum(digits.cast("decimal(38,0)")), F.lit(0)).cast("string")


def fingerprint(df: DataFrame, *, content: bool = False) -> DataFrame:
    """One row: ``tag`` of row count and schema, a cheap sign of change.

    It cannot see edits that keep the row count. ``content`` adds ``content_hash``, see :func:`content_sum`.
    """
    columns = [tag(F.count("*"), df.schema).alias("tag")]
    if content:
        columns.append(content_sum(df.schema).alias("content_hash"))
    return df.agg(*columns)
