"""Data-quality checks. Any number of column checks runs as one aggregation.

A check names a column and a predicate for a bad value; NULL is never bad. Patterns follow
Python's ``re.match``: anchored at the start, ``\\d`` and ``\\s`` know Unicode, ``$`` also fits
before a final newline. Lengths and patterns of values that are no text see Spark's text of them (a large
DOUBLE as ``1.2345678E7``); give a column of text to have it otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewmart.operators.profile import duplicate_keys, key_counts, quoted

# The accepted shapes of dates kept as text.
YEAR = r"^\d{4}$"
QUARTER = r"^\d{4}-Q[1-4]$"
MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"
WEEK = r"^\d{4}-W(0[1-9]|[1-4]\d|5[0-3])$"
DATE = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"
ANY_DATE = [YEAR, QUARTER, MONTH, WEEK, DATE]

SAMPLES = 5


@dataclass(frozen=True)
class Check:
    """A predicate that is true for a bad value of ``column``."""

    name: str
    column: str
    bad: Column


def _fits(column: str, pattern: str) -> Column:
    return F.col(quoted(column)).cast("string").rlike(f"(?dU)^(?:{pattern})")


def _length(column: str) -> Column:
    return F.length(F.col(quoted(column)).cast("string"))


def valid_year(column: str) -> Check:
    """``YYYY``"""
    return Check("valid_year", column, ~_fits(column, YEAR))


def valid_quarter(column: str) -> Check:
    """``YYYY-QN``"""
    return Check("valid_quarter", column, ~_fits(column, QUARTER))


def valid_month(column: str) -> Check:
    """``YYYY-MM``"""
    return Check("valid_month", column, ~_fits(column, MONTH))


def valid_week(column: str) -> Check:
    """``YYYY-WNN``, weeks 01 to 53"""
    return Check("valid_week", column, ~_fits(column, WEEK))


def valid_date(column: str) -> Check:
    """``YYYY-MM-DD`` by shape: the 31st of February passes."""
    return Check("valid_date", column, ~_fits(column, DATE))


def valid_date_any(column: str) -> Check:
    """Any of year, quarter, month, week and date."""
    return Check("valid_date_any", column, ~_fits(column, "|".join(ANY_DATE)))


def max_length(column: str, length: int) -> Check:
    """At most ``length`` characters (code points)."""
    return Check("max_length", column, _length(column) > length)


def min_length(column: str, length: int) -> Check:
    return Check("min_length", column, _length(column) < length)


def exact_length(column: str, length: int) -> Check:
    return Check("exact_length", column, _length(column) != length)


def matches_pattern(column: str, pattern: str, description: str | None = None) -> Check:
    """The value starts with a match of ``pattern``."""
    return Check(description or "matches_pattern", column, ~_fits(column, pattern))


def in_set(column: str, values) -> Check:
    """One of a short list of values; for a long list use :func:`not_in_table`.

    NULL is never bad, so a NULL in the list says nothing.
    """
    return Check("in_set", column, ~F.col(quoted(column)).isin(*[v for v in values if v is not None]))


def positive(column: str, allow_zero: bool = True) -> Check:
    value = F.col(quoted(column))
    return Check("positive", column, value < 0 if allow_zero else value <= 0)


def in_range(column: str, low: float | None = None, high: float | None = None) -> Check:
    """Within the bounds, both included; NaN passes."""
    value, bad = F.col(quoted(column)), F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | ((value > high) & ~F.isnan(value.cast("double")))
    return Check("in_range", column, bad)


def percentage(column: str) -> Check:
    """From 0 to 100."""
    return Check("percentage", column, in_range(column, 0, 100).bad)


def violations(df: DataFrame, checks: list[Check], samples: int = SAMPLES) -> DataFrame:
    """One row per check, ``check, column, bad_rows, sample``, from one pass over ``df``.

    ``sample`` holds up to ``samples`` different bad values: the least one of each hash
    class, so the state per task stays at that many values and re-runs give the same.
    """
    # NULL is never bad, so the bad values themselves tell their number.
    bad = df.select(
        [F.when(c.bad, F.col(quoted(c.column)).cast("string")).alias(f"v{i}") for i, c in enumerate(checks)]
    )
    aggregates = [F.count(f"v{i}").alias(f"n{i}") for i in range(len(checks))]
    if samples:
        slots = [F.when(F.col(v).isNotNull(), F.pmod(F.xxhash64(v), F.lit(samples))) for v in bad.columns]
        bad = bad.select("*", *[slot.alias(f"h{i}") for i, slot in enumerate(slots)])
        aggregates += [
            F.min(F.when(F.col(f"h{i}") == j, F.col(f"v{i}"))).alias(f"s{i}_{j}")
            for i in range(len(checks))
            for j in range(samples)
        ]
    counts = bad.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.column).alias("column"),
                F.col(f"n{i}").alias("bad_rows"),
                F.array_compact(
                    F.array(*[F.col(f"s{i}_{j}") for j in range(samples)]).cast("array<string>")
                ).alias("sample"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


def expect(df: DataFrame, checks: list[Check]) -> None:
    """Raise AssertionError naming every check that fails, with sample values."""
    failed = violations(df, checks).where(F.col("bad_rows") > 0).collect()  # one row per check
    if failed:
        lines = [f"column '{r.column}' fails {r.check}: {r.bad_rows} rows, e.g. {r.sample}" for r in failed]
        raise AssertionError("; ".join(lines))


def not_in_table(df: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """One row ``check, column, bad_rows``: values absent from the first column of ``allowed``.

    Values are counted before the join, so a frequent one is joined once.
    """
    counts = df.where(F.col(quoted(column)).isNotNull()).groupBy(F.col(quoted(column)).alias("value"))
    known = allowed.select(F.col(quoted(allowed.columns[0])).alias("value")).distinct()
    foreign = counts.agg(F.count("*").alias("rows")).join(known, "value", "left_anti")
    return foreign.agg(
        F.lit("in_set").alias("check"),
        F.lit(column).alias("column"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("bad_rows"),
    )


def arrow_name(kind: T.DataType) -> str:
    """Name of a Spark type in Arrow's terms, for type checks by substring."""
    if isinstance(kind, T.DecimalType):
        return f"decimal128({kind.precision}, {kind.scale})"
    if isinstance(kind, T.ArrayType):
        return f"list<element: {arrow_name(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{arrow_name(kind.keyType)}, {arrow_name(kind.valueType)}>"
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{f.name}: {arrow_name(f.dataType)}" for f in kind) + ">"
    # Arrow's names of the plain types.
    names = {
        "tinyint": "int8",
        "smallint": "int16",
        "int": "int32",
        "bigint": "int64",
        "float": "float",
        "double": "double",
        "string": "string",
        "binary": "binary",
        "boolean": "bool",
        "date": "date32[day]",
        "timestamp": "timestamp[us, tz=UTC]",
        "timestamp_ntz": "timestamp[us]",
        "void": "null",
    }
    return names.get(kind.simpleString(), kind.simpleString())


def _unique(spec: dict[str, Any]) -> list[str]:
    unique = spec.get("unique") or []
    return [unique] if isinstance(unique, str) else list(unique)


def contract_measures(schema: T.StructType, spec: dict[str, Any]) -> dict[str, Column]:
    """Aggregates that tell the parts of a contract about rows and NULLs, by name."""
    measures = {}
    if spec.get("min_rows") or spec.get("max_rows") is not None:
        measures["rows"] = F.count("*")
    for i, name in enumerate(spec.get("not_null") or []):
        if name in schema.names:
            measures[f"nulls{i}"] = F.count_if(F.col(quoted(name)).isNull())
    return measures


def contract_report(counts: DataFrame, schema: T.StructType, spec: dict[str, Any]) -> DataFrame:
    """The parts of a contract but uniqueness, as in :func:`validation`, from one row of :func:`contract_measures`."""
    present, types = set(schema.names), {f.name: arrow_name(f.dataType) for f in schema}
    literal = F.array().cast("array<struct<check:string,subject:string,actual:string,ok:boolean>>")
    lines = []
    if spec.get("min_rows"):
        lines.append(_line("min_rows", str(spec["min_rows"]), F.col("rows"), F.col("rows") >= spec["min_rows"]))
    if spec.get("max_rows") is not None:
        lines.append(_line("max_rows", str(spec["max_rows"]), F.col("rows"), F.col("rows") <= spec["max_rows"]))
    for name, expected in (spec.get("columns") or {}).items():
        actual = types.get(name)
        lines.append(_line("column", name, actual or "missing", actual is not None and expected in actual))
    for i, name in enumerate(spec.get("not_null") or []):
        if name not in present:
            lines.append(_line("not_null", name, "missing", False))
            continue
        lines.append(_line("not_null", name, F.col(f"nulls{i}"), F.col(f"nulls{i}") == 0))
    unique = _unique(spec)
    if any(k not in present for k in unique):
        lines.append(_line("unique", ", ".join(unique), "missing", False))
    return counts.select(F.inline(F.concat(literal, F.array(*lines)) if lines else literal))


def _line(check: str, subject: str, actual, ok) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(subject).alias("subject"),
        (actual if isinstance(actual, Column) else F.lit(actual)).cast("string").alias("actual"),
        (ok if isinstance(ok, Column) else F.lit(ok)).alias("ok"),
    )


def validation(df: DataFrame, spec: dict[str, Any]) -> DataFrame:
    """A table contract as rows ``check, subject, actual, ok``.

    ``spec`` may hold ``columns`` ({name: part of the Arrow type name}), ``not_null``, ``unique``
    (a name or a list, composite), ``min_rows`` and ``max_rows``. A missing column that is to
    be non-null or unique fails its check. Rows and NULLs take one pass, uniqueness another.
    """
    measures = contract_measures(df.schema, spec)
    counts = df.agg(*[m.alias(n) for n, m in measures.items()]) if measures else df.sparkSession.range(1)
    report = contract_report(counts, df.schema, spec)
    unique = _unique(spec)
    if unique and set(unique) <= set(df.columns):
        twice = F.col("duplicates")
        key_line = F.array(_line("unique", ", ".join(unique), twice, twice == 0))
        report = report.unionByName(duplicate_keys(df, unique).select(F.inline(key_line)))
    return report


def validate(df: DataFrame, spec: dict[str, Any]) -> None:
    """Raise AssertionError for the parts of the contract that do not hold."""
    raise_failed(validation(df, spec))


def raise_failed(report: DataFrame) -> None:
    """Raise AssertionError for the rows of a report that are not ok."""
    failed = report.where(~F.col("ok")).collect()  # a few rows
    if failed:
        lines = [f"{r.check} {r.subject}: got {r.actual}" for r in failed]
        raise AssertionError("; ".join(lines))


def key_report(df: DataFrame, key: str | list[str], expected_columns: list[str] | None = None) -> DataFrame:
    """Health of a keyed table as one row.

    ``row_count``; ``missing`` (expected or key columns that are absent); ``key_nulls``
    (key column to NULL count, only where above 0); ``key_duplicates``; ``needs_cleanup``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    missing = [c for c in dict.fromkeys([*(expected_columns or []), *keys]) if c not in df.columns]
    absent = F.lit(", ".join(missing)) if missing else F.lit(None).cast("string")
    if any(k not in df.columns for k in keys):
        no_nulls = F.create_map().cast("map<string,bigint>")
        return df.agg(F.count("*").alias("row_count")).select(
            "row_count",
            absent.alias("missing"),
            no_nulls.alias("key_nulls"),
            F.lit(None).cast("bigint").alias("key_duplicates"),
            F.lit(True).alias("needs_cleanup"),
        )
    key_nulls = F.map_filter("nulls", lambda _, n: n > 0)
    bad = (F.size(key_nulls) > 0) | (F.col("duplicates") > 0)
    return key_counts(df, keys).select(
        F.col("rows").alias("row_count"),
        absent.alias("missing"),
        key_nulls.alias("key_nulls"),
        F.col("duplicates").alias("key_duplicates"),
        (F.lit(bool(missing)) | bad).alias("needs_cleanup"),
    )
