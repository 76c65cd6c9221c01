"""Upsert and append of rows, as DataFrames; :mod:`viewmart.sources.tables` stores them."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewmart.operators.profile import key_counts, quoted

HIT = "__hit"


def as_list(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_problems(source: DataFrame, key: str | list[str]) -> DataFrame:
    """What forbids ``key`` as a merge key: ``problem, key, rows``, no row if all is well.

    Missing columns are told from the schema alone; otherwise NULLs are counted per
    key column and duplicate combinations over all of them.
    """
    keys = as_list(key)
    missing = [k for k in keys if k not in source.columns]
    if missing:
        rows = [("missing", k, None) for k in missing]
        return source.sparkSession.createDataFrame(rows, "problem string, key string, rows bigint")
    counts = key_counts(source, keys)
    lines = [("null", k, F.col("nulls")[k]) for k in keys]
    lines.append(("duplicate", ", ".join(keys), F.col("duplicates")))
    found = F.array(
        *[
            F.struct(F.lit(p).alias("problem"), F.lit(k).alias("key"), n.alias("rows"))
            for p, k, n in lines
        ]
    )
    return counts.select(F.inline(found)).where(F.col("rows") > 0)


def check_keys(source: DataFrame, key: str | list[str], name: str = "source") -> int:
    """Rows of ``source``; raises ValueError with all of :func:`key_problems` at once if there are any.

    An empty source is fine, whatever its columns.
    """
    keys = as_list(key)
    if not set(keys) <= set(source.columns):
        rows = 0 if source.isEmpty() else None
        counts = {}
        lines = [("missing", k, None) for k in keys if k not in source.columns] if rows is None else []
    else:
        counts = key_counts(source, keys).first()
        rows = counts.rows
        lines = [("null", k, n) for k, n in counts.nulls.items() if n]
        lines += [("duplicate", ", ".join(keys), counts.duplicates)] if counts.duplicates else []
    if lines:
        found = "; ".join(f"{problem} {k}" + (f" ({n} rows)" if n else "") for problem, k, n in lines)
        raise ValueError(f"{name} can't be merged by {', '.join(keys)}: {found}")
    return rows


def _widens(old: T.DataType, new: T.DataType) -> bool:
    """True for numbers whose every value the other type holds."""
    # Digits that hold every value of an integer type.
    digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
    a, b = old.simpleString(), new.simpleString()
    if a in digits and b in digits:
        return digits[a] <= digits[b]
    if isinstance(new, T.DecimalType):
        whole = new.precision - new.scale
        if a in digits:
            return digits[a] <= whole
        return isinstance(old, T.DecimalType) and old.precision - old.scale <= whole and old.scale <= new.scale
    return (a, b) in {("float", "double"), ("int", "double"), ("smallint", "double"), ("tinyint", "double"),
                      ("void", b)}


def conform(source: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``source`` that ``schema`` names, in the types it gives them.

    A value that does not come back when it is cast back, such as 1.9 or ``' 1'`` for a BIGINT, fails
    the job in any ANSI mode. Types that only become wider are cast as they are.
    """
    types = {f.name: f.dataType for f in schema}
    given = {f.name: f.dataType for f in source.schema}

    def column(name: str) -> Column:
        value = F.col(quoted(name))
        if name not in types or types[name] == given[name]:
            return value
        old, new = given[name], types[name]
        if _widens(old, new):
            return value.cast(new).alias(name)
        as_new = value.try_cast(new.simpleString())
        same = as_new.try_cast(old.simpleString()).eqNullSafe(value)
        problem = F.concat(
            F.lit(f"{name}: {old.simpleString()} does not fit {new.simpleString()}: "),
            F.coalesce(value.cast("string"), F.lit("")),
        )
        return F.when(same, as_new).otherwise(F.raise_error(problem).cast(new)).alias(name)

    return source.select([column(c) for c in source.columns])


def clashing_updates(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur several times in ``source`` and also in ``target``: which source row
    should win is undefined."""
    keys = as_list(key)
    names = [quoted(k) for k in keys]
    several = source.groupBy(*names).agg(F.count("*").alias("__rows")).where(F.col("__rows") > 1)
    known = target.select(*[F.col(n).alias(f"__k{i}") for i, n in enumerate(names)]).distinct()
    same = reduce(and_, [F.col(n) == F.col(f"__k{i}") for i, n in enumerate(names)])
    return several.join(known, same, "left_semi")


def merge_rows(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Upsert: rows of ``source`` update the target rows with an equal key, others are added.

    An update takes every source column, NULLs too; columns only the target has keep
    their value, and are NULL in added rows. NULL keys equal nothing, so they are added.
    ``source`` must hold a key at most once.

    Built as a left join for the kept side and an anti join for the added rows rather
    than one full outer join: a small source can then be broadcast (Spark decides by
    size), so the target is not shuffled, and AQE can split hot or NULL keys of the target.
    """
    keys = as_list(key)
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    kept, added = merged_parts(target, conform(source, target.schema), keys)
    return kept.unionByName(added, allowMissingColumns=True)


def merged_parts(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Target rows with their updates, and source rows without a target row; types are equal already."""
    fresh = {c: f"__new_{i}" for i, c in enumerate(source.columns)}
    updates = source.select(*[F.col(quoted(c)).alias(n) for c, n in fresh.items()], F.lit(True).alias(HIT))
    same_key = reduce(and_, [F.col(quoted(k)) == F.col(fresh[k]) for k in keys])
    joined = target.join(updates, same_key, "left")
    kept = joined.select(
        [
            F.when(F.col(HIT), F.col(fresh[c])).otherwise(F.col(quoted(c))).alias(c)
            if c in fresh
            else F.col(quoted(c))
            for c in target.columns
        ]
    )
    known = target.select(*[F.col(quoted(k)).alias(f"__k{i}") for i, k in enumerate(keys)])
    in_target = reduce(and_, [F.col(quoted(k)) == F.col(f"__k{i}") for i, k in enumerate(keys)])
    return kept, source.join(known, in_target, "left_anti")


def append_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both; a column one side lacks is NULL there. No deduplication."""
    return target.unionByName(conform(source, target.schema), allowMissingColumns=True)
