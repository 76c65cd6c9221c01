"""A file layout that serves lookups by any of several columns: rows in the order of interleaved ranks."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmart.operators.profile import quoted

#: Bits of a column's rank; rows looked at to cut the ranks, about.
BITS, SAMPLE = 10, 50_000
#: Bits of an interleaved number.
MOST_BITS = 60


def rank_borders(df: DataFrame, columns: list[str], bits: int = BITS, sample: int = SAMPLE) -> list[list[str]]:
    """For each column ``2**bits - 1`` values, as text, that cut a sample of its rows into even parts; none if all are NULL.

    About ``sample`` rows come to the driver, however many there are. They decide the layout only, no row.
    """
    keys = df.select(
        *[F.struct(F.col(quoted(c)), F.col(quoted(c)).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)]
    )
    rows = df.count()
    drawn = keys.sample(min(1.0, sample / rows), seed=1).collect() if rows else []
    borders = []
    for i in range(len(columns)):
        values = sorted(tuple(r[i]) for r in drawn if r[i][0] is not None)
        parts = 2**bits
        borders.append([values[len(values) * k // parts][1] for k in range(1, parts)] if values else [])
    return borders


def rank(value: Column, borders: list[str], kind: str, bits: int = BITS) -> Column:
    """How many of the sorted borders are not above the value, by bisection; 0 for NULL."""
    if not borders:
        return F.lit(0)
    # one text that the optimizer turns into one literal, and not a thousand literals
    cuts = F.from_json(F.lit(json.dumps(borders)), "array<string>").cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(cuts, at + step - 1) <= value, step).otherwise(0)
    )


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """One BIGINT of the bits of all ranks in turn, the highest bits first."""
    number = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, of in enumerate(ranks):
            one = F.shiftright(of, bit).bitwiseAND(F.lit(1)).cast("bigint")
            number = number + F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - place)
    return number


def interleave(df: DataFrame, columns: list[str], *, files: int | None = None, bits: int = BITS) -> DataFrame:
    """Rows range-partitioned and sorted by the interleaved ranks of ``columns``.

    Every file then holds a narrow range of each column, so statistics prune files for a lookup by any of them,
    where an order by (a, b) prunes for a alone. Ranks are by quantiles, so skewed columns use all their bits,
    and the ranges are cut on a hash of the row too: a value that fills a third of the rows spreads over
    files. ``files`` partitions (Spark's number and AQE's joining by default).
    """
    if not columns or bits * len(columns) > MOST_BITS:
        raise ValueError(f"between 1 and {MOST_BITS // bits} columns")
    kinds = [df.select(F.col(quoted(c))).schema[0].dataType.simpleString() for c in columns]
    borders = rank_borders(df, columns, bits)
    ranks = [rank(F.col(quoted(c)), b, kind, bits) for c, b, kind in zip(columns, borders, kinds)]
    # all columns in one, so that the number's name clashes with none
    numbered = df.select(interleaved(ranks, bits).alias("number"), F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"))
    order = [F.col("number"), F.xxhash64(F.to_json("row"))]
    ranged = numbered.repartitionByRange(files, *order) if files else numbered.repartitionByRange(*order)
    keys = [F.col("row")[c] for c in columns]
    return ranged.sortWithinPartitions("number", *keys).select("row.*")


def write_interleaved(
    df: DataFrame,
    path: str,
    columns: list[str],
    *,
    bloom: list[str] | None = None,
    files: int | None = None,
    bits: int = BITS,
) -> None:
    """Write parquet files laid out by :func:`interleave`, with Bloom filters on the columns ``bloom``.

    Where a lookup of a single value meets files whose range holds it but not the value, the filter skips them.
    Parquet leaves it out where a file's values fit its dictionary, which then serves as the filter.
    """
    writer = interleave(df, columns, files=files, bits=bits).write.mode("overwrite").option("compression", "snappy")
    for column in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
