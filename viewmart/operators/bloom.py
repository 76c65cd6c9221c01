"""A Bloom filter made by an aggregation and tested by column functions, to thin rows before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each expected value, and bounds of the filter's size: a word of 64 bits to 8 MB.
BITS_A_VALUE = 12
LEAST_BITS, MOST_BITS = 1 << 6, 1 << 26


def filter_bits(n: int) -> int:
    """Bits of a filter for ``n`` values: a power of two within the bounds."""
    wanted = max(LEAST_BITS, min(MOST_BITS, BITS_A_VALUE * max(1, n)))
    return 1 << (wanted - 1).bit_length()


def _places(value: Column, bits: int) -> list[Column]:
    """Four places of a value, cut out of two hashes of 64 bits."""
    low, high = F.xxhash64(value), F.xxhash64(value, F.lit(1))
    mask = F.lit(bits - 1).cast("bigint")
    return [h.bitwiseAND(mask) for h in (low, F.shiftrightunsigned(low, 32), high, F.shiftrightunsigned(high, 32))]


def bloom_filter(values: DataFrame, column: str, n: int) -> DataFrame:
    """One row ``words``: the bits of about ``n`` values, 64 to a word. 8 MB at most, however many values there are."""
    bits = filter_bits(n)
    place = F.explode(F.array(*_places(F.col(column), bits))).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    set_ = values.select(place).select(F.shiftright("place", 6).alias("word"), bit.alias("bits"))
    every = values.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = set_.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("words"))


def might_hold(words: Column, value: Column, n: int) -> Column:
    """False only if ``value`` is not among the values of the filter made with the same ``n``."""
    held = F.lit(True)
    for place in _places(value, filter_bits(n)):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        held = held & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return held


def thinned(rows: DataFrame, column: str, values: DataFrame, n: int) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not among the ``n`` or so values of the same column
    of ``values``; none that is goes. The filter stands before any shuffle of ``rows``."""
    words = bloom_filter(values, column, n).scalar()
    return rows.where(might_hold(words, F.col(column), n))
