"""Line dedup by a suffix array over line-ID sequences.

The lines with a word of each document are its sequence. Prefix doubling ranks the suffixes: level 0
ranks lines, level k + 1 ranks pairs of level-k ranks that lie 2**k lines apart, so the rank of level
k orders suffixes by their first 2**k lines. Each level is one distributed count of pairs, one sort
of the distinct repeated pairs, and one join back. Suffixes whose prefix occurs once leave at once, so the
rows carried on are those of repeated text only.

Suffixes that share their first m lines are neighbours in the suffix array, an interval whose longest
common prefixes are m or more. Two overlapping ranks of level log2(m), at its start and at its end, name it. At
each suffix the interval looked at is the shallowest that holds ``min_words`` words, and the same
is done for the sequences read backwards; every repeated run of that many words is the union of
such windows, so the maximal runs come out whole whatever their length. Each word-bearing line has
a word or more, so m is at most ``min_words`` and log2(min_words) levels are enough.

In each interval the first suffix, by document id and place, stays. The windows of the others are later
copies; their lines are deleted.

Only DataFrame functions are used. The ranks of a level are written to the shared scratch folder.

Defined results: null and empty texts have no lines; lines without a word are neither counted
nor deleted; rows of equal ``doc_id`` and text are one document and get the same result; a null ``doc_id``
comes first in the order; equal ids with other texts are ordered by a hash of the text; an empty table
gives no rows; other columns of the input are kept by ``deduplicated`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewmart.llm.common import materialised, unused, words
from viewmart.llm.quality_lines import without_lines

#: Words that a repeated run must hold to be deleted.
MIN_WORDS = 50

#: Key of a document without nulls, in the order of documents.
DOC = ["has_id", "id", "text_key"]


def _keyed(docs: DataFrame) -> list[Column]:
    nothing = F.lit(0).cast(docs.schema["doc_id"].dataType)
    return [
        F.col("doc_id").isNotNull().alias("has_id"),
        F.coalesce("doc_id", nothing).alias("id"),
        F.xxhash64("text").alias("text_key"),
    ]


def _reach(start: Column, limit: int, step: int) -> Column:
    """Lines from ``start`` on (step 1) or back (step -1) that hold ``limit`` words; null if too few."""
    size = F.size("found")
    return F.aggregate(
        F.sequence(F.lit(0), F.least(F.lit(limit - 1), size - 1 - start if step > 0 else start)),
        F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).alias("lines")),
        lambda acc, k: F.when(acc["words"] >= limit, acc).otherwise(
            F.struct(
                (acc["words"] + F.get("found", start + step * k)["words"]).alias("words"),
                (acc["lines"] + 1).alias("lines"),
            )
        ),
        lambda acc: F.when(acc["words"] >= limit, acc["lines"]),
    )


def _hashed_lines(docs: DataFrame, *more: Callable[[Column], Column]) -> DataFrame:
    """The document's key and found: an array of the lines with a word as (line, a, b, further fields)."""
    found = F.filter(
        F.transform(
            F.split(F.coalesce("text", F.lit("")), "\n"),
            lambda x, i: F.struct(i.alias("line"), x.alias("x")),
        ),
        lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"),
    )
    fields = lambda s: F.struct(
        s["line"].alias("line"),
        F.xxhash64(s["x"]).alias("a"),
        F.xxhash64(F.lit(10), s["x"]).alias("b"),
        *[field(s["x"]) for field in more],
    )
    return docs.select(*_keyed(docs), F.transform(found, fields).alias("found"))


def line_hashes(docs: DataFrame) -> DataFrame:
    """a, b of every line with a word."""
    return (
        _hashed_lines(docs)
        .select(F.explode_outer("found").alias("s"))
        .where("s is not null")
        .select("s.a", "s.b")
    )


def sequence_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line with a word: the document's key, pos, line, words, a, b, ahead, back.

    ``pos`` is the place in the sequence, ``line`` among all lines of the text; (a, b) is the line's
    hash; ``ahead`` and ``back`` are the lines that the window of ``min_words`` words takes from here.
    """
    rows = _hashed_lines(docs, lambda x: F.size(words(x)).cast("bigint").alias("words"))
    rows = rows.withColumn(
        "found",
        F.transform(
            "found",
            lambda s, i: F.struct(
                s["line"].alias("line"),
                s["words"].alias("words"),
                s["a"].alias("a"),
                s["b"].alias("b"),
                _reach(i, min_words, 1).alias("ahead"),
                _reach(i, min_words, -1).alias("back"),
            ),
        ),
    )
    # of an inner explode the optimizer derives a filter that computes the whole array once more
    return (
        rows.select(*DOC, F.posexplode_outer("found").alias("pos", "s"))
        .where("pos is not null")
        .select(*DOC, "pos", "s.*")
    )


def _ranked(pairs: DataFrame, columns: list[str], rank: str) -> DataFrame:
    """The combinations of ``columns`` that occur twice or more, with a rank in their order."""
    repeated = (
        pairs.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
        .orderBy(*columns)
        .withColumn(rank, F.monotonically_increasing_id())
    )
    return materialised(repeated, f"suffix-{rank}")


def suffix_ranks(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, int]:
    """Suffixes that start with a repeated line, with ranks r0, r1, ...; and the number of levels.

    ``rk`` orders suffixes by their first 2**k lines; null where these lines occur once or the document
    ends before.
    """
    lines = sequence_lines(docs, min_words)
    first = _ranked(line_hashes(docs), ["a", "b"], "r0")
    # a repeated row of the input repeats its lines: they count once
    suffixes = materialised(
        lines.join(first, ["a", "b"])
        .drop("a", "b")
        .repartition(*DOC)
        .dropDuplicates([*DOC, "pos"]),
        "suffixes-0",
    )
    level = 0
    while 2 ** (level + 1) <= min_words:
        here, apart = f"r{level}", 2**level
        order = Window.partitionBy(*DOC).orderBy("pos").rangeBetween(apart, apart)
        shifted = suffixes.withColumn("next", F.first(here).over(order))
        pairs = _ranked(
            shifted.where(F.col(here).isNotNull() & F.col("next").isNotNull()).select(here, "next"),
            [here, "next"],
            f"r{level + 1}",
        )
        if pairs.isEmpty():
            break
        suffixes = materialised(
            shifted.join(pairs, [here, "next"], "left").drop("next"), f"suffixes-{level + 1}"
        )
        level += 1
    return suffixes, level + 1


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_key, lines: sorted numbers of the lines that lie in later copies of a run."""
    suffixes, levels = suffix_ranks(docs, min_words)
    ranks = [F.col(f"r{k}") for k in range(levels)]
    level = F.floor(F.log2(F.col("m"))).cast("int")

    def at_level(frame: DataFrame, name: str) -> DataFrame:
        chosen = reduce(
            lambda rest, k: F.when(F.col("level") == k, ranks[k]).otherwise(rest),
            range(levels),
            F.lit(None).cast("bigint"),
        )
        return frame.withColumn(name, chosen)

    # windows read forwards start here, those read backwards end here
    ends = suffixes.select(
        *DOC,
        F.col("pos").alias("place"),
        *[f"r{k}" for k in range(levels)],
        F.explode(
            F.array(
                F.struct(F.col("pos").alias("start"), F.col("ahead").alias("m")),
                F.struct((F.col("pos") - F.col("back") + 1).alias("start"), F.col("back").alias("m")),
            )
        ).alias("w"),
    ).select("*", "w.*").where("m is not null").withColumn("level", level)
    # A window needs the rank at its start and, for its last 2**level lines, the rank where these start.
    windows = ends.select(*DOC, "start", "m", "level").distinct()
    start = at_level(
        windows.join(
            suffixes.withColumnRenamed("pos", "start").drop("line", "words", "ahead", "back"),
            [*DOC, "start"],
        ),
        "head",
    ).select(*DOC, "start", "m", "level", "head")
    whole = at_level(
        start.where("head is not null")
        .withColumn("pos", (F.col("start") + F.col("m") - F.expr("shiftleft(1, level)")).cast("int"))
        .join(suffixes.drop("line", "words", "ahead", "back"), [*DOC, "pos"]),
        "tail",
    ).select(*DOC, "start", "m", "head", "tail").where("tail is not null")
    intervals = whole.groupBy("m", "head", "tail").agg(
        F.min(F.struct(*DOC, "start")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n")
    # a key of its own: only a join that shuffles both sides for itself is split by AQE where one run is everywhere
    run = F.concat_ws(":", "m", "head", "tail").alias("run")
    copies = whole.select(*DOC, "start", "m", run).join(intervals.select(run, "first"), "run").where(
        F.struct(*DOC, "start") != F.col("first")
    )
    covered = copies.select(
        *DOC, F.explode(F.sequence(F.col("start"), (F.col("start") + F.col("m") - 1).cast("int"))).alias("pos")
    ).distinct()
    return (
        covered.join(suffixes.select(*DOC, "pos", "line"), [*DOC, "pos"])
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
        .select(F.expr("if(has_id, id, null)").alias("doc_id"), "text_key", "lines")
    )


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines of later copies; ``n_chars``, if there, is counted anew.

    Documents that lose every line with a word are left out; all columns are kept.
    """
    key, doc_id, text_key, lines = unused(docs, "__key", "__doc_id", "__text_key", "__lines")
    copies = later_copies(docs, min_words).select(
        F.col("doc_id").alias(doc_id), F.col("text_key").alias(text_key), F.col("lines").alias(lines)
    )
    joined = docs.withColumn(key, F.xxhash64("text")).join(
        copies,
        F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(key) == F.col(text_key)),
        "left",
    )
    emptied = F.col(lines).isNotNull() & ~F.coalesce(
        F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)
    )
    return without_lines(joined, lines).where(~emptied).select(docs.columns)
