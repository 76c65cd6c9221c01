"""Quality rules by cross-document line frequency.

Lines are normalised and hashed; per host (``source``) the distinct documents that hold a line are
counted. A line in more documents than the limits allow is boilerplate of that host and is removed.
A document that keeps too few of its words is depleted and rejected. A few rules on single texts
(too short, repeating itself) come first.

Copies of one document are no evidence that its lines are boilerplate. So documents are told apart by the
hash of their whole text, for the count of a line and for the count of its host alike: copies are one
document, and documents that differ anywhere are two, whatever lines they share.

Only DataFrame functions are used. Text is never shuffled for the verdict: rows of line hashes
are, after counts were joined per task.

Defined results: null text has no words (rejected); a null host is a host of its own; rows of equal
``doc_id`` and text are one document and get the same verdict; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmart.llm.common import SPACES, unused, words

#: A line is boilerplate when more distinct documents of its host hold it than both limits say.
MAX_DOCUMENTS = 20
MAX_SHARE = 0.01
#: A document is depleted when fewer words, or a smaller share of its words, are left.
MIN_WORDS_LEFT = 5
MIN_SHARE_LEFT = 0.25
#: Rules on single texts.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    One row per row of ``docs``, without a shuffle. Repeated windows are found by sorting hashes
    of the windows with their places, so a text of n words costs n log n at most.
    """
    lines = F.filter(F.split(_text(), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measured = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        words(_text()).alias("words"),
        F.regexp_count(_text(), F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
    )
    measured = measured.select(
        "doc_id",
        "text_key",
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    window = lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])
    measured = measured.withColumn(
        "windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW), window),
        ),
    ).drop("hashes")
    measured = measured.withColumn(
        "placed",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("windows")
    same = lambda x, i, step: F.coalesce(F.get("placed", i + step)["h"] == x["h"], F.lit(False))
    measured = measured.withColumn(
        "places",
        F.sort_array(
            F.transform(
                F.filter(
                    "placed",
                    # get(-1) is null
                    lambda x, i: same(x, i, -1) | same(x, i, 1),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("placed")
    covered = F.aggregate(
        F.transform(
            "places",
            lambda p, i: F.least(F.lit(WINDOW), F.coalesce(p - F.get("places", i - 1), F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    measured = measured.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measures = F.struct(*names, failed.alias("base_failed"))
    # The explode of one struct keeps filters on the measures above it: moved below, they would compute each
    # step as often as the next one names it.
    return measured.select("doc_id", "text_key", F.explode(F.array(measures)).alias("m")).select(
        "doc_id", "text_key", "m.*"
    )


def normalised(line: Column) -> Column:
    """Line without outer or doubled white space, in lower case, each number as 0."""
    spaced = F.trim(F.regexp_replace(line, SPACES, " "))
    return F.lower(F.regexp_replace(spaced, "[0-9]+", "0"))


def document_lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: doc_id, text_key, source, line, line_hash, line_words.

    ``line`` is the place among all lines of the text, from 0.
    """
    numbered = F.filter(
        F.transform(
            F.split(_text(), "\n"), lambda x, i: F.struct(i.alias("i"), normalised(x).alias("x"))
        ),
        lambda s: s["x"] != "",
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", numbered.alias("rows"))
    rows = rows.withColumn(
        "rows",
        F.transform(
            "rows",
            lambda s: F.struct(
                s["i"].alias("i"),
                F.xxhash64(s["x"]).alias("hash"),
                F.size(F.split(s["x"], " ")).cast("bigint").alias("words"),
            ),
        ),
    )
    # of an inner explode the optimizer derives a filter that computes the whole array once more
    exploded = rows.select(
        "doc_id", "text_key", "source", F.explode_outer("rows").alias("row")
    ).where("row is not null")
    return exploded.select(
        "doc_id",
        "text_key",
        "source",
        F.col("row.i").alias("line"),
        F.col("row.hash").alias("line_hash"),
        F.col("row.words").alias("line_words"),
    )


def boilerplate_lines(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE
) -> DataFrame:
    """source, line_hash, documents of the lines that more documents of a host hold than allowed."""
    hosts = docs.groupBy("source").agg(F.count_distinct(F.xxhash64("text")).alias("host_documents"))
    counted = (
        document_lines(docs)
        .groupBy("source", "line_hash")
        .agg(F.count_distinct("text_key").alias("documents"))
        .where(F.col("documents") > max_documents)
    )
    return (
        counted.join(hosts, counted["source"].eqNullSafe(hosts["source"]))
        .where(F.col("documents") > max_share * F.col("host_documents"))
        .select(counted["source"], "line_hash", "documents")
    )


def removed_lines(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE
) -> DataFrame:
    """doc_id, text_key, removed (array of line numbers), removed_words of documents that lose lines."""
    frequent = boilerplate_lines(docs, max_documents, max_share)
    lines = document_lines(docs)
    hits = lines.join(
        frequent,
        lines["source"].eqNullSafe(frequent["source"]) & (lines["line_hash"] == frequent["line_hash"]),
        "left_semi",
    )
    return (
        hits.groupBy("doc_id", "text_key", "line")
        .agg(F.max("line_words").alias("line_words"))
        .groupBy("doc_id", "text_key")
        .agg(
            F.sort_array(F.collect_list("line")).alias("removed"),
            F.sum("line_words").alias("removed_words"),
        )
    )


def judged(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE
) -> DataFrame:
    """Measures of ``text_measures`` with removed, removed_words and kept for every row."""
    measures = text_measures(docs)
    removed = removed_lines(docs, max_documents, max_share).select(
        F.col("doc_id").alias("r_doc_id"),
        F.col("text_key").alias("r_text_key"),
        "removed",
        "removed_words",
    )
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & (
        (left < MIN_WORDS_LEFT) | (left < MIN_SHARE_LEFT * F.col("n_words"))
    )
    return (
        measures.join(
            removed,
            measures["doc_id"].eqNullSafe(removed["r_doc_id"])
            & (measures["text_key"] == removed["r_text_key"]),
            "left",
        )
        .drop("r_doc_id", "r_text_key")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def filtered(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_share: float = MAX_SHARE
) -> DataFrame:
    """Documents that are kept, without their boilerplate lines; the columns of ``docs``.

    ``n_chars``, if there, is counted anew for texts that change.
    """
    key, doc_id, text_key, removed = unused(docs, "__key", "__doc_id", "__text_key", "__removed")
    verdict = judged(docs, max_documents, max_share).where("kept").select(
        F.col("doc_id").alias(doc_id), F.col("text_key").alias(text_key), F.col("removed").alias(removed)
    ).dropDuplicates([doc_id, text_key])
    joined = docs.withColumn(key, F.xxhash64("text")).join(
        verdict,
        F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(key) == F.col(text_key)),
    )
    return without_lines(joined, removed).select(docs.columns)


def without_lines(docs: DataFrame, numbers: str) -> DataFrame:
    """``docs`` whose text lost the lines of the sorted array ``numbers`` (null: none)."""
    # a map of the numbers would be searched in turn; the lines left are told by one array operation
    all_lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(numbers))
    cut = F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n")
    changed = F.col(numbers).isNotNull()
    out = docs.withColumn("text", F.when(changed, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return out
