"""Secret scans judged by how widely a candidate is owned over the whole corpus.

Candidates are found by patterns: assignments, access keys, hex runs, and as the method's own kind
random-looking tokens. The secret part of each candidate is hashed, and per hash the distinct
repositories and owners that hold it are counted. A value that many owners hold was copied from an
example; one that stays with its owner and looks random is taken for a live credential. Spans of the
first three kinds are always reported; tokens are added only where they are live and no other span
covers them.

The owner of a document is its ``source``, its repository the pair of ``source`` and ``lang``.

Only DataFrame functions are used. A match's place is the running sum of the lengths of the matches and of
what lies between them, so all spans are code points of the whole text. Texts are matched once and not shuffled,
only matches are; counts are pre-aggregated per task, and the join back to candidates is by a key of its own, so
that AQE splits it if one example is everywhere.

Defined results: null text is empty; null owners or languages are one unknown owner or language; rows of
equal ``doc_id`` and text are one document and get the same result, but the owners and repositories of each of them
count; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewmart.llm.common import materialised

# Kinds in the order of reports, with pattern, group of the secret, least length of it.
KINDS = [
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("token", r"[A-Za-z0-9_-]+", 0, 20),
]
BASE = 3
#: What a text must hold for a kind to be looked for; the runs it skips are too short anyway.
QUICK = {
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "token": r"[A-Za-z0-9_-]{20}",
}
#: Runs of one class of characters: shorter ones need not be matched to be dropped.
LONG = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}", "token": r"[A-Za-z0-9_-]{20,}"}
#: More owners or repositories than these make a value an example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 3
#: A live credential has a digit, a letter and so many different characters.
MIN_CHARACTERS = 8

DOC = ["doc_id", "text_key"]


def _looks_random(value: Column) -> Column:
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= MIN_CHARACTERS)
    )


def _matches(number: int, kind: str, least: int) -> Column:
    """Array of a kind's matches; value is null where the secret part is too short or not random."""

    def match(m: Column, i: Column) -> Column:
        value = F.get(f"value_{kind}", i)
        fine = F.length(value) >= least
        if number >= BASE:
            fine = fine & _looks_random(value)
        return F.struct(
            F.lit(number).alias("kind"),
            i.alias("i"),
            F.length(F.get(f"gaps_{kind}", i)).cast("bigint").alias("gap"),
            F.length(m).cast("bigint").alias("size"),
            F.when(fine, value).alias("value"),
        )

    return F.coalesce(F.transform(f"all_{kind}", match), F.array())


def matches(docs: DataFrame) -> DataFrame:
    """One row per match of a row of ``docs``: doc_id, text_key, owner, repository, kind, i, gap, size, value.

    Written to the scratch folder, so that texts are matched once; matches are few and short.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        F.coalesce("source", F.lit("")).alias("owner"),
        F.to_json(F.array("source", "lang")).alias("repository"),
        text.alias("body"),
    )
    found, kinds = [], []
    for number, (kind, pattern, group, least) in enumerate(KINDS):
        used = LONG.get(kind, pattern)
        there = F.col("body").rlike(QUICK.get(kind, pattern))
        found += [
            F.when(there, F.split("body", used, -1)).alias(f"gaps_{kind}"),
            F.when(there, F.regexp_extract_all("body", F.lit(used), F.lit(0))).alias(f"all_{kind}"),
            F.when(there, F.regexp_extract_all("body", F.lit(used), F.lit(group))).alias(f"value_{kind}"),
        ]
        kinds.append(_matches(number, kind, least))
    rows = rows.select(*DOC, "owner", "repository", *found)
    # of an inner explode the optimizer derives a filter that computes the whole array once more
    rows = rows.select(*DOC, "owner", "repository", F.explode_outer(F.concat(*kinds)).alias("m"))
    rows = rows.where("m is not null")
    return materialised(rows.select(*DOC, "owner", "repository", "m.*"), "secret-matches")


def candidates(found: DataFrame) -> DataFrame:
    """One row per candidate of a document: doc_id, text_key, kind, start, end, value."""
    before = Window.partitionBy(*DOC, "kind").orderBy("i")
    # rows of equal number and text are folded in their tasks first
    one = found.dropDuplicates([*DOC, "kind", "i", "gap", "size", "value"]).drop("owner", "repository")
    return (
        one.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
        .where("value is not null")
        .withColumn("start", F.col("end") - F.col("size"))
        .select(*DOC, "kind", "start", "end", "value")
    )


def ownership(found: DataFrame) -> DataFrame:
    """value_key, owners, repositories, counted over the matches of all rows, repeated ones too."""
    return (
        found.where("value is not null")
        .select(_hash("value").alias("value_key"), "owner", "repository")
        .distinct()
        .groupBy("value_key")
        .agg(
            F.count_distinct("owner").alias("owners"),
            F.count_distinct("repository").alias("repositories"),
        )
    )


def _hash(value: str) -> Column:
    """128 bits of a value's hash."""
    return F.concat_ws(":", F.xxhash64(value), F.xxhash64(F.lit(6), F.col(value)))


def spans(
    docs: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES
) -> DataFrame:
    """Reported spans: the columns of ``candidates`` with owners, repositories and verdict.

    verdict: ``example`` (widely copied), ``live`` (owner-specific and random-looking) or ``weak``.
    """
    found = matches(docs)
    # a key of its own: the counts are laid out by theirs, and only a join that shuffles both sides for itself is
    # split by AQE where one value is everywhere
    spread = ownership(found).select(F.concat("value_key", F.lit("")).alias("value_key"), "owners", "repositories")
    verdict = (
        F.when(
            (F.col("owners") > max_owners) | (F.col("repositories") > max_repositories), "example"
        )
        .when(_looks_random(F.col("value")), "live")
        .otherwise("weak")
    )
    judged = (
        candidates(found)
        .withColumn("value_key", _hash("value"))
        .join(spread, "value_key")
        .withColumn("verdict", verdict)
    )
    judged = judged.where((F.col("kind") < BASE) | (F.col("verdict") == "live"))
    # the furthest end of base spans that begin before the token's end
    base = F.col("kind") < BASE
    reach = Window.partitionBy(*DOC).orderBy(F.when(base, F.col("start")).otherwise(F.col("end") - 1))
    covered = F.max(F.when(base, F.col("end"))).over(
        reach.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        judged.withColumn("covered", F.coalesce(covered, F.lit(0)))
        .where(base | (F.col("covered") <= F.col("start")))
        .drop("value_key", "covered")
    )


def reported(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id and found, an array of (start, kind, end, verdict) in order."""
    per_document = (
        spans(docs)
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("found"))
        .withColumnsRenamed({"doc_id": "s_doc_id", "text_key": "s_text_key"})
    )
    every = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string>>")
    return every.join(
        per_document,
        F.col("doc_id").eqNullSafe(F.col("s_doc_id")) & (F.col("text_key") == F.col("s_text_key")),
        "left",
    ).select("doc_id", F.coalesce("found", none).alias("found"))


def named(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, joined by commas."""
    names = F.array(*[F.lit(kind) for kind, *_ in KINDS])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
