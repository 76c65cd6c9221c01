"""URL filters by association rules.

A url becomes a set of tokens: scheme, every suffix of the host, words of the host, segments of the path (numbers as
one), file ending, names of the query and the fragment. FP-growth mines the token combinations that often
stand together with a bad label (quality 0 or toxic 1 of the row of ``labels`` with the page's number). A rule
needs a fixed number of bad pages, however many pages there are, a confidence, and odds of a bad page well above
those of all labelled pages: so many times as high, with the lower bound of the confidence above the base rate.
Both can be reached at every base rate below 1. Only bad pages are mined, and only tokens that enough of them have;
tokens that stand in exactly the same labelled pages are one item, since their rules have the same counts, so a long
path or query that urls share does not multiply. Each combination is then counted over all labelled pages by one join.
Rules that a part of their tokens already gives are pruned. Rules are indexed by their rarest token: a url looks up the
rules of its own tokens and is tested against these alone.

A list of host and path rules comes first: a rule fits its host and all subdomains if the url's path starts
with the rule's; the longest wins. Mined rules judge the urls that no listed rule fits.

Defined results: a null url, or one without ``://``, has an empty host and path and no tokens, so it is
allowed; pages without labels are judged but not learned from; null labels are not bad; repeated rows are
judged each; without labelled pages, or when all are bad, nothing is mined; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewmart.llm.common import materialised

#: The listed rules as (host, path, verdict).
LISTED = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Bad pages, confidence and odds ratio (to all labelled pages) that a mined rule needs.
MIN_PAGES, MIN_CONFIDENCE, MIN_ODDS = 20, 0.6, 2.25
#: Standard deviations of the one-sided bound (Wilson's) of the confidence.
BOUND = 2.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(
    host: Column, path: Column, rules: list[tuple[str, str, str]] | None = None
) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest listed rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules or LISTED, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, rule_verdict).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens of a url; empty for null or a url without ``://``."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat(F.lit("host="), F.array_join(F.slice(labels, -k, k), ".")),
    )
    # the parts of a label; a whole label is a token already where it ends the host
    words = F.transform(
        F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-"))),
        lambda w: F.concat(F.lit("word="), w),
    )
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.concat(F.lit("path="), F.regexp_replace(s, "[0-9]+", "0")),
    )
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    names = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.concat(F.lit("query="), F.split(p, "=")[0]),
    )
    others = F.array(
        F.concat(F.lit("scheme="), F.regexp_extract(url, "^([^:]*)://", 1)),
        F.when(F.regexp_extract(url, "://[^#]*#(.*)", 1) != "", F.lit("fragment")).otherwise(F.lit("host=")),
    )
    every = F.array_remove(
        F.sort_array(F.array_distinct(F.concat(suffixes, words, segments, names, others))), "host="
    )
    return F.when(F.coalesce(url.contains("://"), F.lit(False)), every).otherwise(F.array().cast("array<string>"))


#: Columns of mined rules.
RULES = "key string, tokens array<string>, choices array<array<string>>, confidence double, support double"


def token_sets(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens, n, n_bad: labelled pages and bad ones of every distinct token set."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    labelled = labels.groupBy(F.col("doc_id").alias("l_doc_id")).agg(F.max(bad).alias("bad"))
    items = pages.select("page_id", tokens_of(F.col("url")).alias("tokens")).join(
        labelled, F.col("page_id") == F.col("l_doc_id")
    )
    return items.where(F.size("tokens") > 0).groupBy("tokens").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad")
    )


def token_classes(sets: DataFrame, min_pages: int) -> DataFrame:
    """token, class, held, bad of the tokens in ``min_pages`` bad pages or more.

    Tokens that stand in exactly the same labelled pages are one class, named by the least of them; ``held`` and
    ``bad`` are its pages and bad pages. Equal pages are told by two sums of 64-bit hashes of the token sets.
    """
    places = sets.select("n", "n_bad", F.explode("tokens").alias("token"),
                         *[F.xxhash64(F.lit(k), "tokens").cast("decimal(38,0)").alias(f"h{k}") for k in (1, 2)])
    tokens = (
        places.groupBy("token")
        .agg(F.sum("n").alias("held"), F.sum("n_bad").alias("bad"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
        .where(F.col("bad") >= min_pages)
    )
    own = F.min("token").over(Window.partitionBy("held", "bad", "h1", "h2"))
    return tokens.select("token", own.alias("class"), "held", "bad")


def mined_rules(
    pages: DataFrame,
    labels: DataFrame,
    min_confidence: float = MIN_CONFIDENCE,
    min_odds: float = MIN_ODDS,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Rules (``RULES``) of the token combinations that tell bad urls.

    A url fits a rule if it has one token of each of its ``choices``, which are classes of tokens that stand in the same
    labelled pages; ``tokens`` names the classes. A rule has a row for every token of its rarest class, the ``key``.
    """
    spark = pages.sparkSession
    none = spark.createDataFrame([], RULES)
    sets = materialised(token_sets(pages, labels), "url-tokens")
    n, n_bad = sets.agg(F.sum("n"), F.sum("n_bad")).first()
    if not n or n_bad < min_pages or n_bad == n:
        return none
    classes = materialised(token_classes(sets, min_pages), "url-classes")
    if classes.isEmpty():  # without a token in enough bad urls there is no rule to mine
        return none
    # the classes of every token set; equal ones are one row with its pages
    own = sets.select("tokens", "n", "n_bad", F.explode("tokens").alias("token")).join(
        classes.select("token", "class"), "token"
    )
    own = own.groupBy("tokens", "n", "n_bad").agg(F.sort_array(F.collect_set("class")).alias("items"))
    own = own.groupBy("items").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))
    own = materialised(own, "url-items")
    # only bad pages are mined; half a page less, as FP-growth rounds the share times their number up
    bad_pages = own.where("n_bad > 0").select("items", F.explode(F.sequence(F.lit(1), "n_bad")).alias("copy"))
    model = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / n_bad, minConfidence=1.0).fit(
        bad_pages.select("items")
    )
    sizes = classes.groupBy("class").agg(
        F.first("held").alias("held"), F.sort_array(F.collect_list("token")).alias("members")
    )
    found = model.freqItemsets.select(F.sort_array("items").alias("tokens"), F.col("freq").alias("bad"))
    parts = found.select("*", F.explode("tokens").alias("class")).join(sizes, "class")
    found = parts.groupBy("tokens", "bad").agg(
        F.min(F.struct("held", "class"))["class"].alias("rarest"),
        F.sort_array(F.collect_list(F.struct("class", "members")))["members"].alias("choices"),
    )
    found = materialised(found, "url-found")
    # all labelled pages that fit: looked up by the rarest class
    fits = own.select("items", "n", F.explode("items").alias("rarest")).join(
        found.select("tokens", "rarest"), "rarest"
    )
    fits = fits.where(F.size(F.array_except("tokens", "items")) == 0).groupBy("tokens").agg(F.sum("n").alias("held"))
    base, sure, held = n_bad / n, F.col("confidence"), F.col("held")
    square = BOUND * BOUND / held
    bound = (sure + square / 2 - BOUND * F.sqrt(sure * (1 - sure) / held + square / held / 4)) / (1 + square)
    rules = (
        found.join(fits, "tokens")
        .withColumn("confidence", F.col("bad") / held)
        .where(
            (sure >= min_confidence) & (sure * (1 - base) >= min_odds * base * (1 - sure)) & (bound > base)
        )
        .select("tokens", "choices", "rarest", "confidence", (F.col("bad") / n).alias("support"))
    )
    rules = materialised(rules, "url-rules")
    # A rule is not needed where some of its tokens are a rule. A part has its key among the rule's tokens.
    less = rules.select(F.col("rarest").alias("p_rarest"), F.col("tokens").alias("p_tokens"))
    whole = rules.select(F.col("tokens").alias("w_tokens"), F.explode("tokens").alias("p_rarest"))
    covered = whole.join(less, "p_rarest").where(
        (F.size("p_tokens") < F.size("w_tokens")) & (F.size(F.array_except("p_tokens", "w_tokens")) == 0)
    )
    rules = rules.join(covered, F.col("tokens") == F.col("w_tokens"), "left_anti")
    keys = F.explode(F.get("choices", F.array_position("tokens", F.col("rarest")).cast("int") - 1)).alias("key")
    return rules.select(keys, "tokens", "choices", "confidence", "support")


def judged(pages: DataFrame, rules: DataFrame, listed: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, url, host, path, rule, verdict, mined (tokens of the surest mined rule)."""
    url = F.col("url")
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    every = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path")).select(
        "*", rule.alias("rule"), verdict.alias("listed")
    )
    open_ = every.where("listed is null").select("url").distinct()
    tokens = open_.select("url", tokens_of(url).alias("own")).select("*", F.explode_outer("own").alias("key"))
    if "choices" not in rules.columns:
        rules = rules.withColumn("choices", F.transform("tokens", lambda t: F.array(t)))
    hits = (
        tokens.join(rules, "key")
        .where(F.forall("choices", lambda c: F.arrays_overlap(c, F.col("own"))))
        .groupBy(F.col("url").alias("h_url"))
        .agg(F.max(F.struct("confidence", "support", "tokens")).alias("best"))
    )
    return every.join(hits, F.col("url") == F.col("h_url"), "left").select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("listed", F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("listed").isNull(), F.array_join("best.tokens", " ")).alias("mined"),
    )
