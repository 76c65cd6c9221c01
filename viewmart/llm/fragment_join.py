"""Jaccard join of word n-grams by vertical partitioning.

Every text is the set of its distinct word n-grams. Two texts link when the Jaccard similarity of their sets
is at least ``percent`` / 100. Only sets that could link are compared, and a comparison is cut
vertically: the global order of n-grams is divided into fragments, the overlap of a pair is counted in
each fragment by itself, and the partial counts are summed per pair.

Candidates come from prefixes of a global n-gram order, exactly:

* Equal sets are one class; only classes are compared.
* A partner lacks at most ``(100 - percent) * n / 100`` n-grams of a set, so a set with more n-grams of its own (that
  nobody else has) is alone. This is first told from a quarter of all n-grams, chosen by hash, and (where a short text
  has too few of these) the next ones by hash; document frequencies of these are counted over all documents. It
  settles most sets. For the others, n-grams are counted once more, all of them, among these sets alone.
* The global order of the n-grams left is from rare to frequent. Sets that link share one of their first
  ``n - percent * n / 100 + 1`` n-grams: classes that share such a prefix n-gram form a bucket.
* Two sets whose own n-grams are together more than the difference that a link allows are no candidates. In a group
  of copies of one text this leaves hardly more than the pairs that do link.
* In a bucket not every pair is made: all are first compared with one pivot, the member with the fewest n-grams of
  its own. Members that the links found connect need no comparison any more. After ``PIVOT_ROUNDS`` rounds all
  pairs between components that are still apart are compared, so no link between components is lost.

The work of a bucket of m near copies of one text is therefore m, not m * m. Components are joined by the least
label with pointer jumping; nothing is collected to the driver. Steps that later ones repeat are written to the shared scratch
folder, so a lost executor costs a step at most. Texts are read where they lie: once for all, and again
for the sets that are compared.

Sets hold 64-bit hashes of n-grams and classes are known by their size and a 64-bit sum of mixed hashes.

Defined results: null texts and texts without words have the empty set, which links with nothing; a null
``doc_id`` takes part but names no component unless it is alone (then null); repeated rows are reported
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewmart.llm.common import connected, materialised, unused

WORDS = 4
PERCENT = 85
FRAGMENTS = 8
#: One in so many n-grams is counted over all documents.
SHARE = 4
PIVOT_ROUNDS = 3
#: Ids that are broadcast to find the texts to compare; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Characters of texts hashed together.
TOGETHER = 1_000_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; of fewer words, the whole sequence is one."""
    digest = xxhash.xxh3_64_intdigest
    # bytes.lower() changes A-Z alone, and bytes.split() cuts at the white space of the word rule
    hashes = [digest(w) for w in (text or "").encode().lower().split()]
    if not hashes:
        return np.empty(0, np.uint64)
    h = np.array(hashes, np.uint64)
    n = min(words, len(h))
    grams = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        grams = grams * _MIX[0] + h[k : len(h) - n + 1 + k]
    return np.unique(_mixed(grams))


def _leading(grams: np.ndarray, share: int) -> np.ndarray:
    """The n-grams that begin the global order."""
    return grams[_mixed(grams * _MIX[0]) % np.uint64(share) == 0]


def allowed(n: Column | int, percent: int) -> Column | int:
    """N-grams of a set of n that a partner may lack."""
    return ((100 - percent) * n / 100).cast("bigint") if isinstance(n, Column) else (100 - percent) * n // 100


SKETCH = "doc_id {doc}, text_key bigint, n bigint, key bigint, m bigint, lead array<bigint>, rest array<bigint>"


def sketches(docs: DataFrame, words: int, percent: int, share: int) -> DataFrame:
    """Per row of ``docs``: set size n, class key, the m leading n-grams, others that the prefix needs."""
    schema = SKETCH.format(doc=docs.schema["doc_id"].dataType.simpleString())
    names = [part.split()[0] for part in SKETCH.split(", ")]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, leads, rests = [], [], [], []
            for text in batch["text"]:
                grams = gram_set(text.as_py(), words)
                lead = _leading(grams, share)
                missing = allowed(len(grams), percent) + 1 - len(lead)
                rest = grams[:0]
                if missing > 0 and len(grams):
                    rest = np.setdiff1d(grams, lead, assume_unique=True)[:missing]
                sizes.append(len(grams))
                keys.append(int(_mixed(grams + _MIX[2]).sum(dtype=np.uint64).astype(np.int64)))
                leads.append(lead)
                rests.append(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array([len(x) for x in leads], pa.int64()),
                    _lists(leads),
                    _lists(rests),
                ],
                names,
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(sketch, schema)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *(len(x) for x in arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def suspects(sketched: DataFrame, percent: int) -> DataFrame:
    """key, n of the classes that may link, told from the n-grams of their sketches.

    In the order that begins with the leading n-grams, from rare to frequent, they share one of the prefix.
    """
    tagged = F.concat(
        F.transform("lead", lambda g: F.struct(F.lit(0).alias("late"), g.alias("gram"))),
        F.transform("rest", lambda g: F.struct(F.lit(1).alias("late"), g.alias("gram"))),
    )
    rows = sketched.where("n > 0").select("key", "n", "m", F.explode(tagged).alias("g"))
    rows = (
        rows.select(F.col("g.gram").alias("gram"), F.col("g.late").alias("late"), "key", "n", "m")
        .repartition("gram")
        .dropDuplicates(["gram", "key", "n"])
    )
    shared = rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("df > 1")
    # leading n-grams are ordered by frequency, later ones by hash alone
    in_order = Window.partitionBy("key", "n").orderBy(
        "late", F.when(F.col("late") == 0, F.col("df")).otherwise(0), "gram"
    )
    whole = Window.partitionBy("key", "n")
    leading = F.sum(1 - F.col("late")).over(whole)
    lacking = allowed(F.col("n"), percent)
    return (
        shared.withColumn("leading", leading)
        .withColumn("rank", F.row_number().over(in_order))
        .withColumn("own", F.col("m") - F.col("leading"))
        .where(F.col("own") <= lacking)
        # own n-grams come before all shared leading ones; before later ones, all leading ones do
        .withColumn(
            "place",
            F.when(F.col("late") == 0, F.col("own") + F.col("rank") - 1).otherwise(
                F.col("m") + F.col("rank") - F.col("leading") - 1
            ),
        )
        .where(F.col("place") <= lacking)
        .select("key", "n")
        .distinct()
    )


def prefixes(cut: DataFrame, percent: int) -> DataFrame:
    """gram, key, n, place, own: n-grams of each suspect's prefix that another one holds too.

    ``place`` counts from 0 in the global order, from rare to frequent; ``own`` are the n-grams that no other has.
    """
    rows = cut.select("key", "n", F.explode_outer("grams").alias("gram")).repartition("gram")
    shared = rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("df > 1")
    of_class = Window.partitionBy("key", "n")
    lacking = allowed(F.col("n"), percent)
    return (
        shared.withColumn("rank", F.row_number().over(of_class.orderBy("df", "gram")))
        .withColumn("own", F.col("n") - F.count(F.lit(1)).over(of_class))
        .withColumn("place", F.col("own") + F.col("rank") - 1)
        .where((F.col("own") <= lacking) & (F.col("place") <= lacking))
        .select("gram", "key", "n", "place", "own")
    )


def _may_link(percent: int) -> Column:
    """Sizes and n-grams of their own let a and b link."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    differ = (100 + percent) * (F.col("own_a") + F.col("own_b")) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return (100 * small >= percent * large) & differ


def size_band(n: str, percent: int) -> Column:
    """Number of a size's band; those of two sizes that may link differ by one at most."""
    # a little wider than the ratio that a link allows, so that rounding of logarithms does no harm
    width = max(math.log(100 / percent), 1e-3) * 1.001
    return F.floor(F.log(F.col(n).cast("double")) / width).cast("int")


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    """a, n_a, b, n_b of distinct pairs with (a, n_a) before (b, n_b)."""
    swap = (F.col("b") < F.col("a")) | ((F.col("b") == F.col("a")) & (F.col("n_b") < F.col("n_a")))
    pick = lambda x, y: F.when(swap, F.col(x)).otherwise(F.col(y))
    return pairs.select(
        pick("b", "a").alias("a"),
        pick("n_b", "n_a").alias("n_a"),
        pick("a", "b").alias("b"),
        pick("n_a", "n_b").alias("n_b"),
    ).distinct()


def pivot_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of each bucket's pivot with the members of other components: a, n_a, b, n_b.

    ``members``: gram, key, n, own, component, of buckets with several components. The pivot is the member
    with the fewest n-grams of its own.
    """
    pivots = members.groupBy("gram").agg(F.min(F.struct("own", "key", "n", "component")).alias("p"))
    pairs = members.join(pivots, "gram").where(F.col("component") != F.col("p.component"))
    pairs = pairs.select(
        F.col("p.key").alias("a"),
        F.col("p.n").alias("n_a"),
        F.col("p.own").alias("own_a"),
        F.col("key").alias("b"),
        F.col("n").alias("n_b"),
        F.col("own").alias("own_b"),
    ).where(_may_link(percent))
    return _ordered_pairs(pairs)


def all_pairs_apart(members: DataFrame, percent: int) -> DataFrame:
    """Pairs between different components of a bucket that their places allow to link: a, n_a, b, n_b.

    The members of the pivot's component are the one side that may be large; the other side are those
    outside it, so pairs inside a component of copies are never made. Members meet by n-gram and size band only:
    sizes that may link are in the same band or in neighbouring ones, so a passage that sets of all sizes share does
    not bring them all together, and the join has keys of its own that AQE can split.
    """
    pivots = members.groupBy("gram").agg(F.min(F.struct("own", "key", "n", "component")).alias("p"))
    sided = members.join(pivots, "gram").withColumn("outside", F.col("component") != F.col("p.component"))
    # with the pivot's few own n-grams and the largest size that fits, some member can have a partner at all
    most = (100 - percent) * F.col("n") * (100 + percent) / percent
    sided = sided.where((100 + percent) * (F.col("own") + F.col("p.own")) <= most)
    left = sided.where("outside").select(
        "gram",
        F.col("key").alias("a"),
        F.col("n").alias("n_a"),
        F.col("own").alias("own_a"),
        F.col("place").alias("p_a"),
        F.col("component").alias("c_a"),
    )
    right = sided.select(
        "gram",
        F.col("key").alias("b"),
        F.col("n").alias("n_b"),
        F.col("own").alias("own_b"),
        F.col("place").alias("p_b"),
        F.col("component").alias("c_b"),
        F.col("outside").alias("out_b"),
    )
    # at its first common n-gram, a pair that links has enough n-grams left in both sets
    needed = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    possible = F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
    left = left.withColumn("band", size_band("n_a", percent))
    near = F.explode(F.sequence(size_band("n_b", percent) - 1, size_band("n_b", percent) + 1))
    pairs = left.join(right.withColumn("band", near), ["gram", "band"]).where(
        (F.col("c_a") != F.col("c_b"))
        & (~F.col("out_b") | (F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("n_a") < F.col("n_b"))))
        & _may_link(percent)
        & (possible >= needed)
    )
    return _ordered_pairs(pairs.select("a", "n_a", "b", "n_b"))


def segments(
    docs: DataFrame, sketched: DataFrame, classes: DataFrame, words: int, fragments: int
) -> DataFrame:
    """key, n, fragment, grams: the n-grams of each class of ``classes`` (key, n), cut by fragment."""
    one = (
        sketched.select("doc_id", "text_key", "key", "n")
        .join(classes, ["key", "n"], "left_semi")
        .groupBy("key", "n")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"))
        .select("row.doc_id", "row.text_key")
        .withColumnsRenamed({"doc_id": "w_doc_id", "text_key": "w_text_key"})
    )
    one = materialised(one, "fragment-texts")
    if one.count() <= BROADCAST_IDS:
        one = F.broadcast(one)
    wanted = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").join(
        one,
        F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & (F.col("text_key") == F.col("w_text_key")),
        "left_semi",
    )
    width = np.uint64(-(-(2**64) // fragments) if fragments > 1 else 2**64 - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, numbers, parts = [], [], [], []
            for text in batch["text"]:
                grams = gram_set(text.as_py(), words)
                key = int(_mixed(grams + _MIX[2]).sum(dtype=np.uint64).astype(np.int64))
                fragment = grams // width
                for number in np.unique(fragment).tolist():
                    keys.append(key)
                    sizes.append(len(grams))
                    numbers.append(number)
                    parts.append(grams[fragment == number])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int32()), _lists(parts)],
                ["key", "n", "fragment", "grams"],
            )

    return (
        wanted.select("text")
        .mapInArrow(cut, "key bigint, n bigint, fragment int, grams array<bigint>")
        .dropDuplicates(["key", "n", "fragment"])
    )


def linked(pairs: DataFrame, cut: DataFrame, percent: int) -> DataFrame:
    """Pairs that link: overlaps counted per fragment and summed."""
    left = cut.select(F.col("key").alias("a"), F.col("n").alias("n_a"), "fragment", F.col("grams").alias("g_a"))
    right = cut.select(F.col("key").alias("b"), F.col("n").alias("n_b"), "fragment", F.col("grams").alias("g_b"))
    partial = (
        pairs.join(left, ["a", "n_a"])
        .join(right, ["b", "n_b", "fragment"])
        .select("a", "n_a", "b", "n_b", F.size(F.array_intersect("g_a", "g_b")).alias("overlap"))
    )
    return (
        partial.groupBy("a", "n_a", "b", "n_b")
        .agg(F.sum("overlap").alias("overlap"))
        .where(100 * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap")))
    )


def joined(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    fragments: int = FRAGMENTS,
    share: int = SHARE,
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id, links.

    component_id is the least doc_id that links lead to; links counts the links found from the document's
    class to other classes, which hold together the component.
    """
    sketched = materialised(sketches(docs, words, percent, share), "fragment-sketches")
    name = lambda key, n: F.struct(F.col(n).alias("n"), F.col(key).alias("key"))  # noqa: E731  a class
    cut = materialised(segments(docs, sketched, suspects(sketched, percent), words, fragments), "fragment-segments")
    members = materialised(prefixes(cut, percent), "fragment-prefixes")
    links = docs.sparkSession.createDataFrame([], "a bigint, n_a bigint, b bigint, n_b bigint, overlap bigint")
    labels = tried = None
    for attempt in range(PIVOT_ROUNDS + 1):
        at = members.withColumn("node", name("key", "n"))
        if labels is None:
            at = at.withColumn("component", F.col("node"))
        else:
            at = at.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = at.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        at = at.join(mixed.where("lo != hi").select("gram"), "gram", "left_semi")
        make = pivot_pairs if attempt < PIVOT_ROUNDS else all_pairs_apart
        pairs = make(at.drop("node"), percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "n_a", "b", "n_b"], "left_anti")
        pairs = materialised(pairs, f"fragment-pairs-{attempt}")
        if attempt < PIVOT_ROUNDS and pairs.isEmpty():
            continue
        new = materialised(linked(pairs, cut, percent), f"fragment-links-{attempt}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        if new.isEmpty():
            continue
        links = links.unionByName(new)
        edges = links.select(name("a", "n_a").alias("a"), name("b", "n_b").alias("b"))
        labels = connected(edges)
    every = sketched.select("doc_id", "text_key", F.col("n").alias("n_shingles"), name("key", "n").alias("node"))
    if labels is None:
        every = every.withColumn("component", F.col("node"))
    else:
        every = every.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = links.select(F.explode(F.array(name("a", "n_a"), name("b", "n_b"))).alias("node"))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    least = every.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    # a key of its own: only a join that shuffles both sides for itself is split by AQE where one component is large
    least = least.select(F.concat(F.col("component").cast("string"), F.lit("")).alias("of"), "least")
    return (
        every.join(degree, "node", "left")
        .withColumn("of", F.col("component").cast("string"))
        .join(least, "of", "left")
        .select(
            "doc_id",
            "text_key",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
            F.coalesce("links", F.lit(0).cast("bigint")).alias("links"),
        )
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one with the least doc_id, all columns kept.

    Documents without words link with nothing and stay. Of repeated rows of that document one stays; rows
    with a null ``doc_id`` stay if they are alone.
    """
    key, doc_id, text_key = unused(docs, "__key", "__doc_id", "__text_key")
    joined_ = joined(docs, words, percent)
    keep = (
        joined_.where(F.col("component_id").eqNullSafe(F.col("doc_id")))
        .select(F.col("doc_id").alias(doc_id), F.col("text_key").alias(text_key))
        .distinct()
    )
    kept = docs.withColumn(key, F.xxhash64("text")).join(
        keep,
        F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.col(key) == F.col(text_key)),
        "left_semi",
    )
    return kept.select(docs.columns)
