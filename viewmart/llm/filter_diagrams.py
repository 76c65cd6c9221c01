"""Interaction of filters, from decision diagrams of failure masks.

Each document gets a mask of the filters that it fails. The masks of a part (its source) are counted, and the
counts stand in a decision diagram: one level per filter, a branch for failing and one for passing, equal
subtrees shared, the subtree without documents cut, and on every node the sum of the documents below it. In an
order of filters the documents that reach step k are those on the path that passes everything before, so one walk
down the all-pass path reads every step of that order. The diagram is built once; all orders are visited by
swaps of two neighbouring levels, each of which only touches the nodes of these two levels.

Filters (words are maximal runs of ``[^\\x20\\x09-\\x0D]``, case counts):

A  fewer than 50 words
B  100 * distinct words < 65 * words
C  100 * ``[A-Z]`` characters > 5 * code points
D  any of ``#$%&*|``
E  the text of a smaller doc_id anywhere in the table, removed or not

Texts are read once; their digests, masks and counts go to the scratch folder. Rows that are equal in
number, part and text are one row with a count before anything meets by text, the least number of a text is
aggregated in the tasks before its shuffle, and the join with it is by text and number, so that a group of copies does
not meet in one task. A part is 32 counts at most, however many documents it has; parts are spread over tasks.

Defined results: a null text is empty (it fails A, and E if a smaller number has an empty text); a null doc_id
has no smaller one and stands before none, so it neither fails E nor makes others fail; a repeated number with the
same text is not smaller than itself; a null source is the empty string; several labels of a number count as good
or toxic if one of them says so; rows without label are neither; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmart.llm.common import materialised, words

FILTERS = "ABCDE"
#: Limits of the filters.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 50, 65, 5
MARKS = "[#$%&*|]"
#: Parts whose steps are put into one Arrow batch.
PARTS_A_BATCH = 64

STEP = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)
COUNTS = [n.split()[0] for n in STEP.split(", ")][3:]

# Documents, good ones and toxic ones.
Weight = tuple[int, int, int]
NOTHING: Weight = (0, 0, 0)


def bits(failures: list[Column]) -> Column:
    """Mask whose bit i says that the failure i holds."""
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failures)), F.lit(0))


def text_failures(body: Column, own_words: Column) -> list[Column]:
    """Failures of filters A to D, which a text has by itself."""
    n = F.size(own_words)
    capitals = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    return [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct(own_words)).cast("bigint") < LEAST_DISTINCT_PERCENT * n.cast("bigint"),
        100 * capitals.cast("bigint") > MOST_CAPITALS_PERCENT * F.length(body).cast("bigint"),
        body.rlike(MARKS),
    ]


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask, rows: the failures of every document, equal documents with their count."""
    texts = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("body")
    ).select("*", words(F.col("body")).alias("own"))
    read = texts.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("body", 256)).alias("text_key"),
        bits(text_failures(F.col("body"), F.col("own"))).alias("mask"),
    )
    rows = read.groupBy("doc_id", "part", "text_key", "mask").agg(F.count(F.lit(1)).alias("rows"))
    rows = materialised(rows, "filter-masks")
    first = rows.groupBy(F.col("text_key").alias("f_key")).agg(F.min("doc_id").alias("f_id"))
    joined = rows.join(first, (F.col("text_key") == F.col("f_key")) & (F.col("doc_id") == F.col("f_id")), "left")
    copied = F.col("f_id").isNull() & F.col("doc_id").isNotNull()
    return (
        joined.select("doc_id", "part", (F.col("mask") + copied.cast("int") * 16).alias("mask"), "rows")
        .groupBy("doc_id", "part", "mask")
        .agg(F.sum("rows").alias("rows"))
    )


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, rows, good, toxic: 32 rows a part at most."""
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    joined = failure_masks(docs).join(told, F.col("doc_id") == F.col("l_id"), "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("rows") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def neighbour_swaps(n: int) -> list[int]:
    """Positions k such that swapping places k and k + 1 in turn visits all orders of ``n`` things."""
    if n < 2:
        return []
    down, up = list(range(n - 2, -1, -1)), list(range(n - 1))
    out: list[int] = []
    for k, inner in enumerate([*neighbour_swaps(n - 1), None]):
        out += up if k % 2 else down
        if inner is not None:
            out.append(inner if k % 2 else inner + 1)
    return out


class Diagram:
    """Decision diagram of weighted masks; level k decides ``order[k]``.

    Node 0 is the subtree without documents, at every level. ``level[k]`` lists the other nodes of level k.
    """

    def __init__(self, masks: dict[int, Weight], filters: str = FILTERS) -> None:
        self.order = list(filters)
        self.weight: dict[int, Weight] = {0: NOTHING}
        self.branches: dict[int, tuple[int, int]] = {0: (0, 0)}
        self.last = 0
        ends: dict[Weight, int] = {NOTHING: 0}
        layer = {}
        for mask, weight in masks.items():
            if weight not in ends:
                ends[weight] = self._new(weight)
            layer[mask] = ends[weight]
        self.level: list[list[int]] = [[] for _ in filters]
        for k in reversed(range(len(filters))):
            bit, known = 1 << k, {}
            layer = {
                m: self._node(layer.get(m | bit, 0), layer.get(m, 0), known)
                for m in {m & ~bit for m in layer}
            }
            self.level[k] = list(known.values())
        self.root = layer.get(0, 0)

    def _new(self, weight: Weight) -> int:
        self.last += 1
        self.weight[self.last] = weight
        return self.last

    def _node(self, fails: int, passes: int, known: dict[tuple[int, int], int]) -> int:
        """The one node of a level with these branches."""
        if not fails and not passes:
            return 0
        if (fails, passes) not in known:
            a, b = self.weight[fails], self.weight[passes]
            node = known[fails, passes] = self._new((a[0] + b[0], a[1] + b[1], a[2] + b[2]))
            self.branches[node] = (fails, passes)
        return known[fails, passes]

    def swap(self, k: int) -> None:
        """Exchange levels k and k + 1. Nodes of level k keep what they stand for, so nothing above changes."""
        known: dict[tuple[int, int], int] = {}
        for node in self.level[k]:
            (ff, fp), (pf, pp) = (self.branches[b] for b in self.branches[node])
            self.branches[node] = self._node(ff, pf, known), self._node(fp, pp, known)
        for node in self.level[k + 1]:
            del self.branches[node], self.weight[node]
        self.level[k + 1] = list(known.values())
        self.order[k : k + 2] = reversed(self.order[k : k + 2])

    def steps(self) -> list[tuple[str, Weight, Weight]]:
        """Filter, removed and kept of each step, down the all-pass path."""
        node, out = self.root, []
        for name in self.order:
            fails, node = self.branches[node]
            out.append((name, self.weight[fails], self.weight[node]))
        return out


def audited(masks: dict[int, Weight]) -> list[tuple]:
    """filter_order, step and the counts of ``STEP`` for every order of the filters."""
    diagram, seen = Diagram(masks), {}
    for swap in [None, *neighbour_swaps(len(FILTERS))]:
        if swap is not None:
            diagram.swap(swap)
        seen["".join(diagram.order)] = diagram.steps()
    shares, fails, alone = dict.fromkeys(FILTERS, 0), {}, {}
    for steps in seen.values():
        for name, removed, _ in steps:
            shares[name] += removed[0]
        # the first filter removes all that fail it, the last one those that fail nothing else
        fails[steps[0][0]], alone[steps[-1][0]] = steps[0][1][0], steps[-1][1][0]
    return [
        (order, k, kept[0], removed[0], fails[name] - removed[0], alone[name], removed[1], removed[2], shares[name])
        for order, steps in sorted(seen.items())
        for k, (name, removed, kept) in enumerate(steps, 1)
    ]


def _audit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"part": pa.string(), "filter_order": pa.string(), "step": pa.int32()}
    types |= {n: pa.int64() for n in COUNTS}
    for batch in batches:
        cuts = [*range(0, batch.num_rows, PARTS_A_BATCH), batch.num_rows]
        for start, end in pairwise(cuts):
            rows = []
            for r in batch.slice(start, end - start).to_pylist():
                masks = {m["mask"]: (m["rows"], m["good"], m["toxic"]) for m in r["masks"]}
                rows += [(r["part"], *x) for x in audited(masks)]
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(types))


def steps_by_order(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, see ``STEP``."""
    by_part = mask_counts(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("mask", "rows", "good", "toxic")).alias("masks")
    )
    return by_part.mapInArrow(_audit_batches, STEP)
