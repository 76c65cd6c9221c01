"""Vector code compression: product codes whose codebooks come from Lloyd rounds over cover trees.

A vector becomes integers floor(4096 * x), cut into 8 equal parts. Every part position has a codebook of 16
entries, which starts as that part of the 16 smallest vec_ids and is moved by 6 rounds of Lloyd's algorithm in
whole numbers: nearest entry by squared distance, ties to the lower index, then floor(sum / count).

Vectors are taken in blocks, as they stand in their partition. For each block and part a cover tree is built once
and written to the scratch folder: levels of points, each level's points farther apart than its scale and each point
within twice the scale of its parent; every node has the sum, the number and the greatest distance of the points
below it. A round walks the trees from the roots. With d the distance of a node's point to an entry and r the
node's radius, an entry farther than the nearest one by more than 2 r can't be the nearest of any point below
(triangle inequality), so it's dropped there; a node left with one entry gives its whole sum to it. Only leaves
that are still ambiguous compare their points, in whole numbers. Distances for pruning are rounded to the safe side,
so the result is that of comparing everything.

A task holds one block. Each round sends 128 partial sums a task to a Spark aggregation, and the codebooks,
16 vectors, to the driver and back with the next job. Sums of errors per label are aggregated in the tasks first; both
sides of their join are read from files, so Spark can split a hot label.

Defined results: rows whose vector is null or holds null or non-finite components are dropped. Vectors of another
length than most (the most frequent multiple of 8, the longer of two) can't be cut with the others: they come back
with a null code and error. Empty vectors, if most are, have code 0 and error 0 throughout. A repeated vec_id
starts one entry, its least vector; a null vec_id stands after all others; repeated rows are coded each. With fewer
than 16 vec_ids the codebooks are as short. Integers are held within the bound that keeps a squared distance inside a
long (2**27 at 64 components, x = 32,768); a sum of errors beyond a long is the greatest long. An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmart.llm.common import materialised

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a block, and components where vectors are long.
BLOCK, BLOCK_VALUES = 2048, 1 << 21
#: Points that a leaf of a cover tree holds at most, unless they are equal.
LEAF = 24
#: Relative and absolute slack of pruning; far above the rounding of a double.
SLACK = 1e-9
LONG = (1 << 63) - 1

TREE = "struct<order binary, point binary, parent binary, levels binary, span binary, radius binary, sums binary>"
TREE_TYPE = pa.struct([(n.split()[0], pa.binary()) for n in TREE[7:-1].split(", ")])


def integers(vectors: np.ndarray) -> np.ndarray:
    """Whole numbers of the components, within the bound of the module's docstring."""
    bound = isqrt((1 << 62) // max(1, vectors.shape[1])) // 2
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -bound, bound).astype(np.int64)


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = points - entry
    return (apart * apart).sum(axis=1)


class CoverTree:
    """Cover tree of whole-number points; nodes are numbered level by level.

    The points below node i are ``order[span[i, 0]:span[i, 1]]``; level k is the nodes from ``levels[k]`` to
    ``levels[k + 1]``; ``point`` is the place of a node's own point.
    """

    FIELDS = {
        "order": np.int32,
        "point": np.int32,
        "parent": np.int32,
        "levels": np.int32,
        "span": np.int32,
        "radius": np.float64,
        "sums": np.int64,
    }

    def __init__(self, **arrays: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.leaf = np.ones(len(self.parent), bool)
        self.leaf[self.parent[1:]] = False

    def packed(self) -> dict[str, bytes]:
        return {n: np.ascontiguousarray(getattr(self, n), t).tobytes() for n, t in self.FIELDS.items()}

    @classmethod
    def unpacked(cls, fields: dict[str, bytes]) -> CoverTree:
        arrays = {n: np.frombuffer(fields[n], t) for n, t in cls.FIELDS.items()}
        nodes = len(arrays["parent"])
        arrays["span"] = arrays["span"].reshape(nodes, 2)
        arrays["sums"] = arrays["sums"].reshape(nodes, -1)
        return cls(**arrays)

    @classmethod
    def built(cls, points: np.ndarray, leaf: int = LEAF) -> CoverTree:
        """Levels of ever finer nets, until a net point stands for ``leaf`` points or for equal ones."""
        exact = np.ascontiguousarray(points.T, np.float64)  # one row per component: faster to sum

        def distances(places: np.ndarray, q: int) -> np.ndarray:
            apart = places - exact[:, q : q + 1]
            apart *= apart
            return np.sqrt(apart.sum(axis=0))

        owner, apart = np.zeros(len(points), np.int64), distances(exact, 0)
        own_point, parent, level = [0], [-1], [0]
        node_of = np.full(len(points), -1)
        node_of[0] = 0
        depth = 0
        while True:
            crowded = np.bincount(owner, minlength=len(points)) > leaf
            open_ = np.flatnonzero(crowded[owner])
            if not len(open_) or not (widest := apart[open_].max()):
                break
            depth += 1
            scale, before = widest / 2, owner.copy()
            near, places, held = apart[open_], exact[:, open_], owner[open_]
            added = []
            while (far := (near > scale).argmax()) or near[0] > scale:
                q = open_[far]
                added.append(q)
                to_q = distances(places, q)
                closer = to_q < near
                near[closer], held[closer] = to_q[closer], q
            apart[open_], owner[open_] = near, held
            # a net point with children goes on as a child of its own
            above = {int(p): int(node_of[p]) for p in before[added]}
            for q, up in [*((p, above[p]) for p in above), *((int(q), above[int(before[q])]) for q in added)]:
                node_of[q] = len(parent)
                own_point.append(q)
                parent.append(up)
                level.append(depth)
        return cls._finished(points, node_of[owner], *map(np.array, (own_point, parent, level)))

    @classmethod
    def _finished(cls, points, leaf_of, own_point, parent, level) -> CoverTree:
        nodes = len(parent)
        total = np.bincount(leaf_of, minlength=nodes)
        sums = np.zeros((nodes, points.shape[1]), np.int64)
        np.add.at(sums, leaf_of, points)
        for i in range(nodes - 1, 0, -1):  # children come after their parents
            total[parent[i]] += total[i]
            sums[parent[i]] += sums[i]
        start, free = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        for i in range(1, nodes):
            start[i] = free[i] = free[parent[i]]
            free[parent[i]] += total[i]
        radius, above = np.zeros(nodes), leaf_of.copy()
        every = np.arange(len(points))
        while len(every):
            apart = points[every] - points[own_point[above]]
            np.maximum.at(radius, above, np.sqrt((apart * apart).sum(axis=1).astype(np.float64)))
            above = parent[above]
            every, above = every[above >= 0], above[above >= 0]
        return cls(
            order=np.argsort(start[leaf_of], kind="stable"),
            point=own_point,
            parent=parent,
            levels=np.append(np.flatnonzero(np.diff(level, prepend=-1)), nodes),
            span=np.stack([start, start + total], axis=1),
            radius=radius,
            sums=sums,
        )

    def descended(self, points: np.ndarray, entries: np.ndarray):
        """What a walk from the root decides: nodes with one entry left, their entries, and the ambiguous leaves
        with the entries that they still allow."""
        # an entry equal to an earlier one never wins
        first = np.array([k == 0 or not (entries[:k] == entries[k]).all(axis=1).any() for k in range(len(entries))])
        allowed = np.zeros((len(self.parent), len(entries)), bool)
        open_ = np.zeros(len(self.parent), bool)
        whole, chosen, ambiguous = [], [], []
        for a, b in zip(self.levels[:-1], self.levels[1:], strict=True):
            at = np.arange(a, b) if a == 0 else a + np.flatnonzero(open_[self.parent[a:b]])
            if not len(at):  # children may be several levels below their parent
                continue
            left = np.broadcast_to(first, (1, len(entries))) if a == 0 else allowed[self.parent[at]]
            own, r = points[self.point[at]], self.radius[at]
            d = np.stack([np.sqrt(squared(own, e).astype(np.float64)) for e in entries], axis=1)
            reach = (np.where(left, d, np.inf).min(axis=1) + 2 * r) * (1 + SLACK) + SLACK
            left = left & (d <= reach[:, None])
            one = left.sum(axis=1) == 1
            whole.append(at[one])
            chosen.append(left[one].argmax(axis=1))
            ambiguous.append(at[~one & self.leaf[at]])
            open_[at[~one]] = True
            allowed[at] = left
        return np.concatenate(whole), np.concatenate(chosen), np.concatenate(ambiguous), allowed

    def compared(self, points: np.ndarray, entries: np.ndarray, leaves: np.ndarray, allowed: np.ndarray):
        """Points of the given leaves, and the nearest of each one's allowed entries, in whole numbers."""
        if not len(leaves):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate([self.order[s:e] for s, e in self.span[leaves]])
        kept = np.repeat(allowed[leaves], self.span[leaves, 1] - self.span[leaves, 0], axis=0)
        best, nearest = np.full(len(at), LONG), np.zeros(len(at), np.int64)
        for k, entry in enumerate(entries):
            rows = np.flatnonzero(kept[:, k])
            d = squared(points[at[rows]], entry)
            rows, d = rows[d < best[rows]], d[d < best[rows]]
            best[rows], nearest[rows] = d, k
        return at, nearest

    def summed(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the points nearest to each entry."""
        counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
        whole, chosen, leaves, allowed = self.descended(points, entries)
        np.add.at(counts, chosen, self.span[whole, 1] - self.span[whole, 0])
        np.add.at(sums, chosen, self.sums[whole])
        at, nearest = self.compared(points, entries, leaves, allowed)
        np.add.at(counts, nearest, 1)
        np.add.at(sums, nearest, points[at])
        return counts, sums

    def nearest(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Index of the nearest entry of each point."""
        out = np.zeros(len(points), np.int64)
        whole, chosen, leaves, allowed = self.descended(points, entries)
        for node, k in zip(whole, chosen, strict=True):
            out[self.order[self.span[node, 0] : self.span[node, 1]]] = k
        at, nearest = self.compared(points, entries, leaves, allowed)
        out[at] = nearest
        return out


def _parts(points: np.ndarray) -> list[np.ndarray]:
    """The 8 parts of whole-number vectors, each contiguous."""
    return [np.ascontiguousarray(p) for p in np.split(points, PARTS, axis=1)]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows of a partition in tables of ``size`` rows."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            head = batch.slice(0, size - rows)
            held.append(head)
            rows += head.num_rows
            batch = batch.slice(head.num_rows)
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _tree_writer(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    size = max(1, min(BLOCK, BLOCK_VALUES // max(1, length)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, size):
            vectors = block["embedding"].combine_chunks().flatten().to_numpy().reshape(block.num_rows, length)
            points = integers(vectors)
            trees = [CoverTree.built(p).packed() for p in _parts(points)]
            columns = {n: pa.array([block[n].to_pylist()], pa.list_(block[n].type)) for n in ("vec_id", "label")}
            columns["points"] = pa.array([points.tobytes()], pa.binary())
            columns["trees"] = pa.array([trees], pa.list_(TREE_TYPE))
            yield pa.RecordBatch.from_pydict(columns)

    return build


def _read(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[dict, np.ndarray, list, list]]:
    """The row, the vectors, their parts and trees of every block."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            points = np.frombuffer(row["points"], np.int64)
            points = points.reshape(-1, length) if length else np.zeros((len(row["vec_id"]), 0), np.int64)
            yield row, points, _parts(points), [CoverTree.unpacked(t) for t in row["trees"]]


def _round(books: list[np.ndarray], length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, len(books[0])), np.int64)
        sums = np.zeros((PARTS, *books[0].shape), np.int64)
        for _, _, parts, trees in _read(batches, length):
            for k, (points, tree) in enumerate(zip(parts, trees, strict=True)):
                n, s = tree.summed(points, books[k])
                counts[k] += n
                sums[k] += s
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part, pa.int32()),
                "entry": pa.array(entry, pa.int32()),
                "n": pa.array(counts[part, entry], pa.int64()),
                "sums": pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
            }
        )

    return gather


def _coder(books: list[np.ndarray], length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, whole, parts, trees in _read(batches, length):
            codes = np.zeros((len(whole), PARTS), np.uint8)
            error = np.zeros(len(whole), np.int64)
            for k, (points, tree) in enumerate(zip(parts, trees, strict=True)):
                nearest = tree.nearest(points, books[k])
                codes[:, k] = nearest
                error += squared(points, books[k][nearest])
            text = codes.tobytes().hex()
            width = 2 * PARTS
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": pa.array(row["vec_id"], pa.int64()),
                    "label": pa.array(row["label"], batch_type(row)),
                    "code": pa.array([text[i : i + width] for i in range(0, len(text), width)], pa.string()),
                    "error": pa.array(error, pa.int64()),
                }
            )

    def batch_type(row: dict) -> pa.DataType | None:
        return pa.int64() if all(x is None or isinstance(x, int) for x in row["label"]) else None

    return code


def first_codebooks(kept: DataFrame, length: int) -> list[np.ndarray]:
    """Parts of the 16 smallest vec_ids, for each part position."""
    ids = kept.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES)
    ids = [r.vec_id for r in ids.collect()]
    wanted = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        wanted = wanted | F.col("vec_id").isNull()
    rows = kept.where(wanted).groupBy("vec_id").agg(F.min("embedding").alias("least")).collect()
    by_id = {r.vec_id: r.least for r in rows}
    return _parts(integers(np.array([by_id[i] for i in ids], np.float64).reshape(len(ids), length)))


def moved(books: list[np.ndarray], sums: DataFrame) -> list[np.ndarray]:
    """Entries replaced by floor(sum / count) of their points; those without points stay."""
    places = sums.select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
    means = places.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    books = [b.copy() for b in books]
    for r in means.collect():  # 16 vectors at most
        books[r.part][r.entry, r.place] = r.total // r.n
    return books


def codebooks_text(books: list[np.ndarray]) -> str:
    return ",".join(str(x) for book in books for entry in book for x in entry.tolist())


def coded(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every kept row; see the module's docstring."""
    finite = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    label = F.col("label")
    if dict(embeddings.dtypes)["label"] in ("tinyint", "smallint", "int"):
        label = label.cast("bigint").alias("label")
    kept = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label, "embedding").where(
        F.col("embedding").isNotNull() & ~F.coalesce(finite, F.lit(True))
    )
    label_type = kept.schema["label"].dataType.simpleString()
    size = F.size("embedding")
    lengths = kept.where(size % PARTS == 0).groupBy(size.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if usual is None:
        return kept.select(
            "vec_id", "label", *[F.lit(None).cast(t).alias(n) for n, t in
                                 (("code", "string"), ("error", "bigint"), ("label_error", "bigint"))],
            F.sha2(F.lit(""), 256).alias("codebooks_sha256"),
        )
    length = usual.length
    alike = kept.where(size == length)
    schema = f"vec_id array<bigint>, label array<{label_type}>, points binary, trees array<{TREE}>"
    blocks = materialised(alike.mapInArrow(_tree_writer(length), schema), "cover-trees")
    books = first_codebooks(alike, length)
    for _ in range(rounds):
        sums = blocks.mapInArrow(_round(books, length), "part int, entry int, n bigint, sums array<bigint>")
        books = moved(books, sums)
    codes = blocks.mapInArrow(
        _coder(books, length), f"vec_id bigint, label {label_type}, code string, error bigint"
    )
    others = kept.where(size != length).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")
    )
    codes = materialised(codes.union(others), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = codes.groupBy(F.col("label").alias("s_label")).agg(
        F.least(total, F.lit(LONG).cast("decimal(38,0)")).cast("bigint").alias("label_error")
    )
    sums = materialised(sums, "label-errors")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return codes.join(sums, F.col("label").eqNullSafe(F.col("s_label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
