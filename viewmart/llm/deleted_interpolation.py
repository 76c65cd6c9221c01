"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of orders 0 (uniform), 1 and 2. The mixture weights depend on how
often the context was seen (a bucket per power of two) and are learned by expectation-maximisation: a part
of the training documents is deleted from the counts, and the weights that make that part most likely
under the counts of the rest are kept. The scores then use the counts of all training documents.

Counting. Documents are read in blocks of ``BLOCK_ROWS`` consecutive rows. A block sends each distinct word or word
pair once, as a sorted list of 64-bit hashes cut into hash ranges, with its counts; ranges are summed over all blocks and
the totals go back to the blocks in the same order, so a word that is everywhere costs one entry a
block. There are as many ranges as blocks, so a range holds about as much as a block however large the
corpus is. The blocks then turn each document into the counts of its tokens, once; the weights and the scores need
no further shuffle. Only a histogram of probability steps per bucket (bounded by the steps, not by the
corpus) and the weights pass through the driver.

Blocks are numbered by the rows' places in the partitions of ``docs``, so its plan must give the same
partitions when it is run again (files do; cut lineage before where it would not). A block with other keys
than before is noticed by a digest of them and fails the job.

Defined results: null text is empty: its one token is the end; a null ``doc_id`` has the empty text as
name; repeated rows count and are scored each; an empty table gives no rows; without training tokens the
scores are those of the uniform part; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewmart.llm.common import materialised
from viewmart.llm.fragment_join import _MIX, _mixed

#: Documents whose number modulo FOLDS is HELD_OUT are not learned from; DELETED are those that weights are learned on.
FOLDS, HELD_OUT, DELETED = 7, 2, 5
BLOCK_ROWS = 1536
#: Steps of an octave in the histogram of probabilities; EM rounds.
STEPS, ROUNDS = 8, 60
#: Step of a probability of zero.
ZERO = -(10**6)

# no word holds white space, so these are the hashes of no word
_END = xxhash.xxh3_64_intdigest(b"\n")
_BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"\t"))


def fold_of(doc_id: str = "doc_id") -> Column:
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(name.cast("binary")), F.lit(FOLDS)).cast("int")


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words (A-Z lower-cased) and of the end."""
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in (text or "").encode().lower().split()] + [_END], np.uint64)


@dataclass
class Block:
    """Tokens of a block's documents; ``uni`` and ``pairs`` are sorted distinct keys."""

    sizes: np.ndarray
    uni: np.ndarray
    uni_at: np.ndarray
    pairs: np.ndarray
    pairs_at: np.ndarray


def read_block(tokens: list[np.ndarray]) -> Block:
    sizes = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate(tokens)
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[np.cumsum(sizes) - sizes] = _BEGIN
    uni, uni_at = np.unique(flat, return_inverse=True)
    pairs, pairs_at = np.unique(_mixed(before * _MIX[0] + flat), return_inverse=True)
    return Block(sizes, uni, uni_at, pairs, pairs_at)


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Borders of hash ranges in sorted keys."""
    width = 2**64 // ranges
    inner = np.array([k * width for k in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, inner), [len(keys)]]).astype(np.int64)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences, in six bytes each where that is enough."""
    steps = np.diff(keys, prepend=np.uint64(0))
    first, rest = steps[:1], steps[1:]
    if len(rest) and int(rest.max()) < 2**48:
        return b"6" + first.tobytes() + rest.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return b"8" + steps.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if data[:1] == b"8":
        return np.cumsum(np.frombuffer(data, np.uint64, offset=1), dtype=np.uint64)
    rest = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    steps = np.zeros((len(rest) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(data, np.uint8, count=8, offset=1)
    steps[1:, :6] = rest
    return np.cumsum(steps.reshape(-1).view(np.uint64), dtype=np.uint64)


def _digest(keys: np.ndarray) -> int:
    """Of a set of keys; that of a union of disjoint sets is the exclusive or of theirs."""
    return int(np.bitwise_xor.reduce(keys, initial=np.uint64(0)).view(np.int64))


def _small(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest of them needs."""
    most = values.max(initial=0)
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + values.astype(kind).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


COUNTS = "part int, block bigint, kind int, keys binary, learned binary, deleted binary"


def block_counts(numbered: DataFrame, ranges: int) -> DataFrame:
    """Counts of each block, cut into hash ranges (``part``): learned (training documents) and deleted ones."""
    names = [part.split()[0] for part in COUNTS.split(", ")]

    def rows_of(block: int, tokens: list[np.ndarray], folds: list[int]) -> pa.RecordBatch:
        read = read_block(tokens)
        fold = np.repeat(np.array(folds), read.sizes)
        out: list[tuple] = []
        for kind, keys, at in ((1, read.uni, read.uni_at), (2, read.pairs, read.pairs_at)):
            learned = np.bincount(at[fold != HELD_OUT], minlength=len(keys))
            deleted = np.bincount(at[fold == DELETED], minlength=len(keys))
            borders = _ranges(keys, ranges)
            for part, (a, b) in enumerate(zip(borders[:-1], borders[1:])):
                if a < b:
                    out.append((part, block, kind, _pack(keys[a:b]), _small(learned[a:b]), _small(deleted[a:b])))
        columns = [
            pa.array([r[i] for r in out], kind)
            for i, kind in enumerate([pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tokens, folds = None, [], []
        for batch in batches:
            for block, fold, text in zip(batch["block"].to_pylist(), batch["fold"].to_pylist(), batch["text"]):
                if block != current and tokens:
                    yield rows_of(current, tokens, folds)
                    tokens, folds = [], []
                current = block
                tokens.append(token_hashes(text.as_py()))
                folds.append(fold)
        if tokens:
            yield rows_of(current, tokens, folds)

    return numbered.select("block", "fold", "text").mapInArrow(count, COUNTS)


TOTALS = (
    "block bigint, part int, kind int, digest bigint, learned binary, deleted binary,"
    " tokens bigint, types bigint, kept_tokens bigint, kept_types bigint"
)


def totals(counts: DataFrame) -> DataFrame:
    """The corpus counts of each block's keys in their order; rows of block -1 hold the sums of a range."""
    names = [part.split()[0] for part in TOTALS.split(", ")]

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, of_kind in rows.groupby("kind"):
            keys = [_unpack(k) for k in of_kind["keys"]]
            sizes = [len(k) for k in keys]
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            summed = {}
            for name in ("learned", "deleted"):
                flat = np.concatenate([_wide(x) for x in of_kind[name]])
                summed[name] = np.bincount(at, flat, len(distinct)).astype(np.int64)
            learned, kept = summed["learned"], summed["learned"] - summed["deleted"]
            if kind == 1:
                sums = (learned.sum(), (learned > 0).sum(), kept.sum(), (kept > 0).sum())
                out.append((-1, 0, 0, 0, b"", b"", *map(int, sums)))
            back = {name: np.split(x[at], np.cumsum(sizes)[:-1]) for name, x in summed.items()}
            for block, part, own, a, b in zip(
                of_kind["block"], of_kind["part"], map(_digest, keys), back["learned"], back["deleted"]
            ):
                out.append((block, part, kind, own, _small(a), _small(b), None, None, None, None))
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({name: "Int64" for name in names[6:]})

    return counts.groupBy("part").applyInPandas(add, TOTALS)


DOCUMENTS = (
    "doc_id {doc}, fold int, n_tokens bigint, n_known bigint, base_score double, words binary, pairs binary,"
    " bucket int, step1 int, step2 int, weight bigint"
)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for contexts not seen, else 1 + floor(log2(count))."""
    return np.where(context > 0, np.frexp(np.maximum(context, 1))[1], 0)


def _step(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.floor(np.log2(np.maximum(p, 1e-300)) * STEPS), ZERO).astype(np.int64)


@dataclass
class Size:
    """Training tokens and types, and training documents; of all, and without the deleted part."""

    tokens: int
    types: int
    documents: int
    kept_tokens: int
    kept_types: int
    kept_documents: int


def counted(numbered: DataFrame, summed: DataFrame, size: Size) -> DataFrame:
    """Documents as counts of their tokens, and (rows without ``fold``) the histogram of the deleted part."""
    kind = numbered.schema["doc_id"].dataType
    schema = DOCUMENTS.format(doc=kind.simpleString())
    names = [part.split()[0] for part in schema.split(", ")]

    def lookup(docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("row")
        read = read_block([token_hashes(t) for t in docs["text"]])
        got = {}
        for number, keys, at in ((1, read.uni, read.uni_at), (2, read.pairs, read.pairs_at)):
            rows = back[back["kind"] == number].sort_values("part")
            values = {name: [_wide(x) for x in rows[name]] for name in ("learned", "deleted")}
            if sum(map(len, values["learned"])) != len(keys) or np.bitwise_xor.reduce(rows["digest"]) != _digest(keys):
                raise ValueError("a block of documents changed between two reads; cut its lineage first")
            for name in values:
                got[number, name] = np.concatenate(values[name])[at]
        words, pairs = got[1, "learned"], got[2, "learned"]
        ends = np.cumsum(read.sizes)
        starts = ends - read.sizes
        base = np.log10((words + 1) / (size.tokens + size.types + 1))
        out = []
        for name, fold, a, b in zip(docs["name"], docs["fold"], starts.tolist(), ends.tolist()):
            known = int((words[a:b] > 0).sum())
            out.append((name, fold, b - a, known, float(base[a:b].sum()), _small(words[a:b]), _small(pairs[a:b])))
        frame = pd.DataFrame(out, columns=names[:7])
        frame = frame.astype({"fold": "Int32", "n_tokens": "Int64", "n_known": "Int64"})
        cells = _histogram(
            np.repeat(docs["fold"].to_numpy() == DELETED, read.sizes),
            words - got[1, "deleted"],
            pairs - got[2, "deleted"],
            starts,
            size,
        )
        return pd.concat([frame, cells], ignore_index=True)[["name", *names[1:]]].rename(columns={"name": "doc_id"})

    names[0] = "name"

    def checked(docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        out = lookup(docs, back)
        out["doc_id"] = pd.Series([None if x is None or x is pd.NA else x for x in out["doc_id"]], dtype=object)
        return out

    docs = numbered.select(
        "block", "row", "fold", "text", F.col("doc_id").cast("string").alias("name")
    )
    return (
        docs.groupBy("block")
        .cogroup(summed.groupBy("block"))
        .applyInPandas(checked, schema.replace(f"doc_id {kind.simpleString()}", "doc_id string"))
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def _histogram(
    deleted: np.ndarray, words: np.ndarray, pairs: np.ndarray, starts: np.ndarray, size: Size
) -> pd.DataFrame:
    """bucket, step1, step2, weight of the deleted tokens under the counts that are kept."""
    context = np.empty_like(words)
    context[1:] = words[:-1]
    context[starts] = size.kept_documents
    words, pairs, context = words[deleted], pairs[deleted], context[deleted]
    p1 = words / max(size.kept_tokens, 1)
    p2 = np.where(context > 0, pairs / np.maximum(context, 1), 0.0)
    cells = np.stack([bucket_of(context), _step(p1), _step(p2)], 1)
    cells, weight = np.unique(cells, axis=0, return_counts=True)
    frame = pd.DataFrame(cells, columns=["bucket", "step1", "step2"]).astype("Int32")
    frame["weight"] = pd.array(weight, dtype="Int64")
    return frame


def learned_weights(cells: np.ndarray, types: int) -> np.ndarray:
    """Weights (order 0, 1, 2) per bucket, from rows (bucket, step1, step2, weight), by EM.

    Buckets without tokens take the weights of the next lower one.
    """
    value = lambda step: np.where(step == ZERO, 0.0, 2.0 ** ((np.maximum(step, -9000) + 0.5) / STEPS))
    weights = np.zeros((65, 3))
    last = np.array([0.5, 0.5, 0.0])
    for bucket in range(65):
        own = cells[cells[:, 0] == bucket] if len(cells) else cells
        if len(own):
            p = np.stack([np.full(len(own), 1 / (types + 1)), value(own[:, 1]), value(own[:, 2])], 1)
            count = own[:, 3].astype(float)
            mix = np.array([1 / 3, 1 / 3, 1 / 3]) if bucket else np.array([0.5, 0.5, 0.0])
            for _ in range(ROUNDS):
                part = p * mix
                part /= part.sum(1, keepdims=True)
                # half a token each keeps every order that the bucket has
                seen = count @ part + 0.5 * (mix > 0)
                mix = seen / seen.sum()
            last = mix
        elif bucket == 1:
            last = np.array([1 / 3, 1 / 3, 1 / 3])  # a context seen, but none in the deleted part
        weights[bucket] = last
    return weights


def scored(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    numbered = docs.select("doc_id", "text", fold_of().alias("fold")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    numbered = numbered.withColumn("block", F.floor(F.col("row") / block_rows))
    trained = F.col("fold") != HELD_OUT
    first = numbered.agg(
        F.count_distinct("block").alias("blocks"),
        F.count_if(trained).alias("documents"),
        F.count_if(trained & (F.col("fold") != DELETED)).alias("kept"),
    ).first()
    summed = materialised(totals(block_counts(numbered, max(1, first["blocks"]))), "lm-totals")
    names = ["tokens", "types", "kept_tokens", "kept_types"]
    sums = summed.where("block = -1").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    size = Size(
        sums["tokens"], sums["types"], first["documents"], sums["kept_tokens"], sums["kept_types"], first["kept"]
    )
    table = materialised(counted(numbered, summed.where("block >= 0"), size), "lm-documents")
    cells = (
        table.where("fold is null")
        .groupBy("bucket", "step1", "step2")
        .agg(F.sum("weight").alias("weight"))
        .toPandas()
    )
    weights = learned_weights(cells.to_numpy(np.int64), size.kept_types)
    return _scores(table.where("fold is not null"), weights, size)


SCORES = "doc_id {doc}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def token_probabilities(words: np.ndarray, pairs: np.ndarray, weights: np.ndarray, size: Size) -> np.ndarray:
    """Probability of each token of a document from its counts."""
    context = np.concatenate([[size.documents], words[:-1]])
    mix = weights[bucket_of(context)]
    p1 = words / max(size.tokens, 1)
    p2 = np.where(context > 0, pairs / np.maximum(context, 1), 0.0)
    return mix[:, 0] / (size.types + 1) + mix[:, 1] * p1 + mix[:, 2] * p2


def _scores(table: DataFrame, weights: np.ndarray, size: Size) -> DataFrame:
    schema = SCORES.format(doc=table.schema["doc_id"].dataType.simpleString())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                float(np.log10(token_probabilities(_wide(w.as_py()), _wide(p.as_py()), weights, size)).sum())
                for w, p in zip(batch["words"], batch["pairs"])
            ]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([f == HELD_OUT for f in batch["fold"].to_pylist()], pa.bool_()),
                    batch["n_tokens"],
                    batch["n_known"],
                    pa.array([size.tokens] * n, pa.int64()),
                    batch["base_score"],
                    pa.array(out, pa.float64()),
                ],
                [part.split()[0] for part in schema.split(", ")],
            )

    columns = ["doc_id", "fold", "n_tokens", "n_known", "base_score", "words", "pairs"]
    return table.select(*columns).mapInArrow(score, schema)
