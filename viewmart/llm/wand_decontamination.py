"""Benchmark decontamination with a BM25 index of test items and block-max WAND.

Test items are indexed by term: the impact of a term on an item is its BM25 weight as a share of the
weight of all the item's terms, so the score of a passage is the share of the item that it holds and one
threshold serves all items. Items lie in blocks; the index keeps each term's greatest impact per block.
Every document is cut into overlapping passages, two of the longest item long and one apart, so any copy
of an item lies in one passage whole. A passage's terms are put in the order of their greatest impact on any
item; the pivot is the term at which the sum from the least one on reaches the threshold. Items that hold only
terms before the pivot cannot reach it, so lists of those terms are never walked: blocks are opened by the
lists from the pivot on alone, and a passage without a pivot opens none. In an open block the terms before the pivot
are looked up from the greatest down, each adding its greatest impact in that block, and the block is
left as soon as that and the sum of those still to come stay under the threshold. What is left is scored
item by item. This is block-max WAND with all blocks of some passages moved on together, for numpy, and not
one cursor after the other. Nothing above the threshold is missed.

Passages are searched in portions of ``WORDS`` words, also within one text, and lists are walked ``CELLS`` entries at a
time (or those of one passage), so memory does not grow with a text. A hit counts as a leak when
enough of the word sequences of the item's question and of its answer occur in the passage. Of an answer of
few sequences one changed word takes away more than half; there it is also a leak when enough of the sequences
of the whole item occur, in which the answer weighs by its length, so that edited and cut copies are found.

Items are collected in index shards of bounded size (``SHARD_CHARS`` of item text), each searched over all
documents; usual benchmarks are one shard. ``leaks`` holds one index at a time; ``decontaminated`` filters by
all in one pass over the documents, so there the indexes of all shards are on the executors together. Documents are neither shuffled nor joined: hits are found where the text lies.

The benchmark has one text per item. Its last sentence is taken for the answer, the rest for the
question; of a single sentence, the last quarter of its words is the answer.

Defined results: null texts have no words; items without a word match nothing; equal items all match;
repeated rows are reported each; empty tables give no rows; other columns are kept by
``decontaminated`` and ignored elsewhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from viewmart.llm.common import materialised

#: BM25 saturation and length correction.
K1, B = 1.2, 0.75
#: Share of an item's impact that a passage must hold to be looked at.
THRESHOLD = 0.5
#: Shares of the word sequences of question and answer that make a leak, and their length.
QUESTION_SHARE, ANSWER_SHARE, SEQUENCE = 0.6, 0.5, 3
#: An answer of fewer sequences is judged with its question too: a changed word is in up to ``SEQUENCE`` of them.
FEW = math.ceil(SEQUENCE / ANSWER_SHARE)
#: Items of a block.
BLOCK = 8
#: Characters of item text in one index.
SHARD_CHARS = 4_000_000
#: Characters of documents that a task looks at together.
TOGETHER = 1_000_000
#: Words of passages searched together, list entries walked together, and what sums may differ by from rounding.
WORDS, CELLS, SLACK = 200_000, 1_000_000, 1e-9

HITS = "doc_id {doc}, item_id {item}, score double, question_share double, answer_share double"

_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)
_SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+")


def terms_of(text: str) -> list[bytes]:
    """Words: letters, digits and bytes outside ASCII; A-Z lower-cased."""
    return text.encode().translate(_PLAIN).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    sentences = [s for s in map(terms_of, _SENTENCES.split(text)) if s]
    if not sentences:
        return [], []
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    cut = len(sentences[0]) - max(1, len(sentences[0]) // 4)
    return sentences[0][:cut], sentences[0][cut:]


def sequences(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(SEQUENCE, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of the distinct word sequences of ``part`` that ``passage`` holds; 1 for an empty part."""
    wanted = sequences(part)
    if not wanted:
        return 1.0
    n = len(next(iter(wanted)))
    held = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return len(wanted & held) / len(wanted)


def is_leak(question: list[bytes], answer: list[bytes], passage: list[bytes], shares: tuple[float, float]) -> bool:
    """``shares`` are those of question and answer in the passage."""
    if shares[0] >= QUESTION_SHARE and shares[1] >= ANSWER_SHARE:
        return True
    return len(sequences(answer)) < FEW and overlap(question + answer, passage) >= QUESTION_SHARE


@dataclass
class Index:
    """Postings of a shard. Term 0 is none; items are padded to whole blocks."""

    items: list[object]
    questions: list[list[bytes]]
    answers: list[list[bytes]]
    vocabulary: dict[bytes, int]
    #: By term, from starts[t] to starts[t + 1]: items that hold it, and its impact on them.
    starts: np.ndarray
    postings: np.ndarray
    impacts: np.ndarray
    #: The same by block: block numbers and greatest impacts.
    block_starts: np.ndarray
    blocks: np.ndarray
    block_impacts: np.ndarray
    #: Greatest impact of each term on any item.
    best: np.ndarray
    #: Postings and blocks as one sorted number each: of term and item, of term and block.
    posting_keys: np.ndarray
    block_keys: np.ndarray
    #: Words of the longest item.
    longest: int


def build_index(items: list[tuple[object, str]], n_items: int, mean: float, df: dict[bytes, int]) -> Index:
    """``n_items``, ``mean`` (words an item) and ``df`` (items a term) are those of all shards."""
    items = [(i, text, words) for i, text in items if (words := terms_of(text or ""))]
    # neighbours in a block share rare terms, so that block maxima are tight
    items.sort(key=lambda x: (min(x[2], key=lambda w: (df[w], w)), str(x[0])))
    vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for *_, words in items for w in words}))}
    rows = []
    for number, (_, _, words) in enumerate(items):
        weights = {
            w: math.log1p((n_items - df[w] + 0.5) / (df[w] + 0.5))
            * tf
            * (K1 + 1)
            / (tf + K1 * (1 - B + B * len(words) / mean))
            for w, tf in Counter(words).items()
        }
        whole = sum(weights.values())
        rows += [(vocabulary[w], number, x / whole) for w, x in weights.items()]
    rows.sort()
    best: dict[tuple[int, int], float] = {}
    for term, number, impact in rows:
        key = (term, number // BLOCK)
        best[key] = max(best.get(key, 0.0), impact)
    by_block = sorted((t, b, x) for (t, b), x in best.items())
    terms = np.arange(len(vocabulary) + 2)
    n_blocks = -(-len(items) // BLOCK)
    greatest = np.zeros(len(vocabulary) + 1)
    np.maximum.at(greatest, np.array([t for t, *_ in by_block], np.int64), np.array([x for *_, x in by_block]))
    return Index(
        items=[i for i, _, _ in items],
        questions=[question_and_answer(text)[0] for _, text, _ in items],
        answers=[question_and_answer(text)[1] for _, text, _ in items],
        vocabulary=vocabulary,
        starts=np.searchsorted(np.array([r[0] for r in rows], np.int64), terms),
        postings=np.array([r[1] for r in rows], np.int64),
        impacts=np.array([r[2] for r in rows], np.float64),
        block_starts=np.searchsorted(np.array([r[0] for r in by_block], np.int64), terms),
        blocks=np.array([r[1] for r in by_block], np.int64),
        block_impacts=np.array([r[2] for r in by_block], np.float64),
        best=greatest,
        posting_keys=np.array([t * n_blocks * BLOCK + i for t, i, _ in rows], np.int64),
        block_keys=np.array([t * n_blocks + b for t, b, _ in by_block], np.int64),
        longest=max((len(words) for *_, words in items), default=0),
    )


def _expanded(starts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the postings of ``terms`` one after the other, and for each the place in ``terms``."""
    first, count = starts[terms], starts[terms + 1] - starts[terms]
    of = np.repeat(np.arange(len(terms)), count)
    return np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count), of


def passages(n_words: int, longest: int) -> list[tuple[int, int]]:
    """Passages of ``2 * longest`` words, ``longest`` apart, that cover ``n_words`` words."""
    count = max(1, -(-n_words // longest) - 1)
    return [(k * longest, min(n_words, (k + 2) * longest)) for k in range(count)]


def _groups(costs: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose costs add up to about ``most``; a dearer one is a range with few others."""
    number = np.cumsum(costs) // most
    borders = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(costs)]]).tolist()
    return ((a, b) for a, b in zip(borders[:-1], borders[1:]) if a < b)


def _open_cells(
    index: Index, offsets: np.ndarray, terms: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(passage, block) in which an item may reach the threshold.

    The terms of passage ``p`` lie from ``offsets[p]`` to ``offsets[p + 1]``, by their greatest impact.
    """
    sums = np.concatenate([[0.0], np.cumsum(index.best[terms])])
    upto = sums[1:] - np.repeat(sums[offsets[:-1]], np.diff(offsets))
    passage = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = upto < threshold - SLACK
    pivot = offsets[:-1] + np.bincount(passage[before], minlength=len(offsets) - 1)
    lengths = index.block_starts[terms + 1] - index.block_starts[terms]
    costs = np.bincount(passage[~before], lengths[~before], minlength=len(offsets) - 1).astype(np.int64)
    n_blocks = -(-len(index.items) // BLOCK)
    for first, last in _groups(costs, CELLS):
        walked = np.flatnonzero(~before[offsets[first] : offsets[last]]) + offsets[first]
        at, of = _expanded(index.block_starts, terms[walked])
        cells, group = np.unique(passage[walked][of] * n_blocks + index.blocks[at], return_inverse=True)
        bounds = np.bincount(group, index.block_impacts[at], minlength=len(cells))
        # the term looked up next, from the one before the pivot down
        place = pivot[cells // n_blocks] - 1
        while len(cells):
            open_ = place >= offsets[cells // n_blocks]
            fine = bounds + np.where(open_, upto[place], 0.0) >= threshold - SLACK
            cells, bounds, place, open_ = cells[fine], bounds[fine], place[fine], open_[fine]
            if not open_.any():
                break
            keys = terms[place[open_]] * n_blocks + cells[open_] % n_blocks
            spot = np.minimum(np.searchsorted(index.block_keys, keys), len(index.block_keys) - 1)
            bounds[open_] += np.where(index.block_keys[spot] == keys, index.block_impacts[spot], 0.0)
            place[open_] -= 1
        yield cells // n_blocks, cells % n_blocks


def _scores(
    index: Index, offsets: np.ndarray, terms: np.ndarray, passage: np.ndarray, block: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(passage, item, score) of the items of the given blocks that hold a term of the passage."""
    span = -(-len(index.items) // BLOCK) * BLOCK
    for first, last in _groups(np.diff(offsets)[passage], CELLS):
        at, of = _expanded(offsets, passage[first:last])
        keys = terms[at] * span + block[first:last][of] * BLOCK
        low = np.searchsorted(index.posting_keys, keys)
        count = np.searchsorted(index.posting_keys, keys + BLOCK) - low
        posting = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        of = np.repeat(of, count)
        pairs, group = np.unique(passage[first:last][of] * span + index.postings[posting], return_inverse=True)
        yield pairs // span, pairs % span, np.bincount(group, index.impacts[posting], minlength=len(pairs))


def hits(index: Index, texts: list[str], threshold: float = THRESHOLD) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question share, answer share) of the best passage for each text and item."""
    if not index.items:
        return []
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    known = index.vocabulary.get
    words_of = [terms_of(text) for text in texts]
    ids_of = [np.array([known(w, 0) for w in words], np.int64) for words in words_of]
    where = [(k, *cut) for k, words in enumerate(words_of) for cut in passages(len(words), index.longest)]
    for first, last in _groups(np.array([end - start for _, start, end in where], np.int64), WORDS):
        cuts = where[first:last]
        terms = np.concatenate([ids_of[k][start:end] for k, start, end in cuts])
        passage = np.repeat(np.arange(len(cuts)), [end - start for _, start, end in cuts])
        n_terms = len(index.vocabulary) + 1
        distinct = np.unique((passage * n_terms + terms)[terms > 0])
        passage, terms = distinct // n_terms, distinct % n_terms
        terms = terms[np.lexsort((index.best[terms], passage))]
        offsets = np.searchsorted(passage, np.arange(len(cuts) + 1))
        for cells in _open_cells(index, offsets, terms, threshold):
            for at, items, scores in _scores(index, offsets, terms, *cells):
                above = scores >= threshold - SLACK
                for p, item, score in zip(at[above].tolist(), items[above].tolist(), scores[above].tolist()):
                    number, start, end = cuts[p]
                    words = words_of[number][start:end]
                    question, answer = overlap(index.questions[item], words), overlap(index.answers[item], words)
                    if is_leak(index.questions[item], index.answers[item], words, (question, answer)):
                        key = (number, item)
                        found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (score, question, answer))
    return [(*key, *value) for key, value in found.items()]


def shards(benchmark: DataFrame, shard_chars: int = SHARD_CHARS) -> Iterator[Index]:
    """Indexes of bounded size over the items of ``benchmark``.

    Item ids are numbered by hash into shards; term counts are gathered over all items, but only those of a
    shard's own terms come to the driver.
    """
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+", " ")
    lowered = F.translate(plain, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    items = benchmark.select(
        "item_id", "text", F.array_remove(F.split(lowered, " "), "").alias("words")
    ).where(F.size("words") > 0)
    whole = items.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean"), F.sum(F.length("text")).alias("chars")
    ).first()
    if not whole["n"]:
        return
    n_shards = -(-whole["chars"] // shard_chars)
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards)))
    in_shard = items.select("shard", F.explode(F.array_distinct("words")).alias("word"))
    df = in_shard.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    for shard in range(n_shards):
        rows = items.where(F.col("shard") == shard).select("item_id", "text").collect()
        own = in_shard.where(F.col("shard") == shard).select("word").distinct()
        counts = {r["word"].encode(): r["df"] for r in df.join(own, "word", "left_semi").collect()}
        yield build_index([(r["item_id"], r["text"]) for r in rows], whole["n"], whole["mean"], counts)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of portions of a batch of about ``TOGETHER`` characters."""
    first, texts, chars = 0, [], 0
    for row, text in enumerate(batch["text"]):
        text = text.as_py() or ""
        texts.append(text)
        chars += len(text)
        if chars > TOGETHER:
            yield first, texts
            first, texts, chars = row + 1, [], 0
    if texts:
        yield first, texts


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and item that it leaks: the columns of ``HITS``."""
    doc, item = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = HITS.format(doc=doc.simpleString(), item=item.simpleString())
    names = [part.split()[0] for part in HITS.split(", ")]
    spark = docs.sparkSession
    item_kind = to_arrow_type(item)
    out = spark.createDataFrame([], schema)
    for index in shards(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch["doc_id"]
                found = [
                    (ids[first + hit[0]].as_py(), index.items[hit[1]], *hit[2:])
                    for first, texts in _portions(batch)
                    for hit in hits(index, texts, threshold)
                ]
                kinds = [ids.type, item_kind, pa.float64(), pa.float64(), pa.float64()]
                columns = [pa.array([x[k] for x in found], kind) for k, kind in enumerate(kinds)]
                if found:
                    yield pa.RecordBatch.from_arrays(columns, names)

        # hits are written, so that no index outlives its search
        out = out.union(materialised(docs.select("doc_id", "text").mapInArrow(search, schema), "leaks"))
        shared.destroy()
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns and repeated rows are kept."""
    for index in shards(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                fine = np.ones(batch.num_rows, bool)
                for first, texts in _portions(batch):
                    for hit in hits(index, texts, threshold):
                        fine[first + hit[0]] = False
                yield batch.filter(pa.array(fine))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
