"""Quality classifier by compression: how much better a text packs with a dictionary of good text than of bad.

Labelled rows are dealt in two halves by a hash of their number. From one half a bounded sample of texts is drawn
for each label by another hash and cut into pieces of 1,024 bytes, and a zstandard dictionary is made from each
sample. Every text of the table is then compressed piece by piece, each piece by itself, so that a
long text does not teach the compressor, once with the bad dictionary and once with the good one. The difference of
the sizes, over the length of the text, is the measure; short texts are drawn to the mean of the labelled rows as if
64 such bytes stood before them. The other half of the labelled rows calibrates it: counts of both labels
per step of the measure give a monotone curve (isotonic regression) and a logistic one, and the score is nine tenths
of the first and one of the second, which keeps ranks where the first is flat.

Only text goes into a score. What is fitted is bounded: ``SAMPLE_PIECES`` pieces a label for the dictionaries
(of texts of an eighth of that at most; one task makes each) and a count per step of the measure for the curves. All texts are compressed whole, once,
spread over the tasks, and only their sizes are written to the scratch folder.

Defined results: a null or empty text has size 0 and so the mean of the labelled rows; a null doc_id is not held out
and has no label; several equal labels of a number count once, and a number with labels of both kinds (or null) has
none; repeated rows are scored each, alike; without labelled texts of both kinds to learn from the score is the share
of good ones (0.5 without any); too few bytes for a trained dictionary give one of plain content; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewmart.llm.common import materialised

#: Bytes compressed at once, pieces that each dictionary is made of, bytes of a dictionary, level of zstandard.
PIECE_BYTES, SAMPLE_PIECES, DICTIONARY_BYTES, LEVEL = 1024, 8192, 32768, 3
#: Bytes of mean text that stand before every text.
PRIOR_BYTES = 64
#: Steps of the measure in the counts that calibrate it.
STEPS = 2000
#: Share of the logistic curve, and the least score that counts as good.
LOGISTIC_SHARE, GOOD = 0.1, 0.3

GOOD_LABEL, BAD_LABEL = 1, 0


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def makes_dictionaries(doc_id: Column) -> Column:
    """The half of the learning rows whose texts make the dictionaries; the other half calibrates."""
    return F.xxhash64(doc_id, F.lit("dictionary")) % 2 == 0


def learning_labels(labels: DataFrame) -> DataFrame:
    """l_id, quality of the numbers that may be learned from and have one quality."""
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("l_id")).agg(
        F.min("quality").alias("quality"),
        F.max("quality").alias("most"),
        F.count_if(F.col("quality").isNull()).alias("unknown"),
    )
    sure = (F.col("quality") == F.col("most")) & F.col("quality").isin(BAD_LABEL, GOOD_LABEL) & (F.col("unknown") == 0)
    return one.where(sure & ~held_out(F.col("l_id"))).select("l_id", F.col("quality").cast("int").alias("quality"))


def pieces_of(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE_BYTES] for i in range(0, len(text), PIECE_BYTES)]


def _texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for quality, text in zip(batch["quality"].to_pylist(), _texts(batch["text"]), strict=True):
            if pieces := pieces_of(text):
                labels = pa.array([quality] * len(pieces), pa.int32())
                yield pa.RecordBatch.from_arrays([labels, pa.array(pieces, pa.binary())], names=["quality", "piece"])


def sampled_ids(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_PIECES) -> DataFrame:
    """s_id, quality of numbers whose texts have ``most`` pieces for each quality, taken by a hash of the number.

    Only numbers and lengths are shuffled. At most ``most`` numbers of each quality.
    """
    size = F.ceil(F.octet_length("text") / PIECE_BYTES)
    own = labels.where(makes_dictionaries(F.col("l_id")))
    sizes = docs.select("doc_id", size.alias("n")).where(size.between(1, most // 8)).join(
        own, F.col("doc_id") == F.col("l_id")
    )
    sizes = materialised(sizes.groupBy("l_id", "quality").agg(F.max("n").alias("n")), "zstd-lengths")
    totals = {r.quality: r.n for r in sizes.groupBy("quality").agg(F.sum("n").alias("n")).collect()}  # 2 rows
    share = F.lit(0.0)
    for quality, n in totals.items():
        share = F.when(F.col("quality") == quality, min(1.0, 4 * most / n)).otherwise(share)
    place = F.pmod(F.xxhash64("l_id", F.lit("sample")), F.lit(1 << 30))
    # far more than needed pass this filter, few enough to sort in one task
    few = sizes.withColumn("place", place).where(F.col("place") < share * (1 << 30))
    running = F.sum("n").over(Window.partitionBy("quality").orderBy("place", "l_id"))
    return few.withColumn("running", running).where(F.col("running") <= most).select(
        F.col("l_id").alias("s_id"), "quality"
    )


def sampled_pieces(texts: DataFrame, most: int = SAMPLE_PIECES) -> DataFrame:
    """quality, piece: the different pieces of each quality, ``most`` at most, those with the least hashes."""
    pieces = texts.mapInArrow(_cut, "quality int, piece binary").dropDuplicates(["quality", "piece"])
    rank = F.row_number().over(Window.partitionBy("quality").orderBy(F.xxhash64("piece"), "piece"))
    return pieces.withColumn("rank", rank).where(F.col("rank") <= most).select("quality", "piece")


def sampled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """quality, text of the sampled numbers."""
    ids = materialised(sampled_ids(docs, labels), "zstd-sample")
    # 2 * SAMPLE_PIECES numbers at most, so no text is shuffled for them
    return docs.join(F.broadcast(ids), F.col("doc_id") == F.col("s_id")).select("quality", "text")


def dictionary_of(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or the pieces themselves where they're too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def dictionaries(texts: DataFrame) -> dict[int, bytes]:
    """The dictionary of each quality that ``texts`` (quality, text) hold."""

    def make(rows: pd.DataFrame) -> pd.DataFrame:
        pieces = sorted(rows["piece"].map(bytes))
        return pd.DataFrame({"quality": rows["quality"].iloc[:1], "content": [dictionary_of(pieces)]})

    made = sampled_pieces(texts).groupBy("quality").applyInPandas(make, "quality int, content binary")
    return {r.quality: bytes(r.content) for r in made.collect()}  # two dictionaries


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary)
    content.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False)


def _measurer(bad: bytes, good: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bad, by_good = compressor(bad), compressor(good)
        for batch in batches:
            rows = []
            for text in _texts(batch["text"]):
                pieces = pieces_of(text)
                rows.append((len(text), sum(len(by_bad.compress(p)) for p in pieces),
                             sum(len(by_good.compress(p)) for p in pieces)))
            sizes = zip(*rows, strict=True) if rows else ([], [], [])
            columns = [batch["doc_id"], *(pa.array(c, pa.int64()) for c in sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "bad_bytes", "good_bytes"])

    return measure


def measured(docs: DataFrame, bad: bytes, good: bytes) -> DataFrame:
    """doc_id, n_bytes, bad_bytes, good_bytes: length of every text, and its sizes with both dictionaries."""
    sizes = docs.select("doc_id", "text").mapInArrow(
        _measurer(bad, good), "doc_id bigint, n_bytes bigint, bad_bytes bigint, good_bytes bigint"
    )
    return materialised(sizes, "zstd-sizes")


def with_measure(sizes: DataFrame, mean: float) -> DataFrame:
    """``sizes`` with ``measure``: bytes that the good dictionary saves for each byte of text."""
    saved = F.col("bad_bytes") - F.col("good_bytes") + mean * PRIOR_BYTES
    return sizes.withColumn("measure", saved / (F.col("n_bytes") + PRIOR_BYTES))


def calibrated(sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """``sizes`` with measure and score; ``labels`` (l_id, quality) are those that may be learned from."""
    own = sizes.join(labels.where(~makes_dictionaries(F.col("l_id"))), F.col("doc_id") == F.col("l_id"))
    n, good, length, saved = own.agg(
        F.count(F.lit(1)), F.sum("quality"), F.sum("n_bytes"), F.sum(F.col("bad_bytes") - F.col("good_bytes"))
    ).first()
    measures = with_measure(sizes, (saved or 0) / length if length else 0.0)
    if not n or good in (0, n):
        return measures.withColumn("score", F.lit((good or 0) / n if n else 0.5))
    step = F.floor(F.col("measure") * STEPS)
    counts = (
        with_measure(own, saved / length if length else 0.0)
        .groupBy(step.alias("step"), "quality")
        .agg(F.count(F.lit(1)).cast("double").alias("rows"))
        .select(((F.col("step") + 0.5) / STEPS).alias("measure"), F.col("quality").cast("double").alias("quality"), "rows")
    )
    vector = VectorAssembler(inputCols=["measure"], outputCol="features")
    # in one order, so that sums of doubles come out the same each time
    counts = counts.coalesce(1).sortWithinPartitions("measure", "quality")
    counts = vector.transform(materialised(counts, "zstd-steps"))
    fit = {"labelCol": "quality", "weightCol": "rows"}
    steps = IsotonicRegression(featuresCol="measure", predictionCol="steps", **fit).fit(counts)
    curve = LogisticRegression(regParam=1e-5, probabilityCol="curve", **fit).fit(counts)
    scored = curve.transform(vector.transform(steps.transform(measures)))
    smooth = vector_to_array("curve")[1]
    score = F.col("steps") * (1 - LOGISTIC_SHARE) + smooth * LOGISTIC_SHARE
    return scored.select(*measures.columns, score.alias("score"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, measure and sizes of every document."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = materialised(learning_labels(labels), "zstd-labels")
    made = dictionaries(sampled_texts(docs, known))
    if len(made) == 2:
        sizes = measured(docs, made[BAD_LABEL], made[GOOD_LABEL])
        rows = calibrated(sizes, known)
    else:
        good, n = docs.join(known, F.col("doc_id") == F.col("l_id")).agg(F.sum("quality"), F.count(F.lit(1))).first()
        nothing = [F.lit(None).cast("bigint").alias(c) for c in ("bad_bytes", "good_bytes")]
        length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
        rows = docs.select("doc_id", length, *nothing).select(
            "*", F.lit(0.0).alias("measure"), F.lit(good / n if n else 0.5).alias("score")
        )
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
        "measure",
        "n_bytes",
        "bad_bytes",
        "good_bytes",
    )
