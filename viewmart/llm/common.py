"""What several training-data operators share: tables, scratch tables and word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmart.functions.storage import scratch_folder

#: White space of the word rule: space and the control characters tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The byte-level BPE file that queries and pipeline use; operators take a path."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def materialised(frame: DataFrame, label: str) -> DataFrame:
    """The frame written under the shared scratch folder and read again: lineage ends here.

    Needed where rows hold generated ids, which a repeated task could number otherwise.
    """
    spark = frame.sparkSession
    path = scratch_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unused(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, longer where ``docs`` has a column of that name (in any case) already."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a text without words, null for null."""
    return F.array_remove(F.split(text, SPACES), "")


def connected(edges: DataFrame) -> DataFrame:
    """node, component of every end of ``edges`` (a, b): the least node that edges lead to.

    Each round takes the least label of the neighbours and then the label of the label, so labels travel twice
    as far each time. Labels are written to the scratch folder after each round.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
    )
    both = materialised(both.distinct(), "edges")
    labels = both.groupBy("node").agg(F.min("near").alias("near")).select(
        "node", F.least("node", "near").alias("component")
    )
    labels = materialised(labels, "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "near"), "near")
            .groupBy("node")
            .agg(F.min("component").alias("offered"))
        )
        best = labels.join(near, "node").select(
            "node", "component", F.least("component", "offered").alias("best")
        )
        further = labels.select(F.col("node").alias("best"), F.col("component").alias("onward"))
        moved = materialised(
            best.join(further, "best", "left").select(
                "node", F.least("best", "onward").alias("component"), F.col("component").alias("before")
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.where("component != before").isEmpty():
            return labels
