"""Sync of a curated dimension (``id, title, metadata, status, reason, node``) with its upstream.

Ids are unique on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values given to ids that appear for the first time.
NEW_STATUS = "disabled"
NEW_REASON = "awaiting curation"


def sync_dimension(current: DataFrame, upstream: DataFrame) -> DataFrame:
    """``current`` brought up to date with ``upstream`` (``id, title, metadata``).

    Ids in both take title and metadata from upstream and keep status, reason and
    node (a missing status becomes ``disabled``). Ids only upstream are added as disabled,
    awaiting curation. Ids only in ``current`` stay as they are.
    """
    new = upstream.select(
        F.col("id").alias("new_id"),
        F.col("title").alias("new_title"),
        F.col("metadata").alias("new_metadata"),
    )
    both = current.join(new, F.col("id") == F.col("new_id"), "full_outer")
    listed, known = F.col("new_id").isNotNull(), F.col("id").isNotNull()
    status = F.when(~listed, F.col("status")).when(
        known, F.coalesce("status", F.lit(NEW_STATUS))
    )
    return both.select(
        F.coalesce("id", "new_id").alias("id"),
        F.when(listed, F.col("new_title")).otherwise(F.col("title")).alias("title"),
        F.when(listed, F.col("new_metadata")).otherwise(F.col("metadata")).alias("metadata"),
        status.otherwise(F.lit(NEW_STATUS)).alias("status"),
        F.when(known, F.col("reason")).otherwise(F.lit(NEW_REASON)).alias("reason"),
        "node",
    )


def dimension_changes(current: DataFrame, upstream: DataFrame) -> DataFrame:
    """``id, change`` with change one of ``new``, ``removed``, ``common``."""
    ours = current.select("id", F.lit(True).alias("ours")).distinct()
    theirs = upstream.select("id", F.lit(True).alias("theirs")).distinct()
    change = (
        F.when(F.col("ours").isNull(), "new").when(F.col("theirs").isNull(), "removed").otherwise("common")
    )
    return ours.join(theirs, "id", "full_outer").select("id", change.alias("change"))


def change_counts(current: DataFrame, upstream: DataFrame) -> DataFrame:
    """One row ``total, new, removed``: ids upstream, ids first seen, ids gone upstream."""
    change = F.col("change")
    return dimension_changes(current, upstream).agg(
        F.count_if(change != "removed").alias("total"),
        F.count_if(change == "new").alias("new"),
        F.count_if(change == "removed").alias("removed"),
    )
