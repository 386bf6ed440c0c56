"""Bounded samples of labelled documents, shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, divisible by FOLDS."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """id, text, label of at most ``most`` labelled rows outside the held-out fold.

    The rows with the smallest id hashes are taken, so the sample is the same
    whatever the partitions. ``docs`` has id, text; ``labels`` id and the label.
    Ids labelled more than once count with their largest label. Where ids repeat
    among the documents, the bound holds for the documents.
    """
    chosen = (
        labels.filter(F.col("id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    # At most ``most`` rows of two numbers.
    return docs.select("id", "text").join(F.broadcast(chosen), "id").limit(most)
