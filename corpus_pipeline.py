"""The corpus pipeline: toxicity, quality, near-duplicates, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir),
works on all rows that its predecessor kept and returns a DataFrame. ``run`` writes
each result as Parquet and reads it back as the documents of the next. All but the
last return the columns of documents. Rows without an id are kept by the filters
(a filter decides by the row's own text), and near-duplicates drop them only where
another row of their group stays.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import packing, quality, simhash, toxicity
from foliant.llm.common import bounded_batches, read, stored, tokenizer_path
from foliant.session import ship_package

WORDS = "word_bpe_49k.json"


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    bounded_batches(spark)


def _labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col(label).alias("label"))


def _scored(docs: DataFrame, score, threshold: float, below: bool) -> DataFrame:
    """Rows of ``docs`` whose score is below the threshold (or not below it)."""

    def run(batches):
        for batch in batches:
            scores = score(batch.column("text").to_pylist())
            yield batch.filter(pa.array((scores < threshold) == below))

    return docs.mapInArrow(run, docs.schema)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of any toxic grade is below the threshold."""
    _prepare(spark)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    model = spark.sparkContext.broadcast(toxicity.fit_toxicity(texts, _labels(spark, sf_dir, "toxic")))
    return _scored(
        docs, lambda t: model.value.probabilities(model.value.sums(t))[:, 0], toxicity.THRESHOLD, True
    )


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    _prepare(spark)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    model = spark.sparkContext.broadcast(quality.fit_quality(texts, _labels(spark, sf_dir, "quality")))
    return _scored(docs, lambda t: model.value.score(t), quality.THRESHOLD, False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links by its contract, three words and three
    bits: the one with the smallest id (no id comes last; equal ids go by the hash of their text)."""
    _prepare(spark)
    groups = simhash.near_duplicates(docs)
    key = ["unnamed", "id", "digest"]

    def keyed(rows, id_col, digest, *more):
        named = F.coalesce(F.col(id_col).cast("long"), F.lit(0))
        return rows.select(F.col(id_col).isNull().alias("unnamed"), named.alias("id"), digest.alias("digest"), *more)

    first = keyed(groups, "id", F.col("digest"), "component").groupBy("component").agg(F.min(F.struct(*key)).alias("first"))
    rows = keyed(docs, "doc_id", F.xxhash64("text"), F.struct(*docs.columns).alias("row"))
    # Copies of a row, id and text alike, are one document: the join's shuffle serves both.
    return rows.join(stored(first.select("first.*")), key, "left_semi").dropDuplicates(key).select("row.*")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed documents."""
    _prepare(spark)
    rows = packing.pack(docs, tokenizer_path(WORDS))
    return rows.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("packing", pack_windows),
]

# Trained scores and token ids: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
