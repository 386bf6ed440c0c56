"""Name -> query and name -> oracle SQL, filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Unique key of each table that is spread over the cores when it is one split.
_KEYS = {
    "documents": "doc_id",
    "pages": "page_id",
    "conversations": "conv_id",
    "embeddings": "vec_id",
    "labels": "doc_id",
    "benchmark": "item_id",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
}


def query(name: str, sql: str | None = None):
    """Register a query and, where the result can be written in SQL, its oracle."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are expensive to process, spread over the cores."""
    return spread(table(spark, sf_dir, name), _KEYS[name])


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)

