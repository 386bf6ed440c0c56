"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.components import connected_components
from foliant.operators.joins import lookup
from foliant.session import scratch_folder


BATCH_ROWS = 200
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of bounded size: texts and tiles are wide rows."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file, the same on driver and executors."""
    import public_tokenizers

    return os.path.realpath(public_tokenizers.path(name))


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared scratch folder and read back: later uses neither
    recompute the plan nor depend on the executors that ran it."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def range_index(key: Column, bounds: Sequence) -> Column:
    """How many of the ascending literals ``bounds`` are <= ``key``: binary search, native."""
    if not bounds:
        return F.lit(0)
    array = F.lit(list(bounds))
    steps = len(bounds).bit_length()
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(state, _):
        mid = F.shiftright(state["lo"] + state["hi"], 1)
        right = (state["lo"] < state["hi"]) & (F.get(array, mid) <= key)
        return F.struct(
            F.when(right, mid + 1).otherwise(state["lo"]).alias("lo"),
            F.when(right | (state["lo"] >= state["hi"]), state["hi"]).otherwise(mid).alias("hi"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["lo"])


class Groups:
    """Connected groups of the numbers 0 to n - 1, fed with arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.label[i], self.label[j]
        apart = i != j
        if not apart.any():
            return
        n = len(self.label)
        pairs = np.unique(np.minimum(i[apart], j[apart]) * n + np.maximum(i[apart], j[apart]))
        i, j = pairs // n, pairs % n
        root = np.arange(n)
        while True:
            low = np.minimum(root[i], root[j])
            after = root.copy()
            np.minimum.at(after, root[i], low)
            np.minimum.at(after, root[j], low)
            np.minimum.at(after, i, low)
            np.minimum.at(after, j, low)
            after = after[after]
            if (after == root).all() and (root[i] == root[j]).all():
                break
            root = after
        self.label = root[self.label]


def tile_pairs(
    rows: DataFrame,
    group: Sequence[str],
    axes: Sequence[str],
    deltas: Sequence[tuple[int, ...]],
    payload: str,
    tile_rows: int,
) -> DataFrame:
    """Every pair of tiles whose cells can hold partners: one row per pair, with
    ``group`` columns, ``same`` (a tile with itself), ``left`` and ``right`` (arrays of payloads).

    A cell is one value of ``group`` and integer ``axes``; ``deltas`` are half of
    the axis offsets to visit, the zero offset included. Cells of more than
    ``tile_rows`` rows are split by hash into tiles of about that size, so no task
    receives a hot cell whole and none meets more than two tiles at once.
    """
    cell = F.struct(*[F.col(c) for c in (*group, *axes)])
    rows = rows.select(cell.alias("cell"), F.col(payload).alias("payload"))
    sizes = stored(
        rows.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    )
    tile = F.pmod(F.xxhash64("payload"), F.col("tiles")).cast("int")
    tiles = stored(
        lookup(rows, sizes, "cell")
        .groupBy("cell", tile.alias("tile"))
        .agg(F.collect_list("payload").alias("items"))
    )
    numbered = sizes.select("cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    offsets = F.explode(F.array(*[F.array(*[F.lit(x) for x in d]) for d in deltas]))
    moved = F.struct(
        *[F.col(f"cell.{c}").alias(c) for c in group],
        *[(F.col(f"cell.{a}") + F.col("delta")[k]).cast("int").alias(a) for k, a in enumerate(axes)],
    )
    near = numbered.withColumn("delta", offsets).select("cell", "tile", moved.alias("cell2"))
    other = numbered.select(F.col("cell").alias("cell2"), F.col("tile").alias("tile2"))
    pairs = near.join(other, "cell2").filter("cell <> cell2 OR tile <= tile2")
    left = tiles.withColumnRenamed("items", "left")
    right = tiles.select(
        F.col("cell").alias("cell2"), F.col("tile").alias("tile2"), F.col("items").alias("right")
    )
    return (
        pairs.join(left, ["cell", "tile"])
        .join(right, ["cell2", "tile2"])
        .select(
            *[F.col(f"cell.{c}").alias(c) for c in group],
            F.expr("cell = cell2 AND tile = tile2").alias("same"),
            "left",
            "right",
        )
    )


def components_of(edges: DataFrame) -> DataFrame:
    """node, component of every node that has an edge (u, v)."""
    edges = stored(edges.filter("u <> v").distinct())
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return connected_components(nodes, edges)


def row_chunks(n: int, m: int, most: int) -> Iterator[slice]:
    """Slices of 0..n whose product with m stays near ``most``."""
    step = max(1, most // max(m, 1))
    for start in range(0, n, step):
        yield slice(start, min(n, start + step))
