"""Embedding near-duplicates: tiled comparison along principal axes.

Unit vectors are rotated to the principal axes of all vectors. Two vectors at
cosine c are sqrt(2 - 2c) apart, hence at most that far on each axis: slabs of
that width on the two leading axes form cells, and only neighbouring cells meet,
tile against tile. Within a pair of tiles the products of the leading axes are
summed first; what the rest can add is bounded by the product of the suffix
norms, and pairs that cannot reach the threshold stop there. Survivors are
decided by the cosine of the given vectors in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of different
length never link; components of any finite size take part; equal vectors of a label are compared once and counted as
often as they occur (repeated rows too); a null id keeps its row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import Groups, components_of, row_chunks, stored, tile_pairs
from foliant.operators.joins import lookup

THRESHOLD = 0.98
TILE_ROWS = 2_048
STEPS = (8, 16, 32)
_SLACK = 1e-9  # rounding of rotated products
_CELLS = 250_000


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, node (null where the vector takes no part), dim, h1, h2, vector."""
    v, x = F.col(vector_col).cast("array<double>"), F.col("vector")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    usable = F.col("label").isNotNull() & finite & F.exists(x, lambda c: c != 0.0)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("vector")
    ).withColumns(
        {
            "dim": F.size("vector"),
            "h1": F.xxhash64("vector"),
            "h2": F.xxhash64(F.lit("second"), "vector"),
        }
    )
    node = F.concat_ws(":", F.col("label").cast("string"), "h1", "h2")
    # Squares of very large or small components leave the doubles; a factor changes no cosine.
    top = F.array_max(F.transform(x, F.abs))
    scaled = F.when((top > 1e150) | (top < 1e-150), F.transform(x, lambda c: c / top)).otherwise(x)
    return rows.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), node)).withColumn(
        "vector", F.when(F.col("node").isNotNull(), scaled)
    )


def _rotations(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes by vector length, from the second moments of all vectors."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.stack(part["vector"].to_numpy())
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                x *= np.sqrt(part["n"].to_numpy(float))[:, None]
                sums[dim] = sums.get(dim, 0.0) + x.T @ x
        if sums:
            yield pd.DataFrame({"dim": list(sums), "sums": [s.ravel() for s in sums.values()]})

    summed = (
        nodes.select("dim", "vector", "n")
        .mapInPandas(moments, "dim int, sums array<double>")
        .select("dim", F.posexplode("sums"))
        .groupBy("dim", "pos")
        .agg(F.sum("col").alias("total"))
        .toPandas()
    )
    axes = {}
    for dim, part in summed.groupby("dim"):
        gram = np.zeros(dim * dim)
        gram[part["pos"].to_numpy()] = part["total"].to_numpy()
        axes[int(dim)] = np.linalg.eigh(gram.reshape(dim, dim))[1][:, ::-1].copy()
    return axes


def _unpack(items, dim: int):
    head = np.dtype([("h1", "<i8"), ("h2", "<i8"), ("n", "<i8"), ("vector", "<f8", (dim,))])
    return np.frombuffer(b"".join(items), dtype=head)


def close_pairs(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float):
    """Index pairs of rows with cosine >= threshold, in chunks."""
    norms = [np.linalg.norm(x, axis=1) for x in (left, right)]
    a, b = ((x / n[:, None]) @ axes for x, n in zip((left, right), norms, strict=True))
    dim = a.shape[1]
    steps = [s for s in STEPS if s < dim] + [dim]
    rest_a, rest_b = (
        [np.sqrt((x[:, s:] ** 2).sum(axis=1)) for s in steps] for x in (a, b)
    )
    need = threshold - _SLACK
    for part in row_chunks(len(a), len(b), _CELLS):
        lead = a[part, : steps[0]] @ b[:, : steps[0]].T
        i, j = np.nonzero(lead + rest_a[0][part, None] * rest_b[0][None, :] >= need)
        total, i = lead[i, j], i + part.start
        for k in range(1, len(steps)):
            cut = slice(steps[k - 1], steps[k])
            total = total + np.einsum("ij,ij->i", a[i, cut], b[j, cut])
            keep = total + rest_a[k][i] * rest_b[k][j] >= need
            i, j, total = i[keep], j[keep], total[keep]
        cosine = np.einsum("ij,ij->i", left[i], right[j]) / (norms[0][i] * norms[1][j])
        yield i[cosine >= threshold], j[cosine >= threshold]


def _linked(nodes: DataFrame, axes: dict, threshold: float, tile_rows: int) -> DataFrame:
    """node, root, links: per pair of tiles the links of a node and one edge of its group."""
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    shared = nodes.sparkSession.sparkContext.broadcast(axes)

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                x = np.stack(part["vector"].to_numpy())
                lead = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ shared.value[dim][:, :2]
                slab = np.floor(lead / width).astype(np.int32)
                head = part[["h1", "h2", "n"]].to_numpy(np.int64)
                yield pd.DataFrame(
                    {
                        "label": part["label"].to_numpy(),
                        "dim": dim,
                        "s1": slab[:, 0],
                        "s2": slab[:, -1],
                        "payload": [h.tobytes() + v.tobytes() for h, v in zip(head, x, strict=True)],
                    }
                )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                left = _unpack(row.left, row.dim)
                right = left if row.same else _unpack(row.right, row.dim)
                both = left if row.same else np.concatenate([left, right])
                shift = 0 if row.same else len(left)
                links, groups = np.zeros(len(both), np.int64), Groups(len(both))
                found = close_pairs(left["vector"], right["vector"], shared.value[row.dim], threshold)
                for i, j in found:
                    apart = (i != j) | (not row.same)
                    i, j = i[apart], j[apart]
                    np.add.at(links, i, right["n"][j])
                    if not row.same:
                        np.add.at(links, j + shift, left["n"][i])
                    groups.link(i, j + shift)
                hit = np.flatnonzero(links)
                if len(hit):
                    name = [f"{row.label}:{a}:{b}" for a, b in zip(both["h1"], both["h2"], strict=True)]
                    yield pd.DataFrame(
                        {
                            "node": [name[k] for k in hit],
                            "root": [name[k] for k in groups.label[hit]],
                            "links": links[hit],
                        }
                    )

    schema = "label string, dim int, s1 int, s2 int, payload binary"
    rows = nodes.select(F.col("label").cast("string").alias("label"), "dim", "h1", "h2", "n", "vector")
    half = [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]
    pairs = tile_pairs(
        rows.mapInPandas(cells, schema), ["label", "dim"], ["s1", "s2"], half, "payload", tile_rows
    )
    return pairs.mapInPandas(compare, "node string, root string, links long")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """id, n_links, component_id, kept: every row of ``vectors`` once."""
    rows = _prepared(vectors, id_col, vector_col, label_col)
    slim = stored(rows.select("id", "node"))
    nodes = stored(
        rows.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.count("*").alias("n"),
            F.min("id").alias("first"),
            *[F.first(c).alias(c) for c in ("label", "dim", "h1", "h2", "vector")],
        )
    )
    linked = stored(_linked(nodes, _rotations(nodes), threshold, tile_rows))
    parts = components_of(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = stored(
        nodes.select("node", "n", "first")
        .join(counts, "node", "left")
        .join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = stored(joined.groupBy("component").agg(F.min("first").alias("component_id")))
    table = stored(
        lookup(joined, smallest, "component").select(
            "node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
        )
    )
    out = lookup(slim, table, "node", "left")
    return out.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True))
        .otherwise(F.col("id").eqNullSafe(F.col("component_id")))
        .alias("kept"),
    )
