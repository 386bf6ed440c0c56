"""SimHash near-duplicates: tiled exact comparison with XOR and bit counts.

Fingerprints are compared exactly, tile against tile. A tile holds fingerprints
that agree in the population counts of both 32-bit halves; a differing bit moves
one of the counts by one, so tiles whose counts differ by more than the radius
cannot hold a link and never meet. Inside a pair of tiles the counts of the
lowest 16 bits narrow the comparison further.

Defined cases: a null text is empty; a text without words has fingerprint zero
and links like any other; equal fingerprints are one class whatever their
number; a very long text is hashed in slices, in one task; rows repeat as given; a null id keeps its row and never names a
component unless nothing else is in it (then the component id is null); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import Groups, components_of, row_chunks, stored, tile_pairs
from foliant.operators.joins import lookup

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE_ROWS = 16_384
_CELLS = 2_000_000  # entries of one comparison matrix
_HASHES = 65_536  # shingle hashes counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit majority vote over the XXH64 hashes of all word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s : e - 1], seed) for s, e in zip(starts, starts[width:], strict=False)),
        dtype="<u8",
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _HASHES):
        bits = np.unpackbits(hashes[at : at + _HASHES].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """id, digest (hash of the text as given), fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            columns = [batch.column("id"), batch.column("digest"), pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("digest"),
        F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(run, "id long, digest long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _links(left: np.ndarray, right: np.ndarray, radius: int):
    """Index pairs within the radius. ``right`` is sorted by its low count."""
    low = np.uint64(0xFFFF)
    right_counts = np.bitwise_count(right & low)
    left_counts = np.bitwise_count(left & low)
    for count in np.unique(left_counts):
        rows = np.flatnonzero(left_counts == count)
        a = np.searchsorted(right_counts, max(0, int(count) - radius), "left")
        b = np.searchsorted(right_counts, int(count) + radius, "right")
        for part in row_chunks(len(rows), b - a, _CELLS):
            near = np.bitwise_count(left[rows[part], None] ^ right[None, a:b]) <= radius
            i, j = np.nonzero(near)
            yield rows[part][i], j + a


def compare_tiles(left: np.ndarray, right: np.ndarray | None, radius: int):
    """(u, v) arrays that join what is linked: at most one row per fingerprint."""
    left = left[np.argsort(np.bitwise_count(left & np.uint64(0xFFFF)), kind="stable")]
    if right is not None:
        right = right[np.argsort(np.bitwise_count(right & np.uint64(0xFFFF)), kind="stable")]
    both = left if right is None else np.concatenate([left, right])
    shift = 0 if right is None else len(left)
    groups = Groups(len(both))
    for i, j in _links(left, left if right is None else right, radius):
        groups.link(i, j + shift)
    moved = np.flatnonzero(groups.label != np.arange(len(both)))
    return both[moved], both[groups.label[moved]]


def near_links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """u, v: links whose closure is the closure of all pairs within the radius.

    ``distinct`` has each fingerprint ``fp`` once.
    """
    cells = distinct.select(
        "fp",
        F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int").alias("low"),
        F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int").alias("high"),
    )
    reach = range(-radius, radius + 1)
    deltas = [(a, b) for a in reach for b in reach if abs(a) + abs(b) <= radius and (a, b) >= (0, 0)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for same, left, right in zip(batch["same"], batch["left"], batch["right"], strict=True):
                u, v = compare_tiles(
                    np.asarray(left, np.int64).view(np.uint64),
                    None if same else np.asarray(right, np.int64).view(np.uint64),
                    radius,
                )
                yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    pairs = tile_pairs(cells, [], ["low", "high"], deltas, "fp", tile_rows)
    return pairs.mapInPandas(run, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
    shingle: int = SHINGLE,
) -> DataFrame:
    """id, digest (hash of the text as given), fp, component (a fingerprint of the
    class, never null), component_id (smallest id reachable over links of at most
    ``radius`` differing bits)."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle))
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")))
    parts = components_of(near_links(classes, radius, tile_rows)).withColumnRenamed("node", "fp")
    joined = stored(
        classes.join(parts, "fp", "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("component")
        )
    )
    smallest = stored(joined.groupBy("component").agg(F.min("first").alias("component_id")))
    table = stored(lookup(joined, smallest, "component").select("fp", "component", "component_id"))
    return lookup(rows, table, "fp", "left").select("id", "digest", "fp", "component", "component_id")
