"""Shards of near-equal bytes by sampled splitters; DataFrame functions only.

Records are ordered by a key: the hash of the text, then the hash of the id, so
equal texts stand together, and a group of any size can still be cut. Each round
takes the ranges that hold more than twice their share, draws keys from them
with a chance in proportion to size, and splits them at quantiles of the sample;
it ends when no range is overfull or divisible. Bytes and rows of the ranges are
exact, so a record's place in the order is the sum over the ranges before its own
plus a running sum inside; the place in bytes gives the shard, the place in rows
the slot. No task ever sees more than one range, and the driver holds a bounded
number of splitters and range totals.

Defined cases: a null text has no bytes and the checksum of the empty text;
equal or null ids and repeated rows get slots of their own; a text of any length is one
record, larger than a shard's share if need be; rows equal in text and id share a range
and a task; if ranges are still overfull after the last round they stay so, which
changes the size of tasks, not the result; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import range_index, stored

SHARDS = 40
OVERHEAD = 16  # bytes of a record besides its text
ROWS_PER_RANGE = 50_000
FEWEST_RANGES = 160
MOST_RANGES = 8_192
SAMPLES_PER_RANGE = 16


def _splitters(records: DataFrame, total: int, ranges: int, rounds: int = 8) -> list[str]:
    target = total / ranges
    bounds: list[str] = []
    for _ in range(rounds):
        numbered = records.withColumn("range", range_index(F.col("key"), bounds))
        totals = numbered.groupBy("range").agg(F.sum("size").alias("bytes"))
        wide = F.min("key") < F.max("key")
        over = numbered.groupBy("range").agg(F.sum("size").alias("bytes"), wide.alias("wide"))
        over = over.filter((F.col("bytes") > 2 * target) & F.col("wide")) if bounds else totals
        parts = {r["range"]: -(-r["bytes"] // int(target + 1)) for r in over.collect()}
        if not parts:
            break
        # Chance in proportion to size: SAMPLES_PER_RANGE draws a target's worth of bytes.
        chance = F.pmod(F.xxhash64("key", F.lit(len(bounds))), F.lit(1 << 20)) / (1 << 20)
        draws = F.floor(F.col("size") * F.lit(SAMPLES_PER_RANGE / target) + chance)
        sample = (
            numbered.filter(F.col("range").isin(list(parts)))
            .select("range", "key", draws.alias("draws"))
            .filter("draws > 0")
            .groupBy("range", "key")
            .agg(F.sum("draws").alias("draws"))
            .orderBy("range", "key")
            .collect()
        )
        drawn: dict[int, list] = {}
        for r in sample:
            drawn.setdefault(r["range"], []).append((r["key"], r["draws"]))
        new = set(bounds)
        for which, keys in drawn.items():
            step, seen, due = sum(d for _, d in keys) / max(2, parts[which]), 0, 1
            for key, d in keys:
                seen += d
                if seen >= due * step:
                    new.add(key)
                    due = int(seen // step) + 1
        if len(new) == len(bounds):
            break
        bounds = sorted(new)
    return bounds


def shard_by_bytes(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = OVERHEAD,
) -> DataFrame:
    """id, size, text_crc32, shard, slot: near-equal bytes, slots gapless from 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hexed = [F.lpad(F.hex(F.xxhash64(c)), 16, "0") for c in (text, F.col(id_col).cast("long"))]
    records = stored(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.concat(*hexed).alias("key"),
        )
    )
    rows, total = records.agg(F.count("*"), F.sum("size")).first()
    if not rows:
        return records.select(
            "id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )
    ranges = min(MOST_RANGES, max(FEWEST_RANGES, rows // ROWS_PER_RANGE))
    bounds = _splitters(records, total, ranges)
    numbered = records.withColumn("range", range_index(F.col("key"), bounds))
    sums = numbered.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    bases, bytes_before, rows_before = [], 0, 0
    for r in sums.orderBy("range").collect():
        bases.append((r["range"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + r["bytes"], rows_before + r["rows"]
    base = docs.sparkSession.createDataFrame(bases, "range int, bytes_before long, rows_before long")
    inside = Window.partitionBy("range").orderBy("key", "id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("bytes_before") + F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2
    # One row per range, at most about MOST_RANGES.
    placed = numbered.join(F.broadcast(base), "range").select(
        "id",
        "size",
        "text_crc32",
        F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int").alias("shard"),
        (F.col("rows_before") + F.row_number().over(inside) - 1).alias("place"),
    )
    placed = stored(placed)
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).cast("long").alias("slot")
    )
