"""Global running sums and ranks without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.joins import lookup
from foliant.session import durable

BUCKETS = 512  # at least
ROWS_PER_BUCKET = 500_000


def range_buckets(df: DataFrame, order: str, buckets: int | None = None) -> DataFrame:
    """Add ``_bucket``: order-preserving, each holding about 1/buckets of the rows.

    By default as many buckets as keep each near ``ROWS_PER_BUCKET`` rows.
    """
    if buckets is None:
        buckets = max(BUCKETS, df.count() // ROWS_PER_BUCKET)
    share = [i / buckets for i in range(1, buckets)]
    found = df.agg(
        F.percentile_approx(F.col(order).cast("double"), share, buckets * 20).alias("s")
    ).first()["s"]
    splits = [float("-inf"), *sorted(set(found or [0.0])), float("inf")]
    return (
        Bucketizer(splits=splits, inputCol="_order", outputCol="_bucket")
        .transform(df.withColumn("_order", F.col(order).cast("double")))
        .drop("_order")
    )


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    values: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Add ``cum_<value>``: inclusive running sums along ``order`` in each group.

    Rows must be unique per (group, order). Bucket totals give every bucket its
    offset, so a window only ever sorts one bucket of one group.
    """
    bucketed = range_buckets(df, order, buckets)
    keys = [*group, "_bucket"]
    totals = bucketed.groupBy(*keys).agg(*[F.sum(v).alias(f"_{v}") for v in values])
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values]
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select("*", *[F.sum(v).over(inside).alias(f"_in_{v}") for v in values])
    joined = local.join(offsets, keys)
    return joined.select(
        *df.columns, *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values]
    )


_HASH_BITS = 63


def hash_parts(
    df: DataFrame, cuts: DataFrame, group: str, id_col: str, seed: int, buckets: int = 4096
) -> DataFrame:
    """Add ``part``: cut every group at exact ranks of a seeded hash order.

    ``cuts`` has one row per group with ``cuts``, an array of row counts; part 0
    is the first cuts[0] rows, part 1 the rows up to cuts[1], and so on. Only
    the ids are counted and, within one hash bucket per cut, sorted: the result
    is a comparison with a few cut values, so wide rows are never shuffled.
    """
    shift = _HASH_BITS - (buckets.bit_length() - 1)
    position = F.xxhash64(F.col(id_col), F.lit(seed)).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    narrow = df.select(group, F.col(id_col).alias("_id"), position.alias("_hash")).withColumn(
        "_bucket", F.shiftright("_hash", shift)
    )
    counts = narrow.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    wanted = cuts.select(group, F.posexplode("cuts").alias("_no", "_cut"))
    # The bucket a cut falls in, and the rank of its last row in there.
    inside = (F.col("_cut") > F.col("_off")) & (F.col("_cut") <= F.col("_off") + F.col("_n"))
    marks = durable(
        offsets.join(F.broadcast(wanted), group)
        .filter(inside)
        .select(group, "_bucket", "_no", (F.col("_cut") - F.col("_off")).alias("_rank"))
    )
    touched = F.broadcast(marks.select(group, "_bucket").distinct())
    in_bucket = Window.partitionBy(group, "_bucket").orderBy("_hash", "_id")
    ranked = narrow.join(touched, [group, "_bucket"]).withColumn(
        "_rank", F.row_number().over(in_bucket).cast("long")
    )
    edges = ranked.join(F.broadcast(marks), [group, "_bucket", "_rank"]).groupBy(group).agg(
        F.collect_list(F.struct("_hash", "_id")).alias("_edges")
    )
    empty = F.size(F.filter("cuts", lambda c: c <= 0))
    table = durable(
        cuts.select(group, empty.alias("_empty")).join(edges, group, "left")
    )
    own = F.struct(position.alias("_hash"), F.col(id_col).alias("_id"))
    passed = F.coalesce(F.size(F.filter("_edges", lambda e: own > e)), F.lit(0))
    return lookup(df, table, group).select(
        *df.columns, (F.col("_empty") + passed).alias("part")
    )
