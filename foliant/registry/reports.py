"""Structured report texts derived from every order and its line items."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.registry.base import table

# Reports of a task: the work on a report costs far more than its bytes let a join expect.
ROWS_PER_TASK = 25_000
_MONTHS = "January February March April May June July August September October November December"


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: one report per order with sections, dates, amounts and a table."""
    every = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    # Both sides are dealt by the join's key into parts of their own number, which are not merged
    # again by size; neither the grouping nor the join then needs another shuffle.
    parts = max(spark.sparkContext.defaultParallelism, ceil(every.count() / ROWS_PER_TASK))
    orders = every.repartition(parts, "o_orderkey")
    items = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
        .repartition(parts, "o_orderkey")
        .groupBy("o_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("items"))
    )
    key = F.col("o_orderkey").cast("string")
    day = F.col("o_orderdate").cast("date")
    month = F.get(F.array(*[F.lit(m) for m in _MONTHS.split()]), F.month(day) - 1)
    rows = F.transform(
        F.coalesce("items", F.array().cast("array<struct<l_linenumber:int,l_partkey:bigint>>")),
        lambda r: F.concat(
            r["l_linenumber"].cast("string"), F.lit("||"), r["l_partkey"].cast("string")
        ),
    )
    head = F.array(
        F.concat(F.lit("Order "), key),
        F.lit("Introduction"),
        F.concat(F.lit("Placed "), F.date_format(day, "yyyy-MM-dd"), F.lit(", see https://ex.org/o/"), key),
        F.concat(F.lit("due "), F.date_format(day, "MM/dd/yyyy"), F.lit(" or "), F.date_format(day, "dd-MM-yyyy")),
        F.concat(F.lit("signed "), month, F.lit(" "), F.dayofmonth(day).cast("string"), F.lit(", "), F.year(day).cast("string")),
        F.concat(F.lit("ref "), F.lpad(key, 9, "0")),
        F.lit(""),
        F.concat(F.lit("Total $"), F.floor("o_totalprice").cast("string"), F.lit(" at "), (F.col("o_orderkey") % 100).cast("string"), F.lit("%")),
        F.lit("Results"),
    )
    return orders.join(items.hint("shuffle_hash"), "o_orderkey", "left").select(
        F.col("o_orderkey").alias("doc_id"),
        F.array_join(F.concat(head, rows, F.array(F.lit("End"))), "\n").alias("text"),
    )


REPORTS_SQL = """reports AS (
  SELECT o_orderkey AS doc_id,
    'Order ' || o_orderkey || chr(10) || 'Introduction' || chr(10)
    || 'Placed ' || strftime(o_orderdate, '%Y-%m-%d') || ', see https://ex.org/o/' || o_orderkey || chr(10)
    || 'due ' || strftime(o_orderdate, '%m/%d/%Y') || ' or ' || strftime(o_orderdate, '%d-%m-%Y') || chr(10)
    || 'signed ' || strftime(o_orderdate, '%B %-d, %Y') || chr(10)
    || 'ref ' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || chr(10) || chr(10)
    || 'Total $' || CAST(floor(o_totalprice) AS BIGINT) || ' at ' || (o_orderkey % 100) || '%' || chr(10)
    || 'Results' || chr(10) || coalesce(items, '') || 'End' AS text
  FROM orders LEFT JOIN (
    SELECT l_orderkey, string_agg(l_linenumber || '||' || l_partkey || chr(10), ''
                                  ORDER BY l_linenumber, l_partkey) AS items
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""
