"""Array helpers that keep per-document work inside the row.

A document already sits in one row, so counting its tokens or numbering its
lines needs no ``explode`` + ``groupBy`` (two shuffles); sorting and slicing
the array in place costs none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so ``body`` evaluates it only once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indices(size: Column) -> Column:
    """``[0 .. size-1]``; an empty array for size 0."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
        F.array().cast("array<int>")
    )


def _runs(keys: Column) -> Column:
    """Start positions of the runs of equal values in a sorted array."""
    return F.filter(
        indices(F.size(keys)), lambda i: (i == 0) | (F.get(keys, i) != F.get(keys, i - 1))
    )


def _run_length(starts: Column, start: Column, j: Column, size: Column) -> Column:
    return F.coalesce(F.get(starts, j + 1), size) - start


def token_counts(tokens: Column) -> Column:
    """array<string> -> array<struct<token, n>>, one entry per distinct token."""
    return let(
        F.sort_array(tokens),
        lambda s: let(
            _runs(s),
            lambda starts: F.transform(
                starts,
                lambda p, j: F.struct(
                    F.get(s, p).alias("token"),
                    _run_length(starts, p, j, F.size(s)).alias("n"),
                ),
            ),
        ),
    )


def top_tokens(tokens: Column, n: int) -> Column:
    """Most frequent tokens first, ties by first appearance: array<struct<token, n>>."""

    def ranked(s: Column, keys: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda p, j: F.struct(
                (-_run_length(starts, p, j, F.size(keys))).alias("neg"),
                F.get(s, p)["pos"].alias("first"),
                F.get(keys, p).alias("token"),
            ),
        )

    pairs = F.transform(tokens, lambda t, i: F.struct(t.alias("token"), i.alias("pos")))
    order = let(
        F.sort_array(pairs),
        lambda s: let(
            s["token"],
            lambda keys: let(_runs(keys), lambda starts: ranked(s, keys, starts)),
        ),
    )
    return F.transform(
        F.slice(F.sort_array(order), 1, n),
        lambda r: F.struct(r["token"].alias("token"), (-r["neg"]).alias("n")),
    )


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams with low <= n <= high, words joined by one space."""

    def grams(toks: Column, n: int) -> Column:
        if n == 1:
            return toks
        return F.transform(
            indices(F.size(toks) - (n - 1)),
            lambda i: F.concat_ws(" ", *[F.get(toks, i + k) for k in range(n)]),
        )

    if low == high == 1:
        return tokens
    return let(tokens, lambda t: F.concat(*[grams(t, n) for n in range(low, high + 1)]))


def prefix_sums(values: Column) -> Column:
    """Exclusive running sums: ``[3, 4, 5] -> [0, 3, 7]`` (int)."""
    state = F.aggregate(
        values,
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("sums")),
        lambda acc, v: F.struct(
            (acc["total"] + v).alias("total"),
            F.concat(acc["sums"], F.array(acc["total"])).alias("sums"),
        ),
    )
    return state["sums"]


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
