"""Packing documents into windows by non-negative least squares.

A document of n ids is cut into full windows and a tail. Tails are counted in
bins of ``UNIT`` ids. Every combination of up to three bins that fills a window
is a column; non-negative least squares finds how often each should repeat so
that together they use up the histogram; the counts are rounded down to what the
histogram holds. Tails are numbered within their bin, and the number decides the
window and the place. The rest (what rounding and the shapes leave) is packed
greedily one after the other, cut where a window is full, so that at most the
last of those windows is short.

Only bins and windows per partition are added up centrally; tails are numbered
by partition and bin, never by a sort of all rows, so a length shared by a third
of all documents is spread like any other.

Defined cases: a null text is empty and has the end id alone; repeated rows and
ids are packed as often as they occur; a very long text is many full windows; should the
rounds of the solver run out, its last point is rounded and the greedy rest is larger; a null id keeps its pieces; an empty
table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.llm.word_tokens import END_ID, crc32_all, larger_batches, word_tokens
from foliant.operators.joins import lookup

WINDOW = 2_048
UNIT = 8

_TAILS = (
    "id long, n long, part int, pos long, fulls_before long, full_crcs array<bigint>, "
    "bin int, rank long, tail int, tail_crc long, tail_ids binary"
)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 3_000) -> np.ndarray:
    """x >= 0 that minimises |a x - b|: active-set method with bounded rounds."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slope = a.T @ b
    limit = 1e-9 * max(1.0, float(np.abs(slope).max(initial=0.0)))
    for _ in range(rounds):
        slope[active] = -np.inf
        if active.all() or slope.max(initial=-np.inf) <= limit:
            break
        active[int(np.argmax(slope))] = True
        while True:
            chosen = np.flatnonzero(active)
            best = np.linalg.lstsq(a[:, chosen], b, rcond=None)[0]
            if (best > 0).all():
                x[:] = 0.0
                x[chosen] = best
                break
            low = best <= 0
            old = x[chosen]
            step = np.min(old[low] / np.maximum(old[low] - best[low], 1e-300))
            x[chosen] = np.maximum(old + step * (best - old), 0.0)
            gone = chosen[low & (x[chosen] <= 1e-12)]
            if not len(gone):
                gone = chosen[[int(np.argmin(np.where(low, x[chosen], np.inf)))]]
            x[gone], active[gone] = 0.0, False
        slope = a.T @ (b - a @ x)
    return x


def combinations(bins: list[int], units: int) -> list[tuple[int, ...]]:
    """Up to three bins, ascending, that add up to ``units``."""
    have = set(bins)
    found = [(units,)] if units in have else []
    for a in sorted(have):
        if 2 * a <= units and units - a in have:
            found.append((a, units - a))
        for b in (b for b in have if a <= b and units - a - b >= b):
            if units - a - b in have:
                found.append((a, b, units - a - b))
    return sorted(found)


def repeats(histogram: dict[int, int], units: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations with how often each is used; never more than the histogram has."""
    bins = sorted(histogram)
    shapes = combinations(bins, units)
    if not shapes:
        return []
    row = {b: k for k, b in enumerate(bins)}
    a = np.zeros((len(bins), len(shapes)))
    for column, shape in enumerate(shapes):
        for b in shape:
            a[row[b], column] += 1
    counts = np.array([histogram[b] for b in bins], float)
    x = nonnegative_least_squares(a, counts / counts.max()) * counts.max()
    left, plan = dict(histogram), []
    for column in sorted(range(len(shapes)), key=lambda c: -x[c]):
        wanted, shape = int(np.floor(x[column] + 0.5)), shapes[column]
        times = min([wanted, *(left[b] // shape.count(b) for b in set(shape))])
        if times > 0:
            plan.append((shape, times))
            for b in shape:
                left[b] -= times
    return plan


def _tails(docs: DataFrame, path: str, window: int, unit: int, end_id: int) -> DataFrame:
    """One row per document: full windows and the tail, numbered within partition and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(path)
        part, pos, fulls = TaskContext.get().partitionId(), 0, 0
        ranks = np.zeros(-(-window // unit) + 1, np.int64)
        for batch in larger_batches(batches):
            ids, bounds = encoder.encode_column(batch.column("text"), end_id)
            sizes = np.diff(bounds)
            full, tails = np.divmod(sizes, window)
            cuts = bounds[1:] - tails
            # Checksums of the windows: each document's full ones, then its tail.
            edges = np.repeat(bounds[:-1], full + 1) + window * _within(full + 1)
            crcs = crc32_all(ids, np.append(edges, bounds[-1]))
            last = np.cumsum(full + 1) - 1
            is_full = np.ones(len(edges), bool)
            is_full[last] = False
            which = -(-tails // unit)
            rank = ranks[which] + _place_within(which)
            ranks += np.bincount(which, minlength=len(ranks))
            before = fulls + np.cumsum(full) - full
            view = ids.tobytes()
            rests = [view[4 * a : 4 * b] for a, b in zip(cuts.tolist(), bounds[1:].tolist(), strict=True)]
            columns = [
                batch.column("id"),
                pa.array(sizes),
                pa.array(np.full(len(sizes), part, np.int32)),
                pa.array(pos + np.arange(len(sizes))),
                pa.array(before),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(full)).astype(np.int32)), pa.array(crcs[is_full])),
                pa.array(which.astype(np.int32)),
                pa.array(rank),
                pa.array(tails.astype(np.int32)),
                pa.array(crcs[last]),
                pa.array(rests, pa.binary()),
            ]
            pos, fulls = pos + len(sizes), fulls + int(full.sum())
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _TAILS.split(", ")])

    return docs.mapInArrow(run, _TAILS)


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each run of the given sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _place_within(groups: np.ndarray) -> np.ndarray:
    """How many equal values stand before each one."""
    order = np.argsort(groups, kind="stable")
    place = np.empty(len(groups), np.int64)
    place[order] = _within(np.bincount(groups))
    return place


def _running(df: DataFrame, value: str, over: str, within: str | None = None) -> F.Column:
    """Sum of ``value`` over the rows before, by ``over``: tables of one row per partition."""
    order = Window.partitionBy(within) if within else Window.partitionBy(F.lit(0))
    order = order.orderBy(over).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(order), F.lit(0))


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    unit: int = UNIT,
    end_id: int = END_ID,
) -> DataFrame:
    """id, start, length, crc, n, sequence_id, offset: every id in exactly one piece."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(_tails(docs, path, window, unit, end_id))

    # Full windows: one sequence each, numbered partition after partition.
    full_counts = rows.groupBy("part").agg(F.sum(F.size("full_crcs")).alias("fulls"))
    full_base = stored(full_counts.withColumn("base", _running(full_counts, "fulls", "part")))
    n_full = full_base.agg(F.sum("fulls")).first()[0] or 0
    fulls = lookup(
        rows.filter(F.size("full_crcs") > 0), full_base.select("part", "base"), "part"
    ).select(
        "id",
        "n",
        (F.col("base") + F.col("fulls_before")).alias("first"),
        F.posexplode("full_crcs").alias("k", "crc"),
    )
    fulls = fulls.select(
        "id",
        (F.col("k") * F.lit(window)).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        "crc",
        "n",
        (F.col("first") + F.col("k")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    # Tails: number them over all partitions, bin by bin.
    tails = rows.filter("tail > 0").select("id", "n", "part", "pos", "bin", "rank", "tail", "tail_crc")
    bins = tails.groupBy("part", "bin").agg(F.count("*").alias("rows"))
    bins = stored(bins.withColumn("before", _running(bins, "rows", "part", "bin")))
    histogram = {r[0]: r[1] for r in bins.groupBy("bin").agg(F.sum("rows")).collect()}
    plan = repeats(histogram, window // unit)

    slots, used, sequence = [], dict.fromkeys(histogram, 0), n_full
    for shape, times in plan:
        for place, b in enumerate(shape):
            slots.append((b, used[b], used[b] + times, sequence, place))
            used[b] += times
        sequence += times
    slot_rows = spark.createDataFrame(
        slots, "slot_bin int, low long, high long, first long, place int"
    )
    cell = F.concat_ws(":", "part", "bin")
    places = lookup(
        tails.withColumn("cell", cell), bins.select(cell.alias("cell"), "before"), "cell"
    ).withColumn("number", F.col("before") + F.col("rank"))
    # The slots are bounded by the number of bins, whatever the input.
    placed = stored(
        places.join(
            F.broadcast(slot_rows),
            (F.col("bin") == F.col("slot_bin")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high")),
            "left",
        ).select(
            "id", "n", "part", "pos", "tail", "tail_crc", "place",
            (F.col("first") + F.col("number") - F.col("low")).alias("sequence_id"),
        )
    )
    start = (F.col("n") - F.col("tail")).alias("start")
    order = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    shaped = placed.filter("sequence_id IS NOT NULL").select(
        "id",
        start,
        F.col("tail").cast("long").alias("length"),
        F.col("tail_crc").alias("crc"),
        "n",
        "sequence_id",
        F.coalesce(F.sum("tail").over(order), F.lit(0)).alias("offset"),
    )

    # The rest: one stream, partition after partition, cut at every window.
    rest = placed.filter("sequence_id IS NULL").drop("sequence_id", "place")
    sums = rest.groupBy("part").agg(F.sum("tail").alias("ids"))
    sums = stored(sums.withColumn("base", _running(sums, "ids", "part")))
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("within", F.coalesce(F.sum("tail").over(inside), F.lit(0)))
    rest = lookup(rest, sums.select("part", "base"), "part").withColumn(
        "at", (F.col("base") + F.col("within")).cast("long")
    )
    room = (F.lit(window) - F.col("at") % window).cast("int")
    rest = stored(rest.withColumn("head", F.least(room, F.col("tail"))))
    whole = rest.filter("head = tail").select(
        "id",
        start,
        F.col("tail").cast("long").alias("length"),
        F.col("tail_crc").alias("crc"),
        "n",
        (F.lit(sequence) + F.floor(F.col("at") / window)).cast("long").alias("sequence_id"),
        (F.col("at") % window).alias("offset"),
    )
    cut = rest.filter("head < tail").select("part", "pos", "at", "head")
    ids = rows.select("part", "pos", "id", "n", "tail", "tail_ids").join(cut, ["part", "pos"])

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, tail, at, head = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "tail", "at", "head"))
            pairs = list(zip(batch.column("tail_ids").to_pylist(), (4 * head).tolist(), strict=True))
            first, begin = sequence + at // window, n - tail
            two = [
                (begin, head, [zlib.crc32(x[:k]) for x, k in pairs], n, first, at % window),
                (begin + head, tail - head, [zlib.crc32(x[k:]) for x, k in pairs], n, first + 1, 0 * at),
            ]
            for half in two:
                columns = [batch.column("id"), *(pa.array(c, pa.int64()) for c in half)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "start", "length", "crc", "n", "sequence_id", "offset"]
    schema = ", ".join(f"{c} long" for c in names)
    split = ids.mapInArrow(halves, schema)
    return fulls.unionByName(shaped).unionByName(whole).unionByName(split).select(*names)
