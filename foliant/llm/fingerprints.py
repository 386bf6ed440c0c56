"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes: h = (h << 2) + gear[byte], 16 bits, so a
value depends on the last 8 bytes only. A chunk ends where the top bits of the
hash are zero; normalised: more bits are asked for before the usual length than
after it. Boundaries follow the content, so an edit changes the chunks it touches
and the rest keep their digests wherever they move. A fingerprint is the set of
chunk digests of a text with their lengths; the likeness of two fingerprints is
containment by length: what both hold, over the length of the larger set.

As a string a fingerprint is the base64 text of its sorted entries, 4 bytes of
digest and 1 of length each. Equal texts have equal fingerprints; the fingerprint
of an empty text is the empty string, and two of those are alike (1.0).

Defined cases: a null text is empty; ids are ordered with nulls last in the
descending order, equal ids by the hash of their text; a very long text is hashed in
slices, in one task; rows equal in id and text stay in one task; a table of one row is its own next document; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import range_index

SHORTEST = 8  # also the reach of the gear hash
USUAL = 24
LONGEST = 96
STRICT_BITS = 6
LOOSE_BITS = 3
PARTITION_ROWS = 5_000
MOST_BUCKETS = 20_000
_SLICE = 1 << 22  # bytes hashed at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_GEAR64 = _mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_GEAR16 = (_GEAR64 >> np.uint64(48)).astype(np.uint16)
_BASE = np.uint64(0x9FB21C651E98DF25)  # odd: powers never vanish


def boundaries(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a byte array, the end of the data included."""
    n, found, strict = len(data), [], []
    for at in range(0, n, _SLICE):
        h = _GEAR16[data[max(0, at - SHORTEST) : at + _SLICE]]
        for reach in (1, 2, 4):  # the sum over 8 bytes, by doubling
            before = np.zeros_like(h)
            before[reach:] = h[:-reach] << np.uint16(2 * reach)
            h = h + before
        h = h[min(at, SHORTEST) :]
        hit = np.flatnonzero(h >> np.uint16(16 - LOOSE_BITS) == 0)
        found.append(hit + at + 1)
        strict.append(h[hit] >> np.uint16(16 - STRICT_BITS) == 0)
    ends, start = [], 0
    if found:
        for end, is_strict in zip(
            np.concatenate(found).tolist(), np.concatenate(strict).tolist(), strict=True
        ):
            while end - start > LONGEST:
                start += LONGEST
                ends.append(start)
            size = end - start
            if size >= USUAL or (size >= SHORTEST and is_strict):
                ends.append(end)
                start = end
    while n - start > LONGEST:
        start += LONGEST
        ends.append(start)
    if n > start:
        ends.append(n)
    return np.asarray(ends, np.int64)


_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """_BASE to the powers 0 to n - 1, kept for the next text."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]), dtype=np.uint64)
    return _powers[:n]


def chunk_digests(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of the content of each chunk."""
    starts = np.concatenate([[0], ends[:-1]])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    terms = _GEAR64[data] * _power(LONGEST + 1)[place]
    sums = np.add.reduceat(terms, starts)
    return _mix(sums ^ ((ends - starts).astype(np.uint64) * _STEP))


class Fingerprint:
    """Sorted digests of a text's chunks, and their lengths."""

    __slots__ = ("digests", "sizes", "total")

    def __init__(self, text: str):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if not len(data):
            self.digests, self.sizes, self.total = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
            return
        ends = boundaries(data)
        digests = (chunk_digests(data, ends) >> np.uint64(32)).astype(np.uint32)
        sizes = np.diff(ends, prepend=0)
        self.digests, first = np.unique(digests, return_index=True)
        self.sizes = sizes[first]
        self.total = int(self.sizes.sum())

    def __str__(self) -> str:
        entries = np.empty(len(self.digests), np.dtype([("d", ">u4"), ("s", "u1")]))
        entries["d"], entries["s"] = self.digests, self.sizes
        return base64.b64encode(entries.tobytes()).decode()

    def likeness(self, other: Fingerprint) -> float:
        if not self.total or not other.total:
            return float(self.total == other.total)
        _, mine, _ = np.intersect1d(
            self.digests, other.digests, assume_unique=True, return_indices=True
        )
        return float(self.sizes[mine].sum()) / max(self.total, other.total)


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the start of the next."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_OUT = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


_ARROW = pa.schema(
    [(c.split()[0], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]]) for c in _OUT.split(", ")]
)


def _row(i: int | None, body: str, prints: Fingerprint, text: str, following: Fingerprint) -> dict:
    """The result of one document beside the next one's text and fingerprint."""
    changed = edited(body, text)
    other = Fingerprint(changed) if changed != body else prints
    values = (
        i,
        len(body),
        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        str(prints),
        str(other),
        prints.likeness(other),
        prints.likeness(following),
    )
    return dict(zip(_ARROW.names, values, strict=True))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of sorted rows; guests only serve as the next of the row before."""
    held = None
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("id", "text", "guest"))
        for i, text, guest in zip(*columns, strict=True):
            current = (i, text, Fingerprint(text))
            if held is not None:
                out.append(_row(*held, *current[1:]))
            held = None if guest else current
        yield pa.RecordBatch.from_pylist(out, _ARROW)


def _bounds(keys: list[float], unnamed: float) -> tuple[list[float], set[float]]:
    """Ascending starts of the ranges, and those that start a range of one key alone.

    A key that several quantiles name is frequent: it gets a range of its own.
    """
    times = Counter(keys)
    alone = {k for k, n in times.items() if n > 1 and (k == unnamed or abs(k) < 2**53)}
    starts = set(keys) | {math.nextafter(k, math.inf) for k in alone}
    return sorted(starts), alone


def fingerprint_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    partition_rows: int = PARTITION_ROWS,
    most_buckets: int = MOST_BUCKETS,
) -> DataFrame:
    """Fingerprint each text, its edited text and compare with both and the next document.

    Texts move once: into buckets of neighbouring ids, sorted. Rows without an id, and
    those of a frequent id, are dealt to several buckets by the hash of their text. The
    first document of a bucket also goes to the bucket before it as a guest, found on the
    ids alone, so no document is looked up and no bucket waits for another. There are at
    most about ``2 * most_buckets`` buckets, larger ones for larger tables: tasks read them
    as a stream, and what the driver lists and broadcasts has that bound.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # Descending ids, nulls last: the key ascends with the order of the documents.
    unnamed = 1e19
    key = F.coalesce(-F.col("id").cast("double"), F.lit(unnamed))
    n = docs.count()
    rows_each = max(partition_rows, -(-n // most_buckets))
    parts = max(1, -(-n // rows_each))
    bounds, alone = [], set()
    if parts > 1:
        marks = [k / parts for k in range(1, parts)]
        found = rows.agg(F.percentile_approx(key, F.lit(marks), F.lit(max(100_000, 10 * parts))).alias("k"))
        bounds, alone = _bounds(found.first()["k"], unnamed)
    span = range_index(key, bounds).cast("int")
    pieces = [1] * (len(bounds) + 1)
    if alone:
        counted = rows.groupBy(span.alias("span")).agg(F.count("*").alias("rows")).collect()
        for r in counted:
            if r["span"] and bounds[r["span"] - 1] in alone:
                pieces[r["span"]] = max(1, -(-r["rows"] // rows_each))
    first = [sum_ - p for sum_, p in zip(accumulate(pieces), pieces, strict=True)]
    share = F.col("digest").cast("double") / F.lit(2.0**64) + F.lit(0.5)
    inside = F.least(F.floor(share * F.col("pieces")), F.col("pieces") - 1).cast("int")
    keyed = (
        rows.select("id", "text", F.xxhash64("text").alias("digest"), span.alias("span"))
        .withColumn("pieces", F.get(F.lit(pieces), F.col("span")))
        .select("id", "text", "digest", (F.get(F.lit(first), F.col("span")) + inside).alias("bucket"))
    )
    order = [F.desc_nulls_last("id"), F.asc("digest"), F.asc("text")]
    # The head of each bucket: its largest id, the smallest text hash among equals.
    down = F.bitwise_not(F.col("id"))
    heads = keyed.groupBy("bucket").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), down.alias("down"), "digest")).alias("head")
    )
    tops = sorted(
        (r["bucket"], None if r["head"]["last"] else ~r["head"]["down"], r["head"]["digest"])
        for r in heads.collect()
    )
    if not tops:
        return spark.createDataFrame([], _OUT)
    # A head is the guest of the bucket before; the first one of the last bucket.
    table = spark.createDataFrame(
        [(i is None, i or 0, d, tops[k - 1][0]) for k, (_, i, d) in enumerate(tops)],
        "none boolean, top long, top_digest long, host int",
    )
    matched = keyed.join(
        F.broadcast(table),
        (F.col("id").isNull() == F.col("none"))
        & (F.coalesce("id", F.lit(0)) == F.col("top"))
        & (F.col("digest") == F.col("top_digest")),
    )
    guests = matched.dropDuplicates(["host", "id", "digest"]).select(
        "id", "text", "digest", F.col("host").alias("bucket"), F.lit(True).alias("guest")
    )
    everyone = keyed.select("id", "text", "digest", "bucket", F.lit(False).alias("guest")).unionByName(guests)
    ranged = everyone.repartition(len(tops), "bucket").sortWithinPartitions("bucket", "guest", *order)
    return ranged.select("id", "text", "guest").mapInArrow(_in_order, _OUT)
