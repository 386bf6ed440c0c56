"""Mixing sources to target weights by blocks drawn through index permutations.

The words of a source form one stream, document after document in the order of a hash
of their ids, cut into blocks of ``BLOCK_WORDS``; the last block of a source may be
shorter. The mix is a row of slots, dealt over output shards. The numbers of slots that
each source has in the shards follow the multinomial law given the sources' totals: the
totals are split between halves of the shards, again and again, by hypergeometric draws
with a seed for each node, so that a shard finds its own counts, and how many slots of a
source lie before it, without looking at any other. Slot ``k`` of a source stands for
block ``permutation(k mod blocks)`` of its round ``k div blocks``; the permutation is a
keyed Feistel network, computed where it is needed. Slots and blocks are joined by block
index. The last slot of a source is cut to the length that meets its target exactly.

A source takes full rounds and then part of one more; its target is at most ``MOST``
times its size, so no block, hence no document, is taken more often than that. Every
order comes from ids, texts and seeds, never from partitions: reruns agree.

Sources are a dimension: a few numbers of each are kept on the driver.

Defined cases: a null or empty text has size 0 and nothing is taken from it; a null
source is a source of its own, last in order; rows that repeat are documents of their
own and share their words' draws by position; a very long text spans many blocks; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.operators.joins import lookup

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 4_096
ROWS_PER_PART = 500_000
SEED = 11

WORD = r"[^\x20\x09-\x0D]+"
_EXACT = 900_000_000  # numpy draws exact hypergeometric numbers below it
_SLOTS = "shard long, place int, source_no int, round int, block long, words int"


def targets(
    sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, most: int = MOST
) -> list[Fraction]:
    """Exact targets: ``share`` of all words by weight, no source above ``most`` times its size."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    rest, free = share * sum(sizes), sum(weight)
    out = [Fraction(0)] * len(sizes)
    # The first to reach its limit is the one with the least room for its weight.
    order = sorted(range(len(sizes)), key=lambda k: Fraction(most * sizes[k], weight[k]))
    for at, k in enumerate(order):
        if rest * weight[k] <= most * sizes[k] * free:
            for j in order[at:]:
                out[j] = rest * weight[j] / free
            break
        out[k] = Fraction(most * sizes[k])
        rest, free = rest - most * sizes[k], free - weight[k]
    return out


def _mixed(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Permutation:
    """A pseudorandom permutation of 0 to n - 1 by a seed: Feistel rounds, walked
    until a number below n comes up. ``forward`` and ``backward`` take arrays."""

    ROUNDS = 4

    def __init__(self, n: int, seed: Sequence[int]):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = np.random.default_rng([abs(s) for s in seed]).integers(0, 1 << 63, self.ROUNDS, np.uint64)

    def _step(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ (_mixed(left, key) & self.mask), left
            else:
                left, right = right, left ^ (_mixed(right, key) & self.mask)
        return left << self.half | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._step(np.asarray(x, np.uint64), back)
        while (far := out >= self.n).any():
            out[far] = self._step(out[far], back)
        return out.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, False)

    def backward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, True)


def split_draw(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` things drawn without replacement are of each kind."""
    total = int(counts.sum())
    if total < _EXACT:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    # Beyond the reach of exact draws: the normal limit of each count, whose rounding
    # is then mended so that all counts add up to n.
    out, left, wanted = np.zeros_like(counts), total, n
    for k, c in enumerate(counts.tolist()):
        share = c / left if left else 0.0
        spread = wanted * share * (1 - share) * (left - wanted) / max(left - 1, 1)
        drawn = round(wanted * share + rng.standard_normal() * max(spread, 0.0) ** 0.5)
        out[k] = min(max(drawn, wanted - (left - c), 0), c, wanted)
        left, wanted = left - c, wanted - int(out[k])
    return out


@dataclass
class Plan:
    """What every task needs to draw its shards; arrays have an entry per source."""

    blocks: np.ndarray  # of a source
    short: np.ndarray  # words of its last block
    slots: np.ndarray  # it has in the mix
    last: np.ndarray  # words of its last slot
    block_words: int
    shard_slots: int
    seed: int

    @property
    def shards(self) -> int:
        return -(-int(self.slots.sum()) // self.shard_slots)

    def permutation(self, source: int, turn: int) -> Permutation:
        return Permutation(int(self.blocks[source]), (self.seed, source, turn))

    def counts(self, shard: int, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Slots of each source in the shard, and before it."""
        known = {} if known is None else known
        low, high, before, here = 0, self.shards, np.zeros_like(self.slots), self.slots
        while high - low > 1:
            middle = (low + high) // 2
            if (low, high) not in known:
                rng = np.random.default_rng([self.seed, low, high])
                known[low, high] = split_draw(rng, here, (middle - low) * self.shard_slots)
            left = known[low, high]
            if shard < middle:
                high, here = middle, left
            else:
                low, before, here = middle, before + left, here - left
        return here, before

    def draw(self, shard: int, known: dict | None = None) -> dict[str, np.ndarray]:
        """The shard's slots in their order: source_no, round, block, words."""
        counts, before = self.counts(shard, known)
        parts = []
        for s in np.flatnonzero(counts):
            number = before[s] + np.arange(counts[s])
            turn, at = np.divmod(number, self.blocks[s])
            block = np.empty_like(at)
            for t in np.unique(turn):
                block[turn == t] = self.permutation(int(s), int(t)).forward(at[turn == t])
            words = np.where(block == self.blocks[s] - 1, self.short[s], self.block_words)
            words[number == self.slots[s] - 1] = self.last[s]
            parts.append(np.stack([np.full(len(number), s), turn, block, words]))
        drawn = np.concatenate(parts, axis=1) if parts else np.empty((4, 0), np.int64)
        order = np.random.default_rng([self.seed, 1, shard]).permutation(drawn.shape[1])
        return dict(zip(("source_no", "round", "block", "words"), drawn[:, order], strict=True))


def plan_mix(
    sizes: Sequence[int],
    wanted: Sequence[int],
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Plan:
    """Slots by which each source gives exactly its wanted number of words."""
    blocks = [-(-size // block_words) for size in sizes]
    short = [size - (b - 1) * block_words if b else 0 for size, b in zip(sizes, blocks, strict=True)]
    plan = Plan(*(np.array(x, np.int64) for x in (blocks, short, blocks, short)), block_words, shard_slots, seed)
    slots, last = [], []
    for s, (size, want) in enumerate(zip(sizes, wanted, strict=True)):
        turns, rest = divmod(want, size) if size else (0, 0)
        count, end = turns * blocks[s], 0
        if rest:
            # Blocks of the broken round come in permuted order, the short one somewhere.
            at = int(plan.permutation(s, turns).backward(np.array([blocks[s] - 1]))[0])
            after = rest - at * block_words - short[s]
            if rest <= at * block_words:
                more = -(-rest // block_words)
                end = rest - (more - 1) * block_words
            elif after <= 0:
                more, end = at + 1, rest - at * block_words
            else:
                more = at + 1 + -(-after // block_words)
                end = after - (more - at - 2) * block_words
            count += more
        elif turns:
            final = plan.permutation(s, turns - 1).forward(np.array([blocks[s] - 1]))[0]
            end = short[s] if final == blocks[s] - 1 else block_words
        slots.append(count)
        last.append(end)
    plan.slots, plan.last = np.array(slots, np.int64), np.array(last, np.int64)
    return plan


def draw_slots(spark, plan: Plan) -> DataFrame:
    """shard, place, source_no, round, block, words of every slot of the mix."""
    shared = spark.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                if len(known) > 1_000:
                    known.clear()
                drawn = shared.value.draw(shard, known)
                n = len(drawn["block"])
                columns = [
                    pa.array(np.full(n, shard, np.int64)),
                    pa.array(np.arange(n, dtype=np.int32)),
                    pa.array(drawn["source_no"].astype(np.int32)),
                    pa.array(drawn["round"].astype(np.int32)),
                    pa.array(drawn["block"]),
                    pa.array(drawn["words"].astype(np.int32)),
                ]
                names = ["shard", "place", "source_no", "round", "block", "words"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    parts = max(1, min(plan.shards, -(-plan.shards // 16)))
    return spark.range(0, plan.shards, 1, parts).mapInArrow(run, _SLOTS)


def _placed(rows: DataFrame, source_numbers: DataFrame) -> DataFrame:
    """id, digest, size, source_no, start: every document with words in its source's stream."""
    spark = rows.sparkSession
    rows = lookup(rows.filter("size > 0"), source_numbers, "named").select(
        "id", "digest", "size", "source_no", "tie", F.xxhash64("id").alias("h")
    )
    rows = stored(rows)
    # Equal rows are told apart by where they were read: which is which changes no result.
    order = ["source_no", "h", "id", "digest", "tie"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // ROWS_PER_PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, source, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            starts = []
            for s, size in zip(batch.column("source_no").to_pylist(), batch.column("size").to_pylist(), strict=True):
                if s != source:
                    source, before = s, 0
                starts.append(before)
                before += size
            columns = [batch.column(c) for c in ("id", "digest", "size", "source_no")]
            columns += [pa.array([part] * len(starts), pa.int32()), pa.array(starts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "size", "source_no", "part", "within"])

    schema = "id long, digest long, size long, source_no int, part int, within long"
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    local = stored(ranged.select("id", "digest", "size", "source_no").mapInArrow(run, schema))
    sums = local.groupBy("source_no", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    key = F.struct("source_no", "part").alias("cell")
    bases = stored(sums.select(key, F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")))
    return lookup(local.withColumn("cell", key), bases, "cell").select(
        "id", "digest", "size", "source_no", (F.col("base") + F.col("within")).alias("start")
    )


@dataclass
class Mix:
    """A planned mix; ``documents`` has a row for each document with its source's numbers."""

    placed: DataFrame  # id, digest, size, source_no, start: documents with words
    wordless: DataFrame  # id, size, source_no: the others
    sources: DataFrame  # named, source_no, source_size, target
    slots: DataFrame  # shard, place, source_no, round, block, words
    block_words: int

    def pieces(self) -> DataFrame:
        """The mix itself: shard, place, source_no, round, block, offset (in the slot),
        id, start, first (word of the document), words."""
        width = self.block_words
        span = F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("size") - 1) / width))
        parts = self.placed.select("id", "source_no", "start", "size", F.explode(span).alias("block"))
        low = F.greatest(F.col("start"), F.col("block") * width)
        high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * width)
        parts = parts.select(
            "id", "source_no", "block", "start",
            (low - F.col("start")).alias("first"),
            (low - F.col("block") * width).alias("offset"),
            (high - low).alias("length"),
        )
        taken = F.least(F.col("length"), F.col("words") - F.col("offset"))
        return (
            self.slots.join(parts, ["source_no", "block"])
            .select(
                "shard", "place", "source_no", "round", "block", "offset", "id", "start", "first",
                taken.alias("words"),
            )
            .filter("words > 0")
        )

    def taken(self) -> DataFrame:
        """id, size, source_size, target, taken of every document."""
        key = ["source_no", "start"]
        sums = self.pieces().groupBy(*key).agg(F.sum("words").alias("taken"))
        columns = ["id", "size", "source_no", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
        worded = self.placed.join(sums, key, "left").select(*columns)
        rows = worded.unionByName(self.wordless.withColumn("taken", F.lit(0)).select(*columns))
        return lookup(rows, self.sources, "source_no").select("id", "size", "source_size", "target", "taken")

    def texts(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """shard, place, source_no, round, block, text: the slots' words, joined by blanks."""
        width = self.block_words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*(batch.column(c).to_pylist() for c in ("source_no", "start", "text")), strict=True)
                for source, start, text in rows:
                    words = text.encode().split()
                    ends = [*range(width - start % width, len(words), width), len(words)]
                    begins = [0, *ends[:-1]]
                    at = np.array(begins) + start
                    columns = [
                        pa.array([source] * len(at), pa.int32()),
                        pa.array(at // width),
                        pa.array(at % width),
                        pa.array([b" ".join(words[a:b]).decode() for a, b in zip(begins, ends, strict=True)]),
                        pa.array(np.array(ends) - begins),
                    ]
                    names = ["source_no", "block", "offset", "piece", "length"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        key = F.struct(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("cell")
        wanted = self.placed.select(F.struct("id", "digest").alias("cell"), "source_no", "start")
        whole = docs.select(key, F.col(text_col).alias("text")).dropDuplicates(["cell"])
        schema = "source_no int, block long, offset long, piece string, length long"
        parts = wanted.join(whole, "cell").select("source_no", "start", "text").mapInArrow(run, schema)
        room = F.col("words") - F.col("offset")
        cut = F.when(F.col("length") <= room, F.col("piece")).otherwise(
            F.array_join(F.slice(F.split("piece", " "), F.lit(1), room.cast("int")), " ")
        )
        return (
            self.slots.join(parts, ["source_no", "block"])
            .filter("offset < words")
            .groupBy("shard", "place", "source_no", "round", "block")
            .agg(F.array_sort(F.collect_list(F.struct("offset", cut.alias("piece")))).alias("found"))
            .select("shard", "place", "source_no", "round", "block", F.array_join("found.piece", " ").alias("text"))
        )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """Plan the mix of all documents."""
    spark = docs.sparkSession
    source = F.col(source_col).cast("string")
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            # Never null, so that the null source joins like any other.
            F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name")).alias("named"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(text_col).alias("digest"),
            F.monotonically_increasing_id().alias("tie"),
        )
    )
    sums = rows.groupBy("named").agg(F.sum("size").alias("size"))
    names = [(r[0]["none"], r[0]["name"], r[1]) for r in sums.collect()]
    names.sort(key=lambda r: (r[0], r[1].encode("utf-8", "surrogatepass")))
    sizes = [size for *_, size in names]
    goal = targets(sizes, weights, share, most)
    plan = plan_mix(sizes, [int(g + Fraction(1, 2)) for g in goal], block_words, shard_slots, seed)
    table = spark.createDataFrame(
        [((none, name), k, sizes[k], float(goal[k])) for k, (none, name, _) in enumerate(names)],
        "named struct<none: boolean, name: string>, source_no int, source_size long, target double",
    )
    table = stored(table)
    placed = stored(_placed(rows, table.select("named", "source_no")))
    wordless = lookup(rows.filter("size = 0"), table, "named").select("id", "size", "source_no")
    slots = stored(draw_slots(spark, plan))
    return Mix(placed, wordless, table, slots, block_words)
