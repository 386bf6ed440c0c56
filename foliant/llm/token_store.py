"""Token ids on disk: one zstandard frame per document under a shared dictionary.

File format, a Parquet table so that any store Spark can write to will do. A row
is a block of documents in ascending id order:

* ``part``, ``block``: where the block stands; parts and their blocks ascend;
* ``dictionary_sha256``: hash of the dictionary its frames need (null: none);
* ``width``: bytes of a serialized id (2 or 4, little-endian, unsigned);
* ``doc_ids``, ``starts``, ``counts``, ``offsets``: the index; ids before a
  document within its part, its number of ids, the place of its frame in
  ``frames`` (one entry more: the end);
* ``frames``: the frames, one after the other, each readable alone.

The dictionary is trained on a bounded sample (``SAMPLE_DOCS`` documents spread
over the table by a hash of the id, ``SAMPLE_BYTES`` of each, taken in pieces from
all over the document): it changes sizes, never contents. Too few samples to train
on become a raw dictionary.

Defined cases: a null text is empty and has the end id alone; documents with
equal or null ids keep a row each, null ids first, then ordered by their ids'
checksum; a document larger than a block gets its own; an empty table gives empty
files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import stored
from foliant.llm.word_tokens import END_ID, crc32_all, larger_batches, word_tokens
from foliant.operators.joins import lookup
from foliant.session import scratch_folder

SAMPLE_DOCS = 2_000
SAMPLE_BYTES = 8_192
SAMPLE_PIECES = 8
DICTIONARY_BYTES = 65_536
BLOCK_BYTES = 1 << 20
PART_BYTES = 16 << 20
LEVEL = 3

_BLOCK = (
    "part int, block long, dictionary_sha256 string, width int, doc_ids array<bigint>, "
    "starts array<bigint>, counts array<bigint>, offsets array<bigint>, frames binary"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("dictionary_sha256", pa.string()),
        ("width", pa.int32()),
        *[(c, pa.list_(pa.int64())) for c in ("doc_ids", "starts", "counts", "offsets")],
        ("frames", pa.binary()),
    ]
)


def _spread(ids: bytes, width: int) -> bytes:
    """``SAMPLE_BYTES`` of a document, in pieces spread evenly over it."""
    if len(ids) <= SAMPLE_BYTES:
        return ids
    size = SAMPLE_BYTES // SAMPLE_PIECES
    step = (len(ids) - size) // (SAMPLE_PIECES - 1) // width * width
    return b"".join(ids[k * step : k * step + size] for k in range(SAMPLE_PIECES))


def _zdict(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A shared dictionary; raw content where there is too little to train on."""
    if not any(samples):
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def fit_dictionary(docs: DataFrame, path: str, width: int, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """Train on about ``sample_docs`` documents of (id, text)."""
    every = max(1, docs.select("id").count() // sample_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(path)
        for batch in larger_batches(batches):
            ids, bounds = encoder.encode_column(batch.column("text"))
            narrow = ids.astype(f"<u{width}")
            parts = [_spread(narrow[a:b].tobytes(), width) for a, b in pairwise(bounds.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary())], names=["sample"])

    # A table whose ids are all equal or null would be sampled whole without the cap.
    chosen = docs.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).limit(2 * sample_docs)
    rows = chosen.select("text").mapInArrow(run, "sample binary").toPandas()
    return train_dictionary([bytes(s) for s in rows["sample"]])


def _encoded(docs: DataFrame, path: str, width: int, dictionary: bytes, end_id: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(path)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(shared.value))
        for batch in larger_batches(batches):
            ids, bounds = encoder.encode_column(batch.column("text"), end_id)
            narrow = ids.astype(f"<u{width}")
            frames = [packer.compress(narrow[a:b].tobytes()) for a, b in pairwise(bounds.tolist())]
            columns = [
                batch.column("id"),
                pa.array(np.diff(bounds)),
                pa.array(crc32_all(ids, bounds)),
                pa.array(frames, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "crc", "frame"])

    return docs.mapInArrow(run, "id long, n long, crc long, frame binary")


def _blocks(frames: DataFrame, width: int, digest: str | None, block_bytes: int) -> DataFrame:
    """Blocks of a range-partitioned, sorted table of frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, before, held, size
            ids, counts, frames = zip(*held, strict=True)
            starts = before + np.cumsum([0, *counts[:-1]])
            row = {
                "part": part,
                "block": block,
                "dictionary_sha256": digest,
                "width": width,
                "doc_ids": list(ids),
                "starts": starts.tolist(),
                "counts": list(counts),
                "offsets": np.cumsum([0, *map(len, frames)]).tolist(),
                "frames": b"".join(frames),
            }
            block, before, held, size = block + 1, before + sum(counts), [], 0
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("id", "n", "frame"))
            for i, n, frame in zip(*columns, strict=True):
                if held and size + len(frame) > block_bytes:
                    yield flush()
                held.append((i, n, frame))
                size += len(frame)
        if held:
            yield flush()

    return frames.select("id", "n", "frame").mapInArrow(run, _BLOCK)


def write_store(
    docs: DataFrame,
    path: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES,
) -> None:
    """Encode every document and write ``folder/blocks`` and ``folder/dictionary``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    width = 2 if max(word_tokens(path).size, end_id + 1) <= 1 << 16 else 4
    dictionary = fit_dictionary(docs, path, width)
    digest = hashlib.sha256(dictionary).hexdigest() if dictionary else None
    frames = stored(_encoded(docs, path, width, dictionary, end_id))
    size = frames.agg(F.sum(F.length("frame"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    order = ["id", "crc", "n"]
    ordered = frames.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    _blocks(ordered, width, digest, block_bytes).write.parquet(f"{folder}/blocks")
    spark.createDataFrame(
        [(digest, dictionary)], "dictionary_sha256 string, dictionary binary"
    ).coalesce(1).write.parquet(f"{folder}/dictionary")


def unpack(frames: bytes, offsets, k: int, width: int, dictionary: bytes) -> np.ndarray:
    """The ids of the k-th document of a block, without reading the others."""
    opener = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))
    return np.frombuffer(opener.decompress(frames[offsets[k] : offsets[k + 1]]), f"<u{width}")


def read_store(spark, folder: str) -> DataFrame:
    """id, start (ids of all documents before it), n, crc of every stored document."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    known = {r[0]: bytes(r[1]) for r in spark.read.parquet(f"{folder}/dictionary").collect()}
    shared = spark.sparkContext.broadcast(known)
    # Ids before each part: one row per part file, numbered by a window over these rows.
    added = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    totals = stored(blocks.select("part", added.alias("n")).groupBy("part").agg(F.sum("n").alias("n")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                opener = zstandard.ZstdDecompressor(dict_data=_zdict(shared.value[row["dictionary_sha256"]]))
                crcs, counts = [], []
                for a, b in pairwise(row["offsets"]):
                    ids = np.frombuffer(opener.decompress(row["frames"][a:b]), f"<u{row['width']}")
                    counts.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.array(row["starts"], np.int64) + row["base"]),
                    pa.array(counts, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n", "crc"])

    placed = lookup(blocks, bases, "part")
    return placed.mapInArrow(run, "id long, start long, n long, crc long")


def roundtrip(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the documents to a new folder beside the checkpoints and read them back."""
    folder = scratch_folder(docs.sparkSession)
    write_store(docs, path, folder, **options)
    return read_store(docs.sparkSession, folder)
