"""Byte-level BPE as a monoid: encode halves, join neighbours, reduce up a tree.

A sequence of tokens is the encoding of its bytes exactly when every two
neighbours are the encoding of the bytes of the two. So two encodings join by
re-encoding a window around the seam: where the tokens at its edges also fit
their neighbours outside, nothing beyond the window can change; else the window
grows on that side. Short leaves are merged directly, which keeps a piece of any
length near linear time. Pieces (matches of the splitting pattern) never interact,
so the levels above a piece concatenate, and so does decoding: the bytes of a
sequence are the bytes of its halves.

Long texts are cut where the pattern always starts a new match (a blank between
two characters that are not white space); the segments are the upper leaves and
bound the memory a document needs.

Defined cases: a null or empty text has no ids; repeated rows and ids stay as
they are; a very long text is encoded segment by segment in one task; an empty table gives an empty result; other columns are ignored. A lone
byte without a rank is an error of the vocabulary and raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 12  # bytes merged directly
SEGMENT = 1 << 18  # characters encoded at a time
_KEEP = 300_000  # remembered pieces of a worker

# The same splits as the public pattern for text of ASCII and Latin letters.
_LATIN = "À-ÖØ-öø-ʯ"
_PLAIN = re.compile(rf"[\t\n\r -~{_LATIN}]*")
_LETTERS = f"A-Za-z{_LATIN}"
_BLANKS = r"\t\n\r "
_FAST = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANKS}0-9{_LETTERS}]+"
    rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)
# Fixed value: the white space of the library's pattern engine.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


class ByteBPE(dict):
    """bytes of a piece -> tuple of ids; remembers a bounded number of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.text_of = {r: str(r) for r in ranks.values()}
        self.pattern = regex.compile(pattern.replace(r"\s", f"[{_SPACE}]").replace(
            f"[^[{_SPACE}]", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]"), regex.V0)
        self.fits: dict[tuple[int, int], bool] = {}
        self.seams: dict[bytes, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= _KEEP:
            self.clear()
        ids = self.tree(piece.encode("utf-8", "surrogatepass"))
        self[piece] = ids
        return ids

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Merge the lowest-ranked pair until none has a rank."""
        parts = [data[k : k + 1] for k in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = ranks.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple([ranks[p] for p in parts])

    def window(self, data: bytes) -> tuple[int, ...]:
        """``merge``, remembered for the short byte strings that seams meet again."""
        if len(data) > 2 * LEAF:
            return self.merge(data)
        found = self.seams.get(data)
        if found is None:
            if len(self.seams) >= _KEEP:
                self.seams.clear()
            found = self.seams[data] = self.merge(data)
        return found

    def fit(self, a: int, b: int) -> bool:
        """Whether the two tokens next to each other are stable."""
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) >= _KEEP:
                self.fits.clear()
            found = self.merge(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
            self.fits[(a, b)] = found
        return found

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the concatenation, from the encodings of both sides."""
        if not left or not right:
            return left + right
        i = j = 0
        while True:
            if not i and not j:
                if self.fit(left[-1], right[0]):
                    return left + right
                i = j = 1
            inner = left[len(left) - i :] + right[:j]
            middle = self.window(b"".join(map(self.bytes_of.__getitem__, inner)))
            left_ok = i >= len(left) or self.fit(left[-i - 1], middle[0])
            right_ok = j >= len(right) or self.fit(middle[-1], right[j])
            if left_ok and right_ok:
                return left[: len(left) - i] + middle + right[j:]
            i = i if left_ok else min(len(left), 2 * i)
            j = j if right_ok else min(len(right), 2 * j)

    def tree(self, data: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(data) <= LEAF:
            return self.window(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def pieces(self, text: str) -> list[str]:
        return (_FAST if _PLAIN.fullmatch(text) else self.pattern).findall(text)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids: halves decode alone and concatenate."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One encoder per worker process: its memory of pieces lasts over tasks."""
    return ByteBPE(load_ranks(path), pattern)


_SEAM = re.compile(rf"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Cut a long text where a match of the pattern must start."""
    start = 0
    while len(text) - start > size:
        seam = _SEAM.search(text, start + size)
        if seam is None:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


def roundtrip(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by a blank), decoded_sha256, with
    ``keep_ids`` also ids (array) and decoded (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids_hash, bytes_hash, n, kept, decoded = hashlib.sha256(), hashlib.sha256(), 0, [], []
                for segment in segments(text or ""):
                    ids = bpe.encode(segment)
                    joined = " ".join(map(bpe.text_of.__getitem__, ids))
                    ids_hash.update((" " + joined if n and ids else joined).encode())
                    data = bpe.decode(ids)
                    bytes_hash.update(data)
                    n += len(ids)
                    if keep_ids:
                        kept += ids
                        decoded.append(data)
                row = (n, ids_hash.hexdigest(), bytes_hash.hexdigest())
                rows.append((*row, kept, b"".join(decoded)) if keep_ids else row)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=names)

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<long>, decoded binary"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.binary()]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)
