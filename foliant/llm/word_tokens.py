"""Token ids of whole texts by a public vocabulary of the tokenizers library.

Encoding goes through the library. Texts made of ASCII and Latin letters only
take a shorter way to the same ids: there the library's normalising is
lower-casing and its splitting one pattern. Arrow splits a batch of them at white
space, numbers its distinct words, and cuts those that are letters with marks
behind them into the two; a pattern cuts the few others. Each distinct piece is
handed to the library's model and remembered. Any other text, and any vocabulary
with another normaliser or splitter, goes through the library whole.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

END_ID = 1
_KEEP = 96 << 20  # bytes of remembered pieces in a worker
_ENTRY = 200  # of them an entry takes beside its characters and ids

# The splitter of the lower-casing word vocabulary.
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LATIN = "À-ÖØ-öø-įı-ň Ŋ-ɏ".replace(" ", "")
# Letters that stay Latin when lower-cased: some capitals lower to letters beyond U+024F.
_LETTERS = [c for c in map(chr, range(0xC0, 0x250)) if re.fullmatch(f"[{_LATIN}]+", c + c.lower())]
_PLAIN = rf"\A[\t\n\r -~{''.join(_LETTERS)}]*\z"
_PIECE = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^\sa-z0-9{_LATIN}]+"
)
_MARKS = string.punctuation
_ALPHABET = string.ascii_lowercase + "".join(_LETTERS)


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Recent(dict):
    """key -> ids, for the keys used last: when half of ``keep`` bytes are full, the
    older half makes room. ``make`` finds the ids of a key that is not remembered."""

    def __init__(self, keep: int):
        super().__init__()
        self.room = self.half = keep // 2
        self.older: dict = {}

    def __missing__(self, key):
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        self.room -= len(key) + len(ids) + _ENTRY
        if self.room < 0:
            self.older = dict(self)
            self.clear()
            self.room = self.half
        self[key] = ids
        return ids


class _Pieces(_Recent):
    """piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model):
        super().__init__(_KEEP)
        self.model = model
        self.chars = _byte_chars()

    def make(self, piece: str) -> bytes:
        name = piece
        if not (piece.isascii() and piece.isprintable()):
            name = piece.encode().decode("latin-1").translate(self.chars)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(name)])


class _Mixed(_Recent):
    """Lower-case run of letters, digits and marks -> its ids."""

    def __init__(self, pieces: _Pieces):
        super().__init__(_KEEP // 4)
        self.pieces = pieces

    def make(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECE.findall(word)))


def _gather(known: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``at`` of a table one after the other, and their sizes. The table has
    its entries, of the given sizes, one after the other in ``known``."""
    size = sizes[at]
    source = np.repeat((np.cumsum(sizes) - sizes)[at] - (np.cumsum(size) - size), size)
    source += np.arange(len(source))
    return known[source], size


def _strings(texts: pa.Array) -> np.ndarray:
    return texts.to_numpy(zero_copy_only=False)


class WordTokens:
    """``encode_column`` gives the ids of texts, without special tokens around them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.plain = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [p.get("type") for p in split] == ["Split", "ByteLevel"]
            and split[0]["pattern"] == {"Regex": _SPLITTER}
            and split[0]["invert"]
            and not split[1]["add_prefix_space"]
            and not split[1]["use_regex"]
        )
        self.pieces = _Pieces(self.tokenizer.model)
        self.mixed = _Mixed(self.pieces)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after the other, and how many each has."""
        low = pc.utf8_lower(words)
        core = pc.utf8_rtrim(low, _MARKS)
        letters = _strings(pc.utf8_is_alpha(core)).astype(bool)
        named = pa.array(letters)
        cores = core.filter(named).dictionary_encode()
        marks = pc.utf8_ltrim(low.filter(named), _ALPHABET).dictionary_encode()
        others = _strings(low.filter(pa.array(~letters)))
        found = [self.pieces[x] for part in (cores, marks) for x in _strings(part.dictionary)]
        before = len(cores.dictionary)
        at = np.full((len(words), 2), len(found) + len(others))
        at[letters, 0] = _strings(cores.indices)
        at[letters, 1] = before + _strings(marks.indices)
        at[~letters, 0] = len(found) + np.arange(len(others))
        found += [*map(self.mixed.__getitem__, others), b""]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        ids, size = _gather(np.frombuffer(b"".join(found), "<u4"), sizes, at.ravel())
        return ids, size.reshape(-1, 2).sum(axis=1)

    def _plain_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts one after the other, and how many each has."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        ids, size = _gather(*self._word_ids(coded.dictionary), _strings(coded.indices))
        ends = np.concatenate([[0], np.cumsum(size)])
        offsets = lists.offsets.to_numpy()
        return ids, np.diff(ends[offsets - offsets[0]])

    def _plain(self, texts: pa.Array) -> np.ndarray:
        if not self.plain:
            return np.zeros(len(texts), bool)
        plain = pc.match_substring_regex(texts, _PLAIN)
        for special in self.special:
            plain = pc.and_not(plain, pc.match_substring(texts, special))
        return plain.to_numpy(zero_copy_only=False)

    def encode_column(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit integers, each text followed by ``end_id``, and
        the bounds of the texts in them (one more than texts). A null is an empty text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        plain = self._plain(texts)
        ids, counts = self._plain_ids(texts.filter(pa.array(plain)))
        if not plain.all():
            shares = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
            parts = iter(shares)
            every = [next(parts) if p else self.whole(t.as_py()) for p, t in zip(plain, texts, strict=True)]
            ids, counts = np.concatenate(every), np.array([len(x) for x in every], np.int64)
        ends = np.cumsum(counts)
        bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
        return np.insert(ids, ends, end_id).astype("<u4", copy=False), bounds


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One encoder per worker process: its memory of pieces lasts over tasks."""
    return WordTokens(path)


def larger_batches(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive batches joined to about ``most`` bytes: fewer distinct words for the same rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def crc32_all(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Checksum of every text's ids as little-endian unsigned 32-bit integers."""
    view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    spans = zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True)
    return np.fromiter((zlib.crc32(view[a:b]) for a, b in spans), np.int64, len(bounds) - 1)
