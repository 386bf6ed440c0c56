"""Encoders, token files and packing against the libraries."""

from collections import defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from brute import crc, sha
from conftest import EDGE, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from foliant.llm import byte_bpe, packing, token_store
from foliant.llm.common import tokenizer_path
from foliant.llm.word_tokens import WordTokens

WORDS, RANKS = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def words():
    return WordTokens(WORDS)


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.byte_bpe(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def tik(bpe):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


texts = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abe 'st\n\r\t 09.!É")), max_size=80)


@settings(max_examples=400, deadline=None)
@given(text=texts)
def test_word_tokens_are_the_library_s(words, library, text):
    ids, bounds = words.encode_column(pa.array([text, None, text + " x", "plain"]))
    want = [ids_of(library, t) for t in (text, None, text + " x", "plain")]
    assert [ids[a:b].tolist() for a, b in pairwise(bounds)] == want


def test_every_plain_character_is_the_library_s(words, library):
    """Also the capitals that lower-case to letters beyond the plain ones."""
    texts = [t for c in map(chr, range(1, 0x250)) for t in (f"ab{c}ba", f"{c}aba spoke", f"x {c} 1{c}")]
    ids, bounds = words.encode_column(pa.array(texts))
    for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == ids_of(library, text), text


def test_words_are_forgotten_by_bytes(library):
    few = WordTokens(WORDS)
    for memory in (few.pieces, few.mixed):
        memory.half = memory.room = 3_000
    texts = [f"word{k % 37} " * 3 + "x" * (k % 50) + f".{k}!? it's" for k in range(300)]
    for _ in range(2):
        ids, bounds = few.encode_column(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in pairwise(bounds)] == [ids_of(library, t) for t in texts]
        assert len(few.pieces) + len(few.pieces.older) < 40 and len(few.mixed) + len(few.mixed.older) < 40


def test_ids_stay_exact_beside_null_ids(spark):
    big = 2**60 + 1
    df = frame(spark, [(big, "one text"), (None, "no id"), (big + 1, "two")]).coalesce(1)
    want = {None, big, big + 1}
    assert {r.id for r in token_store.roundtrip(df, WORDS).collect()} == want
    assert {r.id for r in packing.pack(df, WORDS).collect()} == want
    assert {r.id for r in byte_bpe.roundtrip(df, RANKS, P.PATTERN).collect()} == want


@settings(max_examples=400, deadline=None)
@given(text=texts)
def test_byte_bpe_is_the_library_s(bpe, tik, text):
    ids = bpe.encode(text)
    assert ids == tik.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(data=st.text("aetho sin", min_size=30, max_size=300))
def test_tree_of_one_long_piece(bpe, tik, data):
    data = data.encode()
    assert list(bpe.tree(data)) == tik._encode_single_piece(data)


def test_every_token_encodes_to_itself(bpe):
    assert all(bpe.merge(data) == (rank,) for data, rank in bpe.ranks.items())


@settings(max_examples=200, deadline=None)
@given(text=texts, size=st.integers(1, 20))
def test_segments_do_not_change_the_ids(bpe, text, size):
    parts = list(byte_bpe.segments(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in bpe.encode(p)] == bpe.encode(text)


def bpe_expected(tik, rows):
    out = []
    for i, text in rows:
        ids = tik.encode_ordinary(text or "")
        out.append((i, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    return sorted(out, key=lambda r: ((r[0] is None, r[0]), r))


def test_byte_bpe_documents(edge, docs, rows, nothing, tik):
    for df, want in ((edge, EDGE), (docs, rows), (nothing, [])):
        got = [tuple(r) for r in byte_bpe.roundtrip(df, RANKS, P.PATTERN).collect()]
        assert sorted(got, key=lambda r: ((r[0] is None, r[0]), r)) == bpe_expected(tik, want)


def test_byte_bpe_outputs(spark):
    row = byte_bpe.roundtrip(frame(spark, [(1, "Hello world")]), RANKS, P.PATTERN, keep_ids=True).first()
    assert bytes(row.decoded) == b"Hello world" and len(row.ids) == row.n_tokens


def store_expected(library, rows):
    rows = [(i, ids_of(library, t)) for i, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1])))
    out, start = [], 0
    for i, ids in rows:
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 300, "part_bytes": 2000}])
def test_token_store(edge, docs, rows, library, sizes):
    for df, want in ((edge, EDGE), (docs, rows)):
        got = [tuple(r) for r in token_store.roundtrip(df, WORDS, **sizes).collect()]
        assert sorted(got, key=lambda r: r[1]) == store_expected(library, want)


def test_token_store_empty(nothing):
    assert token_store.roundtrip(nothing, WORDS).collect() == []


def test_token_store_file(spark, docs, rows, library, tmp_path):
    folder = f"{tmp_path}/store"
    token_store.write_store(docs, WORDS, folder)
    dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    block = spark.read.parquet(f"{folder}/blocks").orderBy("part", "block").first()
    assert block.dictionary_sha256 == dictionary.dictionary_sha256 == sha(bytes(dictionary.dictionary))
    want = dict(rows)
    for k in (0, len(block.doc_ids) - 1):
        ids = token_store.unpack(bytes(block.frames), block.offsets, k, block.width, bytes(dictionary.dictionary))
        assert ids.tolist() == ids_of(library, want[block.doc_ids[k]])


def check_packing(library, rows, pieces, window=packing.WINDOW):
    """Every id once, windows gapless and not overfull; returns the windows' lengths."""
    want = defaultdict(list)
    for i, text in rows:
        want[i].append(ids_of(library, text))
    of_doc, of_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.id].append(p)
        of_window[p.sequence_id].append((p.offset, p.length))
        assert p.length > 0
    for i, versions in want.items():
        total = sum(len(v) for v in versions)
        assert sum(p.length for p in of_doc[i]) == total
        if len(versions) == 1:
            ids, at = versions[0], 0
            for p in sorted(of_doc[i], key=lambda p: p.start):
                assert p.start == at and p.n == len(ids) and crc(ids[at : at + p.length]) == p.crc
                at += p.length
    assert set(of_doc) == set(want)
    sizes = []
    for parts in of_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        sizes.append(at)
    return sizes


def test_packing(edge, docs, rows, library):
    check_packing(library, EDGE, packing.pack(edge, WORDS).collect())
    sizes = check_packing(library, rows, packing.pack(docs, WORDS).collect())
    assert sum(sizes) / (len(sizes) * packing.WINDOW) > 0.98


def test_packing_of_equal_lengths(spark, library):
    rows = [(k, "the same text in every row of this table " * 9) for k in range(300)]
    sizes = check_packing(library, rows, packing.pack(frame(spark, rows).repartition(5), WORDS).collect())
    assert sum(s < packing.WINDOW - 3 * packing.UNIT for s in sizes) <= 1


def test_packing_empty(nothing):
    assert packing.pack(nothing, WORDS).collect() == []


@settings(max_examples=60, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 31), st.integers(1, 500), min_size=1))
def test_repeats_never_overdraw(counts):
    left = dict(counts)
    for shape, times in packing.repeats(counts, 32):
        assert sum(shape) == 32 and 1 <= len(shape) <= 3 and times > 0
        for b in shape:
            left[b] -= times
    assert min(left.values()) >= 0


def test_least_squares():
    rng = np.random.default_rng(0)
    a, x = rng.random((20, 8)), np.array([0, 2.0, 0, 1.5, 0, 0, 3.0, 0.2])
    assert np.allclose(packing.nonnegative_least_squares(a, a @ x), x, atol=1e-6)
    b = rng.normal(size=20)
    found = packing.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ found)
    assert (found >= 0).all() and (slope <= 1e-6).all() and np.allclose(slope[found > 0], 0, atol=1e-6)
