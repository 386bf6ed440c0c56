"""SimHash, embeddings and fingerprints against plain versions."""

import base64
from functools import lru_cache

import numpy as np
import pytest
import xxhash
from brute import chunks, components, containment, cosine_links, fingerprint, fingerprint_text, sha, simhash
from conftest import EDGE, frame

from foliant.llm import embed_dedup, fingerprints
from foliant.llm import simhash as sh
from foliant.llm.common import Groups


def key(row):
    return tuple((v is None, v) for v in row)


def simhash_expected(rows):
    values = [simhash(t) for _, t in rows]
    ids = [i for i, _ in rows]
    found, _ = components(ids, lambda i, j: (values[i] ^ values[j]).bit_count() <= 3)
    return sorted(zip(ids, [f"{v:016x}" for v in values], found, strict=True), key=key)


def simhash_result(docs, **options):
    out = sh.near_duplicates(docs, **options)
    return sorted(
        (tuple(r) for r in out.select("id", sh.as_hex(out["fp"]), "component_id").collect()), key=key
    )


def test_simhash_edge_cases(edge):
    rows = [(i, t) for i, t in EDGE if not t or len(t) < 100_000]
    got = simhash_result(edge.filter("text IS NULL OR length(text) < 100000"))
    assert got == simhash_expected(rows)


def test_simhash_very_long():
    from conftest import LONG

    assert sh.fingerprint(LONG + " indeed") == simhash(LONG + " indeed")


@pytest.mark.parametrize("tile_rows", [sh.TILE_ROWS, 16])
def test_simhash_documents(docs, rows, tile_rows):
    assert simhash_result(docs, tile_rows=tile_rows) == simhash_expected(rows)


def test_simhash_empty(nothing):
    assert simhash_result(nothing) == []


def test_compare_tiles_finds_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base ^ (1 << rng.integers(0, 60, 60)).astype(np.uint64),
                                       base ^ np.uint64(7), base ^ np.uint64(15)]))
    ids = [int(v) for v in values]
    want, _ = components(ids, lambda i, j: (ids[i] ^ ids[j]).bit_count() <= 3)
    u, v = sh.compare_tiles(values, None, 3)
    groups = Groups(len(ids))
    place = {x: k for k, x in enumerate(ids)}
    groups.link(np.array([place[int(x)] for x in u]), np.array([place[int(x)] for x in v]))
    assert [ids[k] for k in groups.label] == want


def vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(120):
        v = rng.normal(size=12)
        rows.append((k, [float(x) for x in v], k % 3))
        if k % 4 == 0:
            near = v + rng.normal(size=12) * 0.06
            rows.append((1000 + k, [float(x) for x in near], k % 3))
            rows.append((2000 + k, [float(x) for x in 3 * near], (k + k // 8) % 3))
    rows += [(3000 + k, rows[0][1], 0) for k in range(7)]
    rows += [(3000, rows[0][1], 0), (4000, None, 0), (4001, [0.0] * 12, 0), (4002, [float("nan")] * 12, 0),
             (4003, [None] * 12, 0), (4004, [float("inf")] + [1.0] * 11, 0), (4005, rows[0][1], None),
             (4006, [1.0, 0.0], 0), (4007, [2.0, 0.0], 0), (4008, [], 0), (None, rows[0][1], 0), (4009, [5.0], 1),
             (4010, [0.1], 1), (4011, [-0.1], 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("tile_rows", [2048, 8])
def test_embeddings(spark, tile_rows):
    rows, df = vectors(spark)
    ids = [r[0] for r in rows]
    linked = cosine_links([r[2] for r in rows], [r[1] for r in rows])
    found, near = components(ids, linked)
    want = sorted(
        ((i, len(near[k]), c, i == c) for k, (i, c) in enumerate(zip(ids, found, strict=True))), key=key
    )
    df = df.withColumn("node", df["vec_id"]).withColumn("n", df["vec_id"]).repartition(4)
    out = embed_dedup.near_duplicates(df, tile_rows=tile_rows)
    assert sorted((tuple(r) for r in out.collect()), key=key) == want


def test_embeddings_of_any_size(spark):
    """Squared norms beyond the doubles, and below them."""
    rows = [(1, [1e200, 1e200]), (2, [3e200, 3e200]), (3, [1e-200, 1e-200]), (4, [1.0, 1.0]), (5, [-1e300, 1e300])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    out = {r.id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect()}
    assert out == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5)}


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_duplicates(df).collect() == []


@lru_cache(maxsize=10_000)
def plain_fingerprint(text):
    return fingerprint(text)


def fingerprint_expected(rows):
    def place(row):
        i, text = row[0], (row[1] or "").encode()
        hashed = xxhash.xxh64_intdigest(text, 42)
        return (i is None, -(i or 0), hashed - (hashed >> 63 << 64), text)

    order = sorted(rows, key=place)
    out = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        a, b, c = (plain_fingerprint(t) for t in (text, changed, following))
        row = (i, len(text), sha(changed), fingerprint_text(a), fingerprint_text(b))
        out.append((*row, containment(a, b), containment(a, c)))
    return sorted(out, key=key)


@pytest.mark.parametrize("partition_rows", [20_000, 4])
def test_fingerprints_edge_cases(edge, partition_rows):
    # Rows that share an id differ in nothing here, so the order is defined.
    got = fingerprints.fingerprint_documents(edge, partition_rows=partition_rows).collect()
    assert sorted((tuple(r) for r in got), key=key) == fingerprint_expected(EDGE)


def test_fingerprints_documents(docs, rows):
    got = fingerprints.fingerprint_documents(docs, partition_rows=23).collect()
    assert sorted((tuple(r) for r in got), key=key) == fingerprint_expected(rows)
    long_enough = [r for r in got if r.n_chars > 300]
    assert np.median([r.near_edited for r in long_enough]) > 0.6
    assert np.quantile([r.near_next for r in long_enough], 0.9) < 0.1


def test_fingerprints_small_tables(spark, nothing):
    assert fingerprints.fingerprint_documents(nothing).collect() == []
    one = fingerprints.fingerprint_documents(frame(spark, [(1, "alone here")])).collect()
    assert [r.near_next for r in one] == [1.0]


def test_fingerprints_resist_shifts():
    rng = np.random.default_rng(1)
    body = "".join(chr(c) for c in rng.integers(97, 123, 20_000))
    a, b = fingerprints.Fingerprint(body), fingerprints.Fingerprint("inserted at the front " + body)
    assert a.likeness(b) > 0.98
    assert len(base64.b64decode(str(a))) == 5 * len(a.digests)
    assert 15 < a.total / len(a.digests) < 50


def test_chunks_cover_the_text_over_slices(monkeypatch):
    data = np.random.default_rng(2).integers(97, 105, 5_000).astype(np.uint8)
    want = fingerprints.boundaries(data)
    monkeypatch.setattr(fingerprints, "_SLICE", 777)
    assert (fingerprints.boundaries(data) == want).all()
    assert want[-1] == len(data) and (np.diff(want, prepend=0) <= fingerprints.LONGEST).all()


def test_chunks_end_where_the_byte_loop_ends_them():
    rng = np.random.default_rng(8)
    for n in (0, 1, 7, 8, 95, 96, 97, 200, 5_000):
        data = rng.integers(97, 123, n, dtype=np.uint8)
        want = np.cumsum([len(c) for c in chunks(data.tobytes())])
        assert fingerprints.boundaries(data).tolist() == want.tolist()


def test_fingerprints_of_rows_without_ids(spark):
    """A third of the rows has no id, many share one; nobody loses the next document."""
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text {k} " * (k % 9 + 1)) for k in range(300)]
    rows += [(None, "a row that repeats")] * 20 + [(2**60 + 1, "exact"), (2**60 + 2, "ids")]
    df = frame(spark, rows).repartition(4)
    got = fingerprints.fingerprint_documents(df, partition_rows=20).collect()
    assert sorted((tuple(r) for r in got), key=key) == fingerprint_expected(rows)
    few = fingerprints.fingerprint_documents(df, partition_rows=20, most_buckets=3).collect()
    assert sorted((tuple(r) for r in few), key=key) == fingerprint_expected(rows)


def test_frequent_keys_get_ranges_of_their_own():
    starts, alone = fingerprints._bounds([-9.0, -5.0, -5.0, -5.0, -2.0, 1e19, 1e19], 1e19)
    assert alone == {-5.0, 1e19} and starts[0] == -9.0
    assert [s for s in starts if -5.1 < s < -4.9] == [-5.0, np.nextafter(-5.0, 0)]
    assert fingerprints._bounds([2.0**60, 2.0**60], 1e19)[1] == set()
