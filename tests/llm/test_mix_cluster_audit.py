"""Mixing, centroid clustering and the source audit against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest import EDGE, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.llm import divergence, exact_kmeans, mixing

WORDS = re.compile("[^\x20\x09-\x0d]+")


# Mixing


def plain_targets(sizes, weights=(5, 2, 1), share=Fraction(3, 2), most=2):
    """Share, cut what is above, share the excess again."""
    weight = [weights[k % len(weights)] for k in range(len(sizes))]
    fixed = {}
    while True:
        free = [k for k in range(len(sizes)) if k not in fixed]
        rest = share * sum(sizes) - sum(fixed.values())
        out = {k: rest * weight[k] / sum(weight[j] for j in free) for k in free} | fixed
        above = [k for k in free if out[k] > most * sizes[k]]
        if not above:
            return [out[k] for k in range(len(sizes))]
        fixed |= {k: Fraction(most * sizes[k]) for k in above}


@given(sizes=st.lists(st.integers(0, 5000), max_size=12))
def test_targets(sizes):
    assert mixing.targets(sizes) == plain_targets(sizes)


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 700), seed=st.integers(0, 2**31), turn=st.integers(0, 3))
def test_permutation(n, seed, turn):
    order = mixing.Permutation(n, (seed, 5, turn))
    out = order.forward(np.arange(n))
    assert sorted(out) == list(range(n))
    assert (order.backward(out) == np.arange(n)).all()
    if n > 200:
        assert (out != np.arange(n)).mean() > 0.9


@settings(max_examples=60, deadline=None)
@given(
    sizes=st.lists(st.integers(0, 900), min_size=1, max_size=6),
    parts=st.lists(st.fractions(0, 2, max_denominator=50), min_size=6, max_size=6),
    width=st.integers(1, 40),
    shard=st.integers(1, 20),
    seed=st.integers(0, 10),
)
def test_slots_meet_their_totals(sizes, parts, width, shard, seed):
    wanted = [int(p * s) for p, s in zip(parts, sizes, strict=False)]
    plan = mixing.plan_mix(sizes, wanted, width, shard, seed)
    words, used, filled = Counter(), defaultdict(Counter), []
    for k in range(plan.shards):
        drawn = plan.draw(k)
        filled.append(len(drawn["block"]))
        for s, turn, block, n in zip(*drawn.values(), strict=True):
            words[int(s)] += int(n)
            used[int(s), int(turn)][int(block)] += 1
            assert 0 < n <= min(width, sizes[s] - block * width)
    assert [words[s] for s in range(len(sizes))] == wanted
    assert all(n == 1 for c in used.values() for n in c.values())
    for (s, turn), c in used.items():
        if (s, turn + 1) in used:
            assert len(c) == plan.blocks[s]
    assert filled[:-1] == [shard] * (len(filled) - 1)


def test_shards_follow_the_shares():
    """Counts of a shard scatter as those of a multinomial do."""
    sizes = [400_000, 100_000, 100_000]
    plan = mixing.plan_mix(sizes, sizes, 10, 100)
    counts = np.array([plan.counts(k)[0] for k in range(plan.shards)])
    before = np.array([plan.counts(k)[1] for k in range(plan.shards)])
    assert (np.cumsum(counts, axis=0) - counts == before).all()
    share = np.array(sizes) / sum(sizes)
    assert np.allclose(counts.mean(axis=0), 100 * share, atol=0.5)
    assert np.allclose(counts.var(axis=0), 100 * share * (1 - share), rtol=0.25)


def test_split_of_numbers_beyond_exact_draws():
    counts = np.array([3 * 10**12, 10**12, 5, 0], np.int64)
    out = mixing.split_draw(np.random.default_rng(1), counts, 2 * 10**12)
    assert out.sum() == 2 * 10**12 and (out >= 0).all() and (out <= counts).all()
    assert abs(out[0] - 1.5e12) < 1e8


def sourced(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for name in ("id", "size", "start", "block", "words", "tie", "named", "term", "n", "p", "rank", "terms"):
        df = df.withColumn(name, F.lit("clash"))
    return df


MIXED = [
    *[(i, t, ("b", None, "")[k % 3], ("en", None)[k % 2]) for k, (i, t) in enumerate(EDGE)],
    *[(100 + k, f"w{k} " * (k % 50), "hot", "en") for k in range(300)],
    *[(None, "same words twice", "hot", "en")] * 5,
    (500, "a b c", "é", "de"),
]


def check_mix(rows, mixed, docs):
    found = mixed.taken().collect()
    size = [len(WORDS.findall(t or "")) for _, t, *_ in rows]
    names = sorted({s for *_, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    of = Counter()
    for n, (*_, s, _) in zip(size, rows, strict=True):
        of[s] += n
    goal = dict(zip(names, plain_targets([of[s] for s in names]), strict=True))
    want = sorted((i is None, i or 0, n, of[s], float(goal[s])) for n, (i, _, s, _) in zip(size, rows, strict=True))
    assert sorted((r.id is None, r.id or 0, r.size, r.source_size, r.target) for r in found) == want
    taken = Counter()
    for r in found:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size, r.target] += r.taken
    for key, n in taken.items():
        assert abs(n - key[1] * sum((of[s], float(goal[s])) == key for s in names)) <= 2
    # The written slots hold the words of the documents, as often as these were taken.
    written, by_word = Counter(), Counter()
    slots = mixed.texts(docs).collect()
    assert len({(r.shard, r.place) for r in slots}) == len(slots)
    for r in slots:
        words = WORDS.findall(r.text)
        assert 0 < len(words) <= mixed.block_words
        written.update(words)
    for p in mixed.pieces().collect():
        by_word[p.id] += p.words
    totals = Counter()
    for r in found:
        totals[r.id] += r.taken
    assert +by_word == +totals
    assert sum(written.values()) == sum(totals.values())
    return written


def test_mixing(spark):
    docs = sourced(spark, MIXED).repartition(5)
    mixed = mixing.mix(docs, block_words=16, shard_slots=7)
    written = check_mix(MIXED, mixed, docs)
    # Documents of one distinct word: the word is written as often as it was taken.
    for r in mixed.taken().collect():
        if r.id is not None and 100 <= r.id < 400 and r.size:
            assert written[f"w{r.id - 100}"] == r.taken
    again = mixing.mix(docs.repartition(2).orderBy("text"), block_words=16, shard_slots=7)
    key = ["id", "size", "taken"]
    assert sorted(map(str, mixed.taken().select(key).collect())) == sorted(map(str, again.taken().select(key).collect()))


def test_mixing_tables(spark, docs, nothing):
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]
    check_mix(rows, mixing.mix(docs), docs)
    assert mixing.mix(nothing.withColumn("source", F.lit("x"))).taken().collect() == []
    blank = sourced(spark, [(1, None, None, None), (2, "", "a", "b")])
    assert {(r.id, r.taken, r.target) for r in mixing.mix(blank).taken().collect()} == {(1, 0, 0.0), (2, 0, 0.0)}


# Clustering


def plain_kmeans(rows, k, rounds, dim, scale=256):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v):
            kept.append((i, tuple(int(np.floor(float(c) * scale)) for c in v)))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for n, found in members.items():
            centroids[n] = tuple(sum(col) // len(found) for col in zip(*found, strict=True))
    out = [(i, *nearest(v)) for i, v in kept]
    return Counter((i, c, d) for i, d, c in out), centroids


def vector_frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "1 AS id", "'x' AS x", "2 AS cluster", "'y' AS dots", "'z' AS h").repartition(3)


def test_clustering(spark):
    rng = np.random.default_rng(3)
    near = [(int(i), rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(120)]
    odd = [
        (200, None), (201, []), (202, [1.0] * 5), (203, [1.0, None, 1.0, 1.0]), (204, [1.0, float("nan"), 0.0, 0.0]),
        (205, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5, -0.001, 0.1, 9.0]), (5, near[5][1]), (5, [1.0, 1.0, 2.0, 0.3]),
    ]
    rows = near + odd + [(300 + k, [1.0, 2.0, 3.0, 4.0]) for k in range(80)]
    found, centroids = exact_kmeans.cluster_vectors(vector_frame(spark, rows), k=7, rounds=4, dim=4)
    want, centers = plain_kmeans(rows, 7, 4, 4)
    assert [tuple(c) for c in centroids.tolist()] == centers
    told = exact_kmeans.describe_clusters(found, centroids).collect()
    assert Counter((r.id, r.cluster, r.distance) for r in told) == want
    sums = Counter()
    for (_, c, d), n in want.items():
        sums[c] += n * d
    for r in told:
        assert r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values())
        text = ",".join(map(str, centers[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_clustering_edge_cases(spark):
    few = [(1, [0.0, 0.0]), (2, [1.0, -1.0]), (2, [1.0, -1.0])]
    want, _ = plain_kmeans(few, 40, 5, 2)
    found, _ = exact_kmeans.cluster_vectors(vector_frame(spark, few), dim=2)
    assert Counter((r.id, r.cluster, r.distance) for r in found.collect()) == want
    large = [*few, (9, [1e30, 0.0])]
    found, centroids = exact_kmeans.cluster_vectors(vector_frame(spark, large), dim=2)
    rows = exact_kmeans.describe_clusters(found, centroids).collect()
    assert Counter((r.id, r.cluster, r.distance) for r in rows) == want + Counter([(9, None, None)])
    found, centroids = exact_kmeans.cluster_vectors(vector_frame(spark, []))
    assert exact_kmeans.describe_clusters(found, centroids).collect() == []


def test_dot_products_change_with_the_centroids():
    rng = np.random.default_rng(1)
    x, a = rng.integers(-500, 500, (30, 8)), rng.integers(-500, 500, (5, 8))
    b = a.copy()
    b[1, 3] += 7
    b[4] = 0
    assert (exact_kmeans.change_dots(x @ a.T, x, b - a) == x @ b.T).all()


# Audit


def plain_audit(rows, least=10, top=10):
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for _, text, source, lang in rows:
        found = Counter(t.translate(lower) for t in term.findall(text or ""))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v, names = len(kept), [s for x, s in groups if x == lang]

        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        p = {s: share(groups[lang, s]) for s in names}
        q = share(sum((groups[lang, s] for s in names), Counter()))

        def far(a, b):
            return (a - b) ** 2 // (a + b)

        for s in names:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in names if o != s]
            terms = [(-far(p[s][t], q[t]), t.encode(), t) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, name, -n, k) for k, (n, _, name) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("tile, chunk, most", [(256, 2048, 200_000), (2, 3, 5)])
def test_audit(spark, tile, chunk, most):
    texts = ["Alpha BETA1gamma's ÀÉ ß日本", "beta alpha\x00alpha", "delta-epsilon İ", "beta", None, "!!"]
    rows = [(k, texts[(k * k + k // 7) % 6], ("s1", "s2", "", None, "S3", "s4")[k % 6], ("en", "de", None)[k % 3 % 2]) for k in range(200)]
    rows += MIXED + [(1, "rare words only", "x", "fr"), (2, None, "y", "fr"), (3, None, "z", "nothing")]
    docs = sourced(spark, rows).repartition(4)
    counts = divergence.source_counts(docs, most)
    total = counts.agg(F.sum("n")).first()[0]
    assert total == sum(sum(divergence.term_counts((r[1] or "").encode()).values()) for r in rows)
    got = divergence.divergence(docs, tile_sources=tile, chunk_terms=chunk).collect()
    assert sorted(tuple(r) for r in got) == plain_audit(rows)


def test_audit_empty(nothing):
    empty = nothing.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    assert divergence.divergence(empty).collect() == []


def test_audit_of_a_large_share():
    """Counts far beyond 64 bits stay exact."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(7 * 10**17, 10**18, 10**6)], "n long, total long, terms long")
    got = df.select(divergence._share("n", "total", "terms")).first()[0]
    assert got == 1 + 10**9 * (7 * 10**17 + 2) // (10**18 + 2 * 10**6)
