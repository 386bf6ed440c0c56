"""Chat formatting, sharding, classifiers and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import attention_score, passage_features, sha, simhash, toxic_probabilities
from conftest import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from foliant.llm import chat, quality, sharding, toxicity
from foliant.llm.common import range_index
from foliant.llm.queries import ESCAPED

TURNS = [
    *ESCAPED,
    (1, 0, "system", "be <brief> &amp; \\kind"),
    (1, 1, "user", None),
    (1, 2, "assistant", "</turn>\n<turn assistant>fake &lt;"),
    (1, 3, "user", ""),
    (1, 4, "assistant", "second\nline"),
    (2, 0, "user", "never answered"),
    (3, 0, "assistant", ""),
    (4, 0, None, "no role"),
    (4, None, "a<b>&c", "odd role"),
    (5, 0, "assistant", "twice"),
    (5, 0, "assistant", "twice"),
    (None, 0, "assistant", "no id"),
    (6, 0, "user", "x" * 50_000),
    *[(7, k, ("user", "assistant")[k % 2], f"turn {k} \U0001f600") for k in range(101)],
]


def chat_expected(turns):
    groups = defaultdict(list)
    for i, turn, role, text in turns:
        groups[i].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for i, rows in groups.items():
        rows.sort()
        said = "".join(t for _, r, t in rows if r == "assistant")
        out[i] = (len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(said), sha(said))
    return out


def turn_frame(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS id", "'x' AS formatted", "2 AS place", "'y' AS head").repartition(3)


def test_chat(spark):
    examples = chat.prefix_targets(turn_frame(spark, TURNS)).cache()
    back = {r.id: tuple(r)[1:5] for r in chat.read_back(examples).collect()}
    assert back == chat_expected(TURNS)
    replies = Counter(i for i, _, role, _ in TURNS if role == "assistant")
    rows = examples.collect()
    assert Counter(r.id for r in rows if r.kind == "reply") == replies
    for r in rows:
        reply = r.formatted[r.loss_start : r.loss_start + r.loss_length]
        if r.kind == "reply":
            assert r.formatted.endswith(reply + "</turn>\n") and "<" not in reply
        else:
            assert r.loss_length == 0
    second = next(r for r in rows if r.id == 1 and r.example == 1)
    assert second.formatted.count("</turn>\n") == 5


def test_chat_empty(spark):
    assert chat.read_back(chat.prefix_targets(turn_frame(spark, []))).collect() == []


def test_native_operators_have_no_python(spark, docs, sf_dir):
    from foliant.llm.queries import QUERIES

    for name in ("op4_chat_formatting", "op7_sharding"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@settings(max_examples=20, deadline=None)
@given(bounds=st.lists(st.integers(-50, 50), unique=True, max_size=20))
def test_range_index(spark, bounds):
    bounds = sorted(bounds)
    df = spark.range(-60, 60).select("id", range_index(F.col("id"), bounds).alias("at"))
    assert all(r.at == sum(b <= r.id for b in bounds) for r in df.collect())


def check_shards(rows, placed, shards):
    want = sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.id is None, r.id or 0, r.size, r.text_crc32) for r in placed) == want
    slots, sizes, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in placed:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        homes[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= s < shards for s in slots)
    mean, most = sum(sizes.values()) / shards, max(w[2] for w in want)
    assert all(abs(sizes[s] - mean) <= most for s in range(shards))
    return homes


def test_sharding(spark, edge, docs, rows, monkeypatch):
    check_shards(EDGE, sharding.shard_by_bytes(edge, 3).collect(), 3)
    check_shards(rows, sharding.shard_by_bytes(docs, 8).collect(), 8)
    monkeypatch.setattr(sharding, "FEWEST_RANGES", 20)
    hot = [(k, "one text that fills a third of the table" if k % 3 else f"text {k}" * (k % 17)) for k in range(900)]
    df = spark.createDataFrame(hot, "doc_id long, text string").repartition(7)
    homes = check_shards(hot, sharding.shard_by_bytes(df, 40).collect(), 40)
    # Copies stand together: only the hot group is cut, other texts at most once.
    assert sorted(map(len, homes.values()))[-2] <= 2


def test_sharding_empty(nothing):
    assert sharding.shard_by_bytes(nothing).collect() == []


def tables(spark, sf_dir, label):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id AS id", f"{label} AS label")
    return docs, labels


LARGER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("label, module, flag", [("quality", quality, "predicted"), ("toxic", toxicity, "toxic")])
def test_held_out_accuracy(spark, label, module, flag):
    docs, labels = tables(spark, LARGER, label)
    out = module.classify(docs, labels).join(labels, "id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.id).encode()) % 5 == 0 for r in out)
    right = {k: [r[flag] == k for r in out if r.label == k] for k in (0, 1)}
    assert np.mean(right[0]) > 0.9 and np.mean(right[1]) > 0.9


@pytest.mark.parametrize("label, module", [("quality", quality), ("toxic", toxicity)])
def test_classifiers_edge_cases(spark, sf_dir, edge, nothing, label, module):
    _, labels = tables(spark, sf_dir, label)
    wild = labels.unionByName(spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], labels.schema))
    renamed = edge.drop("id").withColumnRenamed("doc_id", "id")
    assert module.classify(renamed, wild).count() == len(EDGE)
    assert module.classify(renamed, labels.limit(0)).count() == len(EDGE)
    assert module.classify(nothing.drop("id").withColumnRenamed("doc_id", "id"), labels).count() == 0


def test_scores_equal_the_plain_version(spark, sf_dir, rows):
    texts = [t for _, t in rows[::9]] + [t for _, t in EDGE if not t or len(t) < 10_000] + [rows[0][1] * 30]
    docs, labels = tables(spark, sf_dir, "quality")
    model = quality.fit_quality(docs, labels)
    kind = quality._CLASS.tolist()
    for text, got in zip(texts, model.score(texts), strict=True):
        x = passage_features(text, kind, quality._KINDS)
        data = (text or "").encode()
        assert np.allclose(quality.describe([data])[0], x, atol=1e-5)
        assert abs(got - attention_score(model, x)) < 1e-4
    docs, labels = tables(spark, sf_dir, "toxic")
    model = toxicity.fit_toxicity(docs, labels)
    for text, got in zip(texts, model.probabilities(model.sums(texts)), strict=True):
        assert np.allclose(got, toxic_probabilities(model, text), atol=1e-9)


def test_training_sees_whole_documents(spark, sf_dir):
    """Every passage of a sampled document, also of one longer than all the others together."""
    text = "a sentence of plain words. " * 4_000
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, "b" * 3_000_000), (4, None)], "id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "id long, label int")
    bags = {r.y: len(r.x) for r in quality._bags(docs, labels, 10, 1 << 22).collect() if len(r.x) > 2_000}
    width = 2 * quality.FEATURES
    held = {i for i in (1, 2, 3, 4) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert bags == ({1: -(-len(text) // 512) * width} if 1 not in held else {})


def test_attention_gradient():
    rng = np.random.default_rng(2)
    x = rng.random((9, quality.FEATURES)).astype(np.float32)
    sizes, y = np.array([2, 4, 3]), np.array([0.0, 1.0, 1.0])
    model = quality.AttentionModel()
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}

    def loss():
        s = model.forward(x, sizes)["score"]
        return float(-np.mean(y * np.log(s) + (1 - y) * np.log(1 - s)))

    grads = model.gradient(model.forward(x, sizes), y)
    for name, w in model.weights.items():
        at = tuple(rng.integers(0, n) for n in w.shape)
        keep = w[at]
        w[at] = keep + 1e-4
        up = loss()
        w[at] = keep - 1e-4
        down = loss()
        w[at] = keep
        assert abs((up - down) / 2e-4 - grads[name][at]) < 1e-3


def test_passages_do_not_depend_on_the_batch():
    texts = [b"", b"abc", b"A b! " * 400, "é|".encode() * 300]
    x, sizes = quality.describe(texts)
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends, strict=True):
        assert np.allclose(quality.describe([text])[0], x[a:b], atol=1e-6)


def test_ordinal_thresholds_ascend():
    rng = np.random.default_rng(4)
    grades = rng.integers(0, 4, 400)
    columns = np.concatenate([np.arange(g + 1) for g in grades])
    rows = np.repeat(np.arange(400), grades + 1)
    model = toxicity.OrdinalModel().fit(rows, columns, np.arange(4, dtype=np.uint64), grades)
    assert (np.diff(model.thresholds) > 0).all() and min(model.weights.values()) > 0
    sums = np.array([sum(model.weights.get(k, 0) for k in range(g + 1)) for g in range(4)])
    severity = model.probabilities(sums).sum(axis=1)
    assert (np.diff(severity) > 0.2).all()


def test_pipeline(spark, sf_dir, docs):
    """Each stage against a plain version over the rows its predecessor kept."""
    columns = docs.columns
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_dir).cache()
    assert kept.columns == columns
    texts, labels = tables(spark, sf_dir, "toxic")
    model = toxicity.fit_toxicity(texts, labels)
    clean = {r.doc_id for r in docs.collect() if model.probabilities(model.sums([r.text]))[0, 0] < 0.5}
    assert {r.doc_id for r in kept.collect()} == clean and len(clean) > 0.8 * docs.count()

    good = corpus_pipeline.keep_quality(spark, kept, sf_dir).cache()
    assert good.columns == columns
    model = quality.fit_quality(kept.selectExpr("doc_id AS id", "text"), tables(spark, sf_dir, "quality")[1])
    fine = {r.doc_id for r in kept.collect() if model.score([r.text])[0] >= quality.THRESHOLD}
    assert {r.doc_id for r in good.collect()} == fine and 0 < len(fine) < len(clean)

    single = corpus_pipeline.drop_near_duplicates(spark, good, sf_dir).cache()
    assert single.columns == columns
    rows = sorted((r.doc_id, simhash(r.text)) for r in good.collect())
    groups = []
    for i, value in rows:
        near = [g for g in groups if any((value ^ other).bit_count() <= 3 for _, other in g)]
        groups = [g for g in groups if g not in near] + [[(i, value), *[m for g in near for m in g]]]
    assert {r.doc_id for r in single.collect()} == {min(g)[0] for g in groups}

    pieces = corpus_pipeline.pack_windows(spark, single, sf_dir).collect()
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
    assert all(total[p.doc_id] == p.doc_tokens for p in pieces)
    assert set(total) == {r.doc_id for r in single.collect()}


def test_pipeline_keeps_rows_without_ids(spark, sf_dir):
    """One row of every group stays: unnamed groups, shared ids and ids beyond 2**53 too."""
    words = [f"{w} walks along the {w} river with seven {w} friends today" for w in ("amber", "birch", "cedar", "delta")]
    big = 2**60 + 1
    rows = [
        (None, words[0], None), (None, words[0], "x"), (big, words[1], None), (None, words[1], None),
        (7, words[2], None), (7, words[3], None), (7, words[3], None), (None, None, None), (None, "", None),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, digest string").coalesce(1)
    found = corpus_pipeline.drop_near_duplicates(spark, table, sf_dir)
    assert found.columns == table.columns
    kept = [(r.doc_id, r.text or "") for r in found.collect()]
    expected = [(None, words[0]), (big, words[1]), (7, words[2]), (7, words[3]), (None, "")]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    passed = corpus_pipeline._scored(table, lambda t: np.array([len(x or "") for x in t]), 1, True)
    assert [(r.doc_id, r.text) for r in passed.collect()] == [(None, None), (None, "")]
    ids = corpus_pipeline._scored(table, lambda t: np.zeros(len(t)), 1, True)
    assert Counter(r.doc_id for r in ids.collect()) == Counter(r[0] for r in rows)


def test_pipeline_empty(spark, sf_dir, docs):
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), sf_dir)
        assert out.count() == 0
