"""Fitted objects stored, loaded and used again."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from foliant.operators import classification as C
from foliant.operators import clustering, reduction
from foliant.operators import fitted as S
from foliant.operators import vectors as V
from foliant.sources import sinks

WORDS = {"sport": "ball goal team match win", "news": "vote law court city mayor", "food": "soup bread salt oven dish"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(60):
        name = sorted(WORDS)[k % 3]
        rows.append((k, " ".join(rng.choice(WORDS[name].split(), 12)) + " common words", name))
    return spark.createDataFrame(rows, "doc_id long, text string, label string")


@pytest.fixture(scope="module")
def bayes(labelled):
    rows = C.encode_labels(labelled)
    vocabulary = C.fit_vocabulary(rows)
    return vocabulary, C.fit_naive_bayes(vocabulary.weights(rows), rows, vocabulary)


def test_classifier_names_classes(spark, labelled, bayes, tmp_path):
    stage = S.TextClassifier.of(*bayes, C.label_table(labelled))
    sinks.save_model(stage, f"{tmp_path}/model")
    docs = labelled.drop("label")
    got = {r.doc_id: (r.label, r.y_pred, tuple(r.prob)) for r in sinks.load_model(f"{tmp_path}/model").transform(docs).collect()}
    direct = {r.doc_id: (r.y_pred, tuple(r.prob)) for r in bayes[1].predict(bayes[0].weights(docs), docs).collect()}
    assert {i: v[1:] for i, v in got.items()} == direct
    assert {i: v[0] for i, v in got.items()} == {r.doc_id: r.label for r in labelled.collect()}


def test_pipeline_of_own_and_given_stages(spark, labelled, bayes, tmp_path):
    encoded = C.encode_labels(labelled)
    vocabulary = bayes[0]
    vectors = vocabulary.tfidf_vectors(encoded).withColumnRenamed("y_true", "numbered")
    trees = C.fit_softmax_trees(vectors, len(vocabulary.terms), 3, rounds=3, depth=2, label="numbered")
    stages = [
        S.TextVectors.of(vocabulary),
        S.TreeClassifier.of(spark, trees),
        S.LabelNames.of(labelled, output="name"),
    ]
    PipelineModel(stages).write().overwrite().save(f"{tmp_path}/pipeline")
    loaded = PipelineModel.load(f"{tmp_path}/pipeline")
    assert [type(s) for s in loaded.stages] == [type(s) for s in stages]
    assert [s.uid for s in loaded.stages] == [s.uid for s in stages]
    out = loaded.transform(labelled.drop("label")).collect()
    want = {r.doc_id: tuple(r.prob) for r in trees.predict(vectors.select("doc_id", "features")).collect()}
    assert {r.doc_id: tuple(r.prob) for r in out} == want
    assert {r.doc_id: r.name for r in out} == {r.doc_id: r.label for r in labelled.collect()}


def test_bases_and_centers(spark, labelled, bayes, tmp_path):
    vocabulary = bayes[0]
    rows = vocabulary.weight_rows(labelled)
    basis = reduction.svd_basis(rows, len(vocabulary.terms), 4)
    S.ReducedVectors.of(spark, vocabulary, basis).write().save(f"{tmp_path}/svd")
    reduced = S.ReducedVectors.load(f"{tmp_path}/svd").transform(labelled)
    direct = reduction.svd(rows, len(vocabulary.terms), 4).collect()
    assert {r.doc_id: pytest.approx(r.reduced) for r in direct} == {r.doc_id: r.reduced for r in reduced.collect()}
    points = reduced.withColumnRenamed("doc_id", "id").withColumnRenamed("reduced", "embedding")
    _, centers, _ = clustering.kmeans(points, 3)
    S.NearestCenter.of(centers).write().save(f"{tmp_path}/centers")
    got = S.NearestCenter.load(f"{tmp_path}/centers").transform(points)
    assert got.exceptAll(clustering.assign_to_centers(points, centers)).isEmpty() and got.count() == 60


def test_another_session_reads_it(spark, labelled, bayes, tmp_path):
    sinks.save_model(S.TextClassifier.of(*bayes, C.label_table(labelled)), f"{tmp_path}/model")
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from foliant.sources import sinks
docs = spark.createDataFrame([(1, "soup salt"), (2, "team goal"), (3, "nothing known")], "doc_id long, text string")
print([(r.doc_id, r.label) for r in sinks.load_model("{tmp_path}/model").transform(docs).orderBy("doc_id").collect()])
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "[(1, 'food'), (2, 'sport'), (3, 'food')]" in done.stdout, done.stderr[-2000:]
