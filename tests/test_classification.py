import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import classification as C
from foliant.operators import comparison as P
from foliant.operators.vectors import fit_vocabulary

WORDS = {"fruit": "apple pear plum", "metal": "iron zinc tin", "animal": "cat dog horse"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(90):
        label = ["fruit", "metal", "animal"][i % 3] if i < 80 else "fruit"
        words = WORDS[label].split() + ["common", "noise"]
        rows.append((i, " ".join(rng.choice(words, 12)), label))
    return spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(4)


@pytest.fixture(scope="module")
def encoded(labelled):
    return C.encode_labels(labelled)


def test_encode_sorts_classes(encoded):
    got = {(r.label, r.y_true) for r in encoded.select("label", "y_true").distinct().collect()}
    assert got == {("animal", 0), ("fruit", 1), ("metal", 2)}


def test_split_is_exact_and_stable(encoded):
    split = C.stratified_split(encoded, 0.2)
    counts = {(r.split, r.y_true): r.n for r in C.class_distribution(split).collect()}
    assert sum(n for (s, _), n in counts.items() if s == "test") == 18
    for c, n in {0: 26, 1: 37, 2: 27}.items():
        assert counts["train", c] + counts["test", c] == n
        assert abs(counts["test", c] - 0.2 * n) < 1
    again = C.stratified_split(encoded.repartition(7), 0.2)
    assert split.exceptAll(again).count() == 0
    other = C.stratified_split(encoded, 0.2, seed=7)
    assert split.exceptAll(other).count() > 0


def test_cuts_are_exact_in_one_bucket_and_in_many(spark):
    from foliant.operators.ordered import hash_parts

    df = spark.range(1000).selectExpr("id", "cast(id % 3 = 0 as int) as g")
    cuts = spark.createDataFrame([(0, [0, 5, 666]), (1, [100, 100, 334])], "g int, cuts array<long>")
    for buckets in (2, 64, 4096):
        got = hash_parts(df, cuts, "g", "id", 1, buckets).groupBy("g", "part").count().collect()
        assert {(r.g, r.part): r["count"] for r in got} == {
            (0, 1): 5, (0, 2): 661, (1, 0): 100, (1, 2): 234}


def test_folds_are_balanced(encoded):
    sizes = C.fold_ids(encoded, 5).groupBy("y_true", "fold").count().collect()
    for c in range(3):
        ns = [r["count"] for r in sizes if r.y_true == c]
        assert len(ns) == 5 and max(ns) - min(ns) <= 1


@pytest.mark.parametrize("name,options", [
    ("random_forest", {"numTrees": 5, "maxDepth": 5}),
    ("svm", {"maxIter": 10}),
    ("logistic_regression", {}),
    ("naive_bayes", {}),
    ("gradient_boosting", {"maxIter": 3}),
    ("xgboost", {"rounds": 4, "depth": 3}),
])
def test_models_learn(encoded, name, options):
    split = C.stratified_split(encoded, 0.2)
    vocabulary, vectors = C.vectorize_split(split)
    trained = C.train(vectors, name, vocabulary=vocabulary, documents=split, **options)
    row = trained.metrics.first()
    assert row.model == name and row.accuracy > 0.8
    probs = [r.prob for r in trained.preds.collect()]
    assert len(probs) == 18 and all(len(p) == 3 for p in probs)
    assert [sum(p) for p in probs] == pytest.approx([1.0] * 18)


def test_unknown_model(encoded):
    split = C.stratified_split(encoded, 0.2)
    vocabulary, vectors = C.vectorize_split(split)
    with pytest.raises(ValueError):
        C.train(vectors, "oracle", vocabulary=vocabulary)
    with pytest.raises(ValueError):
        C.cross_validate(encoded, "naive_bayes")


def test_naive_bayes_likelihoods_agree_with_mllib(encoded):
    from pyspark.ml.classification import NaiveBayes

    vocabulary = fit_vocabulary(encoded)
    bayes = C.fit_naive_bayes(vocabulary.weights(encoded), encoded, vocabulary)
    ours = {r.term: r.likelihood for r in bayes.table.collect()}
    data = vocabulary.tfidf_vectors(encoded).withColumn("y", F.col("y_true").cast("double"))
    theta = NaiveBayes(labelCol="y", smoothing=1.0).fit(data).theta.toArray()
    for i, term in enumerate(vocabulary.terms):
        assert ours[term] == pytest.approx(theta[:, i])
    assert bayes.priors == pytest.approx(np.log(np.array([26, 37, 27]) / 90))


def test_cross_validation(encoded):
    scores = C.cross_validate(encoded, "logistic_regression", 3, maxIter=20).collect()
    assert sorted(r.fold for r in scores) == [0, 1, 2]
    assert all(r.score > 0.8 for r in scores)
    every = C.cross_validate(encoded, "svm", 2, fit_on_all=True, maxIter=5).collect()
    assert len(every) == 2


def test_compare_records_errors(labelled):
    results, preds, info = C.compare_models(
        labelled, ["naive_bayes", "bert", "logistic_regression"],
        options={"logistic_regression": {"maxIter": 20}})
    assert tuple(info.first()) == (90, 72, 18, 3)
    rows = {r.model: r for r in results.collect()}
    assert "Unknown" in rows["bert"].error and rows["naive_bayes"].error is None
    assert preds.select("model").distinct().count() == 2
    assert P.comparison_table(results).count() == 2
    report = P.comparison_report(results).first()
    assert (report.total_models_tested, report.successful_models) == (3, 2)
    assert report.recommendations[-1] == f"Recommend using {report.best_model} for production deployment"


def test_report_without_winner(spark):
    rows = [("svm", 0, 0.0, 0.0, 0.0, 0.0, 0.0, None, None)]
    report = P.comparison_report(spark.createDataFrame(rows, P.RESULT_SCHEMA)).first()
    assert report.best_model is None and report.best_accuracy == 0 and report.recommendations == []


def test_cross_validation_fits_an_svm_once_a_fold(encoded, monkeypatch):
    """Scores go by classes: no calibration fits."""

    def refuse(*_):
        raise AssertionError("calibrated")

    monkeypatch.setattr(C, "fit_calibrated", refuse)
    scores = C.cross_validate(encoded, "svm", 2).collect()
    assert sorted(r.fold for r in scores) == [0, 1]


def test_gradient_boosting_is_one_model_of_all_classes(encoded):
    """Sparse rows and one tree per class and round, not a dense fit for each class."""
    vocabulary, vectors = C.vectorize_split(C.stratified_split(encoded, 0.2))
    model = C.train(vectors, "gradient_boosting", maxIter=2, maxDepth=2).model
    assert isinstance(model, C.SoftmaxTrees) and [len(trees) for trees in model.rounds] == [3, 3]
    assert all(len(t.feature) == 7 for trees in model.rounds for t in trees)


@pytest.mark.parametrize("name", ["svm", "logistic_regression"])
def test_linear_solvers_take_large_partitions(spark, encoded, monkeypatch, name):
    """A step of theirs is a job over every partition; 6,048 rows are too few to deal out."""
    seen = []
    monkeypatch.setattr(C, "durable", lambda df: seen.append(df.rdd.getNumPartitions()) or df)
    _, vectors = C.vectorize_split(C.stratified_split(encoded, 0.2))
    many = vectors.crossJoin(spark.range(84)).withColumn("doc_id", F.xxhash64("doc_id", "id"))
    seen.clear()
    C.train(many.drop("id"), name, calibrated=False, maxIter=1)
    assert seen == [1]
