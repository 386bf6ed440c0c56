"""Text classification: labels, exact splits, models and cross-validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    OneVsRest,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.arrays import let
from foliant.operators.boosting import SoftmaxTrees, fit_residual_trees, fit_softmax_trees
from foliant.operators.calibration import FOLDS as CALIBRATION_FOLDS
from foliant.operators.calibration import Calibrated, fit_calibrated
from foliant.operators.forest import Forest, fit_forest
from foliant.operators.joins import lookup
from foliant.operators.metrics import bin_counts, classification_metrics
from foliant.operators.ordered import hash_parts
from foliant.operators.vectors import Vocabulary, fit_vocabulary
from foliant.session import durable

MODELS = [
    "random_forest",
    "svm",
    "logistic_regression",
    "naive_bayes",
    "gradient_boosting",
    "xgboost",
]
# Training rows of a partition: their number, hence every seeded draw, follows from the data.
ROWS_PER_TASK = 2_000
# The same for MLlib's linear solvers: a step is a job of some microseconds a row, so that small
# partitions cost more to schedule than to add up.
LINEAR_ROWS_PER_TASK = 10_000
# MLlib's names of the options of this library's own trees.
TREE_OPTIONS = {"numTrees": "trees", "maxIter": "rounds", "maxDepth": "depth", "maxBins": "bins", "stepSize": "step"}
TREE_MODELS = {"random_forest": fit_forest, "gradient_boosting": fit_residual_trees, "xgboost": fit_softmax_trees}
CV_MODELS = ["random_forest", "svm", "logistic_regression"]


def label_table(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Classes in sorted order with index 0 .. k-1 and their row counts."""
    counts = labelled.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return counts.withColumn(
        "y_true", (F.row_number().over(Window.orderBy("label")) - 1).cast("int")
    )


def encode_labels(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Add ``y_true``, the index of the label among the sorted classes."""
    classes = label_table(labelled, label).select(F.col("label").alias(label), "y_true")
    return lookup(labelled, durable(classes), label)


def split_quotas(encoded: DataFrame, test_size: float = 0.2) -> DataFrame:
    """y_true, n, train: rows per class and how many of them are for training.

    ceil(test_size * total) rows are held out; classes share the training rows
    proportionally, left-over rows going to the largest remainders.
    """
    counts = encoded.groupBy("y_true").agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(1))  # one row per class
    total = F.sum("n").over(every)
    wanted = total - F.ceil(total * F.lit(test_size))
    share = F.col("n") * F.col("wanted") / F.col("total")
    shared = (
        counts.withColumn("total", total)
        .withColumn("wanted", wanted)
        .withColumn("base", F.floor(share))
        .withColumn("rest", F.round(share - F.col("base"), 9))
    )
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("rest"), "y_true")
    extra = F.col("wanted") - F.sum("base").over(every)
    return shared.select(
        "y_true",
        "n",
        (F.col("base") + (F.row_number().over(order) <= extra).cast("long")).alias("train"),
    )


def stratified_split(
    encoded: DataFrame, test_size: float = 0.2, seed: int = 42, *, id_col: str = "doc_id"
) -> DataFrame:
    """Add ``split`` (train / test) with exact class quotas.

    The held-out rows of a class are the first in a seeded hash order.
    """
    cuts = split_quotas(encoded, test_size).select(
        "y_true", F.array(F.col("n") - F.col("train")).alias("cuts")
    )
    parts = hash_parts(encoded, durable(cuts), "y_true", id_col, seed)
    return parts.withColumn(
        "split", F.when(F.col("part") == 0, "test").otherwise("train")
    ).drop("part")


def class_distribution(split: DataFrame) -> DataFrame:
    """Rows per split and class 0 .. max, zeros included."""
    counts = split.groupBy("split", "y_true").agg(F.count("*").alias("n"))
    return bin_counts(counts, ["split"], "y_true")


def fold_ids(
    encoded: DataFrame, folds: int = 5, seed: int = 42, *, id_col: str = "doc_id"
) -> DataFrame:
    """Add ``fold`` 0 .. folds-1: every class is cut evenly along a seeded order."""
    size, rest = F.floor(F.col("n") / folds), F.col("n") % folds
    ends = [F.lit(i) * size + F.least(rest, F.lit(i)) for i in range(1, folds)]
    cuts = (
        encoded.groupBy("y_true")
        .agg(F.count("*").alias("n"))
        .select("y_true", F.array(*ends).alias("cuts"))
    )
    parts = hash_parts(encoded, durable(cuts), "y_true", id_col, seed)
    return parts.withColumnRenamed("part", "fold")


def make_estimator(model_type: str, n_rows: int, n_classes: int, **options) -> Estimator:
    """The MLlib estimator behind a model name; ``options`` override its preset."""
    common = {"featuresCol": "features", "labelCol": "label"}
    if model_type == "svm":
        preset = {
            "regParam": 1.0 / max(n_rows, 1),
            "maxIter": 100,
            "tol": 1e-3,
            "standardization": False,
        }
        return _several(LinearSVC(**common, **{**preset, **options}), n_classes)
    if model_type == "logistic_regression":
        preset = {
            "maxIter": 1000,
            "regParam": 1.0 / max(n_rows, 1),
            "tol": 1e-4,
            "standardization": False,
        }
        return LogisticRegression(**common, **{**preset, **options})
    raise ValueError(f"Unknown model type: {model_type}")


def _several(binary, n_classes: int) -> Estimator:
    if n_classes <= 2:
        return binary
    return OneVsRest(
        classifier=binary, featuresCol="features", labelCol="label", rawPredictionCol="rawPrediction"
    )


def _shares(values: Column) -> Column:
    """Values divided by their sum."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return let(total, lambda t: F.transform(values, lambda x: x / t))


def _probabilities(scored: DataFrame) -> Column:
    if "prob" in scored.columns:
        return F.col("prob")
    if "probability" in scored.columns:
        return vector_to_array("probability")
    # Margins of too few rows to calibrate: a logistic curve per class, scaled to sum 1.
    curve = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-m)))
    return let(curve, _shares)


@dataclass
class NaiveBayesText:
    """Multinomial naive Bayes on term weights, as grouped sums.

    ``table`` has one row per vocabulary term with the log likelihood of every
    class: bounded by vocabulary x classes.
    """

    table: DataFrame
    priors: list[float]
    classes: list[int]

    def predict(self, weights: DataFrame, ids: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
        """Long weights (id, term, weight) -> id, y_pred, prob for every row of ``ids``."""
        sums = [
            F.sum(F.col("weight") * F.get("likelihood", F.lit(i))).alias(f"_s{i}")
            for i in range(len(self.classes))
        ]
        scored = weights.join(F.broadcast(self.table), "term").groupBy(id_col).agg(*sums)
        scores = F.array(
            *[
                F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.lit(p)
                for i, p in enumerate(self.priors)
            ]
        )
        rows = ids.select(id_col).join(scored, id_col, "left").select(id_col, scores.alias("s"))
        best = F.array_position("s", F.array_max("s")).cast("int")
        relative = let(
            F.array_max("s"), lambda top: F.transform("s", lambda x: F.exp(x - top))
        )
        return rows.select(
            id_col,
            F.get(F.array(*[F.lit(c) for c in self.classes]), best - 1).alias("y_pred"),
            let(relative, _shares).alias("prob"),
        )


def fit_naive_bayes(
    weights: DataFrame, encoded: DataFrame, vocabulary: Vocabulary, *, id_col: str = "doc_id"
) -> NaiveBayesText:
    """Laplace-smoothed class likelihoods ln((w + 1) / (total + V)) and class shares."""
    counts = {r["y_true"]: r["n"] for r in encoded.groupBy("y_true").agg(F.count("*").alias("n")).collect()}
    classes, n = sorted(counts), sum(counts.values())
    joined = weights.join(encoded.select(id_col, "y_true"), id_col)
    per_class = [F.sum(F.when(F.col("y_true") == c, F.col("weight")).otherwise(0.0)).alias(f"c{c}") for c in classes]
    # Every vocabulary term got its weight from these rows, so none is missing.
    sums = durable(joined.groupBy("term").agg(*per_class))
    mass = sums.agg(*[F.sum(f"c{c}").alias(f"c{c}") for c in classes]).first()
    totals = {c: mass[f"c{c}"] for c in classes}
    table = durable(
        sums.select(
            "term",
            F.array(
                *[
                    F.log((F.col(f"c{c}") + 1) / F.lit(totals[c] + len(vocabulary.terms)))
                    for c in classes
                ]
            ).alias("likelihood"),
        )
    )
    return NaiveBayesText(table, [log(counts[c] / n) for c in classes], classes)


@dataclass
class Trained:
    model_type: str
    preds: DataFrame
    model: Model | NaiveBayesText | SoftmaxTrees | Forest | Calibrated
    vocabulary: Vocabulary | None = None

    @property
    def metrics(self) -> DataFrame:
        return classification_metrics(self.preds)


def vectorize_split(
    split: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    vocabulary: Vocabulary | None = None,
) -> tuple[Vocabulary, DataFrame]:
    """Fit the plain TF-IDF on the training rows: vocabulary, slim vectors.

    The vectors keep id, y_true, split and ``features`` but not the text, so
    they can be cached for many fits.
    """
    model = vocabulary or fit_vocabulary(split.filter("split = 'train'"), text=text)
    vectors = model.tfidf_vectors(split.select(id_col, "y_true", "split", text), text=text)
    return model, vectors.drop(text)


def train(
    vectors: DataFrame,
    model_type: str = "random_forest",
    *,
    vocabulary: Vocabulary | None = None,
    documents: DataFrame | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    calibrated: bool = True,
    **options,
) -> Trained:
    """Fit one model on the train rows and predict the test rows.

    Without ``calibrated`` margins become chances by a plain logistic curve: an SVM is then
    fitted once, not once more for each calibration fold. Its classes are the same.

    ``vectors`` comes from :func:`vectorize_split`. Naive Bayes works on the
    long term weights and also needs the vocabulary and the split documents.
    The result's ``preds`` has model, row_id, y_true, y_pred, prob.
    """
    if model_type == "naive_bayes":
        if vocabulary is None or documents is None:
            raise ValueError("naive_bayes needs the vocabulary and the documents")
        fit_rows, held = documents.filter("split = 'train'"), documents.filter("split = 'test'")
        weights = vocabulary.weights(fit_rows, id_col=id_col, text=text)
        model = fit_naive_bayes(weights, fit_rows, vocabulary, id_col=id_col)
        held_weights = vocabulary.weights(held, id_col=id_col, text=text)
        found = model.predict(held_weights, held, id_col=id_col)
        scored = held.select(id_col, "y_true").join(found, id_col)
    else:
        fit_rows, held = vectors.filter("split = 'train'"), vectors.filter("split = 'test'")
        stats = fit_rows.agg(F.count("*").alias("n"), F.max("y_true").alias("top")).first()
        n_classes = (stats["top"] or 0) + 1
        numeric = F.col("y_true").cast("double").alias("label")
        # Iterative solvers run a job per step over stored vectors. Their seeds go by the
        # number of the partition, so rows are dealt by id into as many as the data ask for.
        tasks = 1 + stats["n"] // (ROWS_PER_TASK if model_type in TREE_MODELS else LINEAR_ROWS_PER_TASK)
        dealt = fit_rows.repartition(tasks, id_col).sortWithinPartitions(id_col)
        fold = F.xxhash64(id_col, F.lit(seed)).alias("fold_key")
        ready = durable(dealt.select("features", numeric, fold))
        if model_type in TREE_MODELS:
            some = ready.select("features").first()
            n_features = some["features"].size if some else 0
            preset = {TREE_OPTIONS.get(name, name): value for name, value in options.items()}
            model = TREE_MODELS[model_type](ready, n_features, n_classes, **preset)
            scored = model.predict(held.select(id_col, "y_true", "features"))
        else:
            estimator = make_estimator(model_type, stats["n"], n_classes, **options)
            calibrate = calibrated and model_type == "svm" and stats["n"] >= 2 * CALIBRATION_FOLDS
            model = fit_calibrated(estimator, ready, n_classes) if calibrate else estimator.fit(ready)
            done = model.transform(held)
            scored = done.select(
                id_col,
                "y_true",
                F.col("prediction").cast("int").alias("y_pred"),
                _probabilities(done).alias("prob"),
            )
    preds = scored.select(
        F.lit(model_type).alias("model"), F.col(id_col).alias("row_id"), "y_true", "y_pred", "prob"
    )
    return Trained(model_type, preds, model, vocabulary)


def cross_validate(
    encoded: DataFrame,
    model_type: str = "random_forest",
    folds: int = 5,
    seed: int = 42,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    fit_on_all: bool = False,
    **options,
) -> DataFrame:
    """Weighted F1 per fold: model, fold, score.

    The vocabulary is fitted inside each fold; ``fit_on_all`` fits it once on
    every row instead.
    """
    if model_type not in CV_MODELS:
        raise ValueError(f"Unknown model type: {model_type}")
    dealt = durable(fold_ids(encoded, folds, seed, id_col=id_col))
    shared = fit_vocabulary(dealt, text=text) if fit_on_all else None
    scores = None
    for fold in range(folds):
        split = dealt.withColumn(
            "split", F.when(F.col("fold") == fold, "test").otherwise("train")
        )
        _, vectors = vectorize_split(split, id_col=id_col, text=text, vocabulary=shared)
        vectors.persist()
        # The score goes by classes alone, which calibration does not change.
        trained = train(vectors, model_type, id_col=id_col, calibrated=False, **options)
        score = durable(
            trained.metrics.select(
                "model", F.lit(fold).alias("fold"), F.col("f1_weighted").alias("score")
            )
        )
        vectors.unpersist()
        scores = score if scores is None else scores.unionByName(score)
    return scores


def compare_models(
    labelled: DataFrame,
    models: Sequence[str] = tuple(MODELS),
    test_size: float = 0.2,
    seed: int = 42,
    *,
    label: str = "label",
    id_col: str = "doc_id",
    text: str = "text",
    options: dict[str, dict] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split and vectorize once, train every model: results, preds, data info.

    A failing model becomes a result row with its error.
    """
    from foliant.operators.comparison import RESULT_SCHEMA, TABLE_METRICS

    spark = labelled.sparkSession
    encoded = encode_labels(labelled.select(id_col, text, label), label)
    split = durable(stratified_split(encoded, test_size, seed, id_col=id_col))
    vocabulary, vectors = vectorize_split(split, id_col=id_col, text=text)
    vectors.persist()
    results, preds = None, None
    for order, name in enumerate(models):
        try:
            trained = train(
                vectors,
                name,
                vocabulary=vocabulary,
                documents=split,
                id_col=id_col,
                text=text,
                **(options or {}).get(name, {}),
            )
            rows = durable(trained.preds)
            preds = rows if preds is None else preds.unionByName(rows)
            row = classification_metrics(rows).select(
                "model",
                F.lit(order).alias("run_order"),
                *TABLE_METRICS,
                F.lit(None).cast("double").alias("training_time"),
                F.lit(None).cast("string").alias("error"),
            )
        except Exception as e:  # noqa: BLE001 - the error is the result
            row = spark.createDataFrame(
                [(name, order, None, None, None, None, None, None, str(e).splitlines()[0])],
                RESULT_SCHEMA,
            )
        results = row if results is None else results.unionByName(row)
    vectors.unpersist()
    return results, preds, data_info(split)


def data_info(split: DataFrame) -> DataFrame:
    """One row: total, train and test samples, number of classes."""
    return split.agg(
        F.count("*").alias("total_samples"),
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "test").alias("test_samples"),
        F.count_distinct("y_true").alias("num_classes"),
    )
