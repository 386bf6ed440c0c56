"""Label encoding, splits and classifiers (M1-M11, L4, L5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.operators import classification as K
from foliant.operators.fitted import TextClassifier
from foliant.plans import workflow
from foliant.registry.base import query, table
from foliant.registry.metric_queries import rounded
from foliant.registry.vector_queries import (
    LABELLED_SQL,
    labelled,
    terms_sql,
    vocabulary_sql,
    weights_sql,
)
from foliant.session import scratch_folder
from foliant.sources import sinks


def labelled_documents(spark, sf_dir):
    return labelled(spark, sf_dir)[0]


def encoded(spark, sf_dir):
    return K.encode_labels(labelled_documents(spark, sf_dir))


@query(
    "M1_encode_labels",
    "SELECT doc_id, source, dense_rank() OVER (ORDER BY source) - 1 AS y_true FROM documents",
)
def encode_labels(spark, sf_dir):
    return K.encode_labels(table(spark, sf_dir, "documents").select("doc_id", "source"), "source")


# Quotas by largest remainder, from the class counts alone.
QUOTA_SQL = """counts AS (SELECT label AS y_true, count(*) AS n FROM train GROUP BY label),
  total AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * 0.2) AS wanted FROM counts),
  base AS (SELECT y_true, n, floor(n * wanted / total) AS b, n * wanted / total - floor(n * wanted / total) AS rest,
    wanted FROM counts, total),
  quota AS (SELECT y_true, n, CAST(b + CASE WHEN row_number() OVER (ORDER BY round(rest, 9) DESC, y_true)
      <= wanted - (SELECT sum(b) FROM base) THEN 1 ELSE 0 END AS BIGINT) AS train FROM base)"""


@query(
    "M2_stratified_split",
    f"""WITH {LABELLED_SQL}, {QUOTA_SQL}
    SELECT 'train' AS split, y_true, train AS n FROM quota UNION ALL SELECT 'test', y_true, n - train FROM quota""",
)
def stratified_split(spark, sf_dir):
    return K.class_distribution(K.stratified_split(encoded(spark, sf_dir)))


@query(
    "M2_split_partition",
    f"WITH {LABELLED_SQL} SELECT doc_id, label AS y_true, 1 AS times FROM train",
)
def split_partition(spark, sf_dir):
    """Every labelled document lands in exactly one side."""
    split = K.stratified_split(encoded(spark, sf_dir))
    return split.groupBy("doc_id", "y_true").agg(F.count("split").alias("times"))


@query(
    "M10_fold_sizes",
    f"""WITH {LABELLED_SQL}, counts AS (SELECT label AS y_true, count(*) AS n FROM train GROUP BY label)
    SELECT y_true, fold, (n - fold + 4) // 5 AS n FROM counts, generate_series(0, 4) f(fold)""",
)
def fold_sizes(spark, sf_dir):
    folds = K.fold_ids(encoded(spark, sf_dir), 5)
    return folds.groupBy("y_true", "fold").agg(F.count("*").alias("n"))


def trained(spark, sf_dir, model_type, **options):
    split = K.stratified_split(encoded(spark, sf_dir))
    vocabulary, vectors = K.vectorize_split(split)
    trained = K.train(
        vectors.persist(), model_type, vocabulary=vocabulary, documents=split, **options
    )
    return trained.preds


def model_query(name, model_type):
    @query(name)
    def run(spark, sf_dir):
        return trained(spark, sf_dir, model_type)


model_query("M3_random_forest", "random_forest")
model_query("M4_svm", "svm")
model_query("M5_logistic_regression", "logistic_regression")
model_query("M7_gradient_boosting", "gradient_boosting")
model_query("M8_second_boosting", "xgboost")
model_query("M9_train_naive_bayes", "naive_bayes")


BAYES_SQL = f"""WITH {LABELLED_SQL}, {terms_sql('train', stop=False, bigrams=False)}, {vocabulary_sql('', 'train')},
      {terms_sql('test', stop=False, bigrams=False, prefix='x')},
      fitted AS ({weights_sql('c', 'v')}), held AS ({weights_sql('xc', 'v')}),
      classes AS (SELECT label, count(*) AS n, ln(count(*) / (SELECT count(*) FROM train)) AS prior FROM train GROUP BY label),
      mass AS (SELECT label, term, sum(weight) AS w FROM fitted JOIN train USING (doc_id) GROUP BY ALL),
      totals AS (SELECT label, sum(w) + (SELECT count(*) FROM v) AS t FROM mass GROUP BY label),
      likelihood AS (SELECT v.term, totals.label, ln((coalesce(w, 0) + 1) / t) AS l FROM v CROSS JOIN totals
        LEFT JOIN mass ON mass.term = v.term AND mass.label = totals.label),
      scores AS (SELECT test.doc_id, classes.label, prior + coalesce(s, 0) AS score FROM test CROSS JOIN classes
        LEFT JOIN (SELECT doc_id, label, sum(weight * l) AS s FROM held JOIN likelihood USING (term) GROUP BY ALL) x
        ON x.doc_id = test.doc_id AND x.label = classes.label)"""


@query(
    "M6_naive_bayes",
    f"""{BAYES_SQL}
    SELECT doc_id, arg_max(label, score) AS y_pred,
      round(exp(max(score) FILTER (label = 1) - max(score)) / sum(exp(score - m)), 6) AS p_good
    FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS m FROM scores) GROUP BY doc_id""",
)
def naive_bayes(spark, sf_dir):
    train, test = labelled(spark, sf_dir)
    rows = K.encode_labels(train)
    vocabulary = K.fit_vocabulary(rows)
    bayes = K.fit_naive_bayes(vocabulary.weights(rows), rows, vocabulary)
    found = bayes.predict(vocabulary.weights(test), test)
    return rounded(found.select("doc_id", "y_pred", F.get("prob", F.lit(1)).alias("p_good")))


@query(
    "S16_saved_classifier",
    f"""{BAYES_SQL}
    SELECT doc_id, CASE arg_max(label, score) WHEN 1 THEN 'good' ELSE 'bad' END AS label FROM scores GROUP BY doc_id""",
)
def saved_classifier(spark, sf_dir):
    """Fit, store and load a classifier, then name the classes of documents without labels."""
    train, test = labelled(spark, sf_dir)
    named = train.withColumn("label", F.when(F.col("label") == 1, "good").otherwise("bad"))
    rows = K.encode_labels(named)
    vocabulary = K.fit_vocabulary(rows)
    bayes = K.fit_naive_bayes(vocabulary.weights(rows), rows, vocabulary)
    path = f"{scratch_folder(spark)}/classifier"
    sinks.save_model(TextClassifier.of(vocabulary, bayes, K.label_table(named)), path)
    return sinks.load_model(path).transform(test.select("doc_id", "text")).select("doc_id", "label")


@query("M10_cross_validate")
def cross_validate(spark, sf_dir):
    return K.cross_validate(encoded(spark, sf_dir), "svm", 5)


@query("M11_compare_models")
def compare_models(spark, sf_dir):
    return K.compare_models(labelled_documents(spark, sf_dir))[0]


@query("L4_train_classifier")
def train_classifier(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    _, parts = workflow.train_classifier(rows, scratch_folder(spark), "svm")
    return parts["per_class"]


@query("L5_compare_classification_models")
def compare_classification_models(spark, sf_dir):
    parts = workflow.compare_classification_models(
        labelled_documents(spark, sf_dir),
        scratch_folder(spark),
        [*K.MODELS, "bert"],
    )
    return parts["report"]
