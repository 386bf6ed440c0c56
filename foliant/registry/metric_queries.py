"""Classification scores, curves and model comparison (E1-E6, E13-E15, P1, P2, P5, M12, M13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.arrays import squared_distance
from foliant.operators import comparison as C
from foliant.operators import metrics as M
from foliant.operators.clustering import centroids
from foliant.registry.base import query, table

# Length thresholds that act as three simple classifiers of text quality.
THRESHOLDS = [("random_forest", 1500), ("svm", 500), ("xgboost", 5000)]


def binary_preds(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y_true"))
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(t).alias("t")) for m, t in THRESHOLDS])
    rows = docs.join(labels, "doc_id").select("*", F.inline(models))
    score = F.floor(F.lit(100.0) * F.col("n_chars") / (F.col("n_chars") + F.col("t"))) / 100
    return rows.select(
        "model",
        F.col("doc_id").alias("row_id"),
        "y_true",
        (F.col("n_chars") > F.col("t")).cast("int").alias("y_pred"),
        F.array(1 - score, score).alias("prob"),
    )


def nearest_preds(spark, sf_dir) -> DataFrame:
    """Nearest label centroid as a multiclass model; closeness as probability."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vec")
    )
    centers = centroids(vectors, col="vec", cluster="label").orderBy("cluster").collect()
    grid = F.array(*[F.array(*[F.lit(x) for x in c["center"]]) for c in centers])
    gaps = vectors.withColumn(
        "gap", F.transform(grid, lambda c: F.sqrt(squared_distance(F.col("vec"), c)))
    ).withColumn("close", F.transform("gap", lambda g: 1 / g))
    total = F.aggregate("close", F.lit(0.0), lambda acc, x: acc + x)
    return gaps.select(
        F.lit("nearest").alias("model"),
        F.col("vec_id").alias("row_id"),
        F.col("label").alias("y_true"),
        (F.array_position("gap", F.array_min("gap")) - 1).cast("int").alias("y_pred"),
        F.transform("close", lambda c: F.floor(c / total * 1000) / 1000).alias("prob"),
    )


def all_preds(spark, sf_dir) -> DataFrame:
    return binary_preds(spark, sf_dir).unionByName(nearest_preds(spark, sf_dir))


_VALUES = ", ".join(f"('{m}', {t})" for m, t in THRESHOLDS)
BINARY_SQL = f"""binary_rows AS (
  SELECT model, d.doc_id AS row_id, quality AS y_true, CAST(n_chars > t AS INT) AS y_pred,
    floor(100.0::DOUBLE * n_chars / (n_chars + t)) / 100 AS score
  FROM documents d JOIN labels USING (doc_id), (VALUES {_VALUES}) v(model, t))"""
CENTERS_SQL = """centers AS (
  SELECT label, list(c ORDER BY dim) AS center FROM (
    SELECT label, dim, avg(CAST(x AS DOUBLE)) AS c FROM (
      SELECT label, unnest(generate_series(1, len(embedding))) AS dim, unnest(embedding) AS x FROM embeddings)
    GROUP BY ALL) GROUP BY label)"""
NEAREST_SQL = f"""{CENTERS_SQL}, gaps AS (
  SELECT vec_id, e.label AS y_true, c.label AS cls, list_distance(embedding::DOUBLE[], center) AS gap
  FROM embeddings e, centers c),
nearest_rows AS (
  SELECT 'nearest' AS model, vec_id AS row_id, any_value(y_true) AS y_true, arg_min(cls, gap) AS y_pred
  FROM gaps GROUP BY vec_id),
nearest_scores AS (
  SELECT 'nearest' AS model, vec_id AS row_id, y_true, cls AS label,
    floor((1 / gap) / sum(1 / gap) OVER (PARTITION BY vec_id) * 1000) / 1000 AS score FROM gaps)"""
PREDS_SQL = f"""{BINARY_SQL}, {NEAREST_SQL}, preds AS (
  SELECT model, row_id, y_true, y_pred FROM binary_rows UNION ALL SELECT * FROM nearest_rows),
scores AS (
  SELECT model, row_id, y_true, 1 AS label, score FROM binary_rows
  UNION ALL SELECT model, row_id, y_true, 0, 1 - score FROM binary_rows
  UNION ALL SELECT * FROM nearest_scores)"""
CLASSES_SQL = """classes AS (
  SELECT model, cls, count(*) FILTER (y_true = cls AND y_pred = cls) AS tp,
    count(*) FILTER (y_pred = cls) AS predicted, count(*) FILTER (y_true = cls) AS support
  FROM preds JOIN (SELECT DISTINCT model AS m, y_true AS cls FROM preds
                   UNION SELECT DISTINCT model, y_pred FROM preds) ON m = model GROUP BY ALL),
rated AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
    2 * tp / (predicted + support) AS f1 FROM classes)"""
METRICS_SQL = f"""{PREDS_SQL}, {CLASSES_SQL}, metrics AS (
  SELECT model, sum(tp) / sum(support) AS accuracy, avg(precision) AS precision_macro,
    sum(precision * support) / sum(support) AS precision_weighted, avg(recall) AS recall_macro,
    sum(recall * support) / sum(support) AS recall_weighted, avg(f1) AS f1_macro,
    sum(f1 * support) / sum(support) AS f1_weighted FROM rated GROUP BY model)"""


def rounded(df: DataFrame, *skip: str) -> DataFrame:
    """Round the double columns, so that sums in another order compare equal."""
    return df.select(
        *[
            F.round(c, 6).alias(c) if t == "double" and c not in skip else F.col(c)
            for c, t in df.dtypes
        ]
    )


@query(
    "E1_classification_metrics",
    f"WITH {METRICS_SQL} SELECT model, "
    + ", ".join(f"round({m}, 6) AS {m}" for m in M.METRICS)
    + " FROM metrics",
)
def classification_metrics(spark, sf_dir):
    return rounded(M.classification_metrics(all_preds(spark, sf_dir)))


GRID_SQL = """grid AS (
  SELECT a.model, a.cls AS y_true, b.cls AS y_pred,
    (SELECT count(*) FROM preds p WHERE p.model = a.model AND p.y_true = a.cls AND p.y_pred = b.cls) AS n
  FROM classes a JOIN classes b ON a.model = b.model)"""


@query(
    "E2_confusion_matrix",
    f"WITH {PREDS_SQL}, {CLASSES_SQL}, {GRID_SQL} SELECT model, y_true, y_pred, n FROM grid",
)
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(all_preds(spark, sf_dir))


@query(
    "E3_confusion_normalized",
    f"""WITH {PREDS_SQL}, {CLASSES_SQL}, {GRID_SQL}
    SELECT model, y_true, y_pred, round(n / nullif(support, 0), 6) AS share
    FROM grid JOIN classes c USING (model) WHERE c.cls = y_true""",
)
def confusion_normalized(spark, sf_dir):
    return rounded(M.confusion_normalized(all_preds(spark, sf_dir)))


@query(
    "E4_per_class_report",
    f"""WITH {PREDS_SQL}, {CLASSES_SQL}, report AS (
      SELECT model, CAST(cls AS VARCHAR) AS label, precision, recall, f1, support FROM rated
      UNION ALL SELECT model, 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support),
        sum(tp) / sum(support), sum(support) FROM rated GROUP BY model
      UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)
        FROM rated GROUP BY model
      UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support),
        sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
        FROM rated GROUP BY model)
    SELECT model, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM report""",
)
def per_class_report(spark, sf_dir):
    return rounded(M.per_class_report(all_preds(spark, sf_dir)))


@query(
    "E5_roc_auc",
    f"""WITH {PREDS_SQL},
    duels AS (  -- every ordered class pair, restricted to the rows of the two classes
      SELECT model, label, o.other, score, y_true = label AS pos FROM scores s
      JOIN (SELECT DISTINCT model AS m, y_true AS other FROM preds) o ON o.m = s.model
      WHERE other <> label AND y_true IN (label, other)),
    duel_rank AS (SELECT *, rank() OVER (PARTITION BY model, label, other ORDER BY score)
        + (count(*) OVER (PARTITION BY model, label, other, score) - 1) / 2 AS r FROM duels),
    duel_auc AS (SELECT model, label, other, (sum(r) FILTER (pos) - sum(pos::INT) * (sum(pos::INT) + 1) / 2)
        / (sum(pos::INT) * sum((NOT pos)::INT)) AS auc FROM duel_rank GROUP BY ALL),
    rest_rank AS (SELECT *, y_true = label AS pos, rank() OVER (PARTITION BY model, label ORDER BY score)
        + (count(*) OVER (PARTITION BY model, label, score) - 1) / 2 AS r FROM scores),
    rest_auc AS (SELECT model, label, (sum(r) FILTER (pos) - sum(pos::INT) * (sum(pos::INT) + 1) / 2)
        / (sum(pos::INT) * sum((NOT pos)::INT)) AS auc FROM rest_rank GROUP BY ALL)
    SELECT model, CASE WHEN count(*) = 2 THEN round(max_by(auc, label), 6) END AS roc_auc,
      CASE WHEN count(*) > 2 THEN round(avg(auc), 6) END AS roc_auc_ovr,
      CASE WHEN count(*) > 2 THEN round((SELECT avg(auc) FROM duel_auc d WHERE d.model = r.model), 6) END AS roc_auc_ovo
    FROM rest_auc r GROUP BY model""",
)
def roc_auc(spark, sf_dir):
    return rounded(M.roc_auc(all_preds(spark, sf_dir)))


@query(
    "E6_distributions",
    f"""WITH {PREDS_SQL}, sides AS (
      SELECT model, 'true' AS kind, y_true AS label FROM preds UNION ALL SELECT model, 'pred', y_pred FROM preds),
    grid AS (SELECT model, kind, unnest(generate_series(0, max(label))) AS label FROM sides GROUP BY model, kind)
    SELECT g.model, g.kind, g.label, count(s.label) AS n FROM grid g LEFT JOIN sides s
      ON g.model = s.model AND g.kind = s.kind AND g.label = s.label GROUP BY ALL""",
)
def distributions(spark, sf_dir):
    return M.distributions(all_preds(spark, sf_dir))


CURVE_SQL = f"""{PREDS_SQL}, steps AS (
  SELECT model, label, score, count(*) FILTER (y_true = label) AS pos, count(*) FILTER (y_true <> label) AS neg
  FROM scores GROUP BY ALL),
curve AS (
  SELECT model, label, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER g AS p, sum(neg) OVER g AS n FROM steps
  WINDOW w AS (PARTITION BY model, label ORDER BY score DESC), g AS (PARTITION BY model, label))"""


@query(
    "P1_roc_points",
    f"""WITH {CURVE_SQL}
    SELECT model, label, CAST(score AS DOUBLE) AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve
    UNION ALL SELECT DISTINCT model, label, 'inf'::DOUBLE, 0, 0 FROM curve""",
)
def roc_points(spark, sf_dir):
    return rounded(M.roc_points(all_preds(spark, sf_dir)), "threshold")


@query(
    "P1_curve_area",
    f"""WITH {CURVE_SQL}, points AS (
      SELECT model, label, fp / n AS x, tp / p AS y FROM curve
      UNION ALL SELECT DISTINCT model, label, 0, 0 FROM curve),
    pieces AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM points
               WINDOW w AS (PARTITION BY model, label ORDER BY x, y))
    SELECT model, label, round(sum((x - px) * (y + py) / 2), 6) AS auc FROM pieces GROUP BY ALL""",
)
def curve_area(spark, sf_dir):
    return rounded(M.curve_area(all_preds(spark, sf_dir)))


@query(
    "P2_pr_points",
    f"""WITH {CURVE_SQL}
    SELECT model, label, CAST(score AS DOUBLE) AS threshold, round(tp / (tp + fp), 6) AS precision,
      round(tp / p, 6) AS recall FROM curve
    UNION ALL SELECT DISTINCT model, label, NULL, 1, 0 FROM curve""",
)
def pr_points(spark, sf_dir):
    return rounded(M.pr_points(all_preds(spark, sf_dir)), "threshold")


def model_results(spark, sf_dir) -> DataFrame:
    """Metrics of the three threshold models plus one that failed."""
    order = F.create_map(*[x for i, (m, _) in enumerate(THRESHOLDS) for x in (F.lit(m), F.lit(i))])
    metrics = M.classification_metrics(binary_preds(spark, sf_dir))
    good = metrics.select(
        "model",
        order[F.col("model")].alias("run_order"),
        *C.TABLE_METRICS,
        F.lit(None).cast("double").alias("training_time"),
        F.lit(None).cast("string").alias("error"),
    )
    failed = metrics.agg(F.count("*").alias("n")).select(
        F.lit("bert").alias("model"),
        F.lit(9).alias("run_order"),
        *[F.lit(None).cast("double").alias(c) for c in [*C.TABLE_METRICS, "training_time"]],
        F.lit("no such model").alias("error"),
    )
    return good.unionByName(failed)


_ORDER = "CASE model " + " ".join(f"WHEN '{m}' THEN {i}" for i, (m, _) in enumerate(THRESHOLDS)) + " END"
RESULTS_SQL = f"""{METRICS_SQL}, results AS (
  SELECT *, {_ORDER} AS run_order FROM metrics WHERE model <> 'nearest')"""


@query(
    "E13_compare_results",
    f"""WITH {RESULTS_SQL}
    SELECT (SELECT model FROM results ORDER BY accuracy DESC, run_order LIMIT 1) AS best_accuracy_model,
      round(max(accuracy), 6) AS best_accuracy,
      (SELECT model FROM results ORDER BY f1_weighted DESC, run_order LIMIT 1) AS best_f1_model,
      round(max(f1_weighted), 6) AS best_f1, round(avg(accuracy), 6) AS avg_accuracy,
      round(stddev_pop(accuracy), 6) AS std_accuracy, round(avg(f1_weighted), 6) AS avg_f1,
      round(stddev_pop(f1_weighted), 6) AS std_f1, count(*) AS num_models FROM results""",
)
def compare_results(spark, sf_dir):
    return rounded(M.compare_results(model_results(spark, sf_dir)))


@query(
    "E14_cv_summary",
    f"""WITH {METRICS_SQL} SELECT 'thresholds' AS model, round(avg(f1_weighted), 6) AS cv_mean,
      round(stddev_pop(f1_weighted), 6) AS cv_std, round(min(f1_weighted), 6) AS cv_min,
      round(max(f1_weighted), 6) AS cv_max FROM metrics""",
)
def cv_summary(spark, sf_dir):
    scores = M.classification_metrics(all_preds(spark, sf_dir)).select(
        F.lit("thresholds").alias("model"), F.col("f1_weighted").alias("score")
    )
    return rounded(M.cv_summary(scores))


@query("E15_evaluate_classification")
def evaluate_classification(spark, sf_dir):
    parts = M.evaluate_classification(all_preds(spark, sf_dir))
    rows = [
        df.select(F.lit(name).alias("part"), "model", F.to_json(F.struct("*")).alias("value"))
        for name, df in parts.items()
    ]
    merged = rows[0]
    for row in rows[1:]:
        merged = merged.unionByName(row)
    return merged


@query(
    "P5_bar_data",
    f"WITH {METRICS_SQL} "
    + " UNION ALL ".join(
        f"SELECT model, '{m}' AS metric, round({m}, 6) AS value FROM metrics" for m in C.PANEL_METRICS
    ),
)
def bar_data(spark, sf_dir):
    metrics = M.classification_metrics(all_preds(spark, sf_dir))
    return rounded(M.bar_data(metrics, C.PANEL_METRICS))


@query(
    "M12_comparison_table",
    f"""WITH {RESULTS_SQL} SELECT model, {", ".join(f"round({m}, 6) AS {m}" for m in C.TABLE_METRICS)},
      CAST(NULL AS DOUBLE) AS training_time FROM results""",
)
def comparison_table(spark, sf_dir):
    return rounded(C.comparison_table(model_results(spark, sf_dir)))


def _advice_sql() -> str:
    rows = [(m, i, t) for m, texts in C.RECOMMENDATIONS.items() for i, t in enumerate(texts)]
    return ", ".join(f"('{m}', {i}, '{t}')" for m, i, t in rows)


@query(
    "M13_comparison_report",
    f"""WITH {RESULTS_SQL}, best AS (SELECT model, accuracy FROM results WHERE accuracy > 0
        ORDER BY accuracy DESC, run_order LIMIT 1),
      advice AS (SELECT pos, text FROM (VALUES {_advice_sql()}) v(m, pos, text) JOIN best ON m = model
        UNION ALL SELECT 99, 'Recommend using ' || model || ' for production deployment' FROM best)
    SELECT (SELECT count(*) + 1 FROM results) AS total_models_tested,
      (SELECT count(*) FROM results) AS successful_models, model AS best_model,
      round(accuracy, 6) AS best_accuracy, row_number() OVER (ORDER BY pos) AS pos, text AS recommendation
    FROM best, advice""",
)
def comparison_report(spark, sf_dir):
    report = C.comparison_report(model_results(spark, sf_dir))
    rows = report.select(
        "total_models_tested",
        "successful_models",
        "best_model",
        "best_accuracy",
        F.posexplode("recommendations").alias("pos", "recommendation"),
    )
    return rounded(rows.withColumn("pos", F.col("pos") + 1))
