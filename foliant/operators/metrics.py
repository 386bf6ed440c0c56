"""Classification scores from (model, row_id, y_true, y_pred, prob) rows.

Everything starts from one partially aggregated contingency table, so the size
or skew of the classes never reaches a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.operators.ordered import running_totals
from foliant.session import durable

METRICS = [
    "accuracy",
    "precision_macro",
    "precision_weighted",
    "recall_macro",
    "recall_weighted",
    "f1_macro",
    "f1_weighted",
]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def confusion_counts(preds: DataFrame) -> DataFrame:
    return preds.groupBy("model", "y_true", "y_pred").agg(F.count("*").alias("n"))


def class_scores(preds: DataFrame) -> DataFrame:
    """model, label, precision, recall, f1, support, tp for every true or predicted label."""
    n, hit = F.col("n"), F.col("y_true") == F.col("y_pred")
    zero = F.lit(0).cast("long")
    sides = confusion_counts(preds).select(
        "model",
        F.inline(
            F.array(
                F.struct(
                    F.col("y_true").alias("label"),
                    F.when(hit, n).otherwise(zero).alias("tp"),
                    zero.alias("fp"),
                    n.alias("support"),
                ),
                F.struct(
                    F.col("y_pred").alias("label"),
                    zero.alias("tp"),
                    F.when(hit, zero).otherwise(n).alias("fp"),
                    zero.alias("support"),
                ),
            )
        ),
    )
    sums = sides.groupBy("model", "label").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("support").alias("support")
    )
    tp, fp, support = F.col("tp"), F.col("fp"), F.col("support")
    return sums.select(
        "model",
        "label",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, tp + fp + support).alias("f1"),
        "support",
        "tp",
    )


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("support")) / F.sum("support")


def classification_metrics(preds: DataFrame) -> DataFrame:
    """One row per model: accuracy and macro / weighted precision, recall, F1."""
    return class_scores(preds).groupBy("model").agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        _weighted("precision").alias("precision_weighted"),
        F.avg("recall").alias("recall_macro"),
        _weighted("recall").alias("recall_weighted"),
        F.avg("f1").alias("f1_macro"),
        _weighted("f1").alias("f1_weighted"),
    )


def per_class_report(preds: DataFrame) -> DataFrame:
    """Class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    scores = class_scores(preds)
    names = ["precision", "recall", "f1"]
    classes = scores.select("model", F.col("label").cast("string").alias("label"), *names, "support")
    totals = scores.groupBy("model").agg(
        (F.sum("tp") / F.sum("support")).alias("acc"),
        *[F.avg(c).alias(f"m_{c}") for c in names],
        *[_weighted(c).alias(f"w_{c}") for c in names],
        F.sum("support").alias("support"),
    )

    def summary(label: str, picked: list[str]) -> Column:
        columns = [F.col(p).alias(c) for p, c in zip(picked, names, strict=True)]
        return F.struct(F.lit(label).alias("label"), *columns, "support")

    rows = F.array(
        summary("accuracy", ["acc"] * 3),
        summary("macro avg", [f"m_{c}" for c in names]),
        summary("weighted avg", [f"w_{c}" for c in names]),
    )
    return classes.unionByName(totals.select("model", F.inline(rows)))


def confusion_matrix(preds: DataFrame) -> DataFrame:
    """Dense counts, rows = truth: every label pair of a model, zeros included."""
    counts = confusion_counts(preds)
    labels = counts.groupBy("model").agg(
        F.array_sort(
            F.array_union(F.collect_set("y_true"), F.collect_set("y_pred"))
        ).alias("labels")
    )
    grid = labels.select("model", "labels", F.explode("labels").alias("y_true")).select(
        "model", "y_true", F.explode("labels").alias("y_pred")
    )
    return grid.join(counts, ["model", "y_true", "y_pred"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


def confusion_normalized(preds: DataFrame) -> DataFrame:
    """Confusion matrix divided by its row totals; NaN for a row without truth."""
    total = F.sum("n").over(Window.partitionBy("model", "y_true"))
    return confusion_matrix(preds).select(
        "model",
        "y_true",
        "y_pred",
        F.when(total > 0, F.col("n") / total).otherwise(F.lit(float("nan"))).alias("share"),
    )


def distributions(preds: DataFrame) -> DataFrame:
    """Counts per class 0..max of truth and prediction, zero rows included."""
    sides = confusion_counts(preds).select(
        "model",
        F.inline(
            F.array(
                F.struct(F.lit("true").alias("kind"), F.col("y_true").alias("label"), "n"),
                F.struct(F.lit("pred").alias("kind"), F.col("y_pred").alias("label"), "n"),
            )
        ),
    )
    counts = sides.groupBy("model", "kind", "label").agg(F.sum("n").alias("n"))
    return bin_counts(counts, ["model", "kind"], "label")


def bin_counts(counts: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Fill (keys, label, n) up with zero rows for the missing labels 0 .. max."""
    known = counts.groupBy(*keys).agg(
        F.max(label).alias("_top"),
        F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("_n"),
    )
    filled = known.select(*keys, "_n", F.explode(F.sequence(F.lit(0), "_top")).alias(label))
    count = F.coalesce(F.try_element_at("_n", F.col(label)), F.lit(0))
    return filled.select(*keys, label, count.alias("n"))


def _curve_counts(preds: DataFrame) -> DataFrame:
    """model, label, score, pos, neg: one row per class and distinct score."""
    long = preds.select("model", "y_true", F.posexplode("prob").alias("label", "score"))
    hit = (F.col("y_true") == F.col("label")).cast("long")
    return long.groupBy("model", "label", "score").agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
    )


def roc_auc(preds: DataFrame) -> DataFrame:
    """Exact rank statistic with mid-ranks, one row per model.

    Two classes give ``roc_auc`` (class 1 positive), more give the
    one-vs-rest and one-vs-one macro means. A model with a single true class
    yields no row.
    """
    labels = preds.groupBy("model").agg(F.collect_set("y_true").alias("labels"))
    scores = preds.join(F.broadcast(labels), "model").select(
        "model", "y_true", "labels", F.posexplode("prob").alias("label", "score")
    )
    # One duel per ordered class pair: a positive row meets every other class,
    # a negative row only its own.
    hit = F.col("y_true") == F.col("label")
    others = F.array_except("labels", F.array("label"))
    duels = scores.filter(F.array_contains("labels", F.col("label"))).select(
        "model",
        "label",
        "score",
        hit.alias("hit"),
        F.explode(F.when(hit, others).otherwise(F.array("y_true"))).alias("other"),
    )
    counts = durable(
        duels.groupBy("model", "label", "other", "score").agg(
            F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg")
        )
    )
    ranked = running_totals(counts, ["model", "label", "other"], "score", ["neg"])
    pairs = ranked.groupBy("model", "label", "other").agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2)).alias("won"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    # Wins add up over the opponents, so one-vs-rest needs no second ranking.
    per_label = pairs.groupBy("model", "label").agg(
        (F.sum("won") / F.max("p") / F.sum("n")).alias("ovr"),
        F.sum(F.col("won") / F.col("p") / F.col("n")).alias("ovo"),
        F.count("*").alias("opponents"),
    )
    several = F.count("*") > 2
    return per_label.groupBy("model").agg(
        F.when(~several, F.max_by("ovr", "label")).alias("roc_auc"),
        F.when(several, F.avg("ovr")).alias("roc_auc_ovr"),
        F.when(several, F.sum("ovo") / F.sum("opponents")).alias("roc_auc_ovo"),
    )


def _threshold_counts(preds: DataFrame) -> DataFrame:
    """Counts at and above each distinct score: tp, fp, with class totals p, n."""
    # Read four times below.
    counts = durable(_curve_counts(preds).withColumn("desc", -F.col("score")))
    ranked = running_totals(counts, ["model", "label"], "desc", ["pos", "neg"])
    totals = counts.groupBy("model", "label").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return ranked.join(totals, ["model", "label"]).select(
        "model",
        "label",
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        "p",
        "n",
    )


def roc_points(preds: DataFrame) -> DataFrame:
    """fpr and tpr at every distinct threshold, from (0, 0) at threshold infinity."""
    at = _threshold_counts(preds)
    start = at.select("model", "label").distinct().select(
        "model",
        "label",
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    nan = F.lit(float("nan"))
    curve = at.select(
        "model",
        "label",
        "threshold",
        F.when(F.col("n") > 0, F.col("fp") / F.col("n")).otherwise(nan).alias("fpr"),
        F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(nan).alias("tpr"),
    )
    return curve.unionByName(start)


def curve_area(preds: DataFrame) -> DataFrame:
    """Trapezoid area under each ROC curve."""
    counts = _curve_counts(preds)
    ranked = running_totals(counts, ["model", "label"], "score", ["neg"])
    # Step k adds pos(k) of height over everything below plus half of itself.
    return ranked.groupBy("model", "label").agg(
        (
            F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
            / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))
        ).alias("auc")
    )


def pr_points(preds: DataFrame) -> DataFrame:
    """Precision and recall at every distinct threshold, ending at (1, 0)."""
    at = _threshold_counts(preds)
    end = at.select("model", "label").distinct().select(
        "model",
        "label",
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    curve = at.select(
        "model",
        "label",
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(1.0).alias("recall"),
    )
    return curve.unionByName(end)


def bar_data(table: DataFrame, metrics: list[str]) -> DataFrame:
    """model, metric, value; a missing value counts as 0."""
    return table.unpivot("model", metrics, "metric", "value").withColumn(
        "value", F.coalesce("value", F.lit(0.0))
    )


def first_best(score: str) -> Column:
    """Aggregate: the row with the highest score, the earliest run winning ties."""
    return F.max(
        F.when(
            F.col(score).isNotNull(),
            F.struct(
                F.col(score).alias("score"),
                (-F.col("run_order")).alias("_order"),
                F.col("model").alias("model"),
            ),
        )
    )


def compare_results(results: DataFrame) -> DataFrame:
    """(model, run_order, accuracy, f1_weighted, error) -> best models and summary."""
    good = results.filter(F.col("error").isNull()).select(
        "model",
        "run_order",
        F.coalesce("accuracy", F.lit(0.0)).alias("accuracy"),
        F.coalesce("f1_weighted", F.lit(0.0)).alias("f1_weighted"),
    )
    best = good.agg(
        first_best("accuracy").alias("a"),
        first_best("f1_weighted").alias("f"),
        F.avg("accuracy").alias("avg_accuracy"),
        F.stddev_pop("accuracy").alias("std_accuracy"),
        F.avg("f1_weighted").alias("avg_f1"),
        F.stddev_pop("f1_weighted").alias("std_f1"),
        F.count("*").alias("num_models"),
    )
    return best.select(
        F.col("a.model").alias("best_accuracy_model"),
        F.coalesce("a.score", F.lit(-1.0)).alias("best_accuracy"),
        F.col("f.model").alias("best_f1_model"),
        F.coalesce("f.score", F.lit(-1.0)).alias("best_f1"),
        "avg_accuracy",
        "std_accuracy",
        "avg_f1",
        "std_f1",
        "num_models",
    )


def cv_summary(scores: DataFrame) -> DataFrame:
    """Fold scores -> mean, population std, min, max per model."""
    return scores.groupBy("model").agg(
        F.avg("score").alias("cv_mean"),
        F.stddev_pop("score").alias("cv_std"),
        F.min("score").alias("cv_min"),
        F.max("score").alias("cv_max"),
    )


def evaluate_classification(preds: DataFrame) -> dict[str, DataFrame]:
    """All parts of a classification report, each keyed by model."""
    parts = {
        "metrics": classification_metrics(preds),
        "per_class": per_class_report(preds),
        "confusion_matrix": confusion_matrix(preds),
        "distributions": distributions(preds),
    }
    if "prob" in preds.columns:
        parts["roc_auc"] = roc_auc(preds)
    return parts
