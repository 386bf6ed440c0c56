import pytest

from foliant.operators import metrics as M
from foliant.operators.ordered import running_totals


@pytest.fixture(scope="module")
def preds(spark):
    rows = [("m", i, t, p) for i, (t, p) in enumerate(zip([0, 0, 1, 1, 2], [0, 1, 1, 1, 1]))]
    return spark.createDataFrame(rows, "model string, row_id long, y_true int, y_pred int")


def test_classification_fixture(preds):
    row = M.classification_metrics(preds).first()
    got = [row.accuracy, row.precision_macro, row.recall_macro, row.f1_macro,
           row.precision_weighted, row.recall_weighted, row.f1_weighted]
    assert got == pytest.approx([0.6, 0.5, 0.5, 0.444444, 0.6, 0.6, 0.533333], abs=1e-5)
    cells = {(r.y_true, r.y_pred): r.n for r in M.confusion_matrix(preds).collect()}
    assert [[cells[i, j] for j in range(3)] for i in range(3)] == [[1, 1, 0], [0, 2, 0], [0, 1, 0]]


def test_agrees_with_mllib(spark, preds):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.sql import functions as F

    doubles = preds.select(F.col("y_true").cast("double"), F.col("y_pred").cast("double"))
    row = M.classification_metrics(preds).first()
    for ours, theirs in [("accuracy", "accuracy"), ("f1_weighted", "f1"),
                         ("precision_weighted", "weightedPrecision")]:
        ev = MulticlassClassificationEvaluator(
            labelCol="y_true", predictionCol="y_pred", metricName=theirs)
        assert row[ours] == pytest.approx(ev.evaluate(doubles))


def test_auc_fixture(spark):
    df = spark.createDataFrame(
        [("m", t, [1 - s, s]) for t, s in zip([0, 1, 0, 1], [0.1, 0.4, 0.4, 0.8])],
        "model string, y_true int, prob array<double>")
    assert M.roc_auc(df).first().roc_auc == pytest.approx(0.875)
    areas = {r.label: r.auc for r in M.curve_area(df).collect()}
    assert areas[1] == pytest.approx(0.875)
    points = sorted((r.fpr, r.tpr) for r in M.roc_points(df).filter("label = 1").collect())
    assert points == [(0, 0), (0, 0.5), (0.5, 1), (1, 1)]
    pr = sorted((r.recall, r.precision) for r in M.pr_points(df).filter("label = 1").collect())
    assert pr == [(0, 1), (0.5, 1), (1, 0.5), (1, pytest.approx(2 / 3))]
    one = df.filter("y_true = 1")
    assert M.roc_auc(one).count() == 0


@pytest.mark.parametrize("buckets", [2, 16, 512])
def test_running_totals_match_a_plain_loop(spark, buckets):
    rows = [("a" if i % 3 else "b", (i * 7919) % 1000 / 10.0, i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, x double, v long")
    got = running_totals(df, ["g"], "x", ["v"], buckets).collect()
    for g in "ab":
        mine, total = sorted(r for r in rows if r[0] == g), 0
        want = {}
        for _, x, v in mine:
            total += v
            want[x] = total
        assert {r.x: r.cum_v for r in got if r.g == g} == want


def test_best_model_ties_go_to_the_first(spark):
    df = spark.createDataFrame(
        [("b", 1, 0.5, 0.1, None), ("a", 0, 0.5, 0.1, None), ("x", 2, None, None, "boom")],
        "model string, run_order int, accuracy double, f1_weighted double, error string")
    row = M.compare_results(df).first()
    assert row.best_accuracy_model == "a" and row.num_models == 2 and row.std_f1 == 0
