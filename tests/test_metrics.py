import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.operators import metrics as V


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.random() < 0.3), float(round(rng.random(), 1)), "ab"[i % 2]) for i in range(400)]
    return spark.createDataFrame(rows, "id long, y int, s double, g string").repartition(6)


def brute_auc(pdf):
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    return ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean())


def test_auc_counts_pairs(scored):
    pdf = scored.toPandas()
    assert V.roc_auc(scored, "y", "s").first()[0] == pytest.approx(brute_auc(pdf))
    by = {r["g"]: r["roc_auc"] for r in V.roc_auc(scored, "y", "s", by=["g"]).collect()}
    assert by == {g: pytest.approx(brute_auc(pdf[pdf.g == g])) for g in "ab"}


def test_auc_of_one_class_is_null(scored):
    assert V.roc_auc(scored.filter("y = 1"), "y", "s").first()[0] is None


def test_regression_metrics(spark):
    df = spark.createDataFrame([(2.0, 1.0), (4.0, 5.0), (0.0, 1.0)], "y double, p double")
    got = V.evaluate(df, "y", "p", ["mse", "mae", "r2", "rmspe"]).first()
    assert got["mse"] == pytest.approx(1.0) and got["mae"] == pytest.approx(1.0)
    assert got["r2"] == pytest.approx(1 - 3 / 8)
    assert got["rmspe"] == pytest.approx(np.sqrt((0.25 + 0.0625) / 2))
    assert df.agg(V.rmspe("y", "p", zero="inf")).first()[0] == float("inf")


def test_confusion_matrix_fills_zeros(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "y int, p int")
    got = {(r["actual"], r["predicted"]): r["n"] for r in V.confusion_matrix(df, "y", "p").collect()}
    assert len(got) == 9 and got[(1, 0)] == 1 and got[(2, 2)] == 0


def test_report_with_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 0)], "y int, p int")
    got = {r["label"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert got["1"]["precision"] == 0.0 and got["1"]["recall"] == 0.0 and got["1"]["support"] == 2
    assert got["accuracy"]["f1"] == pytest.approx(1 / 3)
    assert got["weighted avg"]["recall"] == pytest.approx(1 / 3)


def test_scorer_signs_and_registration(spark):
    df = spark.createDataFrame([(2.0, 1.0)], "y double, p double")
    assert df.agg(V.scorer("mse")("y", "p")).first()[0] == -1.0
    V.register_metric("bias_for_test", lambda y, p: F.avg(F.col(p) - F.col(y)), False)
    assert V.evaluate(df, "y", "p", ["bias_for_test"]).first()[0] == -1.0
    with pytest.raises(ValueError):
        V.register_metric("mse", V.mse, False)
    del V.METRICS["bias_for_test"]


def test_compare_predictions(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, p double")
    assert V.compare_predictions(a, a, "id", "p").first()["identical"] is True
    b = spark.createDataFrame([(1, 1.0), (3, 2.0)], "id long, p double")
    got = V.compare_predictions(a, b, "id", "p").first()
    assert (got["n_both"], got["n_unmatched"], got["identical"]) == (1, 2, False)


def test_silhouette_matches_pairs(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (20, 2)), rng.normal(4, 1, (25, 2)), [[30.0, 30.0]]])
    c = np.array([0] * 20 + [1] * 25 + [2])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    want = []
    for i in range(len(x)):
        own = c == c[i]
        if own.sum() == 1:
            want.append(0.0)
            continue
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][c == k].mean() for k in set(c) - {c[i]})
        want.append((b - a) / max(a, b))
    df = spark.createDataFrame([(float(p), float(q), int(k)) for (p, q), k in zip(x, c)], "a double, b double, c int")
    assert V.silhouette(df, ["a", "b"], "c").first()[0] == pytest.approx(np.mean(want))
