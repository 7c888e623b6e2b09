import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.functions.moments import moments
from rowloom.models import linear, mlp, spark_ml
from rowloom.operators.split import holdout_split, kfold_shuffled
from rowloom.plans.credit import credit_default
from rowloom.plans.property import property_price
from rowloom.models.trees import boosted_trees, extra_trees_regress
from rowloom.search import candidates as H
from rowloom.search import cv


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("s"),
    )
    df = df.withColumn("y", 4 * F.col("a") + F.col("b") + 30).withColumn("k", (F.col("a") > 11).cast("int"))
    return kfold_shuffled(df, "id", 3).persist()


def test_grid_order_and_size(spark):
    grid = {"n": [1, 2, 3], "d": ["x", "y"]}
    got = H.param_grid(spark, grid).orderBy("candidate_id").collect()
    assert [r["candidate_id"] for r in got] == list(range(6))
    assert [dict(r["params"]) for r in got] == [{k: str(v) for k, v in c.items()} for c in H.grid_list(grid)]


def test_random_candidates(spark):
    assert H.random_candidates(spark, {"a": [1, 2]}, 10) == [{"a": 1}, {"a": 2}]
    some = H.random_candidates(spark, {"a": list(range(10)), "b": [1, 2, 3]}, 7)
    assert len(some) == 7 and len({tuple(c.items()) for c in some}) == 7
    drawn = H.random_candidates(spark, {"n": H.randint(5, 9), "u": H.uniform(0.1, 0.2), "c": ["x", "y"]}, 50)
    assert all(5 <= c["n"] < 9 and 0.1 <= c["u"] < 0.3 and c["c"] in "xy" for c in drawn)
    assert drawn == H.random_candidates(spark, {"n": H.randint(5, 9), "u": H.uniform(0.1, 0.2), "c": ["x", "y"]}, 50)


def test_logspace():
    assert H.logspace(-2, 1, 4) == pytest.approx([0.01, 0.1, 1.0, 10.0])


def test_ridge_grid_equals_the_fold_loop(rows):
    alphas = [0.5, 50.0]
    quick = {r["alpha"]: r["mean_score"] for r in cv.grid_search_ridge(rows, ["a", "b"], "y", alphas).collect()}
    fit = lambda d, alpha: linear.fit_ridge(moments(d, ["a", "b", "y"]), ["a", "b"], "y", alpha)
    slow = cv.search_cv(rows, fit, [{"alpha": a} for a in alphas], "y").orderBy("candidate_id").collect()
    assert [quick[a] for a in alphas] == pytest.approx([r["mean_score"] for r in slow])
    assert slow[0]["is_best"] and not slow[1]["is_best"]


def test_search_by_area_and_refit(rows):
    fit = lambda d, c: spark_ml.logistic_regression(d, ["a", "b"], "k", c=c)
    model, table = cv.search_and_refit(rows, fit, [{"c": 1e-6}, {"c": 1.0}], "k", "roc_auc")
    got = table.orderBy("candidate_id").collect()
    assert all(0.99 < r["mean_score"] <= 1.0 for r in got) and sum(r["is_best"] for r in got) == 1
    assert model.score(rows).filter("prediction = k").count() > 300
    both = cv.cv_score_table(rows, lambda d: fit(d, 1.0), "k", ("roc_auc", "accuracy"))
    assert set(both.columns) == {"fold", "roc_auc", "accuracy"} and both.count() == 3


def test_every_row_is_predicted_once(rows):
    fit = lambda d: linear.fit(d, ["a", "b"], "y")
    out = cv.cross_val_predict(rows, fit)
    assert out.count() == 600 and out.select("id").distinct().count() == 600
    assert cv.cv_score_table(rows, fit, "y").count() == 3


@pytest.mark.parametrize(
    "fit",
    [
        lambda d: linear.fit(d, ["a", "b"], "y"),
        lambda d: extra_trees_regress(d, ["a", "b"], "y", n_estimators=2, max_depth=4),
        lambda d: boosted_trees(d, ["b", "a"], "k", loss="logistic", n_estimators=2, max_depth=2),
        lambda d: mlp.fit_mlp(d, ["a", "b"], "y", hidden=(3,), max_iter=2),
        lambda d: spark_ml.decision_tree_regress(d, ["a", "b"], "y", max_depth=3),
    ],
)
def test_fold_models_score_like_one_by_one(rows, fit):
    """Null features and rows without a fold included; the scans of all but MLlib's models don't grow with the folds."""
    odd = rows.withColumn("fold", F.when(F.col("id") % 50 > 0, F.col("fold")))
    models = {f: fit(odd.filter(F.col("fold") != f)) for f in (0, 1, 2)}
    got = cv.score_by_fold(odd, models)
    options = {"probability": "p"} if getattr(models[0], "link", None) == "logistic" else {}
    got = cv.score_by_fold(odd, models, **options)
    want = [r for f, m in models.items() for r in m.score(odd.filter(F.col("fold") == f), **options).collect()]
    pick = lambda rs: sorted((r["id"], r["prediction"], r["p"] if options else 0) for r in rs)
    assert np.allclose(pick(got.collect()), pick(want), rtol=1e-12)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("Union" in plan) == isinstance(models[0], spark_ml.Fitted)


def test_resampling_stays_inside_the_training_folds(rows):
    seen = []
    cv.cross_val_predict(rows, lambda d: linear.fit(d, ["a"], "y"), resample=lambda d: (seen.append(d.count()), d)[1]).count()
    assert sum(seen) == 1200


def test_benchmark_refuses_repeated_names(rows):
    fit = lambda d, **p: linear.fit(d, ["a"], "y")
    with pytest.raises(ValueError):
        cv.benchmark_models(rows, rows, [("m", fit, {}), ("m", fit, {})], "y")


def test_benchmark_orders_by_score(rows):
    train, test = holdout_split(rows, "id", 0.3)
    zoo = [
        ("weak", lambda d, **p: linear.fit(d, ["b"], "y"), {}),
        ("strong", lambda d, **p: linear.fit(d, ["a", "b"], "y"), {}),
        ("tree", lambda d, **p: spark_ml.decision_tree_regress(d, ["a", "b"], "y", **p), {"max_depth": [1, 6]}),
    ]
    got = cv.benchmark_models(train, test, zoo, "y", n_iter=2).collect()
    assert [r["model"] for r in got][0] == "strong" and got[-1]["model"] == "weak"
    assert next(r for r in got if r["model"] == "tree")["best_params"] == "max_depth=6"


def test_credit_flow(rows):
    train, score = holdout_split(rows.select("id", "a", "b", "s", "k"), "id", 0.25, seed=1)
    score = score.drop("k").withColumn("b", F.when(F.col("id") % 4 > 0, F.col("b")))
    fit = lambda d, x, y: boosted_trees(d, x, y, loss="logistic", n_estimators=3, max_depth=3)
    result = credit_default(train, score, "id", "k", fit=fit)
    assert result.predictions.count() == score.count() and result.predictions.columns == ["id", "k"]
    report = {r["label"]: r for r in result.report.collect()}
    assert report["accuracy"]["f1"] > 0.95
    assert sum(r["n"] for r in result.confusion.collect()) == result.holdout.count()


def test_price_flow(rows):
    train, score = holdout_split(rows.select("id", "a", "b", "s", "y"), "id", 0.25, seed=1)
    fit = lambda d, x, y: extra_trees_regress(d, x, y, n_estimators=3, max_depth=5)
    result = property_price(train, score.drop("y"), "id", "y", {"y": (0.01, 0.99)}, component_trim=(0, 1), folds=2, fit=fit)
    assert result.predictions.count() == score.count()
    assert result.metrics.first()["rmse"] < 10 and result.folds.count() == 2


def test_elimination_by_boosting_is_the_same_in_tasks_and_over_the_cluster(spark, monkeypatch):
    from rowloom.models import boosting
    from rowloom.search.elimination import eliminate_by_boosting, elimination_report

    r = np.random.default_rng(5)
    x = r.normal(size=(900, 4)).round(3)
    y = (x[:, 2] + 0.4 * x[:, 0] + 0.3 * r.normal(size=900) > 0).astype(int)
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))] + [(900, None, 0.0, 0.0, 0.0, 1)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y int")
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    names = ["a", "b", "c", "d"]
    fit = lambda: eliminate_by_boosting(train, test, names, "y", n_estimators=8, max_depth=3, learning_rate=0.3)
    steps = fit().orderBy("k").collect()
    assert [s.k for s in steps] == [1, 2, 3, 4]
    assert steps[0].selected == "c" and steps[1].selected == "a,c" and steps[0].dropped is None and steps[1].dropped == "a"
    assert all(s.tn + s.fp + s.fn + s.tp == 225 for s in steps) and steps[1].tn + steps[1].tp > 180
    report = {(r.k, r.label): r for r in elimination_report(fit()).collect()}
    two = steps[1]
    assert len(report) == 8 and report[2, 1].support == two.tp + two.fn
    assert report[2, 1].precision == two.tp / (two.tp + two.fp) and report[2, 0].recall == two.tn / (two.tn + two.fp)
    assert report[2, 0].accuracy == (two.tn + two.tp) / 225
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    spread_out = fit().orderBy("k").collect()
    assert [(s.selected, s.dropped, s.tn, s.fp, s.fn, s.tp) for s in spread_out] == [(s.selected, s.dropped, s.tn, s.fp, s.fn, s.tp) for s in steps]
    with pytest.raises(ValueError):
        eliminate_by_boosting(train, test, names, "y", least=5)
