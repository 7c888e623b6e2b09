"""Planted signals, optimality conditions and closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.functions.moments import moments
from rowloom.functions.hashing import hash32, text_unit
from rowloom.models import adaboost, bayes, boosting, forests, kernel, linear, mlp, robust, spark_ml, trees
from rowloom.operators import reduce as D
from rowloom.operators import relevance
from rowloom.operators.metrics import evaluate, roc_auc

X = ["a", "b", "c"]


def build(spark, n=1500, outliers=0.0, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) + [1.0, 0.0, -2.0]
    y = 3 * x[:, 0] - 2 * x[:, 1] + 5 + 0.1 * rng.normal(size=n)
    bad = rng.random(n) < outliers
    y[bad] += 100 + 50 * rng.random(bad.sum())
    k = (x[:, 0] + x[:, 1] + 0.3 * rng.normal(size=n) > 1).astype(int)
    rows = [(i, *map(float, v), float(t), int(c)) for i, (v, t, c) in enumerate(zip(x, y, k))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, k int").repartition(5)


@pytest.fixture(scope="module")
def clean(spark):
    return build(spark).persist()


@pytest.fixture(scope="module")
def dirty(spark):
    return build(spark, outliers=0.2).persist()


def rmse(model, df):
    return evaluate(model.score(df), "y", "prediction", ["rmse"]).first()[0]


@pytest.mark.parametrize("method", ["least_squares", "ridge", "lars", "bayesian_ridge", "ard", "lasso", "elastic_net", "lasso_lars", "orthogonal_matching_pursuit"])
def test_linear_family_finds_the_plane(clean, method):
    extra = {"lasso": {"alpha": 0.001}, "elastic_net": {"alpha": 0.001}, "lasso_lars": {"alpha": 0.001}, "orthogonal_matching_pursuit": {"n_nonzero": 2}}
    m = linear.fit(clean, X, "y", method, **extra.get(method, {}))
    assert np.allclose(m.coefficients, [3, -2, 0], atol=0.03) and m.intercept == pytest.approx(5, abs=0.05)


def test_ridge_equals_the_normal_equations(clean):
    pdf = clean.toPandas()
    x, y = pdf[X].to_numpy(), pdf["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 50 * np.eye(3), xc.T @ yc)
    assert np.allclose(linear.fit(clean, X, "y", "ridge", alpha=50.0).coefficients, w)


def test_lasso_meets_its_optimality_conditions(clean):
    pdf = clean.toPandas()
    x, y = pdf[X].to_numpy(), pdf["y"].to_numpy()
    m = linear.fit(clean, X, "y", "lasso", alpha=0.5)
    g = (x - x.mean(0)).T @ (y - m.intercept - x @ m.coefficients) / len(y)
    for gi, w in zip(g, m.coefficients):
        assert (abs(gi) <= 0.5 + 1e-6) if w == 0 else gi == pytest.approx(0.5 * np.sign(w), abs=1e-6)


def test_holdout_error_from_moments(clean):
    m = moments(clean, [*X, "y"])
    model = linear.fit_ridge(m, X, "y", 10.0)
    assert linear.holdout_mse(model, m, "y") == pytest.approx(evaluate(model.score(clean), "y", "prediction", ["mse"]).first()[0])


def test_fits_do_not_depend_on_partitions(clean):
    a = linear.fit(clean.repartition(1), X, "y").coefficients
    assert np.allclose(a, linear.fit(clean.repartition(7), X, "y").coefficients, rtol=1e-12)


def test_robust_fits_ignore_gross_outliers(dirty):
    t = robust.fit_theil_sen(dirty, "id", X, "y", max_subpopulation=600)
    assert np.allclose(t.coefficients, [3, -2, 0], atol=0.5)
    for options in ({}, {"min_samples": 0.02}):
        r = robust.fit_ransac(dirty, "id", X, "y", residual_threshold=1.0, max_trials=60, **options)
        assert np.allclose(r.coefficients, [3, -2, 0], atol=0.05)
    h = linear.fit_huber(dirty, X, "y")
    assert np.allclose(h.coefficients, [3, -2, 0], atol=0.2)


def test_spatial_median_minimises_distances():
    p = np.random.default_rng(0).normal(size=(200, 3))
    c = robust.spatial_median(p)
    cost = lambda q: np.linalg.norm(p - q, axis=1).sum()
    assert all(cost(c) <= cost(c + 1e-3 * d) for d in np.vstack([np.eye(3), -np.eye(3)]))


def test_large_subsets_resist_outliers(dirty):
    for n in (8, 25):
        t = robust.fit_theil_sen(build(dirty.sparkSession, outliers=0.02), "id", X, "y", max_subpopulation=400, n_subsamples=n)
        assert np.allclose(t.coefficients, [3, -2, 0], atol=0.5)


def test_scattered_is_a_permutation():
    for n in (1, 2, 5, 64, 1000, 1025):
        orders = [robust.scattered(np.arange(n), n, salt) for salt in range(4)]
        assert all(sorted(o) == list(range(n)) for o in orders)
        assert list(orders[0]) == list(range(n))
    assert not np.array_equal(orders[1], orders[2])


@pytest.mark.parametrize("intercept", [True, False])
def test_large_subset_fits_equal_fits_of_their_rows(clean, intercept, monkeypatch):
    """Some subsets come from permuted ranks and from several passes."""
    monkeypatch.setattr(robust, "CROSS_PRODUCTS", 100)
    got = robust.large_subset_fits(clean, "id", X, "y", 9, 400, intercept=intercept)
    pdf = clean.withColumn("h", robust.hash32("id", 42)).toPandas()
    pdf["key"] = pdf["id"].astype(str)
    pdf = pdf.sort_values(["h", "key"])
    x, y = robust._design(pdf[X].to_numpy(), intercept), pdf["y"].to_numpy()
    for s in range(9):
        place = robust.scattered(np.arange(len(pdf)), len(pdf), s // 3)
        mine = (place < 1200) & (place // 400 == s % 3)
        assert mine.sum() == 400
        w = np.linalg.lstsq(x[mine], y[mine], rcond=None)[0]
        assert np.allclose(got[s], w if intercept else np.append(w, 0), atol=1e-8)


def test_theil_sen_without_intercept(clean):
    through = clean.withColumn("y", 3 * F.col("a") - 2 * F.col("b"))
    for n in (None, 20):
        t = robust.fit_theil_sen(through, "id", X, "y", max_subpopulation=300, n_subsamples=n, intercept=False)
        assert np.allclose(t.coefficients, [3, -2, 0], atol=1e-6) and t.intercept == 0
    with pytest.raises(ValueError):
        robust.fit_theil_sen(through, "id", X, "y", n_subsamples=2)


def test_online_regression(clean):
    model = linear.fit_passive_aggressive(clean, X, "y", c=0.05)
    assert rmse(model, clean) < 0.5 and model.converged and model.passes < 1000


@pytest.mark.parametrize("intercept", [True, False])
def test_online_pass_equals_the_rule_row_by_row(intercept):
    rng = np.random.default_rng(3)
    block = np.column_stack([rng.normal(size=(700, 2)), rng.normal(size=700)])
    block[5, :2] = 0
    w, b, loss = linear._passive_aggressive_pass(block, np.zeros(2), 0.0, 0.3, 0.2, intercept)
    v, bias, total = np.zeros(2), 0.0, 0.0
    for *x, y in block:
        x = np.array(x)
        error = y - v @ x - bias
        miss = max(abs(error) - 0.2, 0)
        total += miss
        if miss > 0 and x @ x > 0:
            step = min(0.3, miss / (x @ x)) * np.sign(error)
            v, bias = v + step * x, bias + step * intercept
    assert np.allclose(w, v) and b == pytest.approx(bias) and loss == pytest.approx(total)


def test_passes_do_not_depend_on_partitions(clean):
    odd = clean.withColumn("a", F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("a")))
    again = odd.union(odd.filter("id < 300")).union(odd.filter("id < 5").withColumn("y", F.lit(None).cast("double")))
    for fit in (
        lambda d: linear.fit_passive_aggressive(d, X, "y", max_iter=3, shard_rows=20).coefficients,
        lambda d: mlp.fit_mlp(d, X, "y", hidden=(4,), max_iter=3, shard_rows=20, batch_size=7).flat,
    ):
        assert np.array_equal(fit(again.repartition(1)), fit(again.repartition(7)))


def test_fits_on_an_empty_table_say_so(clean):
    for fit in (linear.fit_passive_aggressive, mlp.fit_mlp):
        with pytest.raises(ValueError):
            fit(clean.filter("id < 0"), X, "y")


def test_mlp_gradient_equals_differences():
    rng = np.random.default_rng(1)
    z = rng.normal(size=(30, 4))
    for activation in ("identity", "logistic", "tanh"):
        sizes = [3, 4, 2, 1]
        flat = mlp.initial_weights(sizes, activation, 5)
        gradient, _ = mlp._gradient(z, flat, sizes, activation)
        for i in range(len(flat)):
            step = 1e-6 * np.eye(len(flat))[i]
            up, down = (mlp._gradient(z, flat + d, sizes, activation)[1] / 2 for d in (step, -step))
            assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-4)


@pytest.mark.parametrize(
    "options",
    [
        {"solver": "sgd", "learning_rate": 0.01},
        {"solver": "sgd", "learning_rate": 0.05, "schedule": "invscaling", "power_t": 0.1, "nesterov": False},
        {"solver": "sgd", "learning_rate": 0.02, "schedule": "adaptive", "n_iter_no_change": 2},
        {"learning_rate": 0.02, "early_stopping": True},
    ],
)
def test_mlp_schedules(clean, options):
    scaled = clean.withColumn("y", F.col("y") / 4)
    model = mlp.fit_mlp(scaled, X, "y", hidden=(8,), activation="tanh", batch_size=50, max_iter=40, **options)
    assert rmse(model, scaled) < 0.3 and model.loss_curve[-1] < model.loss_curve[0] / 3


def test_scale_gamma(clean):
    x = clean.select(*X).toPandas().to_numpy()
    assert kernel.scale_gamma(clean, X) == pytest.approx(1 / (3 * x.var()))
    assert evaluate(kernel.kernel_svc(clean, "id", X, "k", gamma="scale").score(clean), "k", "prediction", ["accuracy"]).first()[0] > 0.85


def test_logistic_gradient_vanishes(clean):
    m = spark_ml.logistic_regression(clean, X, "k", c=2.0, tol=1e-10)
    pdf = clean.toPandas()
    w, b = m.model.coefficients.toArray(), m.model.intercept
    x = pdf[X].to_numpy()
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(x.T @ (p - pdf["k"]) + w / 2.0, 0, atol=0.05)


@pytest.mark.parametrize(
    "fit",
    [
        lambda d: spark_ml.linear_svc(d, X, "k"),
        lambda d: spark_ml.random_forest_classify(d, X, "k", n_estimators=10, max_depth=5),
        lambda d: trees.boosted_trees(d, X, "k", loss="logistic", n_estimators=8, max_depth=3),
        lambda d: spark_ml.gradient_boosting_classify(d, X, "k", n_estimators=5),
        lambda d: kernel.kernel_svc(d, "id", X, "k", landmarks=30),
    ],
)
def test_classifiers_separate(clean, fit):
    scored = fit(clean).score(clean)
    assert evaluate(scored, "k", "prediction", ["accuracy"]).first()[0] > 0.85


def test_adaboost_and_bayes_classify(clean):
    m = adaboost.adaboost_classify(clean, X, "k", n_estimators=5, max_depth=2)
    assert evaluate(m.score(clean), "k", "prediction", ["accuracy"]).first()[0] > 0.8
    scored = bayes.fit_gaussian_nb(clean, X, "k").score(clean, probability="p")
    assert roc_auc(scored, "k", "p").first()[0] > 0.9


@pytest.mark.parametrize(
    "fit, limit",
    [
        (lambda d: trees.extra_trees_regress(d, X, "y", n_estimators=10, max_depth=10), 1.0),
        (lambda d: trees.boosted_trees(d, X, "y", n_estimators=15, max_depth=4, key="id", subsample=0.8, colsample=0.7), 1.0),
        (lambda d: trees.hist_gradient_boosting(d, X, "y", max_iter=10, learning_rate=0.3, max_depth=4), 1.0),
        (lambda d: adaboost.adaboost_regress(d, X, "y", n_estimators=4, max_depth=5), 1.2),
        (lambda d: kernel.kernel_ridge(d, "id", X, "y", alpha=0.1, kernel="polynomial", degree=2, landmarks=30), 0.3),
        (lambda d: kernel.linear_svr(d, X, "y", c=10.0, epsilon=0.05), 0.2),
        (lambda d: mlp.fit_mlp(d, X, "y", hidden=(16,), learning_rate=0.02, max_iter=40), 1.0),
    ],
)
def test_regressors_fit(clean, fit, limit):
    assert rmse(fit(clean), clean) < limit


def test_huber_boosting_resists_outliers(dirty, clean):
    m = trees.huber_boosting(dirty, X, "y", n_estimators=12, learning_rate=0.4, alpha=0.75)
    assert rmse(m, clean) < 6


def test_margins_written_mid_way_change_nothing(clean, monkeypatch):
    options = dict(n_estimators=6, max_depth=2, max_bins=16)
    a = trees.boosted_trees(clean, X, "y", **options).table(clean.sparkSession).collect()
    monkeypatch.setattr(trees, "MARGIN_EVERY", 2)
    b = trees.boosted_trees(clean, X, "y", **options).table(clean.sparkSession).collect()
    for r, s in zip(a, b):
        assert r[:3] == s[:3] and r["value"] == pytest.approx(s["value"], abs=1e-9)


def test_leaf_limits(clean):
    forest = trees.extra_trees_regress(clean, X, "y", n_estimators=3, max_depth=8, min_samples_leaf=100)
    for t in forest.trees:
        x = clean.toPandas()[X].to_numpy()
        leaves = trees._walk(t, x)
        assert np.bincount(leaves)[np.unique(leaves)].min() >= 100


def test_pca_properties(clean):
    p = D.pca_fit(clean, X, k=3)
    assert np.allclose(p.loadings @ p.loadings.T, np.eye(3), atol=1e-10)
    z = p.transform(clean, keep=[]).toPandas().to_numpy()
    assert np.allclose(np.cov(z.T), np.diag(p.variances), atol=1e-8)
    assert D.pca_fit(clean, X, share=0.5).k <= 3


def test_wide_projection_equals_expressions(clean, monkeypatch):
    p = D.pca_fit(clean, X, k=2)
    a = p.transform(clean, keep=["id"]).orderBy("id").toPandas()
    monkeypatch.setattr(D, "WIDE_PROJECTION", 0)
    assert np.allclose(a, p.transform(clean, keep=["id"]).orderBy("id").toPandas(), atol=1e-12)


def test_ica_unmixes(spark):
    rng = np.random.default_rng(2)
    s = np.column_stack([rng.uniform(-1, 1, 4000), np.sign(rng.normal(size=4000)) * rng.exponential(size=4000)])
    x = s @ np.array([[1.0, 0.5], [0.3, 2.0]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "p double, q double")
    z = D.fast_ica(df, ["p", "q"], 2).transform(df, keep=[]).toPandas().to_numpy()
    c = np.abs(np.corrcoef(np.column_stack([z, s]).T)[:2, 2:])
    assert sorted(c.max(axis=1))[0] > 0.98


def test_lda_separates(clean):
    z = D.lda_projection(clean, X, "k").transform(clean, keep=["k"])
    area = roc_auc(z, "k", "PC1").first()[0]
    assert max(area, 1 - area) > 0.95


def test_rfe_keeps_the_strong_columns(clean):
    ranks = {r["column_name"]: r["rank"] for r in relevance.rfe(clean, X, "y").collect()}
    assert ranks == {"a": 1, "b": 2, "c": 3}


def test_null_rows_do_not_enter_fits(clean):
    gap = clean.withColumn("a", F.when(F.col("id") % 10 > 0, F.col("a")))
    m = linear.fit(gap, X, "y")
    assert np.allclose(m.coefficients, [3, -2, 0], atol=0.03)


def test_refusals_and_features(clean):
    with pytest.raises(ValueError):
        spark_ml.decision_tree_regress(clean, X, "y", max_depth=40)
    with pytest.raises(ValueError):
        spark_ml.logistic_regression(clean, X, "k", penalty="elasticnet")
    with pytest.raises(ValueError):
        spark_ml.logistic_regression(clean, X, "k", penalty="l3")
    free = spark_ml.logistic_regression(clean, X, "k", c=0.01, penalty="none").model.coefficients.toArray()
    tied = spark_ml.logistic_regression(clean, X, "k", c=0.01, penalty="elasticnet", l1_ratio=0.5).model.coefficients.toArray()
    assert np.abs(free).sum() > np.abs(tied).sum()
    forest = trees.extra_trees_regress(clean.limit(200), X, "y", n_estimators=2, max_depth=None, max_features="sqrt")
    assert max(len(t[0]) for t in forest.trees) > 100
    few = clean.limit(12)
    fits = robust.every_subset_fit(few, X, "y", len(X) + 1)
    assert len(fits) == __import__("math").comb(12, len(X) + 1)


def _same_trees(a, b):
    for s, t in zip(a, b):
        assert list(s.feature) == list(t.feature) and list(s.left) == list(t.left)
        assert np.allclose(s.value, t.value, atol=1e-9) and np.allclose(s.threshold, t.threshold)


def test_boosting_in_a_task_equals_passes(clean, monkeypatch):
    rows = clean.withColumn("fold", (F.col("id") % 3).cast("int"))
    jobs = [boosting.Options(n_estimators=n, max_depth=3, learning_rate=0.3, held=h, subsample=0.9) for n, h in ((4, 0), (6, 1), (6, None))]
    run = lambda scored: boosting.boost_many(rows, X, "y", jobs, trees.Tree, "id", "fold", 16, scored=scored)
    near, scored_near = run(False)[0], run(True)[3].toPandas()
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    monkeypatch.setattr(boosting, "MARGIN_EVERY", 3)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    far, _, bases, scored_far = run(True)
    for a, b in zip(near, far):
        _same_trees(a.trees, b.trees)
    order = ["job", "y", "margin"]
    a, b = (d.sort_values(order).reset_index(drop=True) for d in (scored_near, scored_far.toPandas()))
    assert len(a) == rows.filter("fold < 2").count() and np.allclose(a["margin"], b["margin"])
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)  # partial sums meet on the cluster
    monkeypatch.setattr(boosting, "MAX_CELLS", 100)  # several passes a level
    for a, b in zip(near, run(False)[0]):
        _same_trees(a.trees, b.trees)


def test_drawn_rounds_train_on_counted_rows(spark, monkeypatch):
    rows = spark.range(3000).select(
        "id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 31 % 11).cast("double").alias("b"), (F.col("id") % 2).cast("int").alias("fold"),
        (F.col("id") % 7 * 3 + F.sin("id")).alias("y"), (F.col("id") % 7 + F.sin("id") > 3).cast("int").alias("k"),
    )
    passed, drawn = [], boosting.Binned._drawn
    monkeypatch.setattr(boosting.Binned, "_drawn", lambda self, *a: passed.append(drawn(self, *a)) or passed[-1])
    for target, loss in (("y", "squared"), ("k", "logistic")):
        jobs = [boosting.Options(loss, n_estimators=n, max_depth=3, held=h, subsample=0.6, colsample=0.5) for n, h in ((3, None), (2, 1))]
        run = lambda: boosting.boost_many(rows, ["a", "b"], target, jobs, trees.Tree, "id", "fold", 16)[0]
        with monkeypatch.context() as m:
            m.setattr(boosting, "DRAWN_BYTES", 0)  # every row by itself
            whole = run()
            assert not passed
        for name, value in ((None, None), ("DRAWN_BYTES", 16 * 200), ("DRAWN_ROWS", 100), ("TASK_BYTES", 0)):
            with monkeypatch.context() as m:
                if name:
                    m.setattr(boosting, name, value)
                for a, b in zip(whole, run(), strict=True):
                    _same_trees(a.trees, b.trees)
                assert passed.pop()[1] == 154
        assert not passed


def test_held_rows_get_the_margins_of_a_model_without_them(clean):
    rows = clean.withColumn("fold", (F.col("id") % 2).cast("int"))
    held = boosting.boost_many(rows, X, "y", boosting.candidates_by_fold([{"n_estimators": 3}, {"n_estimators": 5}], [0, 1], max_depth=2), trees.Tree, None, "fold", 8, scored=True)[3]
    for job, n, f in ((0, 3, 0), (3, 5, 1)):
        got = sorted(r.margin for r in held.filter(f"job = {job}").collect())
        assert len(got) == rows.filter(f"fold = {f}").count() and held.filter(f"job = {job} and fold <> {f}").count() == 0
        _, _, (base,), _ = boosting.boost_many(rows, X, "y", [boosting.Options(n_estimators=n, max_depth=2, held=f)], trees.Tree, None, "fold", 8)
        assert abs(np.mean(got) - base) < 5


def test_sketched_edges_rank_error(spark):
    n, bins = 40_000, 32
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v"), (F.col("id") % 3).cast("double").alias("few"))
    many, few = boosting.sketched_edges(df, ["v", "few"], bins)
    want = np.arange(1, bins) / bins * n
    assert np.abs(many - want).max() <= n / 10_000 + 1
    assert few.tolist() == [0.0, 1.0, 2.0]


def test_nodes_finished_in_tasks_equal_whole_trees(clean, monkeypatch):
    options = dict(n_estimators=3, max_depth=None, min_samples_split=4, min_samples_leaf=3, max_features=2)
    x = clean.toPandas()[X].to_numpy()
    whole = trees.extra_trees_regress(clean, X, "y", **options)
    monkeypatch.setattr(forests, "TASK_BYTES", clean.count() * 40 // 5)
    upper = trees.extra_trees_regress(clean, X, "y", **options)
    for a, b in zip(whole.trees, upper.trees):
        assert len(a[0]) == len(b[0]) and np.allclose(a[4][trees._walk(a, x)], b[4][trees._walk(b, x)])
    with pytest.raises(ValueError):
        trees.decision_tree(clean, X, "y")


def test_exact_cuts_found_on_the_cluster_equal_those_of_a_task(clean, monkeypatch):
    pdf = clean.withColumn("h", hash32("id").cast("double")).toPandas()
    x, hashes = pdf[X].to_numpy(), pdf["h"].to_numpy()
    options = dict(min_samples_split=4, min_samples_leaf=3, max_features=2)
    fits = [
        lambda: trees.decision_tree(clean, X, "y", max_depth=2, large=True),
        lambda: trees.decision_tree(clean, X, "y", **options, large=True),
        lambda: trees.random_forest(clean, X, "y", "id", n_estimators=3, **options, large=True),
    ]
    whole = [fit() for fit in fits]
    monkeypatch.setattr(forests, "TASK_BYTES", clean.count() * 40 // 5)
    monkeypatch.setattr(forests, "SORTED_ROWS", 150)
    for a, fit in zip(whole, fits):
        b = fit()
        assert np.allclose(a.importances, b.importances, atol=1e-3)  # features that part a node's rows alike may change places
        for i, (s, t) in enumerate(zip(a.trees, b.trees)):
            bag = forests._weights(forests.Growth(None, 4, 3, 2, 42, True, True), i, hashes) > 0 if len(a.trees) > 1 else hashes >= 0
            assert len(s[0]) == len(t[0]) and np.allclose(s[4][trees._walk(s, x[bag])], t[4][trees._walk(t, x[bag])])


def test_forests_on_the_cluster_score_as_on_the_driver(clean, monkeypatch):
    fits = [
        lambda: trees.extra_trees_regress(clean, X, "y", n_estimators=3, max_depth=6, min_samples_leaf=3),
        lambda: trees.random_forest(clean, X, "y", "id", n_estimators=3, min_samples_leaf=3, large=True),
    ]
    asked = clean.select("id", "y", *[F.when(F.col("id") % 10 != 0, F.col(c)).alias(c) for c in X])
    for limit, fit in zip((forests.TASK_BYTES, clean.count() * 40 // 5), fits):
        monkeypatch.setattr(forests, "TASK_BYTES", limit)
        monkeypatch.setattr(trees, "DRIVER_NODES", 2_000_000)
        near = fit()
        monkeypatch.setattr(trees, "DRIVER_NODES", 0)
        far = fit()
        assert isinstance(far, trees.SpreadForest) and np.allclose(near.importances, far.importances)
        a, b = (m.score(asked).select("id", "y", "prediction").orderBy("id").toPandas() for m in (near, far))
        assert np.allclose(a, b)
        a, b = (m.table(clean.sparkSession).orderBy("tree", "node").toPandas() for m in (near, far))
        assert len(a) == len(b) and (a["feature"] == b["feature"]).all() and (a["left"] == b["left"]).all()


def test_sweep_over_shared_trees_equals_a_forest_for_each_candidate(clean, monkeypatch):
    held = clean.filter("id % 5 = 0")
    grid = [
        {"max_depth": d, "min_samples_split": s, "min_samples_leaf": leaf, "n_estimators": e}
        for d, s, leaf, e in ((1, 2, 3, 2), (4, 2, 3, 2), (None, 2, 3, 2), (6, 40, 3, 1), (None, 300, 3, 2), (None, 2, 40, 2))
    ]
    run = lambda: trees.sweep_forests(clean, held, X, "y", grid).orderBy("candidate", "y").toPandas()
    near = run()
    monkeypatch.setattr(forests, "TASK_BYTES", clean.count() * 40 // 5)
    far = run()
    assert len(near) == len(grid) * held.count() and (near["candidate"] == far["candidate"]).all()
    assert np.allclose(near["y"], far["y"]) and np.allclose(near["prediction"], far["prediction"])


def test_exact_tree_equals_brute_force(clean):
    pdf = clean.toPandas()
    x, y = pdf[X].to_numpy(float), pdf["y"].to_numpy(float)

    def best(rows):
        found = (0.0, None)
        for j in range(x.shape[1]):
            for v in np.unique(x[rows, j])[:-1]:
                a, b = y[rows][x[rows, j] <= v], y[rows][x[rows, j] > v]
                if min(len(a), len(b)) >= 5:
                    gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - y[rows].sum() ** 2 / len(rows)
                    if gain > found[0] + 1e-9:
                        found = gain, x[rows, j] <= v
        return found[1]

    rows = np.arange(len(y))[:150]
    tree = trees.decision_tree(clean.sparkSession.createDataFrame(pdf.iloc[:150]), X, "y", max_depth=2, min_samples_leaf=5).trees[0]
    got = tree[4][trees._walk(tree, x[rows])]
    left = best(rows)
    for side in (rows[left], rows[~left]):
        cut = best(side)
        for part in (side[cut], side[~cut]):
            assert np.allclose(got[part], y[part].mean())


def test_bootstrap_counts_and_pure_leaves(clean):
    growth = forests.Growth(None, 2, 1, 3, 1, best=True, bootstrap=True)
    w = forests._weights(growth, 0, np.arange(20_000.0))
    assert abs(w.mean() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.02
    assert (w != forests._weights(growth, 1, np.arange(20_000.0))).any()
    assert rmse(trees.decision_tree(clean, X, "y"), clean) < 1e-6  # no limit: every row has its own leaf
    assert rmse(trees.random_forest(clean, X, "y", "id", n_estimators=10), clean) < 1.5


@pytest.mark.parametrize("loss", ["squared", "logistic"])
def test_boosting_of_counted_rows_equals_boosting_of_rows(spark, monkeypatch, loss):
    """Few bins: equal rows of bins are trained on as one, and however many rows there are, one task can hold them."""
    rows = spark.range(4_000).select(
        "id", (F.col("id") % 5).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 3).cast("int").alias("fold"),
        ((F.col("id") * 37 % 11 < F.col("id") % 5 + F.col("id") % 7).cast("double") if loss == "logistic" else F.col("id") % 35 + F.col("id") % 13 / 8.0).alias("y"),
    )
    jobs = [boosting.Options(loss, n_estimators=n, max_depth=3, learning_rate=0.3, held=h) for n, h in ((3, 0), (5, 1), (5, None))]
    sent, packed = [], boosting._packed
    monkeypatch.setattr(boosting, "_packed", lambda table, *a: sent.append(table.count()) or packed(table, *a))

    def run(scored):
        models, _, _, held = boosting.boost_many(rows, ["a", "b"], "y", jobs, trees.Tree, None, "fold", 16, scored=scored)
        return models, held.toPandas().sort_values(["job", "y", "margin"]).reset_index(drop=True) if scored else None

    got, held = run(False)[0], run(True)[1]
    assert sent[0] == 105 and (105 < sent[1] <= 210 if loss == "logistic" else sent[1] == 4_000)
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    monkeypatch.setattr(boosting, "MARGIN_EVERY", 2)
    far, far_held = run(False)[0], run(True)[1]
    monkeypatch.setattr(boosting.Binned, "_merged", lambda self, *_: (self.table, self.edges, 4_000))
    want, want_held = run(False)[0], run(True)[1]
    for a, b, c in zip(got, far, want):
        _same_trees(a.trees, c.trees)
        _same_trees(b.trees, c.trees)
    for h in (held, far_held):
        assert len(h) == len(want_held) and np.allclose(h[["job", "fold", "y", "margin"]], want_held[["job", "fold", "y", "margin"]])


def test_kernel_svc_keeps_no_mapped_columns(clean, monkeypatch):
    """The mapped columns are many times as wide as the table: only its own are kept."""
    kept, settle = [], kernel.settle
    monkeypatch.setattr(kernel, "settle", lambda d: kept.append(d.columns) or settle(d))
    m = kernel.kernel_svc(clean, "id", X, "k", gamma="scale", landmarks=12, max_iter=3)
    assert kept == [[*X, "k"]] and m.score(clean).count() == clean.count()


def _simple_tree(x, y, w, growth, tree, label="0", depth=0):
    """A nested (feature, threshold, left, right) or a leaf's mean, node by node in plain loops."""
    n, total = w.sum(), (w * y).sum()
    lo, hi = x.min(axis=0), x.max(axis=0)
    if not forests.may_split(growth, depth, n, total, (w * y * y).sum()) or not (hi > lo).any():
        return total / n
    tried = forests.chosen_features(growth, tree, [label], (hi > lo)[None])[0]
    best = (-np.inf, None, None)
    for j in np.flatnonzero(tried):
        values = np.unique(x[:, j])
        drawn = text_unit(f"{growth.seed}:{tree}:{label}:{j}")
        cuts = (values[1:] + values[:-1]) / 2 if growth.best else [lo[j] + drawn * (hi[j] - lo[j])]
        for cut in cuts:
            left = x[:, j] <= cut
            nl, sl = w[left].sum(), (w * y)[left].sum()
            if min(nl, n - nl) >= growth.min_samples_leaf and (g := sl**2 / nl + (total - sl) ** 2 / (n - nl)) > best[0] * (1 + 1e-12):
                best = (g, j, cut)
    if best[1] is None:
        return total / n
    left = x[:, best[1]] <= best[2]
    halves = [_simple_tree(x[s], y[s], w[s], growth, tree, label + b, depth + 1) for s, b in ((left, "0"), (~left, "1"))]
    return (best[1], best[2], *halves)


@pytest.mark.parametrize("best", [False, True])
@pytest.mark.parametrize("bootstrap", [False, True])
@pytest.mark.parametrize("cache", [1, 300, 1 << 16])
def test_trees_grown_in_pieces_equal_simple_ones(monkeypatch, best, bootstrap, cache):
    """Rows of neighbouring nodes are taken to the leaves together; the trees and the numbers of their nodes don't depend on it."""
    monkeypatch.setattr(forests, "CACHE_ROWS", cache)
    r = np.random.default_rng(3)
    x = np.column_stack([r.normal(size=700), r.integers(0, 6, 700), r.integers(0, 40, 700)]).astype(float)
    y = x[:, 0] ** 2 + x[:, 1] + r.normal(size=700) * 0.1
    growth = forests.Growth(9, 8, 3, 2, 42, best, bootstrap)
    w = forests._weights(growth, 5, r.integers(0, 2**32, 700).astype(float))
    feature, threshold, left, right, value, gains, sizes = forests.grow(x, y, growth, 5, weight=w)
    w = np.ones(700) if w is None else w

    def same(node, simple):
        if not isinstance(simple, tuple):
            assert feature[node] == -1 and left[node] == -1 and value[node] == pytest.approx(simple)
            return 1
        assert (feature[node], threshold[node]) == (simple[0], pytest.approx(simple[1])) and right[node] == left[node] + 1
        assert sizes[node] == sizes[left[node]] + sizes[right[node]]
        return 1 + same(left[node], simple[2]) + same(right[node], simple[3])

    assert same(0, _simple_tree(x[w > 0], y[w > 0], w[w > 0], growth, 5)) == len(feature) > 50
    inner = feature >= 0
    assert (left[inner] == 1 + 2 * np.arange(inner.sum())).all()  # level by level
    assert gains.sum() > 0 and sizes[0] == w.sum()


def test_few_trees_travel_at_a_time(clean, monkeypatch):
    """Rows of all trees at once would fill the disks with as many copies of the table."""
    fit = lambda: trees.random_forest(clean, X, "y", "id", n_estimators=5, min_samples_leaf=3, large=True)
    monkeypatch.setattr(forests, "TASK_BYTES", clean.count() * 40 // 4)
    monkeypatch.setattr(trees, "DRIVER_NODES", 0)
    together, lists = forests._together, []
    monkeypatch.setattr(forests, "_together", lambda *a: lists.append(together(*a)) or lists[-1])
    whole = fit()
    want = whole.score(clean).select("id", "prediction").orderBy("id").toPandas()
    assert lists == [[[0, 1, 2, 3, 4]]] * 2
    monkeypatch.setattr(forests, "DEALT_BYTES", clean.count() * 40 * 2)
    lists.clear()
    some = fit()
    got = some.score(clean).select("id", "prediction").orderBy("id").toPandas()
    assert lists[0] == [[0, 1], [2, 3], [4]] and all(len(v) < 5 for v in lists[1]) and [s for s, _ in some.parts] == lists[0]
    assert np.allclose(got, want) and np.allclose(some.importances, whole.importances)  # rows are added up in any order


def test_kernel_svc_takes_the_steps_of_mllib(clean):
    """Weights, not only classes, agree with MLlib's on the mapped columns."""
    k = kernel.KernelMap(clean, "id", X, gamma="scale", landmarks=12)
    for steps in (1, 4, 30):
        want = spark_ml.linear_svc(k.add(clean), k.columns, "k", 2.0, steps).model
        got = kernel.kernel_svc(clean, "id", X, "k", 2.0, steps, gamma="scale", landmarks=12).inner
        assert np.allclose(got.coefficients, want.coefficients.toArray(), rtol=1e-5, atol=1e-6)
        assert got.intercept == pytest.approx(want.intercept, rel=1e-5, abs=1e-6)
    with pytest.raises(ValueError):
        kernel.kernel_svc(clean.withColumn("k", F.lit(2)), "id", X, "k", landmarks=12)


@pytest.mark.parametrize("fit", [kernel.kernel_svc, kernel.kernel_svr])
def test_kernel_fits_keep_no_mapped_columns_anywhere(clean, monkeypatch, fit):
    """Neither the fit itself nor MLlib below it writes rows many times as wide as the table."""
    frame = type(clean)
    kept, persist = [], frame.persist
    monkeypatch.setattr(frame, "persist", lambda d, *a, **b: kept.append(d.columns) or persist(d, *a, **b))
    monkeypatch.setattr(spark_ml.LinearSVC, "fit", lambda *a: pytest.fail("keeps its vectors"))
    m = fit(clean, "id", X, "k", gamma="scale", landmarks=12, max_iter=3)
    assert kept and all(columns == [*X, "k"] for columns in kept) and m.score(clean).count() == clean.count()


def test_kernel_svr_equals_a_fit_on_the_mapped_columns(clean):
    k = kernel.KernelMap(clean, "id", X, gamma="scale", landmarks=12)
    for steps in (1, 3):
        want = kernel.linear_svr(k.add(clean), k.columns, "y", 2.0, 0.05, steps)
        got = kernel.kernel_svr(clean, "id", X, "y", 2.0, 0.05, steps, gamma="scale", landmarks=12)
        assert np.allclose(got.inner.coefficients, want.coefficients, rtol=1e-5, atol=1e-7)
    a = got.score(clean).select("id", "prediction").orderBy("id").toPandas()
    b = want.score(k.add(clean)).select("id", "prediction").orderBy("id").toPandas()
    assert np.allclose(a, b, rtol=1e-5, atol=1e-7)


def test_forest_of_many_trees_votes_as_one(clean):
    """More trees than are grown together: all of them vote, by the shares of their leaves."""
    m = spark_ml.random_forest_classify(clean, X, "k", n_estimators=25, max_depth=6)
    assert [f.model.getNumTrees for f in m.forests] == [10, 10, 5] and m.importances.sum() == pytest.approx(1)
    held = clean.withColumn("a", F.when(F.col("id") % 9 != 0, F.col("a"))) if "a" in X else clean
    got = m.score(held, probability="p").select("id", "prediction", "p").orderBy("id").toPandas()
    raw = [f.model.transform(spark_ml.assemble(held, X)).select("id", F.col("_raw")).orderBy("id").toPandas() for f in m.forests]
    votes = sum(np.array([v.toArray() for v in r["_raw"]]) for r in raw)
    assert (got["id"] == raw[0]["id"]).all() and np.allclose(got["p"], votes[:, 1] / 25) and (got["prediction"] == votes.argmax(axis=1)).all()
    assert set(m.score(clean).columns) == {*clean.columns, "prediction"}


def test_registered_forest_grows_a_hundred_deep_trees(spark, monkeypatch):
    from catalog import ensembles

    asked, fit = [], spark_ml.RandomForestClassifier
    monkeypatch.setattr(spark_ml, "RandomForestClassifier", lambda **o: asked.append((o["numTrees"], o["maxDepth"])) or fit(**{**o, "numTrees": 1, "maxDepth": 2}))
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), *[F.rand(i).alias(c) for i, c in enumerate("abc")]).withColumn("y", (F.col("a") > 0.5).cast("int"))
    monkeypatch.setattr(ensembles, "fx_bin", lambda *_: rows)
    assert ensembles.random_forest_classify(spark, "").count() == 1
    assert sum(n for n, _ in asked) == 100 and {d for _, d in asked} == {30}
