"""Linear, robust, Bayesian, kernel and neural models."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import BIN_FEATURES, CLF, DIMS, REG, VEC, fx_bin, fx_clf, fx_reg, fx_vec, h32, held, with_
from rowloom.functions.moments import moments
from rowloom.models import bayes, kernel, linear, mlp, robust
from rowloom.models import spark_ml as ml
from rowloom.operators.encode import apply_scale, standard_state
from rowloom.operators.metrics import evaluate
from rowloom.operators.split import holdout_split

_XY = ["net", "l_discount"]
_M2 = """m AS (SELECT count(*) AS n, avg(net) AS m0, avg(l_discount) AS m1, avg(y) AS my, var_pop(net) AS a, covar_pop(net, l_discount) AS b,
   var_pop(l_discount) AS c, covar_pop(net, y) AS p, covar_pop(l_discount, y) AS q FROM fx_reg)"""


def _solve2(alpha):
    a, c = f"(a + {alpha} / n)", f"(c + {alpha} / n)"
    return f"w AS (SELECT *, ({c} * p - b * q) / ({a} * {c} - b * b) AS w0, ({a} * q - b * p) / ({a} * {c} - b * b) AS w1 FROM m)"


_TERMS2 = """SELECT 'intercept' AS term, round(my - w0 * m0 - w1 * m1, 3) AS value FROM w
  UNION ALL SELECT 'net', round(w0, 6) FROM w UNION ALL SELECT 'l_discount', round(w1, 3) FROM w"""


def _terms(model, spark):
    digits = F.when(F.col("term") == "net", F.round("value", 6)).otherwise(F.round("value", 3))
    return model.table(spark).withColumn("value", digits)


def _fit(spark, sf, method, features=_XY, **params):
    return _terms(linear.fit(fx_reg(spark, sf), features, "y", method, **params), spark)


@query("linear_regression", with_(REG, _M2, _solve2("0.0")) + _TERMS2)
def linear_regression(spark, sf):
    return _fit(spark, sf, "least_squares")


@query("ridge", with_(REG, _M2, _solve2("10.0")) + _TERMS2)
def ridge(spark, sf):
    return _fit(spark, sf, "ridge", alpha=10.0)


_ONE = "m AS (SELECT avg(net) AS mx, avg(y) AS my, var_pop(net) AS v, covar_pop(net, y) AS c FROM fx_reg)"


def _one(expr):
    return f"SELECT 'intercept' AS term, round(my - ({expr}) * mx, 3) AS value FROM m UNION ALL SELECT 'net', round({expr}, 6) FROM m"


@query("lasso", with_(REG, _ONE) + _one("sign(c) * greatest(abs(c) - 100000000.0, 0) / v"))
def lasso(spark, sf):
    return _fit(spark, sf, "lasso", ["net"], alpha=1e8)


@query("lasso_lars", with_(REG, _ONE) + _one("sign(c) * greatest(abs(c) - 1000.0, 0) / v"))
def lasso_lars(spark, sf):
    return _fit(spark, sf, "lasso_lars", ["net"], alpha=1e3)


@query("elastic_net", with_(REG, _ONE) + _one("sign(c) * greatest(abs(c) - 25000000.0, 0) / (v + 75000000.0)"))
def elastic_net(spark, sf):
    return _fit(spark, sf, "elastic_net", ["net"], alpha=1e8, l1_ratio=0.25)


@query("lars", with_(REG, _M2, _solve2("0.0")) + _TERMS2)
def lars(spark, sf):
    """Run to the end of its path, least-angle regression meets least squares."""
    return _fit(spark, sf, "lars")


@query(
    "orthogonal_matching_pursuit",
    with_(REG, _ONE) + _one("c / v") + " UNION ALL SELECT 'l_quantity', CAST(0 AS DOUBLE) UNION ALL SELECT 'l_discount', CAST(0 AS DOUBLE)",
)
def orthogonal_matching_pursuit(spark, sf):
    """The first pick is the column with the largest |correlation|."""
    return _fit(spark, sf, "orthogonal_matching_pursuit", ["l_quantity", "net", "l_discount"], n_nonzero=1)


@query("bayesian_ridge")
def bayesian_ridge(spark, sf):
    return _fit(spark, sf, "bayesian_ridge")


@query("ard_regression")
def ard_regression(spark, sf):
    return _fit(spark, sf, "ard", ["net", "l_discount", "l_tax"])


_SUMS = "m AS (SELECT count(*) AS n, avg(net) AS mx, avg(y) AS my, var_pop(net) * count(*) AS xx, covar_pop(net, y) * count(*) AS xy, var_pop(y) * count(*) AS yy FROM fx_reg)"


@query(
    "bayesian_ridge_step",
    with_(
        REG, _SUMS, "a AS (SELECT *, xy / (xx + yy / n) AS w, n / yy AS noise FROM m)", "b AS (SELECT *, yy - 2 * w * xy + w * w * xx AS rss, noise * xx / (1 + noise * xx) AS gamma FROM a)",
        "c AS (SELECT *, (gamma + 2e-6) / (w * w + 2e-6) AS weight, (n - gamma + 2e-6) / (rss + 2e-6) AS precision FROM b)", "w AS (SELECT mx, my, xy / (xx + weight / precision) AS w FROM c)",
    )
    + "SELECT 'intercept' AS term, round(my - w * mx, 3) AS value FROM w UNION ALL SELECT 'net', round(w, 6) FROM w",
)
def bayesian_ridge_step(spark, sf):
    """One round of the evidence iteration."""
    return _fit(spark, sf, "bayesian_ridge", ["net"], max_iter=1)


@query(
    "ard_step",
    with_(REG, _SUMS, "w AS (SELECT mx, my, n / yy * xy / (1 + n / yy * xx) AS w FROM m)")
    + "SELECT 'intercept' AS term, round(my - w * mx, 3) AS value FROM w UNION ALL SELECT 'net', round(w, 6) FROM w",
)
def ard_step(spark, sf):
    return _fit(spark, sf, "ard", ["net"], max_iter=1)


@query(
    "svr_step",
    with_(
        REG, "p AS (SELECT net / 10000 AS x, y / 10000 AS t FROM fx_reg)", "m AS (SELECT avg(x) AS mx, avg(t) AS mt, stddev_pop(t) AS sd FROM p)",
        "r AS (SELECT x - mx AS x, t - mt AS t, CASE WHEN abs(t - mt) > 0.5 THEN 1 / greatest(abs(t - mt) - 0.5, 1e-6 * sd) ELSE 0 END AS a, t - mt - sign(t - mt) * 0.5 AS aim FROM p, m)",
        "s AS (SELECT sum(a * x * x) + 1 AS p, sum(a * x) AS q, sum(a) + 1e-12 AS r, sum(a * x * aim) AS u, sum(a * aim) AS v FROM r)",
        "w AS (SELECT (r * u - q * v) / (p * r - q * q) AS w, (p * v - q * u) / (p * r - q * q) AS b FROM s)",
    )
    + "SELECT 'intercept' AS term, round(b + mt - mx * w, 6) AS value FROM w, m UNION ALL SELECT 'x', round(w, 6) FROM w",
)
def svr_step(spark, sf):
    """One reweighted step from zero: rows outside the tube pull with their inverse distance to it."""
    rows = fx_reg(spark, sf).select((F.col("net") / 10000).alias("x"), (F.col("y") / 10000).alias("t"))
    table = kernel.linear_svr(rows, ["x"], "t", c=1.0, epsilon=0.5, max_iter=1).table(spark)
    return table.withColumn("value", F.round("value", 6))


@query("huber_regression")
def huber_regression(spark, sf):
    return linear.fit_huber(fx_reg(spark, sf), ["net", "l_quantity"], "y").table(spark)


def _scaled(spark, sf, names=("net", "l_quantity", "y")):
    r = fx_reg(spark, sf).select("id", *names)
    return apply_scale(r, standard_state(r, list(names)))


@query("passive_aggressive_regression")
def passive_aggressive_regression(spark, sf):
    """Up to 1,000 passes, or until five in a row bring no gain."""
    rows = _scaled(spark, sf)
    model = linear.fit_passive_aggressive(rows, ["net", "l_quantity"], "y", key="id")
    return evaluate(model.score(rows), "y", "prediction", ["rmse"])


_PA_ORDER = f"(ORDER BY {h32('id')}, id)"
_PA_LOSS = "greatest(abs(r.y - a.w * r.x - a.b) - 0.1, 0) * sign(r.y - a.w * r.x - a.b)"
_PA_MOVE = f"CASE WHEN r.x = 0 THEN 0 ELSE sign({_PA_LOSS}) * least(0.5, abs({_PA_LOSS}) / (r.x * r.x)) END"


@query(
    "passive_aggressive_pass",
    with_(
        REG, f"o AS (SELECT net / 50000 AS x, y / 50000 AS y, row_number() OVER {_PA_ORDER} - 1 AS place FROM fx_reg)",
        "g AS (SELECT place // 5000 AS shard, count(*) AS n, list({'x': x, 'y': y, 'w': CAST(0 AS DOUBLE), 'b': CAST(0 AS DOUBLE)} ORDER BY place) AS rows FROM o GROUP BY 1)",
        "p AS (SELECT n, list_reduce(list_prepend({'x': CAST(0 AS DOUBLE), 'y': CAST(0 AS DOUBLE), 'w': CAST(0 AS DOUBLE), 'b': CAST(0 AS DOUBLE)}, rows), "
        f"lambda a, r: {{'x': r.x, 'y': r.y, 'w': a.w + r.x * ({_PA_MOVE}), 'b': a.b + ({_PA_MOVE})}}) AS e FROM g)",
    )
    + "SELECT 'intercept' AS term, round(sum(n * e.b) / sum(n), 6) AS value FROM p UNION ALL SELECT 'x', round(sum(n * e.w) / sum(n), 6) FROM p",
)
def passive_aggressive_pass(spark, sf):
    """One pass of the online rule over blocks of 5,000 rows in hash order, and the mean of their weights."""
    rows = fx_reg(spark, sf).select("id", (F.col("net") / 50000).alias("x"), (F.col("y") / 50000).alias("y"))
    model = linear.fit_passive_aggressive(rows, ["x"], "y", c=0.5, max_iter=1, shuffle=False, shard_rows=5000, key="id")
    return model.table(spark).withColumn("value", F.round("value", 6))


@query("theil_sen")
def theil_sen(spark, sf):
    return robust.fit_theil_sen(fx_reg(spark, sf), "id", _XY, "y").table(spark)


@query(
    "theil_sen_large_subsets",
    with_(
        REG, f"o AS (SELECT net AS x, y, row_number() OVER (ORDER BY {h32('id')}, id) - 1 AS place FROM fx_reg)",
        "s AS (SELECT place // 40 AS subset, count(*) AS n, sum(x * y) / sum(x * x) AS w FROM o GROUP BY 1)",
    )
    + "SELECT 'intercept' AS term, CAST(0 AS DOUBLE) AS value UNION ALL SELECT 'net', round(median(w), 9) FROM s WHERE n = 40",
)
def theil_sen_large_subsets(spark, sf):
    """Every row in one subset of 40, slopes through the origin from cross products, their median."""
    rows = fx_reg(spark, sf)
    model = robust.fit_theil_sen(rows, "id", ["net"], "y", max_subpopulation=rows.count() // 40, n_subsamples=40, intercept=False)
    return model.table(spark).withColumn("value", F.round("value", 9))


@query("ransac")
def ransac(spark, sf):
    return robust.fit_ransac(fx_reg(spark, sf), "id", _XY, "y").table(spark)


def nb_sql(train, score, features, smoothing="1e-9", p=""):
    """CTEs up to `sc`: (id, actual, l0, l1) log densities of the two classes; `p` prefixes their names."""
    stats = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in features)
    big = "greatest(" + ", ".join(f"var_pop({f})" for f in features) + ")" if len(features) > 1 else f"var_pop({features[0]})"
    dens = f"ln(CAST({p}st.n AS DOUBLE) / {p}tt.n)" + "".join(
        f" - 0.5 * ln(2 * pi() * (v_{f} + CAST({smoothing} AS DOUBLE) * big)) - 0.5 * ({f} - m_{f}) * ({f} - m_{f}) / (v_{f} + CAST({smoothing} AS DOUBLE) * big)"
        for f in features
    )
    return f"""{p}st AS (SELECT y, count(*) AS n, {stats} FROM {train} GROUP BY y), {p}tt AS (SELECT count(*) AS n, {big} AS big FROM {train}),
 {p}ll AS (SELECT r.id, r.y AS actual, {p}st.y AS cls, {dens} AS l FROM {score} r, {p}st, {p}tt),
 {p}sc AS (SELECT id, any_value(actual) AS actual, max(CASE WHEN cls = 0 THEN l END) AS l0, max(CASE WHEN cls = 1 THEN l END) AS l1 FROM {p}ll GROUP BY id)"""


_NB = ["n_chars", "n_words"]


@query(
    "gaussian_naive_bayes",
    with_(CLF, f"tr AS (SELECT * FROM fx_clf WHERE NOT {held('id', 0.2)}), te AS (SELECT * FROM fx_clf WHERE {held('id', 0.2)})", nb_sql("tr", "te", _NB))
    + "SELECT id, CAST(CASE WHEN l0 >= l1 THEN 0 ELSE 1 END AS INTEGER) AS prediction, round(1 / (1 + exp(l0 - l1)), 6) AS probability FROM sc",
)
def gaussian_naive_bayes(spark, sf):
    train, test = holdout_split(fx_clf(spark, sf).select("id", "y", *_NB), "id", 0.2)
    out = bayes.fit_gaussian_nb(train, _NB, "y").score(test, probability="probability")
    return out.select("id", "prediction", F.round("probability", 6).alias("probability"))


def _classify(spark, sf, fit):
    train, test = holdout_split(fx_bin(spark, sf), "id", 0.2)
    return evaluate(fit(train).score(test), "y", "prediction", ["accuracy", "f1"])


@query("logistic_regression")
def logistic_regression(spark, sf):
    return _classify(spark, sf, lambda d: ml.logistic_regression(d, BIN_FEATURES, "y", c=1.0))


@query("linear_svm_classify")
def linear_svm_classify(spark, sf):
    return _classify(spark, sf, lambda d: ml.linear_svc(d, BIN_FEATURES, "y", c=1.0, max_iter=20))


@query("kernel_svm_classify")
def kernel_svm_classify(spark, sf):
    return _classify(spark, sf, lambda d: kernel.kernel_svc(d, "id", BIN_FEATURES, "y", kernel="rbf", gamma="scale"))


@query("svr")
def svr(spark, sf):
    model = kernel.linear_svr(_scaled(spark, sf), ["net", "l_quantity"], "y", c=100.0, epsilon=0.05, max_iter=10)
    return evaluate(model.score(_scaled(spark, sf)), "y", "prediction", ["rmse", "mae"])


@query("kernel_svr")
def kernel_svr(spark, sf):
    rows = _scaled(spark, sf)
    model = kernel.kernel_svr(rows, "id", ["net", "l_quantity"], "y", c=10.0, epsilon=0.05, kernel="rbf", gamma="scale")
    return evaluate(model.score(rows), "y", "prediction", ["rmse", "mae"])


@query("kernel_ridge")
def kernel_ridge(spark, sf):
    rows = _scaled(spark, sf)
    model = kernel.kernel_ridge(rows, "id", ["net", "l_quantity"], "y", alpha=0.1, kernel="polynomial", gamma=0.5, degree=2)
    return evaluate(model.score(rows), "y", "prediction", ["rmse", "r2"])


@query(
    "kernel_ridge_linear",
    with_(REG, "w AS (SELECT sum(net / 10000 * y) / (sum(net / 10000 * net / 10000) + 5.0) AS w FROM fx_reg)") + "SELECT id, round(net / 10000 * w, 2) AS prediction FROM fx_reg, w",
)
def kernel_ridge_linear(spark, sf):
    """With a linear kernel on one feature the landmark map is exact."""
    rows = fx_reg(spark, sf).select("id", (F.col("net") / 10000).alias("x"), "y")
    model = kernel.kernel_ridge(rows, "id", ["x"], "y", alpha=5.0, kernel="linear", landmarks=10)
    return model.score(rows).select("id", F.round("prediction", 2).alias("prediction"))


@query("mlp_regress")
def mlp_regress(spark, sf):
    """100 hidden units, mini-batches of 200, up to 200 passes."""
    rows = _scaled(spark, sf)
    model = mlp.fit_mlp(rows, ["net", "l_quantity"], "y", key="id")
    return evaluate(model.score(rows), "y", "prediction", ["rmse"])


_START = (0.3, -0.2, 0.1, 0.4, 0.05, -0.1, 0.7, -0.5, 0.2)  # w11 w12 w21 w22 b1 b2 v1 v2 c


@query(
    "mlp_step",
    with_(
        REG, "p AS (SELECT net / 50000 AS x1, l_quantity / 50 AS x2, y / 50000 AS y FROM fx_reg)",
        "h AS (SELECT *, 1 / (1 + exp(-(0.3 * x1 + 0.1 * x2 + 0.05))) AS h1, 1 / (1 + exp(-(-0.2 * x1 + 0.4 * x2 - 0.1))) AS h2 FROM p)",
        "d AS (SELECT *, 0.7 * h1 - 0.5 * h2 + 0.2 - y AS d FROM h)",
        "e AS (SELECT *, d * 0.7 * h1 * (1 - h1) AS d1, d * -0.5 * h2 * (1 - h2) AS d2 FROM d)",
        "g AS (SELECT [avg(d1 * x1), avg(d2 * x1), avg(d1 * x2), avg(d2 * x2), avg(d1), avg(d2), avg(d * h1), avg(d * h2), avg(d)] AS g FROM e)",
        f"w AS (SELECT unnest(range(9)) AS place, unnest(g) AS g, unnest({list(_START)}) AS w FROM g)",
    )
    + "SELECT CAST(place AS INTEGER) AS place, round(w - 0.5 * g, 8) AS weight FROM w",
)
def mlp_step(spark, sf):
    """One gradient step over all rows from given weights; blocks of 5,000 rows, averaged, make the same step."""
    p = fx_reg(spark, sf).select("id", (F.col("net") / 50000).alias("x1"), (F.col("l_quantity") / 50).alias("x2"), (F.col("y") / 50000).alias("y"))
    model = mlp.fit_mlp(
        p, ["x1", "x2"], "y", hidden=(2,), activation="logistic", solver="sgd", alpha=0.0, learning_rate=0.5, max_iter=1, batch_size=5000,
        momentum=0.0, nesterov=False, shard_rows=5000, key="id", start=_START,
    )
    return spark.createDataFrame([(i, round(float(w), 8)) for i, w in enumerate(model.flat)], "place int, weight double")


_CENTERS = [(-0.1,) * len(DIMS), (0.1,) * len(DIMS)]
_D = ["(CAST(0 AS DOUBLE) + " + " + ".join(f"({c} - CAST({v} AS DOUBLE)) * ({c} - CAST({v} AS DOUBLE))" for c, v in zip(DIMS, center)) + ")" for center in _CENTERS]


@query(
    "kmeans_step",
    with_(VEC, f"c AS (SELECT CASE WHEN {_D[0]} <= {_D[1]} THEN 0 ELSE 1 END AS cluster, * FROM fx_vec)")
    + f"SELECT cluster, count(*) AS n, {', '.join(f'round(avg({c}), 9) AS {c}' for c in DIMS)} FROM c GROUP BY cluster",
)
def kmeans_step(spark, sf):
    return ml.lloyd_step(fx_vec(spark, sf), DIMS, _CENTERS).withColumns({c: F.round(c, 9) for c in DIMS})


@query("kmeans")
def kmeans(spark, sf):
    v = fx_vec(spark, sf)
    return ml.kmeans(v, DIMS, k=2).score(v, "cluster").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query(
    "refit_on_all_and_score",
    with_(REG, f"tr AS (SELECT * FROM fx_reg WHERE NOT {held('id', 0.2)})", "m AS (SELECT regr_slope(y, net) AS w, regr_intercept(y, net) AS b FROM tr)")
    + f"SELECT id, round(b + net * w, 3) AS prediction FROM fx_reg, m WHERE {held('id', 0.2)}",
)
def refit_on_all_and_score(spark, sf):
    labelled, unlabelled = holdout_split(fx_reg(spark, sf), "id", 0.2)
    model = linear.fit_least_squares(moments(labelled, ["net", "y"]), ["net"], "y")
    return model.score(unlabelled.drop("y")).select("id", F.round("prediction", 3).alias("prediction"))
