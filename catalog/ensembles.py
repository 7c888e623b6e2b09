"""Trees and tree ensembles."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import BIN_FEATURES, REG, fx_bin, fx_reg, with_
from rowloom.models import adaboost as ada
from rowloom.models import spark_ml as ml
from rowloom.models import trees
from rowloom.operators.metrics import evaluate
from rowloom.operators.split import holdout_split

_X = ["net", "l_quantity", "l_discount"]

_LEVEL = "lv AS (SELECT floor(y / 2000) AS x, net AS t, CAST(net > 50000 AS INTEGER) AS k FROM fx_reg)"


def _level(spark, sf):
    y, net = F.col("y"), F.col("net")
    return fx_reg(spark, sf).select(
        F.floor(y / 2000).cast("double").alias("x"), net.alias("t"), (net > 50000).cast("int").alias("k")
    )


_CUM = """v AS (SELECT x, count(*) AS n, sum(t) AS s, sum(k) AS k FROM lv GROUP BY x),
 c AS (SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl, CAST(sum(k) OVER (ORDER BY x) AS DOUBLE) AS kl,
   sum(n) OVER () AS n, sum(s) OVER () AS s, CAST(sum(k) OVER () AS DOUBLE) AS k FROM v)"""


@query(
    "decision_tree_regress",
    with_(REG, _LEVEL, _CUM, "b AS (SELECT x FROM c WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, x LIMIT 1)")
    + "SELECT round(avg(t), 4) AS prediction, count(*) AS n FROM lv, b GROUP BY lv.x <= b.x",
)
def decision_tree_regress(spark, sf):
    rows = _level(spark, sf)
    out = ml.decision_tree_regress(rows, ["x"], "t", max_depth=1, max_bins=128).score(rows)
    return out.groupBy(F.round("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


_STUMP = with_(
    REG, _LEVEL, _CUM, "b AS (SELECT x FROM c WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, x LIMIT 1)"
) + "SELECT round(avg(t), 4) AS prediction, count(*) AS n FROM lv, b GROUP BY lv.x <= b.x"


def _leaves(scored):
    return scored.groupBy(F.round("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("adaboost_round", _STUMP)
def adaboost_round(spark, sf):
    """The first round has equal weights: its median is the plain stump."""
    rows = _level(spark, sf)
    return _leaves(ada.adaboost_regress(rows, ["x"], "t", n_estimators=1, max_depth=1, max_bins=128).score(rows))


@query("gradient_boosting_round", _STUMP)
def gradient_boosting_round(spark, sf):
    rows = _level(spark, sf)
    return _leaves(ml.gradient_boosting_regress(rows, ["x"], "t", n_estimators=1, max_depth=1, max_bins=128).score(rows))


@query("hist_gradient_boosting_round", _STUMP)
def hist_gradient_boosting_round(spark, sf):
    """One full step without penalty ends at the side means."""
    rows = _level(spark, sf)
    return _leaves(trees.hist_gradient_boosting(rows, ["x"], "t", max_iter=1, learning_rate=1.0, max_depth=1).score(rows))


@query(
    "decision_tree_classify",
    with_(
        REG, _LEVEL, _CUM,
        "b AS (SELECT x FROM c WHERE nl < n ORDER BY (kl * kl + (nl - kl) * (nl - kl)) / nl + ((k - kl) * (k - kl) + (n - nl - k + kl) * (n - nl - k + kl)) / (n - nl) DESC, x LIMIT 1)",
    )
    + "SELECT CAST(avg(k) > 0.5 AS INTEGER) AS prediction, round(avg(k), 6) AS probability, count(*) AS n FROM lv, b GROUP BY lv.x <= b.x",
)
def decision_tree_classify(spark, sf):
    rows = _level(spark, sf)
    out = ml.decision_tree_classify(rows, ["x"], "k", max_depth=1, max_bins=128).score(rows, probability="probability")
    return out.groupBy(F.col("prediction").cast("int").alias("prediction"), F.round("probability", 6).alias("probability")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "boosted_trees_split",
    with_(
        REG, _LEVEL, _CUM, "g AS (SELECT x, nl, n - nl AS nr, sl - nl * s / n AS gl, s - sl - (n - nl) * s / n AS gr, s / n AS base FROM c)",
        "b AS (SELECT * FROM g WHERE nr > 0 ORDER BY gl * gl / (nl + 1) + gr * gr / (nr + 1) DESC, x LIMIT 1)",
    )
    + "SELECT round(any_value(CASE WHEN lv.x <= b.x THEN base + gl / (nl + 1) ELSE base + gr / (nr + 1) END), 4) AS prediction, count(*) AS n FROM lv, b GROUP BY lv.x <= b.x",
)
def boosted_trees_split(spark, sf):
    """One round of depth one: the split with the largest second-order gain."""
    rows = _level(spark, sf)
    out = trees.boosted_trees(rows, ["x"], "t", n_estimators=1, learning_rate=1.0, max_depth=1, max_bins=1000).score(rows)
    return out.groupBy(F.round("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def _regress(spark, sf, fit):
    train, test = holdout_split(fx_reg(spark, sf).select("id", "y", *_X), "id", 0.2)
    return evaluate(fit(train, _X, "y").score(test), "y", "prediction", ["rmse", "rmspe"])


def _classify(spark, sf, fit):
    train, test = holdout_split(fx_bin(spark, sf), "id", 0.2)
    return evaluate(fit(train, BIN_FEATURES, "y").score(test), "y", "prediction", ["accuracy", "f1"])


@query("random_forest_regress")
def random_forest_regress(spark, sf):
    return _regress(spark, sf, lambda d, x, y: ml.random_forest_regress(d, x, y, n_estimators=10, max_depth=6))


@query("random_forest_classify")
def random_forest_classify(spark, sf):
    """100 trees, as deep as MLlib grows them."""
    return _classify(spark, sf, lambda d, x, y: ml.random_forest_classify(d, x, y, n_estimators=100, max_depth=ml.MAX_DEPTH))


@query("extra_trees_regress")
def extra_trees_regress(spark, sf):
    return _regress(spark, sf, lambda d, x, y: trees.extra_trees_regress(d, x, y, n_estimators=100, max_depth=40, min_samples_split=4, min_samples_leaf=5))


_CUTS = """ex AS (SELECT 0 AS f, min(net) AS lo, max(net) AS hi FROM fx_reg UNION ALL SELECT 1, min(l_quantity), max(l_quantity) FROM fx_reg
   UNION ALL SELECT 2, min(l_discount), max(l_discount) FROM fx_reg),
 ct AS (SELECT t, f, lo + (CAST('0x' || substr(md5('42:' || t || ':0:' || f), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)) * (hi - lo) AS cut FROM ex, range(3) r(t)),
 sd AS (SELECT t, f, cut, count(*) AS nl, sum(y) AS sl FROM fx_reg JOIN ct ON (CASE f WHEN 0 THEN net WHEN 1 THEN l_quantity ELSE l_discount END) <= cut GROUP BY ALL),
 tt AS (SELECT count(*) AS n, sum(y) AS s FROM fx_reg),
 bs AS (SELECT t, f, cut, sl / nl AS vl, (s - sl) / (n - nl) AS vr FROM sd, tt
   QUALIFY row_number() OVER (PARTITION BY t ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, f) = 1),
 pr AS (SELECT id, avg(CASE WHEN (CASE f WHEN 0 THEN net WHEN 1 THEN l_quantity ELSE l_discount END) <= cut THEN vl ELSE vr END) AS p FROM fx_reg, bs GROUP BY id)"""


@query("extra_trees_split", with_(REG, _CUTS) + "SELECT round(p, 4) AS prediction, count(*) AS n FROM pr GROUP BY 1")
def extra_trees_split(spark, sf):
    """Three trees of depth one: random cuts per feature, the best feature wins."""
    rows = fx_reg(spark, sf)
    out = trees.extra_trees_regress(rows, _X, "y", n_estimators=3, max_depth=1).score(rows)
    return out.groupBy(F.round("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("gradient_boosting_regress")
def gradient_boosting_regress(spark, sf):
    return _regress(spark, sf, lambda d, x, y: ml.gradient_boosting_regress(d, x, y, n_estimators=5, max_depth=4, learning_rate=0.5))


@query("gradient_boosting_regress_huber")
def gradient_boosting_regress_huber(spark, sf):
    return _regress(spark, sf, lambda d, x, y: trees.huber_boosting(d, x, y, n_estimators=3, learning_rate=0.5))


@query("gradient_boosting_classify")
def gradient_boosting_classify(spark, sf):
    return _classify(spark, sf, lambda d, x, y: ml.gradient_boosting_classify(d, x, y, n_estimators=5, max_depth=3))


@query("boosted_trees_regress")
def boosted_trees_regress(spark, sf):
    return _regress(spark, sf, lambda d, x, y: trees.boosted_trees(d, x, y, key="id", n_estimators=100, max_depth=4, learning_rate=0.1, subsample=0.8))


@query("boosted_trees")
def boosted_trees_classify(spark, sf):
    return _classify(
        spark, sf, lambda d, x, y: trees.boosted_trees(d, x, y, loss="logistic", n_estimators=850, max_depth=4, learning_rate=0.01, colsample=0.75, max_bins=32)
    )


@query("hist_gradient_boosting")
def hist_gradient_boosting(spark, sf):
    return _regress(spark, sf, lambda d, x, y: trees.hist_gradient_boosting(d, x, y))


_DEPTH2 = """lv AS (SELECT floor(y / 2000) AS x, net AS t FROM fx_reg),
 v AS (SELECT x, count(*) AS n, sum(t) AS s FROM lv GROUP BY x),
 c AS (SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM v),
 b AS (SELECT x FROM c WHERE nl >= 5 AND n - nl >= 5 ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, x LIMIT 1),
 v2 AS (SELECT v.x, v.n, v.s, v.x <= b.x AS side FROM v, b),
 c2 AS (SELECT side, x, sum(n) OVER (PARTITION BY side ORDER BY x) AS nl, sum(s) OVER (PARTITION BY side ORDER BY x) AS sl, sum(n) OVER (PARTITION BY side) AS n, sum(s) OVER (PARTITION BY side) AS s FROM v2),
 b2 AS (SELECT side, x FROM c2 WHERE nl >= 5 AND n - nl >= 5 QUALIFY row_number() OVER (PARTITION BY side ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, x) = 1)"""


@query(
    "decision_tree_depth_two",
    with_(REG, _DEPTH2) + "SELECT round(avg(t), 4) AS prediction, count(*) AS n FROM (SELECT lv.t, lv.x <= b.x AS s1, lv.x <= b2.x AS s2 FROM lv, b JOIN b2 ON true WHERE b2.side = (lv.x <= b.x)) GROUP BY s1, s2",
)
def decision_tree_depth_two(spark, sf):
    """A tree of depth two on exact cuts: splits of four rows, leaves of five."""
    rows = _level(spark, sf)
    return _leaves(trees.decision_tree(rows, ["x"], "t", max_depth=2, min_samples_split=4, min_samples_leaf=5, large=True).score(rows))


@query("decision_tree_unbounded")
def decision_tree_unbounded(spark, sf):
    """Grown until leaves are pure or too small, without a limit of depth."""
    return _regress(spark, sf, lambda d, x, y: trees.decision_tree(d, x, y, min_samples_split=4, min_samples_leaf=5, large=True))


@query("random_forest_unbounded")
def random_forest_unbounded(spark, sf):
    """100 bootstrapped trees without a limit of depth, a third of the features in a node."""
    return _regress(spark, sf, lambda d, x, y: trees.random_forest(d, x, y, "id", min_samples_split=4, min_samples_leaf=5, max_features=0.34, large=True))


@query("adaboost_regress")
def adaboost_regress(spark, sf):
    return _regress(spark, sf, lambda d, x, y: ada.adaboost_regress(d, x, y, n_estimators=4))


@query("adaboost_classify")
def adaboost_classify(spark, sf):
    return _classify(spark, sf, lambda d, x, y: ada.adaboost_classify(d, x, y, n_estimators=4, max_depth=2))
