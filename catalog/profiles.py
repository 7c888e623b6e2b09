"""Descriptive tables, correlations and relevance."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import CLF, DIMS, REG, REG_NUMBERS, fx_clf, fx_reg, fx_vec, h32, held, union_all, with_
from rowloom.operators import profile as A
from rowloom.operators import relevance as R
from rowloom.operators.split import holdout_split, kfold_shuffled


def _r(df, digits, *cols):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(
    "describe_table",
    with_(REG)
    + union_all(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max,
            round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM fx_reg"""
        for c in ("y", "l_quantity", "net", "gap")
    ),
)
def describe_table(spark, sf):
    return _r(A.describe_table(fx_reg(spark, sf), ["y", "l_quantity", "net", "gap"]), 6, "mean", "std", "q25", "q50", "q75")


@query(
    "quantiles",
    with_(REG)
    + union_all(
        f"SELECT '{c}' AS column_name, CAST({q} AS DOUBLE) AS q, round(quantile_cont({c}, {q}), 6) AS value FROM fx_reg"
        for c in ("y", "neg", "gap") for q in (0.00001, 0.03, 0.5, 0.97)
    ),
)
def quantiles(spark, sf):
    return _r(A.quantile_table(fx_reg(spark, sf), ["y", "neg", "gap"], [0.00001, 0.03, 0.5, 0.97]), 6, "value")


@query("distinct_values", with_(CLF) + "SELECT DISTINCT source FROM fx_clf")
def distinct_values(spark, sf):
    return A.distinct_values(fx_clf(spark, sf), "source")


@query("n_unique", with_(REG) + union_all(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique FROM fx_reg" for c in ("y", "gap", "one", "l_returnflag")))
def n_unique(spark, sf):
    return A.n_unique(fx_reg(spark, sf), ["y", "gap", "one", "l_returnflag"])


@query(
    "class_balance",
    with_(CLF, "c AS (SELECT source, y, count(*) AS n FROM fx_clf GROUP BY 1, 2)", "g AS (SELECT source FROM c GROUP BY 1 HAVING count(*) = 2)")
    + """SELECT source, arg_max(y, n * 10 - y) AS majority, max(n) AS n_majority, arg_min(y, n * 10 - y) AS minority, min(n) AS n_minority
         FROM c SEMI JOIN g USING (source) GROUP BY source""",
)
def class_balance(spark, sf):
    return A.class_balance(fx_clf(spark, sf), "source", "y")


@query("column_extents_across_tables", with_(REG) + union_all(f"SELECT '{c}' AS column_name, min({c}) AS lo, max({c}) AS hi FROM fx_reg" for c in ("y", "net", "gap")))
def column_extents_across_tables(spark, sf):
    return A.column_extents(holdout_split(fx_reg(spark, sf), "id", 0.2), ["y", "net", "gap"])


@query(
    "mean_std_of_scores",
    with_(REG, f"f AS (SELECT {h32('id')} % 5 AS fold, avg(y) AS score FROM fx_reg GROUP BY 1)")
    + "SELECT round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score, count(*) AS n_folds FROM f",
)
def mean_std_of_scores(spark, sf):
    folds = kfold_shuffled(fx_reg(spark, sf), "id", 5).groupBy("fold").agg(F.avg("y").alias("score"))
    return _r(A.score_summary(folds), 6, "mean_score", "std_score")


@query(
    "histogram",
    with_(REG, "e AS (SELECT min(net) AS lo, (max(net) - min(net)) / 30 AS w FROM fx_reg)")
    + """SELECT CAST(least(floor((net - lo) / w), 29) AS BIGINT) AS bin, count(*) AS n,
         round(lo + least(floor((net - lo) / w), 29) * w, 6) AS bin_start FROM fx_reg, e GROUP BY ALL""",
)
def histogram(spark, sf):
    return _r(A.histogram(fx_reg(spark, sf), "net"), 6, "bin_start")


@query(
    "histogram_by_class",
    with_(CLF, "e AS (SELECT min(n_chars) AS lo, (max(n_chars) - min(n_chars)) / 20 AS w FROM fx_clf)")
    + "SELECT y, CAST(least(floor((n_chars - lo) / w), 19) AS BIGINT) AS bin, count(*) AS n FROM fx_clf, e GROUP BY 1, 2",
)
def histogram_by_class(spark, sf):
    return A.histogram(fx_clf(spark, sf), "n_chars", bins=20, by=["y"]).drop("bin_start")


@query(
    "kde_curve",
    with_(
        CLF,
        "b AS (SELECT y, pow(count(*), CAST(-0.2 AS DOUBLE)) * stddev_samp(n_words) AS h FROM fx_clf GROUP BY y)",
        "t AS (SELECT count(*) AS n, min(n_words) AS lo, (max(n_words) - min(n_words)) / CAST(29 AS DOUBLE) AS step FROM fx_clf)",
        "g AS (SELECT CAST(i AS INTEGER) AS grid_i, lo + i * step AS grid_x FROM t, range(30) r(i))",
    )
    + """SELECT c.y, grid_i, round(grid_x, 6) AS grid_x, round(sum(exp(-0.5 * pow((grid_x - n_words) / h, 2)) / (h * (SELECT n FROM t) * sqrt(2 * pi()))), 9) AS density
         FROM fx_clf c JOIN b ON c.y = b.y, g GROUP BY 1, 2, g.grid_x""",
)
def kde_curve(spark, sf):
    out = A.kde_curve(fx_clf(spark, sf), "n_words", "y")
    return out.withColumn("density", F.round("density", 9)).withColumn("grid_x", F.round("grid_x", 6))


@query("scatter_sample", with_(REG) + f"SELECT id, net, y FROM fx_reg WHERE {held('id', 0.05, 0)}")
def scatter_sample(spark, sf):
    return A.scatter_sample(fx_reg(spark, sf), "id", ["net", "y"], 0.05)


_GRAM = ["l_quantity", "l_discount", "l_tax"]


@query(
    "gram_matrix",
    with_(REG)
    + union_all(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, round(covar_pop({a}, {b}) * count(*), 2) AS sum_product FROM fx_reg"
        for i, a in enumerate(_GRAM) for b in _GRAM[i:]
    ),
)
def gram_matrix(spark, sf):
    return _r(A.gram_table(fx_reg(spark, sf), _GRAM), 2, "sum_product")


def _corr(a, b):
    pair = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    x, y = f"CASE WHEN {pair} THEN {a} END", f"CASE WHEN {pair} THEN {b} END"
    return f"round(CASE WHEN stddev_pop({x}) = 0 OR stddev_pop({y}) = 0 THEN NULL ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END, 6)"


_CORR = ["y", "net", "neg", "l_quantity", "gap", "one"]


@query("correlation_matrix", with_(REG) + union_all(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {_corr(a, b)} AS r FROM fx_reg" for a in _CORR for b in _CORR))
def correlation_matrix(spark, sf):
    return _r(R.correlation_matrix(fx_reg(spark, sf), _CORR), 6, "r")


_PREDICTORS = [c for c in REG_NUMBERS if c != "y"]


@query("target_correlation_ranked", with_(REG) + "SELECT * FROM (" + union_all(f"SELECT '{c}' AS column_name, {_corr(c, 'y')} AS r FROM fx_reg" for c in _PREDICTORS) + ") ORDER BY r DESC NULLS LAST, column_name")
def target_correlation_ranked(spark, sf):
    return _r(R.target_correlation_ranked(fx_reg(spark, sf), _PREDICTORS, "y"), 6, "r")


@query("select_by_correlation", with_(REG) + "SELECT id, net, y FROM fx_reg")
def select_by_correlation(spark, sf):
    return R.select_by_correlation(fx_reg(spark, sf), _PREDICTORS, "y", keep=["id"])[0]


@query("select_by_absolute_correlation", with_(REG) + "SELECT id, net, neg, y FROM fx_reg")
def select_by_absolute_correlation(spark, sf):
    return R.select_by_correlation(fx_reg(spark, sf), _PREDICTORS, "y", mode="abs", keep=["id"])[0]


@query(
    "null_aware_target_correlation",
    with_(REG) + union_all(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL OR y IS NULL) AS n_excluded, {_corr(c, 'y')} AS r FROM fx_reg" for c in ("gap", "l_quantity")),
)
def null_aware_target_correlation(spark, sf):
    return _r(R.null_aware_target_correlation(fx_reg(spark, sf), ["gap", "l_quantity"], "y"), 6, "r")


@query(
    "max_correlation_column",
    with_(REG, "t AS (" + union_all(f"SELECT '{c}' AS column_name, {_corr(c, 'y')} AS r FROM fx_reg" for c in ("neg", "l_quantity", "gap", "one")) + ")")
    + "SELECT column_name, r FROM t WHERE r IS NOT NULL ORDER BY abs(r) DESC LIMIT 1",
)
def max_correlation_column(spark, sf):
    return _r(R.max_correlation_column(R.target_correlation(fx_reg(spark, sf), ["neg", "l_quantity", "gap", "one"], "y")), 6, "r")


def _mi(c):
    return f"""SELECT '{c}' AS column_name, round(greatest(sum(n / t * ln(n * t / (nx * ny))), 0), 9) AS mi FROM (
      SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS t,
             CAST(sum(count(*)) OVER (PARTITION BY {c}) AS DOUBLE) AS nx, CAST(sum(count(*)) OVER (PARTITION BY y) AS DOUBLE) AS ny
      FROM fx_clf GROUP BY {c}, y)"""


@query("mutual_information", with_(CLF) + union_all(_mi(c) for c in ("lang", "source", "toxic", "n_words")))
def mutual_information(spark, sf):
    return _r(R.mutual_information(fx_clf(spark, sf), ["lang", "source", "toxic", "n_words"], "y"), 9, "mi")


@query(
    "top_k_features",
    with_(CLF) + "SELECT * FROM (" + union_all(_mi(c) for c in ("lang", "source", "toxic", "n_words")) + ") ORDER BY mi DESC, column_name LIMIT 2",
)
def top_k_features(spark, sf):
    scores = R.mutual_information(fx_clf(spark, sf), ["lang", "source", "toxic", "n_words"], "y")
    return _r(A.sorted_top(scores, "mi", 2, "column_name"), 9, "mi")


@query(
    "rfe",
    with_(
        REG,
        "c AS (SELECT corr(l_quantity, y) AS r1, corr(neg, y) AS r2, corr(l_quantity, neg) AS r12 FROM fx_reg)",
        "b AS (SELECT *, abs((r1 - r12 * r2) / (1 - r12 * r12)) AS b1, abs((r2 - r12 * r1) / (1 - r12 * r12)) AS b2 FROM c)",
    )
    + """SELECT 'l_quantity' AS column_name, CASE WHEN b1 < b2 THEN 2 ELSE 1 END AS rank, round(CASE WHEN b1 < b2 THEN b1 ELSE abs(r1) END, 6) AS importance FROM b
         UNION ALL SELECT 'neg', CASE WHEN b1 < b2 THEN 1 ELSE 2 END, round(CASE WHEN b1 < b2 THEN abs(r2) ELSE b2 END, 6) FROM b""",
)
def rfe(spark, sf):
    return _r(R.rfe(fx_reg(spark, sf), ["l_quantity", "neg"], "y"), 6, "importance")


@query("rfe_wide")
def rfe_wide(spark, sf):
    return R.rfe(fx_vec(spark, sf), DIMS, "y")


@query("rfe_trees")
def rfe_trees(spark, sf):
    from rowloom.models.spark_ml import decision_tree_classify

    data = fx_vec(spark, sf).persist()
    return R.rfe(
        data, ["e0", "e1", "e2", "e3"], "y", n_keep=2,
        importance=lambda df, names, y: list(decision_tree_classify(df, names, y, max_depth=4).importances),
    )


@query("feature_importance_table")
def feature_importance_table(spark, sf):
    from rowloom.models.spark_ml import random_forest_regress

    names = ["net", "l_quantity", "l_discount", "l_tax"]
    model = random_forest_regress(fx_reg(spark, sf), names, "y", n_estimators=5, max_depth=4)
    return R.feature_importance_table(model.model, names, spark)


