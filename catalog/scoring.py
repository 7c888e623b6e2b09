"""Metrics and diagnostics."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import CLS_PRED, DIMS, PRED, VEC, fx_cls_pred, fx_pred, fx_vec, union_all, with_
from rowloom.operators import metrics as V
from rowloom.operators.clean import equality_subset


def _round(df, digits=6, *cols):
    return df.withColumns({c: F.round(c, digits) for c in (cols or df.columns)})


@query("mse", with_(PRED) + "SELECT round(avg((y - p) * (y - p)), 4) AS mse FROM fx_pred")
def mse(spark, sf):
    return _round(V.evaluate(fx_pred(spark, sf), "y", "p", ["mse"]), 4)


@query("rmse", with_(PRED) + "SELECT l_returnflag, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM fx_pred GROUP BY 1")
def rmse(spark, sf):
    return _round(V.evaluate(fx_pred(spark, sf), "y", "p", ["rmse"], by=["l_returnflag"]), 6, "rmse")


@query(
    "rmspe",
    with_(PRED, "z AS (SELECT CASE WHEN l_quantity = 7 THEN 0 ELSE y END AS y, p FROM fx_pred)")
    + """SELECT round(sqrt(avg(((y - p) / nullif(y, 0)) * ((y - p) / nullif(y, 0)))), 6) AS rmspe,
         CAST('inf' AS DOUBLE) AS rmspe_inf, (SELECT round(sqrt(avg(((y - p) / y) * ((y - p) / y))), 6) FROM fx_pred) AS rmspe_nonzero FROM z""",
)
def rmspe(spark, sf):
    base = fx_pred(spark, sf)
    zero = base.withColumn("y0", F.when(F.col("l_quantity") == 7, 0.0).otherwise(F.col("y")))
    return _round(
        zero.agg(V.rmspe("y0", "p").alias("rmspe"), V.rmspe("y0", "p", zero="inf").alias("rmspe_inf"), V.rmspe("y", "p").alias("rmspe_nonzero")),
        6, "rmspe", "rmspe_nonzero",
    )


@query("r2", with_(PRED) + "SELECT round(1 - avg((y - p) * (y - p)) / var_pop(y), 9) AS r2 FROM fx_pred")
def r2(spark, sf):
    return _round(V.evaluate(fx_pred(spark, sf), "y", "p", ["r2"]), 9)


@query("accuracy", with_(CLS_PRED) + "SELECT round(avg(CAST(y = p AS DOUBLE)), 9) AS accuracy FROM fx_cls_pred")
def accuracy(spark, sf):
    return _round(V.evaluate(fx_cls_pred(spark, sf), "y", "p", ["accuracy"]), 9)


_LABELS = "lb AS (SELECT y AS l FROM fx_cls_pred UNION SELECT p FROM fx_cls_pred)"


@query(
    "confusion_matrix",
    with_(CLS_PRED, _LABELS) + "SELECT a.l AS actual, b.l AS predicted, (SELECT count(*) FROM fx_cls_pred WHERE y = a.l AND p = b.l) AS n FROM lb a, lb b",
)
def confusion_matrix(spark, sf):
    return V.confusion_matrix(fx_cls_pred(spark, sf), "y", "p")


def report_sql(rel, y="y", p="p"):
    """CTEs and the final select of a classification report on `rel`."""
    return (
        f"""lb AS (SELECT {y} AS l FROM {rel} UNION SELECT {p} FROM {rel}),
 pc AS (SELECT l, count(*) FILTER ({y} = l AND {p} = l) AS hit, count(*) FILTER ({p} = l) AS said, count(*) FILTER ({y} = l) AS sup FROM lb, {rel} GROUP BY l),
 pr AS (SELECT CAST(l AS VARCHAR) AS label, coalesce(hit / nullif(said, 0), 0) AS precision, coalesce(hit / nullif(sup, 0), 0) AS recall,
   coalesce(2.0 * hit / nullif(sup + said, 0), 0) AS f1, sup AS support, hit FROM pc)""",
        """SELECT label, round(CAST(precision AS DOUBLE), 6) AS precision, round(CAST(recall AS DOUBLE), 6) AS recall, round(CAST(f1 AS DOUBLE), 6) AS f1, CAST(support AS BIGINT) AS support FROM (
   SELECT label, precision, recall, f1, support FROM pr
   UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM pr
   UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM pr
   UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM pr)""",
    )


_REPORT = report_sql("fx_cls_pred")


@query("classification_report", with_(CLS_PRED, _REPORT[0]) + _REPORT[1])
def classification_report(spark, sf):
    return _round(V.classification_report(fx_cls_pred(spark, sf), "y", "p"), 6, "precision", "recall", "f1")


def auc_sql(rel, y, score):
    return f"""(SELECT (sum(CASE WHEN {y} = 1 THEN rk END) - any_value(np) * (any_value(np) + 1) / 2.0) / (any_value(np) * any_value(nn)) FROM (
      SELECT {y}, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS rk,
             count(*) FILTER ({y} = 1) OVER () AS np, count(*) FILTER ({y} = 0) OVER () AS nn FROM {rel}))"""


@query("roc_auc", with_(CLS_PRED) + f"SELECT round(CAST({auc_sql('fx_cls_pred', 'y', 'n_words')} AS DOUBLE), 9) AS roc_auc")
def roc_auc(spark, sf):
    return _round(V.roc_auc(fx_cls_pred(spark, sf), "y", "n_words"), 9)


@query(
    "roc_auc_by_group",
    with_(PRED, "g AS (SELECT l_returnflag AS f, CAST(l_linestatus = 'F' AS INTEGER) AS t, l_quantity AS s FROM fx_pred)")
    + """, k AS (SELECT f, t, rank() OVER (PARTITION BY f ORDER BY s) + (count(*) OVER (PARTITION BY f, s) - 1) / 2.0 AS rk FROM g)
        SELECT f AS l_returnflag, round((sum(rk) FILTER (t = 1) - CAST(count(*) FILTER (t = 1) AS DOUBLE) * (count(*) FILTER (t = 1) + 1) / 2)
          / (CAST(count(*) FILTER (t = 1) AS DOUBLE) * count(*) FILTER (t = 0)), 9) AS roc_auc FROM k GROUP BY f""",
)
def roc_auc_by_group(spark, sf):
    rows = fx_pred(spark, sf).withColumn("t", (F.col("l_linestatus") == "F").cast("int"))
    return _round(V.roc_auc(rows, "t", "l_quantity", by=["l_returnflag"]), 9, "roc_auc")


@query("f1_score", with_(CLS_PRED) + "SELECT round(2.0 * count(*) FILTER (y = 1 AND p = 1) / (count(*) FILTER (y = 1) + count(*) FILTER (p = 1)), 9) AS f1 FROM fx_cls_pred")
def f1_score(spark, sf):
    return _round(V.evaluate(fx_cls_pred(spark, sf), "y", "p", ["f1"]), 9)


@query("residuals", with_(PRED) + "SELECT id, y - p AS residual FROM fx_pred")
def residuals(spark, sf):
    return V.with_residuals(fx_pred(spark, sf), "y", "p").select("id", "residual")


@query(
    "silhouette",
    with_(
        VEC,
        f"s AS (SELECT label, count(*) AS n, {', '.join(f'avg({c}) AS m_{c}' for c in DIMS)}, {' + '.join(f'var_pop({c})' for c in DIMS)} AS v FROM fx_vec GROUP BY label)",
        f"d AS (SELECT id, x.label AS own, s.label AS l, s.n, {' + '.join(f'({c} - m_{c}) * ({c} - m_{c})' for c in DIMS)} + v AS d FROM fx_vec x, s)",
        "ab AS (SELECT id, max(CASE WHEN own = l THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> l THEN d END) AS b FROM d GROUP BY id)",
    )
    + "SELECT round(avg((b - a) / greatest(a, b)), 9) AS silhouette FROM ab",
)
def silhouette(spark, sf):
    return _round(V.silhouette(fx_vec(spark, sf), DIMS, "label"), 9)


@query("custom_scorer", with_(PRED) + "SELECT round(-sqrt(avg(((y - p) / y) * ((y - p) / y))), 6) AS neg_rmspe, round(-avg(abs(y - p)), 6) AS neg_mae FROM fx_pred")
def custom_scorer(spark, sf):
    out = fx_pred(spark, sf).agg(V.scorer("rmspe")("y", "p").alias("neg_rmspe"), V.scorer("mae")("y", "p").alias("neg_mae"))
    return _round(out, 6)


@query(
    "compare_prediction_tables",
    with_(PRED, "a AS (SELECT id, p FROM fx_pred WHERE l_quantity < 45)", "b AS (SELECT id, y AS p FROM fx_pred WHERE l_quantity > 3)", "j AS (SELECT a.p - b.p AS gap FROM a FULL JOIN b ON a.id = b.id)")
    + """SELECT count(gap) AS n_both, count(*) FILTER (gap IS NULL) AS n_unmatched, round(sqrt(avg(gap * gap)), 6) AS rmse_between,
         max(abs(gap)) AS max_diff, count(*) FILTER (gap IS NULL OR gap <> 0) = 0 AS identical FROM j""",
)
def compare_prediction_tables(spark, sf):
    r = fx_pred(spark, sf)
    other = r.filter("l_quantity > 3").select("id", F.col("y").alias("p"))
    return _round(V.compare_predictions(r.filter("l_quantity < 45"), other, "id", "p"), 6, "rmse_between")


@query(
    "confusion_by_class",
    with_(CLS_PRED) + union_all(f"SELECT {v} AS y, count(*) AS n, count(*) FILTER (p = 1) AS n_predicted FROM fx_cls_pred WHERE y = {v}" for v in (0, 1)),
)
def confusion_by_class(spark, sf):
    rows = fx_cls_pred(spark, sf)
    parts = [equality_subset(rows, "y", v).groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == 1).alias("n_predicted")) for v in (0, 1)]
    return parts[0].unionByName(parts[1])
