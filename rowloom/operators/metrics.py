"""Regression and classification metrics as aggregates."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.lineage import cut_lineage, rows_within


def _d(c):
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def mse(y, p):
    e = _d(y) - _d(p)
    return F.avg(e * e)


def rmse(y, p):
    return F.sqrt(mse(y, p))


def rmspe(y, p, zero="null"):
    """Root mean squared relative error. Rows with y = 0: 'null' leaves them out, 'inf' makes it infinite."""
    y = _d(y)
    ratio = F.try_divide(y - _d(p), y)
    value = F.sqrt(F.avg(ratio * ratio))
    if zero == "inf":
        return F.when(F.count_if(y == 0.0) > 0, F.lit(float("inf"))).otherwise(value)
    return value


def mae(y, p):
    return F.avg(F.abs(_d(y) - _d(p)))


def r2(y, p):
    """1 - SSE/SST over the rows where both are present."""
    y, p = _d(y), _d(p)
    both = F.when(p.isNotNull(), y)
    e = y - p
    return 1.0 - F.try_divide(F.avg(e * e), F.var_pop(both))


def accuracy(y, p):
    return F.avg(F.when(_d(y) == _d(p), 1.0).otherwise(0.0))


def _rates(y, p, positive):
    hit = F.count_if((_d(y) == positive) & (_d(p) == positive))
    return hit, F.count_if(_d(p) == positive), F.count_if(_d(y) == positive)


def precision(y, p, positive=1):
    hit, said, _ = _rates(y, p, positive)
    return F.coalesce(F.try_divide(hit, said), F.lit(0.0))


def recall(y, p, positive=1):
    hit, _, is_ = _rates(y, p, positive)
    return F.coalesce(F.try_divide(hit, is_), F.lit(0.0))


def f1(y, p, positive=1):
    hit, said, is_ = _rates(y, p, positive)
    return F.coalesce(F.try_divide(2.0 * hit, said + is_), F.lit(0.0))


# name -> (aggregate over label and prediction columns, higher is better)
METRICS = {
    "mse": (mse, False),
    "rmse": (rmse, False),
    "rmspe": (rmspe, False),
    "mae": (mae, False),
    "r2": (r2, True),
    "accuracy": (accuracy, True),
    "precision": (precision, True),
    "recall": (recall, True),
    "f1": (f1, True),
}


def register_metric(name, aggregate, higher_is_better):
    """Own metric for searches and reports: aggregate(y, p) -> Column."""
    if name in METRICS:
        raise ValueError(f"metric {name} exists")
    METRICS[name] = (aggregate, higher_is_better)


def scorer(name):
    """aggregate(y, p) in which larger is always better."""
    aggregate, higher = METRICS[name]
    return aggregate if higher else (lambda y, p: -aggregate(y, p))


def evaluate(df, y, p, names, by=()) -> DataFrame:
    return df.groupBy(*by).agg(*[METRICS[n][0](y, p).alias(n) for n in names])


def with_residuals(df, y, p, name="residual"):
    return df.withColumn(name, _d(y) - _d(p))


def confusion_matrix(df, y, p, max_labels=1_000) -> DataFrame:
    """(actual, predicted, n) over all label pairs, zeros included; refuses more than `max_labels` labels."""
    seen = df.select(F.col(y).cast("string").alias("l")).union(df.select(F.col(p).cast("string").alias("l"))).distinct()
    if not rows_within(seen, max_labels):
        raise ValueError(f"more than {max_labels} labels: a full matrix of them would be huge; group or bin them first")
    counts = df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    labels = counts.agg(F.array_distinct(F.concat(F.collect_set("actual"), F.collect_set("predicted"))).alias("l"))
    cells = labels.select("l", F.explode("l").alias("actual")).select("actual", F.explode("l").alias("predicted"))
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def classification_report(df, y, p) -> DataFrame:
    """label, precision, recall, f1, support per class, then accuracy, macro avg and weighted avg."""
    counts = df.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    hits = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    by_actual = counts.select(F.col("actual").alias("l"), F.col("n").alias("sup"), F.lit(0).alias("said"), hits.alias("hit"))
    by_said = counts.select(F.col("predicted").alias("l"), F.lit(0).alias("sup"), F.col("n").alias("said"), F.lit(0).alias("hit"))
    sums = by_actual.union(by_said).groupBy("l").agg(*[F.sum(c).alias(c) for c in ("sup", "said", "hit")])
    zero = F.lit(0.0)
    per = sums.select(
        F.col("l").cast("string").alias("label"),
        F.coalesce(F.try_divide("hit", "said"), zero).alias("precision"),
        F.coalesce(F.try_divide("hit", "sup"), zero).alias("recall"),
        F.coalesce(F.try_divide(2.0 * F.col("hit"), F.col("sup") + F.col("said")), zero).alias("f1"),
        F.col("sup").alias("support"),
        "hit",
    )
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], total.alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names],
        total.alias("support"),
    )
    acc = F.sum("hit") / total
    overall = per.agg(F.lit("accuracy").alias("label"), *[acc.alias(c) for c in names], total.alias("support"))
    return per.drop("hit").unionByName(overall).unionByName(macro).unionByName(weighted)


def roc_auc(df, y, score, by=(), count=None) -> DataFrame:
    """Area under the ROC curve with ties averaged, per group. `count` names a column telling for how many rows each one stands.

    Mann-Whitney form: every positive counts the negatives below it. Equal scores
    collapse to one row first; a range sort then cuts the distinct scores into
    ordered parts, each part adds up its own pairs, and the few part totals
    supply what lies below each part. No group is ever ranked in one task.
    """
    by = list(by)
    positive, rows = F.when(_d(y) == 1.0, 1).otherwise(0), F.col(count) if count else F.lit(1)
    ties = df.filter(F.col(score).isNotNull()).groupBy(*by, _d(score).alias("_s")).agg(
        F.sum(positive * rows).alias("_pos"), F.sum((1 - positive) * rows).alias("_neg")
    )
    order = [*by, "_s"]
    parts = cut_lineage(ties.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    below = F.sum("_neg").over(Window.partitionBy("_part", *by).orderBy("_s")) - F.col("_neg")
    local = parts.withColumn("_u", F.col("_pos") * (below + F.col("_neg") / 2.0))
    totals = local.groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in ("_pos", "_neg", "_u")])
    ranked = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_part")  # one row per sort partition
    earlier = F.sum("_neg").over(ranked) - F.col("_neg")
    area = totals.withColumn("_u", F.col("_u") + F.col("_pos") * earlier)
    return area.groupBy(*by).agg(F.try_divide(F.sum("_u"), F.sum("_pos").cast("double") * F.sum("_neg")).alias("roc_auc"))


def compare_predictions(left, right, key, prediction) -> DataFrame:
    """Two stored prediction tables against each other."""
    a = left.select(key, _d(prediction).alias("_a"))
    b = right.select(key, _d(prediction).alias("_b"))
    gap = F.col("_a") - F.col("_b")
    return a.join(b, key, "full_outer").agg(
        F.count(gap).alias("n_both"),
        F.count_if(gap.isNull()).alias("n_unmatched"),
        F.sqrt(F.avg(gap * gap)).alias("rmse_between"),
        F.max(F.abs(gap)).alias("max_diff"),
        (F.count_if(gap.isNull() | (gap != 0.0)) == 0).alias("identical"),
    )


def silhouette(df, features, cluster) -> DataFrame:
    """Mean simplified silhouette with squared distances to cluster means.

    The mean squared distance from x to a cluster is |x - m|^2 + v (v = mean
    squared spread), so centroids and spreads (k rows) replace all pairs.
    """
    stats = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"m_{f}") for f in features],
        sum((F.var_pop(f) for f in features[1:]), F.var_pop(features[0])).alias("v"),
    ).collect()
    own = F.lit(None).cast("int")
    distances = []
    for i, r in enumerate(stats):
        own = F.when(F.col(cluster) == F.lit(r[cluster]), F.lit(i)).otherwise(own)
        gaps = [F.col(f) - F.lit(r[f"m_{f}"]) for f in features]
        distances.append(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) + F.lit(r["v"]))
    # within its own cluster a row is not compared with itself; a cluster of one scores 0
    correction = F.array(*[F.lit(r["n"] / (r["n"] - 1.0) if r["n"] > 1 else None).cast("double") for r in stats])
    scored = df.select(F.array(*distances).alias("_d"), own.alias("_own"))
    a = F.col("_d")[F.col("_own")] * correction[F.col("_own")]
    b = F.array_min(F.filter("_d", lambda d, i: i != F.col("_own")))
    near = scored.select(a.alias("_a"), b.alias("_b"), "_own")
    value = F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    return near.filter("_own is not null").agg(F.avg(value).alias("silhouette"))
