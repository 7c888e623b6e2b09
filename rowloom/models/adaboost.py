"""AdaBoost on MLlib trees: row weights live in a column, rounds run on the driver."""

import math

from pyspark.sql import functions as F

from rowloom.functions.lineage import cut_lineage
from rowloom.functions.nulls import complete_rows
from rowloom.functions.spreading import settle
from rowloom.models.spark_ml import decision_stump_weighted, decision_tree_regress

CUT_EVERY = 5


def _next(rows, i, held):
    """Weights of the next round: kept for its passes, written to the shared folder every few rounds."""
    if (i + 1) % CUT_EVERY:
        held.append(rows.persist())
        return held[-1]
    written = cut_lineage(rows)
    while held:
        held.pop().unpersist()
    return written


class AdaBoostRegressor:
    """Weighted median of the trees' predictions."""

    def __init__(self, trees, strengths):
        self.trees, self.strengths = trees, strengths

    def score(self, df, name="prediction"):
        out = df
        for i, t in enumerate(self.trees):
            out = t.score(out, f"_p{i}")
        pairs = F.array_sort(F.array(*[F.struct(F.col(f"_p{i}").alias("p"), F.lit(s).alias("s")) for i, s in enumerate(self.strengths)]))
        half = F.lit(0.5 * sum(self.strengths))
        start = F.struct(F.lit(0.0).alias("acc"), F.lit(None).cast("double").alias("p"))

        def step(state, e):
            acc = state["acc"] + e["s"]
            reached = state["p"].isNull() & (acc >= half * F.lit(1 - 1e-12))
            return F.struct(acc.alias("acc"), F.when(reached, e["p"]).otherwise(state["p"]).alias("p"))

        median = F.aggregate(pairs, start, step, lambda s: s["p"])
        return out.withColumn(name, median).drop(*[f"_p{i}" for i in range(len(self.trees))])


def adaboost_regress(df, features, target, n_estimators=50, learning_rate=1.0, max_depth=3, max_bins=64, seed=42):
    """AdaBoost.R2 with linear loss; weights enter the tree fit directly instead of by resampling."""
    rows = df.select(*features, target).transform(complete_rows).withColumn("_w", F.lit(1.0))
    rows = settle(rows)
    trees, strengths, held = [], [], [rows]
    n = rows.count()
    for i in range(n_estimators):
        tree = decision_tree_regress(rows, features, target, max_depth, max_bins=max_bins, seed=seed, weight="_w")
        scored = tree.score(rows, "_p").withColumn("_e", F.abs(F.col("_p") - F.col(target)))
        top, total, weighted = scored.agg(F.max("_e"), F.sum("_w"), F.sum(F.col("_w") * F.col("_e"))).first()
        if not top:
            return AdaBoostRegressor([tree], [1.0])
        loss = weighted / (top * total)
        if loss >= 0.5:
            if not trees:
                trees, strengths = [tree], [1.0]
            break
        beta = loss / (1.0 - loss)
        trees.append(tree)
        strengths.append(learning_rate * math.log(1.0 / beta))
        factor = F.pow(F.lit(beta), (F.lit(1.0) - F.col("_e") / F.lit(top)) * F.lit(learning_rate))
        rows = scored.withColumn("_w", F.col("_w") * factor * F.lit(n / total)).drop("_p", "_e")
        rows = _next(rows.withColumn("_w", F.greatest(F.col("_w"), F.lit(1e-300))), i, held)
    for table in held:
        table.unpersist()
    return AdaBoostRegressor(trees, strengths)


class AdaBoostClassifier:
    """Weighted vote; ties go to the smaller class."""

    def __init__(self, trees, strengths, classes):
        self.trees, self.strengths, self.classes = trees, strengths, classes

    def score(self, df, name="prediction"):
        out = df
        for i, t in enumerate(self.trees):
            out = t.score(out, f"_p{i}")
        votes = []
        for c in self.classes:
            total = F.lit(0.0)
            for i, s in enumerate(self.strengths):
                total = total + F.when(F.col(f"_p{i}") == F.lit(float(c)), F.lit(s)).otherwise(0.0)
            votes.append(total)
        best = F.greatest(*votes) if len(votes) > 1 else votes[0]
        label = F.lit(None)
        for c, v in reversed(list(zip(self.classes, votes))):
            label = F.when(v >= best, F.lit(c)).otherwise(label)
        return out.withColumn(name, label).drop(*[f"_p{i}" for i in range(len(self.trees))])


def adaboost_classify(df, features, label, n_estimators=50, learning_rate=1.0, max_depth=1, max_bins=64, seed=42):
    """SAMME: misclassified rows gain weight, every round votes with its log odds."""
    classes = sorted(r[0] for r in df.select(label).distinct().collect())
    k = len(classes)
    rows = settle(df.select(*features, label).transform(complete_rows).withColumn("_w", F.lit(1.0)))
    trees, strengths, held = [], [], [rows]
    n = rows.count()
    for i in range(n_estimators):
        tree = decision_stump_weighted(rows, features, label, "_w", max_depth, max_bins, seed)
        scored = tree.score(rows, "_p").withColumn("_miss", (F.col("_p") != F.col(label).cast("double")).cast("double"))
        total, wrong = scored.agg(F.sum("_w"), F.sum(F.col("_w") * F.col("_miss"))).first()
        error = wrong / total
        if error <= 0:
            return AdaBoostClassifier(trees + [tree], strengths + [1.0 + sum(strengths)], classes)
        if error >= 1.0 - 1.0 / k:
            if not trees:
                trees, strengths = [tree], [1.0]
            break
        strength = learning_rate * (math.log((1.0 - error) / error) + math.log(k - 1.0))
        trees.append(tree)
        strengths.append(strength)
        rows = _next(scored.withColumn("_w", F.col("_w") * F.exp(F.lit(strength) * F.col("_miss")) * F.lit(n / total)).drop("_p", "_miss"), i, held)
    for table in held:
        table.unpersist()
    return AdaBoostClassifier(trees, strengths, classes)
