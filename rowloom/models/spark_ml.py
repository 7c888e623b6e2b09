"""Estimators that MLlib provides, on plain columns and with penalties in the usual units."""

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from rowloom.functions.nulls import complete_rows
from rowloom.functions.spreading import settle

MAX_DEPTH = 30  # deepest tree MLlib grows
BAGS = 10  # trees that MLlib grows together; it keeps a count for each of them beside every row


class Fitted:
    """A fitted MLlib model that scores plain columns."""

    def __init__(self, model, features):
        self.model, self.features = model, list(features)

    def score(self, df, name="prediction", probability=None):
        rows = assemble(df, self.features)
        out = self.model.transform(rows).withColumn(name, F.col("_prediction"))
        if probability:
            source = "_probability" if "_probability" in out.columns else "_raw"
            out = out.withColumn(probability, vector_to_array(source)[1])
        return out.drop("_x", "_prediction", "_probability", "_raw")

    @property
    def importances(self):
        return self.model.featureImportances.toArray()


class Voted:
    """Forests whose trees vote together, as those of one forest do."""

    def __init__(self, forests):
        self.forests, self.features = forests, forests[0].features

    def score(self, df, name="prediction", probability=None):
        out, raws = assemble(df, self.features), []
        for i, f in enumerate(self.forests):
            raws.append(f"_raw{i}")
            out = f.model.copy().setRawPredictionCol(raws[-1]).setProbabilityCol("").setPredictionCol("").transform(out)
        votes = F.array(*[sum(vector_to_array(r)[k] for r in raws) for k in range(self.forests[0].model.numClasses)])
        out = out.withColumn("_votes", votes).withColumn(name, (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"))
        if probability:
            out = out.withColumn(probability, F.col("_votes")[1] / F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b))
        return out.drop("_x", "_votes", *raws)

    @property
    def importances(self):
        shares = [f.model.getNumTrees * f.importances for f in self.forests]
        return sum(shares) / max(sum(map(sum, shares)), 1e-300)


def assemble(df, features):
    return VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="skip").transform(df)


def _fit(make, df, features, label, weight=None):
    """Fit `make(row count)` on the settled feature columns."""
    kept = [*features, *([weight] if weight else [])]
    rows = settle(complete_rows(df.select(*kept, F.col(label).cast("double").alias("_y"))))
    try:
        estimator = make(rows.count())
        estimator.setFeaturesCol("_x").setLabelCol("_y").setPredictionCol("_prediction")
        if estimator.hasParam("rawPredictionCol"):
            estimator.setRawPredictionCol("_raw")
        if estimator.hasParam("probabilityCol"):
            estimator.setProbabilityCol("_probability")
        if weight:
            estimator.setWeightCol(weight)
        return Fitted(estimator.fit(assemble(rows, features)), features)
    finally:
        rows.unpersist()


def _tree(max_depth, min_samples_leaf, max_bins, seed):
    if max_depth is None or max_depth > MAX_DEPTH:
        raise ValueError(f"these trees grow to depth {MAX_DEPTH}; extra trees and second-order boosting have no limit")
    return dict(maxDepth=max_depth, minInstancesPerNode=min_samples_leaf, maxBins=max_bins, seed=seed)


def logistic_regression(df, features, label, c=1.0, penalty="l2", l1_ratio=None, max_iter=100, tol=1e-6):
    """Penalty l1, l2, elasticnet (with l1_ratio) or none; its strength is 1/c per data set, i.e. 1/(c n) in MLlib's mean loss."""
    mixes = {"l1": 1.0, "l2": 0.0, "elasticnet": l1_ratio, "none": 0.0, None: 0.0}
    if mixes.get(penalty) is None or not 0 <= mixes[penalty] <= 1:
        raise ValueError("penalty is l1, l2, none, or elasticnet with an l1_ratio from 0 to 1")
    mix = mixes[penalty]
    options = dict(elasticNetParam=mix, standardization=False, maxIter=max_iter, tol=tol)
    return _fit(lambda n: LogisticRegression(regParam=0.0 if penalty in (None, "none") else 1.0 / (c * n), **options), df, features, label)


def linear_svc(df, features, label, c=1.0, max_iter=100):
    return _fit(lambda n: LinearSVC(regParam=1.0 / (c * n), standardization=False, maxIter=max_iter), df, features, label)


def decision_tree_classify(df, features, label, max_depth=MAX_DEPTH, min_samples_leaf=1, max_bins=64, seed=42):
    return _fit(lambda n: DecisionTreeClassifier(**_tree(max_depth, min_samples_leaf, max_bins, seed)), df, features, label)


def decision_tree_regress(df, features, label, max_depth=MAX_DEPTH, min_samples_leaf=1, max_bins=64, seed=42, weight=None):
    options = _tree(max_depth, min_samples_leaf, max_bins, seed)
    return _fit(lambda n: DecisionTreeRegressor(**options), df, features, label, weight)


def decision_stump_weighted(df, features, label, weight, max_depth=1, max_bins=64, seed=42):
    return _fit(lambda n: DecisionTreeClassifier(**_tree(max_depth, 1, max_bins, seed)), df, features, label, weight)


def random_forest_classify(df, features, label, n_estimators=100, max_depth=MAX_DEPTH, min_samples_leaf=1, max_bins=64, seed=42):
    """Above `BAGS` trees the forest is grown in parts, as MLlib writes the counts of all its trees beside every row."""
    parts = []
    for i in range(0, n_estimators, BAGS):
        options = _tree(max_depth, min_samples_leaf, max_bins, seed + i)
        parts.append(_fit(lambda n, i=i, o=options: RandomForestClassifier(numTrees=min(BAGS, n_estimators - i), **o), df, features, label))
    return parts[0] if len(parts) == 1 else Voted(parts)


def random_forest_regress(
    df, features, label, n_estimators=100, max_depth=MAX_DEPTH, min_samples_leaf=1, max_bins=64, max_features="all", seed=42
):
    options = dict(numTrees=n_estimators, featureSubsetStrategy=max_features, **_tree(max_depth, min_samples_leaf, max_bins, seed))
    return _fit(lambda n: RandomForestRegressor(**options), df, features, label)


def _boosting(n_estimators, learning_rate, max_depth, subsample, max_features, min_samples_leaf, max_bins, seed):
    return dict(
        maxIter=n_estimators, stepSize=learning_rate, subsamplingRate=subsample, featureSubsetStrategy=max_features,
        **_tree(max_depth, min_samples_leaf, max_bins, seed),
    )


def gradient_boosting_classify(
    df, features, label, n_estimators=100, learning_rate=0.1, max_depth=3, subsample=1.0, max_features="all",
    min_samples_leaf=1, max_bins=64, seed=42,
):
    options = _boosting(n_estimators, learning_rate, max_depth, subsample, max_features, min_samples_leaf, max_bins, seed)
    return _fit(lambda n: GBTClassifier(**options), df, features, label)


def gradient_boosting_regress(
    df, features, label, n_estimators=100, learning_rate=0.1, max_depth=3, subsample=1.0, max_features="all",
    min_samples_leaf=1, max_bins=64, seed=42,
):
    options = _boosting(n_estimators, learning_rate, max_depth, subsample, max_features, min_samples_leaf, max_bins, seed)
    return _fit(lambda n: GBTRegressor(**options), df, features, label)


def kmeans(df, features, k=2, max_iter=20, seed=42):
    rows = settle(complete_rows(df.select(*features)))
    try:
        model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="_x", predictionCol="_prediction").fit(assemble(rows, features))
        return Fitted(model, features)
    finally:
        rows.unpersist()


def lloyd_step(df, features, centers) -> "DataFrame":
    """One k-means update from given centers: (cluster, n, mean of each feature)."""
    label, distances = F.lit(None).cast("int"), []
    for c in centers:
        d = F.lit(0.0)
        for f, v in zip(features, c):
            d = d + (F.col(f) - F.lit(float(v))) * (F.col(f) - F.lit(float(v)))
        distances.append(d)
    best = F.least(*distances)
    for i, d in reversed(list(enumerate(distances))):
        label = F.when(d <= best, F.lit(i)).otherwise(label)
    return df.withColumn("cluster", label).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in features]
    )
