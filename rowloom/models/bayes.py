"""Gaussian naive Bayes: class statistics in one aggregate, scoring as column expressions."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.nulls import complete_rows


class GaussianNB:
    """Classes, priors, means and population variances (smoothed by a share of the largest variance)."""

    def __init__(self, features, classes, prior, mean, var, largest, smoothing):
        self.features, self.classes = list(features), list(classes)
        self.prior, self.mean, self.var = prior, mean, var
        self.largest, self.smoothing = largest, smoothing

    def log_density(self, c, smoothing=None):
        """Joint log density of class c as a column; `smoothing` may be a number or a column."""
        smoothing = self.smoothing if smoothing is None else smoothing
        extra = (smoothing if not isinstance(smoothing, (int, float)) else F.lit(float(smoothing))) * F.lit(self.largest)
        total = F.lit(math.log(self.prior[c]))
        for f in self.features:
            v = F.lit(self.var[c][f]) + extra
            gap = F.col(f) - F.lit(self.mean[c][f])
            total = total - 0.5 * F.log(F.lit(2.0 * math.pi) * v) - 0.5 * gap * gap / v
        return total

    def score(self, df, name="prediction", probability=None, margin=None, smoothing=None) -> DataFrame:
        """Most likely class (ties: smallest); optionally the probability of the last class
        and its log odds against the first."""
        logs = {c: self.log_density(c, smoothing) for c in self.classes}
        out = df.withColumns({f"_l{i}": v for i, v in enumerate(logs.values())})
        names = [F.col(f"_l{i}") for i in range(len(self.classes))]
        best = F.greatest(*names) if len(names) > 1 else names[0]
        label = F.lit(None)
        for c, l in reversed(list(zip(self.classes, names))):
            label = F.when(l >= best, F.lit(c)).otherwise(label)
        out = out.withColumn(name, label)
        if probability:
            total = F.exp(names[0] - best)
            for l in names[1:]:
                total = total + F.exp(l - best)
            out = out.withColumn(probability, F.exp(names[-1] - best) / total)
        if margin:
            out = out.withColumn(margin, names[-1] - names[0])
        return out.drop(*[f"_l{i}" for i in range(len(self.classes))])

    def table(self, spark):
        rows = [(c, f, self.prior[c], self.mean[c][f], self.var[c][f]) for c in self.classes for f in self.features]
        return spark.createDataFrame(rows, ["label", "column_name", "prior", "mean", "variance"])


def class_statistics(df, features, label, by=()):
    """Mergeable sums per class (and fold): n, sum x and sum x^2 around the feature means.

    Feature means come from the same pass in double precision, shifted by class.
    """
    return df.groupBy(*by, label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.var_pop(f).alias(f"v_{f}") for f in features],
    )


def _merge(rows, features):
    n = sum(r["n"] for r in rows)
    mean = {f: sum(r["n"] * r[f"m_{f}"] for r in rows) / n for f in features}
    var = {
        f: sum(r["n"] * (r[f"v_{f}"] + (r[f"m_{f}"] - mean[f]) ** 2) for r in rows) / n for f in features
    }
    return n, mean, var


def model_from_statistics(rows, features, label, var_smoothing=1e-9, priors=None) -> GaussianNB:
    classes = sorted({r[label] for r in rows})
    total, _, whole = _merge(rows, features)
    prior, mean, var = {}, {}, {}
    for c in classes:
        n, mean[c], var[c] = _merge([r for r in rows if r[label] == c], features)
        prior[c] = n / total if priors is None else priors[c]
    return GaussianNB(features, classes, prior, mean, var, max(whole.values()), var_smoothing)


def fit_gaussian_nb(df, features, label, var_smoothing=1e-9, priors=None) -> GaussianNB:
    full = complete_rows(df, [*features, label])
    rows = class_statistics(full, features, label).collect()
    return model_from_statistics(rows, features, label, var_smoothing, priors)
