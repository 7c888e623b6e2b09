"""Cross-validation, parameter search and model comparison.

Methods whose fit is a sum over rows (ridge, naive Bayes) and nearest neighbours
judge all candidates in one pass per fold set. Other models run a driver loop
over candidate and fold; the fits themselves are Spark jobs.
"""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.lineage import cut_lineage
from rowloom.functions.moments import grouped_moments
from rowloom.functions.nulls import complete_rows
from rowloom.models.bayes import class_statistics, model_from_statistics
from rowloom.models.linear import LinearModel, fit_ridge, holdout_mse
from rowloom.operators.metrics import METRICS, evaluate, roc_auc
from rowloom.operators.neighbors import knn_join, predict_from_neighbors
from rowloom.search.candidates import describe_params, random_candidates


def fold_values(df, fold="fold") -> list:
    return sorted(r[0] for r in df.select(fold).distinct().collect())


def score_by_fold(df, models: dict, fold="fold", **score) -> DataFrame:
    """Every row scored by the model of its own fold; rows of other folds are left out.

    Linear models, forests, boosted trees and networks read the table once, whatever the number of
    folds: a row is given to its fold's model alone. Other models score fold after fold.
    """
    rows, kinds = df.filter(F.col(fold).isin(list(models))), {type(m) for m in models.values()}
    if kinds == {LinearModel}:
        value = F.lit(None).cast("double")
        for f, m in models.items():
            value = F.when(F.col(fold) == F.lit(f), m.expression()).otherwise(value)
        return rows.withColumn(score.get("name", "prediction"), value)
    first = next(iter(models.values()))
    alike = len(kinds) == 1 and len({getattr(m, "link", None) for m in models.values()}) == 1
    if not alike or not hasattr(first, "raw"):
        parts = [m.score(df.filter(F.col(fold) == F.lit(f)), **score) for f, m in models.items()]
        return reduce(DataFrame.unionByName, parts)
    names = sorted({c for m in models.values() for c in m.features})
    turns = [(m, [names.index(c) for c in m.features]) for m in models.values()]
    turn = F.lit(-1)
    for i, f in enumerate(models):
        turn = F.when(F.col(fold) == F.lit(f), F.lit(i)).otherwise(turn)

    @F.pandas_udf("double")
    def raw(which: pd.Series, *columns: pd.Series) -> pd.Series:
        x, which = np.column_stack(columns), which.to_numpy()
        out = np.full(len(x), np.nan)
        for i, (model, at) in enumerate(turns):
            if (mine := which == i).any():
                out[mine] = model.raw(x[mine][:, at])
        return pd.Series(out)

    return first.finish(rows, raw(turn, *[F.col(c).cast("double") for c in names]), **score)


def cross_val_predict(df, fit, fold="fold", resample=None, **score) -> DataFrame:
    """Every row scored by the model that was fitted without its fold.

    `fit(train) -> model with .score(df)`; `resample(train)` acts on training rows only;
    further options go to `.score`, such as probability="probability". A table without a fold
    raises ValueError.
    """
    models = {}
    for f in fold_values(df.filter(F.col(fold).isNotNull()), fold):
        train = df.filter(F.col(fold) != F.lit(f))
        models[f] = fit(resample(train) if resample else train)
    if not models:
        raise ValueError("no row has a fold")
    return score_by_fold(df, models, fold, **score)


def cv_score_table(df, fit, target, metrics=("mse",), fold="fold", resample=None) -> DataFrame:
    """(fold, metric columns) on held-out rows; roc_auc needs models that score a probability."""
    plain = [m for m in metrics if m != "roc_auc"]
    if len(plain) == len(metrics):
        return evaluate(cross_val_predict(df, fit, fold, resample), target, "prediction", metrics, by=[fold])
    scored = cross_val_predict(df, fit, fold, resample, probability="probability")
    area = roc_auc(scored, target, "probability", [fold])
    return area.join(evaluate(scored, target, "prediction", plain, by=[fold]), fold) if plain else area


def _higher(metric):
    return True if metric == "roc_auc" else METRICS[metric][1]


def search_and_refit(df, fit_with, candidates, target, metric="mse", fold="fold"):
    """(best model refitted on all rows, score table)."""
    table = search_cv(df, fit_with, candidates, target, metric, fold)
    best = table.filter("is_best").first()["candidate_id"]
    return fit_with(df, **candidates[best]), table


def _best(rows, metric, higher):
    """First candidate with the best mean score."""
    sign = -1.0 if higher else 1.0
    return min(rows, key=lambda r: (sign * r[1], r[0]))


def search_cv(df, fit_with, candidates, target, metric="mse", fold="fold", parallelism=4) -> DataFrame:
    """(candidate_id, params, mean_score, std_score, is_best) for `fit_with(train, **params)`.

    `parallelism` candidates run their jobs at the same time, which fills the gaps
    between the short stages of iterative fits.
    """

    def judge(numbered):
        i, params = numbered
        scores = cv_score_table(df, lambda t: fit_with(t, **params), target, (metric,), fold)
        values = np.array([r[metric] for r in scores.collect()], dtype=float)
        return i, float(values.mean()), float(values.std()), describe_params(params)

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(judge, enumerate(candidates)))
    best = _best(rows, metric, _higher(metric))[0]
    table = [(i, p, m, s, i == best) for i, m, s, p in rows]
    return df.sparkSession.createDataFrame(
        table, "candidate_id int, params string, mean_score double, std_score double, is_best boolean"
    )


def search_boosted(df, features, target, candidates, metrics=("roc_auc",), loss="logistic", fold="fold", key=None, max_bins=64, **common) -> DataFrame:
    """(candidate_id, params, a mean and a std column for each metric, is_best): boosted trees of all candidates and folds at once.

    One trainer serves every candidate and fold over one binned table and gives each row the margin of the model that left its fold
    out, so no model is shipped for scoring. All metrics are grouped aggregates over one long table; the first one picks the best.
    """
    from rowloom.models.boosting import boost_many, candidates_by_fold
    from rowloom.models.trees import Tree

    folds = fold_values(df, fold)
    jobs = candidates_by_fold(candidates, folds, loss=loss, **common)
    _, _, _, held = boost_many(df, features, target, jobs, Tree, key, fold, max_bins, scored=True, counted=True)
    rows = held.withColumn("candidate_id", F.floor(F.col("job") / len(folds)).cast("int"))
    prediction = (F.col("margin") > 0).cast("int") if loss == "logistic" else F.col("margin")
    rows, by = cut_lineage(rows.withColumn("prediction", prediction)), ["candidate_id", "fold"]
    each = rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))  # metrics may be any aggregate
    table = None
    for part in ([roc_auc(rows, "y", "margin", by, "n")] if "roc_auc" in metrics else []) + ([evaluate(each, "y", "prediction", plain, by=by)] if (plain := [m for m in metrics if m != "roc_auc"]) else []):
        table = part if table is None else table.join(part, by)
    means = [x for m in metrics for x in (F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}"))]
    means = table.groupBy("candidate_id").agg(*means)
    names = df.sparkSession.createDataFrame([(i, describe_params(c)) for i, c in enumerate(candidates)], "candidate_id int, params string")
    first = F.col(f"mean_{metrics[0]}")
    place = F.row_number().over(Window.orderBy(first.desc() if _higher(metrics[0]) else first.asc(), "candidate_id"))
    return names.join(means, "candidate_id").withColumn("is_best", place == 1)


def sweep_extra_trees(train, holdout, features, target, candidates, n_estimators=100, metrics=("rmspe", "rmse"), seed=42) -> DataFrame:
    """(params, metric columns) on the holdout for extra trees of every candidate, grown side by side; best first metric on top."""
    from rowloom.models.trees import sweep_forests

    scored = sweep_forests(train, holdout, features, target, candidates, n_estimators, seed)
    names = train.sparkSession.createDataFrame([(i, describe_params(c)) for i, c in enumerate(candidates)], "candidate int, params string")
    return evaluate(scored, "y", "prediction", metrics, by=["candidate"]).join(names, "candidate").select("params", *metrics).orderBy(metrics[0], "params")


def grid_search_knn(df, key, features, target, ks, weights=("uniform",), task="regress", metric=None, fold="fold", p=2) -> DataFrame:
    """(k, weights, mean_score, std_score, is_best): one neighbour search per fold serves every candidate."""
    metric = metric or ("mse" if task == "regress" else "accuracy")
    largest = max(ks)
    aggregate, higher = METRICS[metric]
    parts = None
    for f in fold_values(df, fold):
        held = df.filter(F.col(fold) == F.lit(f))
        near = knn_join(held, df.filter(F.col(fold) != F.lit(f)), features, key, largest, p=p, carry=[target])
        near = near.withColumn(fold, F.lit(f))
        parts = near if parts is None else parts.unionByName(near)
    # every neighbour row counts for each candidate whose k reaches its rank
    reaching = F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank")))
    weighted = parts.withColumn("weights", F.explode(F.array(*[F.lit(w) for w in weights]))).withColumn("k", reaching)
    scored = predict_from_neighbors(weighted, target, F.col("weights"), task, by=["k", "weights"])
    truth = df.select(F.col(key).alias("query_id"), F.col(target).alias("_truth"), fold)
    per_fold = scored.join(truth, "query_id").groupBy("k", "weights", fold).agg(aggregate("_truth", "prediction").alias("score"))
    return _mark_best(per_fold, ["k", "weights"], higher, fold)


def _mark_best(per_fold, names, higher, fold="fold"):
    """Candidate means over folds; the result has one row per candidate."""
    means = per_fold.groupBy(*names).agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    order = F.col("mean_score").desc() if higher else F.col("mean_score").asc()
    place = F.row_number().over(Window.orderBy(order, *names))
    return means.withColumn("is_best", place == 1)


def _nb_fold_scores(df, features, label, smoothings, fold):
    """Every row scored once per smoothing value by the model fitted without its fold."""
    full = complete_rows(df, [*features, label])
    stats = class_statistics(full, features, label, by=[fold]).collect()
    options = F.explode(F.array(*[F.lit(float(s)) for s in smoothings])).alias("var_smoothing")
    out = None
    for f in sorted({r[fold] for r in stats}):
        model = model_from_statistics([r for r in stats if r[fold] != f], features, label)
        held = full.filter(F.col(fold) == F.lit(f)).select("*", options)
        part = model.score(held, margin="margin", smoothing=F.col("var_smoothing"))
        out = part if out is None else out.unionByName(part)
    return out


def multi_metric_search_nb(df, features, label, smoothings, metrics=("roc_auc", "f1"), refit="roc_auc", fold="fold") -> DataFrame:
    """(var_smoothing, mean of each metric, is_best): statistics once, one scoring pass for all candidates."""
    scored = _nb_fold_scores(df, features, label, smoothings, fold)
    by = ["var_smoothing", fold]
    plain = [m for m in metrics if m != "roc_auc"]
    per_fold = evaluate(scored, label, "prediction", plain, by) if plain else None
    if "roc_auc" in metrics:
        area = roc_auc(scored, label, "margin", by)
        per_fold = area if per_fold is None else per_fold.join(area, by)
    means = per_fold.groupBy("var_smoothing").agg(*[F.avg(m).alias(m) for m in metrics])
    order = F.col(refit).desc() if _higher(refit) else F.col(refit).asc()
    return means.withColumn("is_best", F.row_number().over(Window.orderBy(order, "var_smoothing")) == 1)


def grid_search_ridge(df, features, target, alphas, fold="fold") -> DataFrame:
    """(alpha, mean_score, std_score, is_best): fold co-moments in one pass answer every candidate and fold."""
    parts = grouped_moments(df, [*features, target], fold)
    whole = None
    for m in parts.values():
        whole = m if whole is None else whole.merge(m)
    rows = []
    for i, a in enumerate(alphas):
        errors = [holdout_mse(fit_ridge(whole.merge(m, -1), features, target, a), m, target) for m in parts.values()]
        rows.append((i, float(np.mean(errors)), float(np.std(errors)), float(a)))
    best = _best(rows, "mse", False)[0]
    return df.sparkSession.createDataFrame(
        [(a, m, s, i == best) for i, m, s, a in rows], "alpha double, mean_score double, std_score double, is_best boolean"
    )


def random_search_cv(df, fit_with, distributions, target, n_iter=10, metric="mse", fold="fold", seed=42) -> DataFrame:
    return search_cv(df, fit_with, random_candidates(df.sparkSession, distributions, n_iter, seed), target, metric, fold)


def benchmark_models(train, holdout, zoo, target, fold="fold", n_iter=50, metric="mse", seed=42) -> DataFrame:
    """(model, best_params, holdout_score, cv_mean, cv_std), best cross-validated score first.

    `zoo` lists (name, fit_with(train, **params), grid); repeated names are refused.
    """
    names = [z[0] for z in zoo]
    if len(set(names)) != len(names):
        raise ValueError("model names must differ")
    spark = train.sparkSession
    out = []
    for name, fit_with, grid in zoo:
        candidates = random_candidates(spark, grid, n_iter, seed) if grid else [{}]
        model, table = search_and_refit(train, fit_with, candidates, target, metric, fold)
        best = table.filter("is_best").first()
        held = evaluate(model.score(holdout), target, "prediction", (metric,)).first()[0]
        out.append((name, best["params"], held, best["mean_score"], best["std_score"]))
    result = spark.createDataFrame(out, "model string, best_params string, holdout_score double, cv_mean double, cv_std double")
    order = F.col("cv_mean").desc() if METRICS[metric][1] else F.col("cv_mean").asc()
    return result.orderBy(order, "model")


def product_sweep(train, holdout, fit_with, grid, target, metrics=("rmspe", "rmse")) -> DataFrame:
    """Every grid combination judged on the holdout, best first metric on top."""
    from rowloom.search.candidates import grid_list

    rows = []
    for params in grid_list(grid):
        got = evaluate(fit_with(train, **params).score(holdout), target, "prediction", metrics).first()
        rows.append((describe_params(params), *[float(got[m]) for m in metrics]))
    fields = ", ".join(f"{m} double" for m in metrics)
    return train.sparkSession.createDataFrame(rows, f"params string, {fields}").orderBy(metrics[0], "params")


def trim_sweep(df, column, settings) -> DataFrame:
    """(low_q, high_q, low, high, n_kept, share_kept) per quantile range: one quantile call, one count."""
    from rowloom.functions.quantiles import exact_quantiles

    found = exact_quantiles(df, {column: sorted({float(q) for s in settings for q in s})})
    cells = [
        F.struct(
            F.lit(float(a)).alias("low_q"), F.lit(float(b)).alias("high_q"),
            F.lit(found[(column, float(a))]).alias("low"), F.lit(found[(column, float(b))]).alias("high"),
            F.count_if(F.col(column).between(found[(column, float(a))], found[(column, float(b))])).alias("n_kept"),
            F.count(F.lit(1)).alias("n_all"),
        ).alias(f"s{i}")
        for i, (a, b) in enumerate(settings)
    ]
    wide = df.agg(*cells)
    rows = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(settings))])).alias("s")).select("s.*")
    return rows.withColumn("share_kept", F.col("n_kept") / F.col("n_all")).drop("n_all")
