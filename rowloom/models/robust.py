"""Regression that withstands gross outliers: fits on many small random row subsets."""

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rowloom.functions.hashing import hash32, uniform_draws, unit_interval
from rowloom.functions.moments import moments, sum_over_rows
from rowloom.functions.nulls import complete_rows
from rowloom.functions.quantiles import exact_quantiles
from rowloom.functions.ranking import hash_rank
from rowloom.functions.spreading import settle
from rowloom.models.linear import LinearModel, fit_least_squares

SUBSETS_PER_LOT = 250  # solved in one task call
CROSS_PRODUCTS = 2_000_000  # sums one pass keeps per task
SMALL_SUBSET = 4  # up to so many rows per weight a subset is solved from its rows, else from cross products


def _design(x, intercept):
    return np.column_stack([x, np.ones(len(x))]) if intercept else x


def _with_bias(fits, intercept):
    return fits if intercept else np.column_stack([fits, np.zeros(len(fits))])


def subset_fits(df, key, features, target, subsets, size, seed=42, intercept=True) -> np.ndarray:
    """(subsets, p + 1) least-squares fits [w, intercept] on random disjoint row sets.

    The rows with the smallest hashes are a uniform sample and come from a bounded
    top-n. A table too small for that is dealt several times in other orders. Meant for small
    subsets: subsets x size rows, a product of parameters, are sorted and solved.
    """
    features = list(features)
    rows = df.select(F.col(key).cast("string").alias("_id"), *[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("_y")).transform(complete_rows)
    n = rows.limit(subsets * size).count()
    if n < size:
        raise ValueError("fewer rows than one subset needs")
    rounds = -(-subsets // (n // size))
    dealt = rows.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    mixed = dealt.withColumn("_h", hash32(F.concat_ws(":", "_round", "_id"), seed))
    sample = mixed.orderBy("_round", "_h", "_id").limit(rounds * n)
    ranked = hash_rank(sample.withColumn("_deal", F.concat_ws(":", "_round", "_id")), "_deal", by=["_round"], seed=seed, name="_place")
    grouped = (
        ranked.withColumn("_subset", F.floor(F.col("_place") / F.lit(size)))
        .filter(F.col("_subset") < n // size)
        .withColumn("_subset", F.col("_round") * F.lit(n // size) + F.col("_subset"))
        .filter(F.col("_subset") < subsets)
    )

    def solve(pdf):
        x, y = _design(pdf[features].to_numpy(float), intercept), pdf["_y"].to_numpy(float)
        lots = pdf.groupby("_subset").indices
        return pd.DataFrame({"_subset": list(lots), "w": [np.linalg.lstsq(x[i], y[i], rcond=None)[0] for i in lots.values()]})

    lots = F.floor(F.col("_subset") / F.lit(SUBSETS_PER_LOT))
    fits = grouped.groupBy(lots.alias("_lot")).applyInPandas(solve, "_subset bigint, w array<double>").collect()
    return _with_bias(np.array([r["w"] for r in sorted(fits)], dtype=float), intercept)


def share_fits(df, key, features, target, trials, share, seed=42) -> np.ndarray:
    """(trials, p + 1) least-squares fits, each on a random share of all rows.

    One pass sums the cross products of every trial; a row's coin flips come from its key hash.
    """
    features = list(features)
    p = len(features)
    m = moments(df, [*features, target])
    rows = df.select(*features, target, hash32(key, seed).cast("double").alias("_u"))

    def block(z):
        x = np.column_stack([z[:, : p + 1] - m.mean, np.ones(len(z))])
        parts = [x[uniform_draws(z[:, p + 1], t + 1) < share] for t in range(trials)]
        return np.concatenate([(part.T @ part).ravel() for part in parts])

    sums = sum_over_rows(rows, [*features, target, "_u"], block, trials * (p + 2) ** 2).reshape(trials, p + 2, p + 2)
    fits = np.zeros((trials, p + 1))
    x, y = [*range(p), p + 1], p
    for t in range(trials):
        w = np.linalg.lstsq(sums[t][np.ix_(x, x)], sums[t][x, y], rcond=None)[0]
        fits[t, :p], fits[t, p] = w[:p], w[p] + m.mean[p] - w[:p] @ m.mean[:p]
    return fits


def scattered(ranks, n, salt):
    """The ranks 0..n-1 of a batch under a fixed random permutation of 0..n-1; salt 0 leaves them as they are.

    Four Feistel rounds permute the next power of four; places beyond n go round again.
    """
    places = np.asarray(ranks, dtype=np.int64)
    if salt == 0 or n < 2:
        return places
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def once(v):
        left, right = v >> half, v & mask
        for turn in range(4):
            mixed = (uniform_draws(right, salt * 4 + turn) * (mask + 1)).astype(np.int64)
            left, right = right, left ^ mixed
        return (left << half) | right

    places = once(places)
    while (far := places >= n).any():
        places[far] = once(places[far])
    return places


def large_subset_fits(df, key, features, target, subsets, size, seed=42, intercept=True) -> np.ndarray:
    """(subsets, p + 1) least-squares fits on random row sets of exactly `size` rows, from their cross products.

    Rows get one random rank. n // size disjoint subsets are runs of ranks; further ones are runs of
    permuted ranks, worked out inside the tasks, so rows move once however many subsets they join.
    Where the subsets need less than the table, rows beyond a hash threshold don't move at all.
    """
    features = list(features)
    p, needed = len(features), subsets * size
    names = [f"_x{i}" for i in range(p)]
    rows = df.select(
        F.col(key).cast("string").alias("_id"), *[F.col(c).cast("double").alias(v) for c, v in zip(features, names)], F.col(target).cast("double").alias("_y")
    ).transform(complete_rows)
    n = rows.count()
    if n < size:
        raise ValueError("fewer rows than one subset needs")
    if n > 2 * needed:
        reach = 1.1 * needed / n
        while (near := rows.filter(unit_interval("_id", seed) < reach)).count() < needed and reach < 1:
            reach *= 2
        rows = near if reach < 1 else rows
    ranked = settle(hash_rank(rows, "_id", seed=seed, name="_rank").select(*names, "_y", "_rank"))
    try:
        m = moments(ranked, [*names, "_y"])
        total = m.n
        center = m.mean if intercept else np.zeros(p + 1)
        each, q = total // size, p + 1 + bool(intercept)
        lot = max(1, CROSS_PRODUCTS // (q * q))
        fits = []
        for first in range(0, subsets, lot):
            last = min(first + lot, subsets)

            def block(z, first=first, last=last):
                x = z[:, : p + 1] - center
                x = np.column_stack([x, np.ones(len(x))]) if intercept else x
                pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), q * q)
                out = np.zeros((last - first, q * q))
                for r in range(first // each, (last - 1) // each + 1):
                    place = scattered(z[:, p + 1].astype(np.int64), total, r)
                    subset = np.where(place < each * size, place // size + r * each - first, -1)
                    mine = (subset >= 0) & (subset < last - first)
                    order = np.argsort(subset[mine], kind="stable")
                    if len(order):
                        ids, starts = np.unique(subset[mine][order], return_index=True)
                        out[ids] += np.add.reduceat(pairs[mine][order], starts, axis=0)
                return out.ravel()

            sums = sum_over_rows(ranked, [*names, "_y", "_rank"], block, (last - first) * q * q).reshape(-1, q, q)
            x = [i for i in range(q) if i != p]
            w = (np.linalg.pinv(sums[:, x][:, :, x], hermitian=True) @ sums[:, x, p][..., None])[..., 0]
            bias = w[:, p] + center[p] - w[:, :p] @ center[:p] if intercept else np.zeros(len(w))
            fits.append(np.column_stack([w[:, :p], bias]))
    finally:
        ranked.unpersist()
    return np.concatenate(fits)


def spatial_median(points, max_iter=300, tol=1e-10):
    """Point with the least summed distance to all others (Weiszfeld steps)."""
    center = np.median(points, axis=0)
    for _ in range(max_iter):
        d = np.linalg.norm(points - center, axis=1)
        w = 1.0 / np.maximum(d, 1e-12 * max(1.0, d.max()))
        new = (points * w[:, None]).sum(axis=0) / w.sum()
        if np.linalg.norm(new - center) <= tol * max(1.0, np.linalg.norm(center)):
            return new
        center = new
    return center


def every_subset_fit(df, features, target, size, intercept=True) -> np.ndarray:
    """Least-squares fits on all row subsets of a size, for tables whose number of subsets a parameter bounds."""
    rows = df.select(*[F.col(c).cast("double") for c in [*features, target]]).transform(complete_rows).collect()
    table = np.array([tuple(r) for r in sorted(rows)], dtype=float)
    x, y = _design(table[:, :-1], intercept), table[:, -1]
    fits = [np.linalg.lstsq(x[list(s)], y[list(s)], rcond=None)[0] for s in itertools.combinations(range(len(table)), size)]
    return _with_bias(np.array(fits), intercept)


def fit_theil_sen(df, key, features, target, max_subpopulation=10_000, n_subsamples=None, seed=42, intercept=True) -> LinearModel:
    """Spatial median of least-squares fits on subsets of one row per weight (or `n_subsamples`).

    All subsets where there are at most `max_subpopulation`, else that many random ones. Without
    an intercept it is 0. A table with fewer rows than one subset needs raises ValueError.
    """
    weights = len(features) + bool(intercept)
    size = n_subsamples or weights
    if size < weights:
        raise ValueError("a subset needs a row for every weight")
    n = df.select(*features, target).transform(complete_rows).limit(int(max_subpopulation) + 1).count()
    if size <= n <= max_subpopulation and math.comb(n, size) <= max_subpopulation:
        fits = every_subset_fit(df, features, target, size, intercept)
    elif size <= SMALL_SUBSET * weights:
        fits = subset_fits(df, key, features, target, int(max_subpopulation), size, seed, intercept)
    else:
        fits = large_subset_fits(df, key, features, target, int(max_subpopulation), size, seed, intercept)
    if not intercept and len(features) == 1:
        return LinearModel(list(features), np.median(fits[:, :1], axis=0), 0.0)
    w = spatial_median(fits if intercept else fits[:, :-1])
    return LinearModel(list(features), w[: len(features)], float(w[-1]) if intercept else 0.0)


def fit_ransac(df, key, features, target, min_samples=None, residual_threshold=None, max_trials=100, seed=42) -> LinearModel:
    """Best consensus fit: every trial model is judged in one shared pass, the winner is refitted on its inliers.

    `min_samples` below 1 is a share of the rows, which then joins each trial by a
    coin flip on its key; the threshold defaults to the median absolute deviation
    of the target. More inliers win, then a higher R^2.
    """
    features = list(features)
    p = len(features)
    table = df.select(key, *features, target).transform(complete_rows)
    size = p + 1 if min_samples is None else min_samples
    if residual_threshold is None:
        middle = exact_quantiles(table, {target: [0.5]})[(target, 0.5)]
        spread = table.select(F.abs(F.col(target) - F.lit(middle)).alias("d"))
        residual_threshold = exact_quantiles(spread, {"d": [0.5]})[("d", 0.5)]
    if size < 1:
        fits = share_fits(table, key, features, target, max_trials, size, seed)
    else:
        fits = subset_fits(table, key, features, target, max_trials, int(size), seed)
    t = len(fits)

    def judge(z):
        x, y = np.column_stack([z[:, :p], np.ones(len(z))]), z[:, p]
        e = y[:, None] - x @ fits.T
        ok = np.abs(e) <= residual_threshold
        return np.concatenate([ok.sum(0), (ok * e**2).sum(0), (ok * y[:, None]).sum(0), (ok * y[:, None] ** 2).sum(0)])

    n, sse, s, ss = sum_over_rows(table, [*features, target], judge, 4 * t).reshape(4, t)
    with np.errstate(divide="ignore", invalid="ignore"):
        quality = np.where(n > 1, 1.0 - sse / (ss - s * s / n), -np.inf)
    best = max(range(t), key=lambda i: (n[i], np.nan_to_num(quality[i], nan=-np.inf)))
    trial = LinearModel(features, fits[best, :p], float(fits[best, p]))
    inliers = table.filter(F.abs(F.col(target) - trial.expression()) <= F.lit(residual_threshold))
    return fit_least_squares(moments(inliers, [*features, target]), features, target)
