"""Linear regression family on shared co-moments.

`fit_*` take a `Moments` object, so one pass over the data serves every method,
every penalty and, with per-fold moments, every fold.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from rowloom.functions.hashing import uniform_draws
from rowloom.functions.moments import Moments, balanced_sum, moments
from rowloom.functions.nulls import complete_rows
from rowloom.functions.shards import SHARD_ROWS, packed_shards, pass_over_shards

_PA_BLOCK = 256  # rows whose products are held at once


@dataclass
class LinearModel:
    features: list
    coefficients: np.ndarray
    intercept: float

    def expression(self):
        terms = [F.col(c) * F.lit(float(w)) for c, w in zip(self.features, self.coefficients)]
        return balanced_sum([F.lit(float(self.intercept)), *terms])

    def score(self, df, name="prediction"):
        return df.withColumn(name, self.expression())

    def table(self, spark):
        rows = [("intercept", float(self.intercept))] + [(c, float(w)) for c, w in zip(self.features, self.coefficients)]
        return spark.createDataFrame(rows, "term string, value double")


class Normal:
    """Centred normal equations X'X w = X'y cut from the co-moments."""

    def __init__(self, m: Moments, features, target, intercept=True):
        part = m.pick([*features, target])
        second, mean = part.comoment, part.mean
        if not intercept:
            second, mean = second + part.n * np.outer(mean, mean), np.zeros_like(mean)
        p = len(features)
        self.features, self.n, self.p = list(features), part.n, p
        self.xx, self.xy, self.yy = second[:p, :p], second[:p, p], second[p, p]
        self.x_mean, self.y_mean = mean[:p], mean[p]

    def model(self, w):
        w = np.asarray(w, dtype=float)
        return LinearModel(self.features, w, float(self.y_mean - self.x_mean @ w))

    def solve(self, keep=None, ridge=0.0):
        keep = list(range(self.p)) if keep is None else keep
        w = np.zeros(self.p)
        a = self.xx[np.ix_(keep, keep)] + ridge * np.eye(len(keep))
        w[keep] = np.linalg.lstsq(a, self.xy[keep], rcond=None)[0]
        return w


def fit_least_squares(m, features, target, intercept=True):
    eq = Normal(m, features, target, intercept)
    return eq.model(eq.solve())


def fit_ridge(m, features, target, alpha=1.0, intercept=True):
    """|y - Xw|^2 + alpha |w|^2, intercept not penalised."""
    eq = Normal(m, features, target, intercept)
    return eq.model(eq.solve(ridge=alpha))


def fit_elastic_net(m, features, target, alpha=1.0, l1_ratio=0.5, intercept=True, tol=1e-10, max_iter=10_000):
    """|y - Xw|^2 / 2n + alpha * l1_ratio * |w|_1 + alpha * (1 - l1_ratio) / 2 * |w|^2, by coordinate descent."""
    eq = Normal(m, features, target, intercept)
    xx, xy = eq.xx / eq.n, eq.xy / eq.n
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    w = np.zeros(eq.p)
    for _ in range(max_iter):
        largest = 0.0
        for j in range(eq.p):
            if xx[j, j] <= 0:
                continue
            pull = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (xx[j, j] + l2)
            largest = max(largest, abs(new - w[j]) * np.sqrt(xx[j, j]))
            w[j] = new
        if largest <= tol * max(np.sqrt(eq.yy / eq.n), 1e-300):
            break
    return eq.model(w)


def fit_lasso(m, features, target, alpha=1.0, intercept=True, **options):
    return fit_elastic_net(m, features, target, alpha, 1.0, intercept, **options)


def fit_orthogonal_matching_pursuit(m, features, target, n_nonzero=None, intercept=True):
    """Greedy: add the column most correlated with the residual, refit on the chosen ones."""
    eq = Normal(m, features, target, intercept)
    n_nonzero = n_nonzero or max(1, eq.p // 10)
    norm = np.sqrt(np.maximum(np.diag(eq.xx), 1e-300))
    chosen, w = [], np.zeros(eq.p)
    while len(chosen) < min(n_nonzero, eq.p):
        strength = np.abs(eq.xy - eq.xx @ w) / norm
        strength[chosen] = -1.0
        chosen.append(int(strength.argmax()))
        w = eq.solve(chosen)
    return eq.model(w)


def fit_lars(m, features, target, n_nonzero=500, intercept=True):
    """Least-angle regression: move along the equiangular direction, one new column per step."""
    eq = Normal(m, features, target, intercept)
    norm = np.sqrt(np.maximum(np.diag(eq.xx), 1e-300))
    gram, start = eq.xx / np.outer(norm, norm), eq.xy / norm
    idle = [j for j in range(eq.p) if eq.xx[j, j] > 1e-12 * max(np.diag(eq.xx).max(), 1e-300)]
    w, active = np.zeros(eq.p), []
    for _ in range(min(n_nonzero, len(idle))):
        c = start - gram @ w
        active.append(max(idle, key=lambda j: abs(c[j])))
        idle.remove(active[-1])
        top = np.abs(c[active]).max()
        direction = np.linalg.lstsq(gram[np.ix_(active, active)], np.sign(c[active]), rcond=None)[0]
        drift = gram[:, active] @ direction  # active correlations fall by 1 per unit of step
        step = top
        for j in idle:
            for rate, gap in ((1 - drift[j], top - c[j]), (1 + drift[j], top + c[j])):
                if rate > 1e-12 and 1e-12 < gap / rate < step:
                    step = gap / rate
        w[active] += step * direction
    return eq.model(w / norm)


def fit_lasso_lars(m, features, target, alpha=1.0, intercept=True):
    """Lasso solution at `alpha`; the path and coordinate descent share their optimum."""
    return fit_lasso(m, features, target, alpha, intercept)


def fit_bayesian_ridge(m, features, target, alpha_1=1e-6, alpha_2=1e-6, lambda_1=1e-6, lambda_2=1e-6, tol=1e-3, max_iter=300, intercept=True):
    """Evidence maximisation for noise precision and one weight precision."""
    eq = Normal(m, features, target, intercept)
    values, vectors = np.linalg.eigh(eq.xx)
    values, rotated = np.maximum(values, 0.0), vectors.T @ eq.xy
    noise, weight = 1.0 / max(eq.yy / eq.n, 1e-300), 1.0
    w = np.zeros(eq.p)
    for _ in range(max_iter):
        old = w
        w = vectors @ (rotated / (values + weight / noise))
        rss = max(eq.yy - 2 * w @ eq.xy + w @ eq.xx @ w, 0.0)
        gamma = np.sum(noise * values / (weight + noise * values))
        weight = (gamma + 2 * lambda_1) / (w @ w + 2 * lambda_2)
        noise = (eq.n - gamma + 2 * alpha_1) / (rss + 2 * alpha_2)
        if np.abs(w - old).sum() < tol:
            break
    return eq.model(vectors @ (rotated / (values + weight / noise)))


def fit_ard(m, features, target, alpha_1=1e-6, alpha_2=1e-6, lambda_1=1e-6, lambda_2=1e-6, tol=1e-3, max_iter=300, prune=1e4, intercept=True):
    """Evidence maximisation with one precision per weight; weights above `prune` leave."""
    eq = Normal(m, features, target, intercept)
    noise, weight = 1.0 / max(eq.yy / eq.n, 1e-300), np.ones(eq.p)
    keep, w = np.arange(eq.p), np.zeros(eq.p)
    for _ in range(max_iter):
        old = w.copy()
        cov = np.linalg.inv(np.diag(weight[keep]) + noise * eq.xx[np.ix_(keep, keep)])
        w = np.zeros(eq.p)
        w[keep] = noise * cov @ eq.xy[keep]
        rss = max(eq.yy - 2 * w @ eq.xy + w @ eq.xx @ w, 0.0)
        gamma = 1.0 - weight[keep] * np.diag(cov)
        weight[keep] = (gamma + 2 * lambda_1) / (w[keep] ** 2 + 2 * lambda_2)
        noise = (eq.n - gamma.sum() + 2 * alpha_1) / (rss + 2 * alpha_2)
        keep = np.array([j for j in keep if weight[j] < prune], dtype=int)
        w[[j for j in range(eq.p) if j not in keep]] = 0.0
        if np.abs(w - old).sum() < tol or not len(keep):
            break
    return eq.model(w)


def holdout_mse(model: LinearModel, m: Moments, target) -> float:
    """Mean squared error of a linear model on other rows, from their co-moments."""
    part = m.pick([*model.features, target])
    v = np.append(-model.coefficients, 1.0)
    bias = v @ part.mean - model.intercept
    return float(v @ part.comoment @ v / part.n + bias * bias)


def fit_huber(df, features, target, epsilon=1.35, reg=0.0):
    """Huber loss with a jointly fitted scale."""
    rows = VectorAssembler(inputCols=list(features), outputCol="_x").transform(complete_rows(df, [*features, target]))
    # its scaling is set by column spread; a target of any unit is fine
    fitted = LinearRegression(featuresCol="_x", labelCol=target, loss="huber", epsilon=epsilon, regParam=reg).fit(rows)
    return LinearModel(list(features), fitted.coefficients.toArray(), fitted.intercept)


def _passive_aggressive_pass(block, w, b, c, epsilon, intercept):
    """The online rule over rows [x, y] in order; (w, b, summed loss before each step).

    A block product gives the errors of many rows at once; a step corrects the errors of the
    rows after it by their products with its own row, so rows inside the tube cost nothing more.
    """
    loss = 0.0
    for at in range(0, len(block), _PA_BLOCK):
        x, y = block[at : at + _PA_BLOCK, :-1], block[at : at + _PA_BLOCK, -1]
        products = x @ x.T
        norm = np.diag(products).copy()
        if intercept:
            products = products + 1.0
        error, step, i = y - x @ w - b, np.zeros(len(y)), 0
        while i < len(y):
            outside = np.flatnonzero(np.abs(error[i:]) > epsilon)
            if not len(outside):
                break
            i += outside[0]
            excess = abs(error[i]) - epsilon
            loss += excess
            if norm[i] > 0:
                step[i] = min(c, excess / norm[i]) * np.sign(error[i])
                error[i + 1 :] -= step[i] * products[i, i + 1 :]
            i += 1
        w, b = w + step @ x, b + (step.sum() if intercept else 0.0)
    return w, b, loss


def fit_passive_aggressive(
    df, features, target, c=1.0, epsilon=0.1, max_iter=1000, tol=1e-3, n_iter_no_change=5, intercept=True, shuffle=True,
    shard_rows=SHARD_ROWS, key=None, seed=42,
):
    """Online passive-aggressive regression (steps of at most `c`, no loss within `epsilon`).

    Rows lie in fixed blocks ordered by the hash of `key`, or of their values without one
    (`functions/shards.py`). A pass takes every block through the online rule from the shared
    weights, in a new order each time if `shuffle`; the row-weighted mean is the next start. The
    fit ends after `max_iter` passes, or once `n_iter_no_change` passes in a row have not brought
    the mean loss `tol` below its least (None: never). The result is the same on any partitioning.
    Rows with a null are left out; a table without rows raises ValueError. The model's `passes`
    and `converged` tell how it ended.
    """
    features = list(features)
    p = len(features)
    state, best, idle, passes, converged = np.zeros(p + 1), np.inf, 0, 0, False
    table = packed_shards(df, [*features, target], key, shard_rows, seed)
    try:
        while passes < max_iter and not converged:
            now, salt = state, seed * 1_000 + passes

            def work(shard, block):
                if shuffle:
                    block = block[np.argsort(uniform_draws(np.arange(len(block)) + (int(shard) << 32), salt), kind="stable")]
                w, b, loss = _passive_aggressive_pass(block, now[:p], now[p], c, epsilon, intercept)
                return np.append(w, b), [len(block), loss]

            state, (n, loss) = pass_over_shards(table, p + 1, work)
            passes += 1
            if tol is not None:
                idle = idle + 1 if loss / n > best - tol else 0
                converged = idle >= n_iter_no_change
            best = min(best, loss / n)
    finally:
        table.unpersist()
    model = LinearModel(features, state[:p], float(state[p]))
    model.passes, model.converged = passes, converged
    return model


def fit(df, features, target, method="least_squares", **params):
    """Fit one of the co-moment methods on a table."""
    fitters = {
        "least_squares": fit_least_squares, "ridge": fit_ridge, "lasso": fit_lasso, "elastic_net": fit_elastic_net,
        "lars": fit_lars, "lasso_lars": fit_lasso_lars, "orthogonal_matching_pursuit": fit_orthogonal_matching_pursuit,
        "bayesian_ridge": fit_bayesian_ridge, "ard": fit_ard,
    }
    return fitters[method](moments(df, [*features, target]), features, target, **params)
