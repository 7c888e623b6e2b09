"""Multi-layer perceptron regression by mini-batches.

Rows lie in fixed blocks (`functions/shards.py`). A pass takes every block through its
mini-batches from the shared weights; the new weights are the row-weighted mean. A table
of one block is fitted by the plain sequential rule.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rowloom.functions.hashing import uniform_draws
from rowloom.functions.shards import SHARD_ROWS, packed_shards, pass_over_shards

_ACTIVATIONS = {
    "identity": (lambda z: z, lambda a: np.ones_like(a)),
    "logistic": (lambda z: 1.0 / (1.0 + np.exp(-z)), lambda a: a * (1.0 - a)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
}
_SLOWEST = 1e-6  # the adaptive rate stops here


def _unpack(flat, sizes):
    layers, at = [], 0
    for i, o in zip(sizes[:-1], sizes[1:]):
        layers.append((flat[at : at + i * o].reshape(i, o), flat[at + i * o : at + i * o + o]))
        at += i * o + o
    return layers


def _forward(x, layers, act):
    outs = [x]
    for i, (w, b) in enumerate(layers):
        z = outs[-1] @ w + b
        outs.append(act(z) if i < len(layers) - 1 else z)
    return outs


def _gradient(z, flat, sizes, activation):
    """(summed gradient of half the squared error, summed squared error) of rows [x, y]."""
    act, slope = _ACTIVATIONS[activation]
    layers = _unpack(flat, sizes)
    outs = _forward(z[:, :-1], layers, act)
    delta = outs[-1] - z[:, -1:]
    error, grads = float((delta**2).sum()), []
    for i in range(len(layers) - 1, -1, -1):
        grads = [(outs[i].T @ delta).ravel(), delta.sum(0), *grads]
        if i:
            delta = (delta @ layers[i][0].T) * slope(outs[i])
    return np.concatenate(grads), error


def initial_weights(sizes, activation, seed):
    rng = np.random.default_rng(seed)
    parts = []
    for i, o in zip(sizes[:-1], sizes[1:]):
        bound = np.sqrt((2.0 if activation == "logistic" else 6.0) / (i + o))
        parts += [rng.uniform(-bound, bound, i * o), rng.uniform(-bound, bound, o)]
    return np.concatenate(parts)


class MLPRegressor:
    """`loss_curve`: loss per pass; `converged`: whether the fit stopped before `max_iter`."""

    def __init__(self, features, sizes, flat, activation, loss_curve=(), converged=False):
        self.features, self.sizes, self.flat, self.activation = features, sizes, flat, activation
        self.loss_curve, self.converged = list(loss_curve), converged

    def raw(self, x):
        """Predictions for the rows of a feature matrix."""
        return _forward(x, _unpack(self.flat, self.sizes), _ACTIVATIONS[self.activation][0])[-1][:, 0]

    def finish(self, df, raw, name="prediction"):
        return df.withColumn(name, raw)

    def score(self, df, name="prediction"):
        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(self.raw(np.column_stack(columns)))

        return self.finish(df, predict(*[F.col(f).cast("double") for f in self.features]), name)


def fit_mlp(
    df, features, target, hidden=(100,), activation="relu", solver="adam", alpha=1e-4, learning_rate=1e-3, max_iter=200, seed=42,
    batch_size=200, schedule="constant", power_t=0.5, momentum=0.9, nesterov=True, tol=1e-4, n_iter_no_change=10,
    early_stopping=False, validation_fraction=0.1, shard_rows=SHARD_ROWS, key=None, start=None,
) -> MLPRegressor:
    """Squared loss with an L2 penalty; solvers `adam` and `sgd`.

    `schedule` holds for `sgd`: "constant", "invscaling" (rate / rows seen ** power_t) or
    "adaptive" (a fifth after n_iter_no_change passes that gain less than `tol`, until 1e-6).
    The fit stops after n_iter_no_change passes without a gain of `tol` in the loss, or with
    `early_stopping` in R^2 on the first `validation_fraction` of every block, which then
    takes no steps; the best weights are returned. `start` gives the flat first weights.
    Rows with a null feature or target are left out; a table without rows raises ValueError.
    """
    features = list(features)
    sizes = [len(features), *hidden, 1]
    flat = initial_weights(sizes, activation, seed) if start is None else np.asarray(start, dtype=float)
    decay = np.concatenate([np.append(np.ones(i * o), np.zeros(o)) for i, o in zip(sizes[:-1], sizes[1:])])
    share = validation_fraction if early_stopping else 0.0
    size, width = len(flat), len(features) + 1
    adam = solver == "adam"
    moving = np.zeros(2 * size if adam else size)
    steps, rate, best, idle, curve, kept, converged = 0, learning_rate, np.inf, 0, [], flat, False
    table = packed_shards(df, [*features, target], key, shard_rows, seed)

    def go(epoch, flat, moving, steps, rate):
        """One pass from shared weights: (weights, solver state, batches), (rows, squared error, held-out sums)."""

        def work(shard, block):
            cut = int(len(block) * share)
            held, rows = block[:cut], block[cut:]
            y = held[:, -1]
            missed = _gradient(held, flat, sizes, activation)[1] if cut else 0.0
            state, w, error, t = moving.copy(), flat.copy(), 0.0, steps
            mixed = np.argsort(uniform_draws(np.arange(len(rows)) + (int(shard) << 32), seed * 1_000 + epoch), kind="stable")
            for at in range(0, len(rows), batch_size):
                z = rows[mixed[at : at + batch_size]]
                gradient, sse = _gradient(z, w, sizes, activation)
                gradient = (gradient + alpha * decay * w) / len(z)
                error += sse
                t += 1
                if adam:
                    state[:size] = 0.9 * state[:size] + 0.1 * gradient
                    state[size:] = 0.999 * state[size:] + 0.001 * gradient**2
                    w = w - rate * (state[:size] / (1 - 0.9**t)) / (np.sqrt(state[size:] / (1 - 0.999**t)) + 1e-8)
                else:
                    state = momentum * state - rate * gradient
                    w = w + (momentum * state - rate * gradient if nesterov else state)
            return np.concatenate([w, state, [t - steps]]), [len(rows), error, cut, missed, y.sum(), (y * y).sum()]

        mean, sums = pass_over_shards(table, width, work)
        return mean[:size], mean[size:-1], int(np.ceil(mean[-1])), sums

    def held_out_loss(sums):
        spread = sums[5] - sums[4] ** 2 / max(sums[2], 1.0)
        return sums[3] / spread if spread > 0 else sums[3]  # 1 - R^2

    try:
        seen = 0.0
        for epoch in range(max_iter + bool(early_stopping)):
            before = flat
            flat, moving, batches, sums = go(epoch, flat, moving, steps, rate)
            steps, seen = steps + batches, seen + sums[0]
            # held-out rows judge the weights a pass began with, so one more pass judges the last ones
            loss = held_out_loss(sums) if early_stopping else 0.5 * (sums[1] + alpha * float(decay @ flat**2)) / max(sums[0], 1.0)
            curve.append(loss)
            idle = idle + 1 if loss > best - tol else 0
            if loss < best:
                best, kept = loss, before if early_stopping else flat
            if not early_stopping:
                kept = flat
            if not adam and schedule == "invscaling":
                rate = learning_rate / (seen + 1.0) ** power_t
            if idle >= n_iter_no_change:
                if adam or schedule != "adaptive" or rate <= _SLOWEST:
                    converged = True
                    break
                rate, idle = rate / 5.0, 0
    finally:
        table.unpersist()
    return MLPRegressor(features, sizes, kept, activation, curve, converged)
