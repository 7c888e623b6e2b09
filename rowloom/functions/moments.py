"""Means, co-moments and other sums that every linear method shares.

Only p numbers or a p x p matrix reach the driver, never data rows.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.nulls import complete_rows

WIDE_SUM = 4_096
DRIVER_SUM = 4_000_000  # numbers that may come back at once
WIDE = 12  # beyond this many columns NumPy blocks beat one SQL aggregate per pair


@dataclass
class Moments:
    columns: list
    n: int
    mean: np.ndarray
    comoment: np.ndarray  # sum of (x - mean)(x - mean)'

    def pick(self, names):
        at = [self.columns.index(c) for c in names]
        return Moments(list(names), self.n, self.mean[at], self.comoment[np.ix_(at, at)])

    def merge(self, other, sign=1):
        """Union of two row sets (sign=1) or removal of one (sign=-1)."""
        n = self.n + sign * other.n
        if n <= 0:
            p = len(self.columns)
            return Moments(self.columns, 0, np.zeros(p), np.zeros((p, p)))
        delta = other.mean - self.mean
        mean = self.mean + sign * other.n / n * delta
        spread = np.outer(delta, delta) * (self.n * other.n / n)
        return Moments(self.columns, n, mean, self.comoment + sign * (other.comoment + spread))


def balanced_sum(terms):
    """Sum of many column expressions as a shallow tree; deep chains overflow the optimizer's recursion."""
    terms = list(terms)
    while len(terms) > 1:
        terms = [sum(terms[i + 1 : i + 2], terms[i]) for i in range(0, len(terms), 2)]
    return terms[0]


def _pairs(columns):
    return [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]


def _from_row(columns, row):
    p = len(columns)
    n = row["n"] or 0
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(p)])
    co = np.zeros((p, p))
    for i, j in _pairs(columns):
        co[i, j] = co[j, i] = (row[f"c{i}_{j}"] or 0.0) * n
    return Moments(list(columns), n, mean, co)


def _moment_exprs(columns):
    cols = [F.col(c).cast("double") for c in columns]
    return (
        [F.count(F.lit(1)).alias("n")]
        + [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
        + [F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in _pairs(columns)]
    )


def moments(df: DataFrame, columns) -> Moments:
    """Moments over the rows in which every listed column is present."""
    columns = list(columns)
    full = df.select(*columns).transform(complete_rows)
    if len(columns) <= WIDE:
        return _from_row(columns, full.agg(*_moment_exprs(columns)).first())
    first = full.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    mean = np.array([first[f"m{i}"] or 0.0 for i in range(len(columns))])
    p = len(columns)
    total = sum_over_rows(full, columns, lambda x: ((x - mean).T @ (x - mean)).ravel(), p * p)
    return Moments(columns, first["n"], mean, total.reshape(p, p))


def grouped_moments(df: DataFrame, columns, by: str) -> dict:
    """{group value: Moments}; for folds and classes, whose number is small by nature."""
    columns = list(columns)
    if len(columns) > WIDE:
        groups = [r[0] for r in df.select(by).dropna().distinct().collect()]
        return {g: moments(df.filter(F.col(by) == F.lit(g)), columns) for g in groups}
    rows = df.select(by, *columns).transform(complete_rows).groupBy(by).agg(*_moment_exprs(columns)).collect()
    return {r[by]: _from_row(columns, r) for r in rows}


def sum_over_rows(df: DataFrame, columns, block, size: int) -> np.ndarray:
    """Sum of block(X) over Arrow batches X; block returns a flat vector of `size`.

    Each task adds up its batches and emits one vector. Short vectors are summed
    position by position; longer ones are first merged whole in a few tasks. The
    driver gets at most a few times `size` numbers.
    """
    columns = list(columns)

    def partial(batches):
        total = np.zeros(size)
        for pdf in batches:
            if len(pdf):
                total += block(pdf[columns].to_numpy(dtype=float))
        yield pd.DataFrame({"part": [total]})

    parts = df.select(*columns).mapInPandas(partial, "part array<double>")
    if size > WIDE_SUM:
        tasks = max(8, df.sparkSession.sparkContext.defaultParallelism // 8)
        parts = parts.repartition(tasks).mapInPandas(_add_vectors(size), "part array<double>")
        if size * tasks <= DRIVER_SUM:
            return np.sum([np.array(r["part"]) for r in parts.collect()], axis=0)
    rows = parts.select(F.posexplode("part")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["pos"]] = r["s"]
    return out


def _add_vectors(size):
    def add(batches):
        total = np.zeros(size)
        for pdf in batches:
            for v in pdf["part"]:
                total += v
        yield pd.DataFrame({"part": [total]})

    return add
