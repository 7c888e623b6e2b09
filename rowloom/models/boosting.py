"""One trainer for many boosted models over one binned table.

Features are cut into bins by one mergeable quantile sketch over every row. Rows are then packed into blocks: bins, target, fold and a
margin for every model. A pass over the blocks serves one level of all models at once. The first level of a round also adds the leaves
of the round before to the margins, which are written with the blocks; the levels below read them. Of two siblings only the one with
fewer rows is summed, the other one is its parent less that sum.

Features of few bins have few different rows of bins. Where these are under half of the rows, equal ones are one row with its count and
its sum of the target: the sums of gradients and curvatures need no more. Rounds that draw rows by their hash have a count and a sum each.

Tables whose packed form fits `TASK_BYTES` are shipped whole, and every task trains models by itself with the same sums and splits; larger
ones are passed over by all tasks for every level.

A model may leave a fold out: its rows get margins but enter no sum, so cross-validation needs no scoring pass and no copy of the table.
"""

import pickle
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.hashing import hash32, uniform_draws
from rowloom.functions.lineage import cut_lineage
from rowloom.functions.nulls import complete_rows
from rowloom.functions.spreading import spread

BLOCK_ROWS = 1 << 16
MARGIN_EVERY = 8  # rounds between two checkpoints of the margins
MAX_CELLS = 4_000_000  # histogram sums asked for in one pass
DRIVER_BYTES = 64 << 20  # partial sums collected as they are; more are added up on the cluster first
TASK_BYTES = 64 << 20  # packed rows that one task trains on by itself
STATE_BYTES = 512  # margins a row in one lot of models
DRAWN_BYTES = 64 << 20  # counts and sums of drawn rows that one task keeps
DRAWN_ROWS = 1 << 17  # rows whose draws are made together
_BLOCK = "bins binary, y binary, u binary, fold binary, n binary, margin binary, sums binary"
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]
_HELD_SCHEMA = "job int, fold int, y double, margin double, n bigint"
_HELD = [c.split()[0] for c in _HELD_SCHEMA.split(", ")]
_ROOT = (np.array([-1]), np.zeros(1), np.array([-1]), np.array([-1]), np.zeros(1))


@dataclass(frozen=True)
class Options:
    """Parameters of one model; `held` is the fold it doesn't learn from, `among` the places of the features it may split on (all)."""

    loss: str = "squared"
    n_estimators: int = 100
    learning_rate: float = 0.3
    max_depth: int = 6
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    min_samples_leaf: int = 1
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 42
    held: int | None = None
    among: tuple | None = None


def sketched_edges(df: DataFrame, features, max_bins: int) -> list:
    """Per feature the sorted cut values between bins: quantiles of all rows, found in one pass by a mergeable sketch.

    The sketch's rank error is at most one row in 10,000, and at most a fortieth of a bin. Values met in the table are returned.
    """
    shares = [i / max_bins for i in range(1, max_bins)]
    accuracy = max(10_000, 40 * max_bins)
    found = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, accuracy).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(q if q is not None else [], dtype=float)) for q in found]


def gradients(loss, y, margin, n=1.0):
    """Gradients and curvatures of rows, or of n rows each with the sum y of their targets."""
    if loss == "logistic":
        p = 1.0 / (1.0 + np.exp(-margin))
        return p * n - y, np.maximum(p * (1.0 - p), 1e-16) * n
    return margin * n - y, np.ones(len(y)) * n


def walk_bins(frozen, bins):
    """Leaf of every row; bins has a line for each feature."""
    feature, threshold, left, right, _ = frozen
    node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        node = np.where(inner, np.where(bins[np.maximum(f, 0), rows] <= threshold[node], left[node], right[node]), node)


def _row(*values):
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=_NAMES)


def _packed(table: DataFrame, features, edges, kind, bases) -> DataFrame:
    """Blocks of rows, with the models' starting margins; a column `_n` tells for how many rows each stands."""
    p, counted = len(features), "_n" in table.columns

    def block(parts):
        x = np.concatenate(parts)
        bins = np.stack([np.searchsorted(e, x[:, j], side="left").astype(kind) for j, e in enumerate(edges)])
        margin = np.repeat(np.asarray(bases, float)[:, None], len(x), axis=1)
        count = x[:, p + 3].tobytes() if counted else None
        return _row(bins.tobytes(), x[:, p].tobytes(), x[:, p + 1].tobytes(), x[:, p + 2].astype(np.int32).tobytes(), count, margin.tobytes(), None)

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            parts.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(parts)
                parts, n = [], 0
        if n:
            yield block(parts)

    return table.select(*features, "_y", "_u", "_fold", *(["_n"] if counted else [])).mapInArrow(run, _BLOCK)


def _joined(batches, size):
    """Columns of about so many rows from Arrow batches."""
    parts, n = [], 0
    for batch in batches:
        parts, n = [*parts, batch], n + batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(parts).combine_chunks().columns
            parts, n = [], 0
    if n:
        yield pa.Table.from_batches(parts).combine_chunks().columns


class _Rows:
    """A block as arrays."""

    def __init__(self, raw, i, p, kind, jobs):
        if raw is None:
            return
        get = lambda name, t: np.frombuffer(raw.column(_NAMES.index(name))[i].as_py(), t)
        self.y, self.fold = get("y", float), get("fold", np.int32)
        n = len(self.fold)
        self.u = get("u", float) if raw.column(_NAMES.index("u"))[i].is_valid else None
        self.n = get("n", float) if raw.column(_NAMES.index("n"))[i].is_valid else None
        if self.u is None:  # a line for each round, of the rows it draws
            self.y, self.n = self.y.reshape(-1, n), self.n.reshape(-1, n)
        self.bins = get("bins", kind).reshape(p, n)
        self.margin = get("margin", float).reshape(jobs, n)

    def sums(self, job: Options, round_, margin, node, slots, count, chosen, width):
        """[3, slot, feature, bin]: gradients, curvatures and rows of the nodes that have a slot."""
        slot = slots[node]
        use = slot >= 0
        if job.held is not None:
            use &= self.fold != job.held
        y, n = (self.y[round_], self.n[round_]) if self.u is None else (self.y, self.n)
        if job.subsample < 1.0 and self.u is not None:
            use &= uniform_draws(self.u, round_ + 1) < job.subsample
        at = np.flatnonzero(use)
        out = np.zeros((3, count, len(chosen), width))
        if len(at):
            n = None if n is None else n[at]
            g, h = gradients(job.loss, y[at], margin[at], 1.0 if n is None else n)
            base = slot[at] * width
            for a, j in enumerate(chosen):
                cell = base + self.bins[j, at]
                for b, v in enumerate((g, h, n)):
                    out[b, :, a] = np.bincount(cell, v, minlength=count * width).reshape(count, width)
        return out.ravel()


def _added(parts: DataFrame, tasks: int, size: int) -> np.ndarray:
    """Sum of the vectors in `sums`; beyond `DRIVER_BYTES` they meet in ever fewer tasks before the driver gets them."""

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(raw.as_py(), float)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    while tasks * size * 8 > DRIVER_BYTES and tasks > 8:
        tasks = max(8, tasks // 16)
        parts = parts.repartition(tasks).mapInArrow(add, "sums binary")
    total = np.zeros(size)
    for row in parts.toLocalIterator() if tasks * size * 8 > DRIVER_BYTES else parts.collect():
        total += np.frombuffer(row[0], float)
    return total


class _Grown:
    """A model on the driver: its trees, and of the tree that grows the open nodes and their histograms."""

    def __init__(self, job: Options, p: int, make_tree):
        self.job, self.p, self.make_tree = job, p, make_tree
        self.trees, self.gains = [], np.zeros(p)
        self.open, self.kept = [], {}

    def begin(self, round_):
        job = self.job
        self.tree = self.make_tree()
        among = np.arange(self.p) if job.among is None else np.array(job.among)
        self.chosen = sorted(among[np.random.default_rng([job.seed, round_]).choice(len(among), max(1, int(round(job.colsample * len(among)))), replace=False)].tolist())
        self.open, self.kept = [0], {}
        self.build, self.rest = [0], []  # nodes to be summed; (node, parent, sibling) to be had by subtraction

    def split(self, found: dict, last: bool):
        """Split the open nodes, given the sums of those in `build`."""
        job, lam = self.job, self.job.reg_lambda
        hist = dict(found)
        for node, parent, sibling in self.rest:
            hist[node] = self.kept[parent] - hist[sibling]
        self.kept, self.build, self.rest, opened = {}, [], [], []
        for node in self.open:
            g, h, n = hist[node]
            total_g, total_h, total_n = g[0].sum(), h[0].sum(), n[0].sum()
            self.tree.value[node] = -total_g / (total_h + lam) if total_h + lam > 0 else 0.0
            gl, hl, nl = (np.cumsum(v, axis=1)[:, :-1] for v in (g, h, n))
            if not gl.size:
                continue
            gr, hr, nr = total_g - gl, total_h - hl, total_n - nl
            least = max(job.min_samples_leaf, 0.5)  # sums by subtraction may be off by a rounding
            valid = (hl >= job.min_child_weight) & (hr >= job.min_child_weight) & (nl >= least) & (nr >= least)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = 0.5 * (gl**2 / (hl + lam) + gr**2 / (hr + lam) - total_g**2 / (total_h + lam)) - job.gamma
            gain = np.where(valid, gain, -np.inf)
            a, b = np.unravel_index(gain.argmax(), gain.shape)
            if not gain[a, b] > 1e-12 * max(1.0, total_n):
                continue
            self.gains[self.chosen[a]] += gain[a, b]
            children = self.tree.split(node, self.chosen[a], float(b))
            for child, gg, hh in zip(children, (gl[a, b], gr[a, b]), (hl[a, b], hr[a, b])):
                self.tree.value[child] = -gg / (hh + lam) if hh + lam > 0 else 0.0
            if not last:
                small, large = children if nl[a, b] <= nr[a, b] else children[::-1]
                self.kept[node] = hist[node]
                self.build.append(small)
                self.rest.append((large, node, small))
                opened += children
        self.open = opened


def _pass(state, models, live, round_, p, kind, width, jobs, leaves=None):
    """(new state or None, {model: {node: sums}}): one level of the models at `live`; with `leaves` (a tree or None for every model)
    the margins take them in and are written anew."""
    orders = [(k, models[k].job, models[k].tree.frozen(), list(models[k].build), models[k].chosen) for k in live]
    cells = {k: 3 * len(build) * len(chosen) * width for k, _, _, build, chosen in orders}
    size = sum(cells.values())
    rates = [m.job.learning_rate for m in models]
    # closures travel with the tasks: trees of the level and, at most, one tree a model

    def run(batches):
        total = np.zeros(size)
        for raw in batches:
            for i in range(raw.num_rows):
                if raw.column(0)[i].as_py() is None:
                    continue
                rows = _Rows(raw, i, p, kind, jobs)
                margin = rows.margin
                if leaves is not None:
                    margin = margin.copy()
                    for k, tree in enumerate(leaves):
                        if tree is not None:
                            margin[k] += rates[k] * tree[4][walk_bins(tree, rows.bins)]
                at = 0
                for k, job, frozen, build, chosen in orders:
                    slots = np.full(len(frozen[0]), -1)
                    slots[build] = np.arange(len(build))
                    total[at : at + cells[k]] += rows.sums(job, round_, margin[k], walk_bins(frozen, rows.bins), slots, len(build), chosen, width)
                    at += cells[k]
                if leaves is not None:
                    yield _row(*(raw.column(c)[i].as_py() for c in range(5)), margin.tobytes(), None)
        yield _row(None, None, None, None, None, None, total.tobytes())

    out = state.mapInArrow(run, _BLOCK)
    if leaves is not None:
        out = out.persist()
    total = _added(out.filter(F.col("sums").isNotNull()).select("sums"), state.rdd_partitions, size)
    found, at = {}, 0
    for k, _, _, build, chosen in orders:
        part = total[at : at + cells[k]].reshape(3, len(build), len(chosen), width)
        found[k] = {node: part[:, s] for s, node in enumerate(build)}
        at += cells[k]
    return (out if leaves is not None else None), found


class _Held:
    """A frame with its number of partitions, asked for once."""

    def __init__(self, frame, partitions):
        self.frame, self.rdd_partitions = frame, partitions

    def mapInArrow(self, *a):
        return self.frame.mapInArrow(*a)


def _alone(rows: _Rows, job: Options, base: float, p: int, width: int, make_tree, stages=(), held=None):
    """One model from rows held whole: the passes of `_train` without leaving the task; and the margins of the rows at `held` after
    so many rounds as `stages` names."""
    model, n, kept = _Grown(job, p, make_tree), rows.bins.shape[1], {}
    margin, line = np.full(n, base), np.arange(n)
    for round_ in range(job.n_estimators):
        model.begin(round_)
        node, depth = np.zeros(n, np.int64), 0
        while model.open and depth < job.max_depth:
            build = model.build
            slots = np.full(len(model.tree.feature), -1)
            slots[build] = np.arange(len(build))
            part = rows.sums(job, round_, margin, node, slots, len(build), model.chosen, width).reshape(3, len(build), len(model.chosen), width)
            model.split({v: part[:, s] for s, v in enumerate(build)}, last=depth + 1 >= job.max_depth)
            feature, threshold, left, right, _ = model.tree.frozen()
            f = feature[node]
            node = np.where(f >= 0, np.where(rows.bins[np.maximum(f, 0), line] <= threshold[node], left[node], right[node]), node)
            depth += 1
        model.trees.append(model.tree)
        margin += job.learning_rate * np.array(model.tree.value)[node]
        if round_ + 1 in stages:
            kept[round_ + 1] = margin[held]
    return model, kept


def _in_tasks(packed: DataFrame, jobs, bases, p, kind, width, make_tree, scored):
    """The models of `boost_many` for a table that is shipped whole; a task for every model. With `scored`, models that differ in their
    number of rounds alone are one model looked at after so many rounds (without gains), and trees stay in the tasks."""
    spark = packed.sparkSession
    alike = {}
    for k, job in enumerate(jobs):
        alike.setdefault(replace(job, n_estimators=0) if scored else k, []).append(k)
    groups = sorted(alike.values(), key=lambda g: (-jobs[g[0]].max_depth * max(jobs[k].n_estimators for k in g), g))
    blocks = [tuple(r) for r in packed.select("bins", "y", "u", "fold", "n").collect()]  # TASK_BYTES at most
    shipped = spark.sparkContext.broadcast(blocks)

    def run(batches):
        rows = _Rows(None, 0, p, kind, 0)
        rows.bins = np.concatenate([np.frombuffer(b[0], kind).reshape(p, -1) for b in shipped.value], axis=1)
        rows.fold = np.concatenate([np.frombuffer(b[3], np.int32) for b in shipped.value])
        lines = 1 if shipped.value[0][2] is not None else max(job.n_estimators for job in jobs)
        rows.y, rows.u, rows.n = (None if shipped.value[0][i] is None else np.concatenate([np.frombuffer(b[i], float).reshape(lines, -1) for b in shipped.value], axis=1) for i in (1, 2, 4))
        if rows.u is not None:
            rows.y, rows.u, rows.n = (None if v is None else v[0] for v in (rows.y, rows.u, rows.n))
        for batch in batches:
            for g in batch.column(0).to_pylist():
                longest = max(groups[g], key=lambda k: jobs[k].n_estimators)
                job = jobs[longest]
                held = np.flatnonzero(rows.fold == job.held) if scored and job.held is not None else np.zeros(0, np.int64)
                stages = {jobs[k].n_estimators for k in groups[g]} if scored else ()
                model, margins = _alone(rows, job, bases[longest], p, width, make_tree, stages, held)
                for k in groups[g]:
                    grown = pickle.dumps(((), model.gains) if scored else (model.trees, model.gains)) if len(groups[g]) == 1 else None
                    margin = margins.get(jobs[k].n_estimators, np.full(len(held), bases[k]))
                    count = np.ones(len(held)) if rows.n is None else rows.n[held]
                    values = (k, grown, (rows.y[held] / count).tobytes(), margin.tobytes(), count.tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), *[pa.binary()] * 4))], names=["job", "model", "y", "margin", "n"])

    cores = spark.sparkContext.defaultParallelism
    each = spark.range(0, len(groups), 1, min(len(groups), 4 * cores)).select(F.col("id").cast("int").alias("group"))
    each = each.repartition(min(len(groups), 4 * cores), F.col("group") % (4 * cores)) if len(groups) > 4 * cores else each
    done = cut_lineage(each.mapInArrow(run, "job int, model binary, y binary, margin binary, n binary"))
    models = [_Grown(job, p, make_tree) for job in jobs]
    for r in done.filter("model is not null").select("job", "model").collect():
        models[r["job"]].trees, models[r["job"]].gains = pickle.loads(r["model"])

    def opened(batches):
        for batch in batches:
            for k, *values in zip(*(batch.column(i).to_pylist() for i in range(4))):
                y, margin, n = (np.frombuffer(v, float) for v in values)
                fold = -1 if jobs[k].held is None else jobs[k].held
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(y), k, np.int32)), pa.array(np.full(len(y), fold, np.int32)), pa.array(y), pa.array(margin), pa.array(n.astype(np.int64))], names=_HELD
                )

    return models, done.select("job", "y", "margin", "n").mapInArrow(opened, _HELD_SCHEMA) if scored else None


def _lots(jobs, p, width):
    """Models trained together: by the margins a row they need and the sums of a level."""
    lot, cells = [], 0
    for k, job in enumerate(jobs):
        own = 3 * p * width * max(1, 2 ** (job.max_depth - 2))
        if lot and (len(lot) * 8 >= STATE_BYTES or cells + own > MAX_CELLS):
            yield lot
            lot, cells = [], 0
        lot.append(k)
        cells += own
    if lot:
        yield lot


class Binned:
    """A table made ready for boosting: complete rows as numbers, kept in memory, and the bins' edges. Many fits may use it."""

    def __init__(self, df: DataFrame, features, target, key=None, fold=None, max_bins=64, seed=42):
        self.features = list(features)
        u = F.lit(0.0) if key is None else hash32(key, seed).cast("double")
        number = F.col(fold).cast("double") if fold else F.lit(0.0)
        table = df.select(*[F.col(c).cast("double").alias(c) for c in self.features], F.col(target).cast("double").alias("_y"), u.alias("_u"), number.alias("_fold"))
        self.table, self.merged = table.transform(complete_rows).persist(), []
        self.sums = {int(f): (n, s) for f, n, s in self.table.groupBy("_fold").agg(F.count(F.lit(1)), F.sum("_y")).collect()}
        if not self.sums:
            self.release()
            raise ValueError("no complete rows")
        self.edges = sketched_edges(self.table, self.features, max_bins)
        self.width = max(len(e) for e in self.edges) + 1
        self.kind = np.uint8 if self.width <= 256 else np.uint16

    def release(self):
        for t in (self.table, *self.merged):
            t.unpersist()

    def base(self, job: Options) -> float:
        """The margin before the first round: the mean of the rows the job learns from, or its log odds."""
        n, s = (sum(v[i] for f, v in self.sums.items() if f != job.held) for i in (0, 1))
        mean = s / n
        return float(np.log(mean / (1 - mean))) if job.loss == "logistic" else float(mean)

    def _merged(self, jobs, scored):
        """(table, edges, rows): rows of equal bins and fold as one row with their number `_n` and the sum of the target, if these are few
        and sums are all that the jobs need; otherwise the table as it is. Held-out rows also need their own targets, of which there
        are two for the logistic loss."""
        n = sum(v[0] for v in self.sums.values())
        cells = self._cells(2 if scored else 1)
        apart = any(j.subsample < 1.0 for j in jobs) or (scored and any(j.loss != "logistic" for j in jobs))
        if apart or cells > n / 2:
            return self.table, self.edges, n
        features, edges = self.features, self.edges

        def run(batches):
            for batch in batches:
                bins = [np.searchsorted(e, c.to_numpy(zero_copy_only=False), side="left") for e, c in zip(edges, batch.columns)]
                yield pa.RecordBatch.from_arrays([*[pa.array(b.astype(np.int16)) for b in bins], *batch.columns[len(bins) :]], names=batch.schema.names)

        schema = ", ".join(f"`{f}` smallint" for f in features) + ", _y double, _fold double"
        binned = self.table.select(*features, "_y", "_fold").mapInArrow(run, schema)
        by = [F.col(f"`{f}`") for f in features] + [F.col("_fold")] + ([F.col("_y").alias("_own")] if scored else [])
        merged = binned.groupBy(*by).agg(F.sum("_y").alias("_y"), F.count(F.lit(1)).cast("double").alias("_n"))
        merged = merged.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features], "_y", F.lit(0.0).alias("_u"), "_fold", "_n")
        merged = merged.orderBy(*[F.col(f"`{f}`") for f in features], "_fold", "_y").persist()  # the same order on every run
        self.merged.append(merged)
        return merged, [np.arange(len(e), dtype=float) for e in edges], merged.count()

    def _drawn(self, share, rounds):
        """(slices of cells, their number) for rounds that draw this share of the rows: a slice has the codes of its cells, and for every
        round the number and the sum of the target of the rows that the round draws from each cell. A cell stands for the rows of equal bins and fold."""
        edges, folds, cells = self.edges, np.array(sorted(self.sums)), self._cells()
        sizes = [*[len(e) + 1 for e in edges], len(folds)]
        cores, parts = self.table.sparkSession.sparkContext.defaultParallelism, self.table.select(F.spark_partition_id().alias("p")).distinct().count()
        table = self.table if parts >= cores else self.table.repartition(cores)
        per_pass = max(1, min(rounds, DRAWN_BYTES // (16 * cells)))
        slice_ = max(1, min(BLOCK_ROWS, DRAWN_BYTES // (16 * rounds * max(parts, cores))))

        def counted(first):
            count = min(per_pass, rounds - first)

            def run(batches):
                total, met = np.zeros((2, count, cells)), np.zeros(cells, bool)

                def add(batch):
                    x = [c.to_numpy(zero_copy_only=False) for c in batch]
                    places = [np.searchsorted(e, v, side="left") for e, v in zip(edges, x)] + [np.searchsorted(folds, x[-1])]
                    code = np.ravel_multi_index(places, sizes)
                    order = np.argsort(code, kind="stable")
                    code, y, u = code[order], x[-3][order], x[-2][order].astype(np.uint64)
                    at = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                    seen = code[at]
                    met[seen] = True
                    for r in range(count):
                        taken = (uniform_draws(u, first + r + 1) < share).astype(float)
                        total[0, r, seen] += np.add.reduceat(taken, at)
                        total[1, r, seen] += np.add.reduceat(taken * y, at)

                for part in _joined(batches, DRAWN_ROWS):
                    add(part)
                used = np.flatnonzero(met)
                for code in np.split(used, np.flatnonzero(np.diff(used // slice_)) + 1) if len(used) else []:
                    raw = (code.tobytes(), np.ascontiguousarray(total[:, :, code]).tobytes())
                    place = (int(code[0]) // slice_, first, TaskContext.get().partitionId())
                    yield pa.RecordBatch.from_arrays([*[pa.array([v], pa.int32()) for v in place], *[pa.array([v], pa.binary()) for v in raw]], names=["slice", "first", "part", "code", "sums"])

            return table.select(*self.features, "_y", "_u", "_fold").mapInArrow(run, "slice int, first int, part int, code binary, sums binary")

        def added(group):
            rows = sorted(group.to_pylist(), key=lambda r: (r["first"], r["part"]))
            code = np.unique(np.concatenate([np.frombuffer(r["code"], np.int64) for r in rows]))
            out = np.zeros((2, rounds, len(code)))
            for r in rows:
                own = np.frombuffer(r["code"], np.int64)
                found = np.frombuffer(r["sums"], float).reshape(2, -1, len(own))
                out[:, r["first"] : r["first"] + found.shape[1], np.searchsorted(code, own)] += found
            return pa.table({"slice": pa.array([rows[0]["slice"]], pa.int32()), "code": pa.array([code.tobytes()], pa.binary()), "n": pa.array([out[0].tobytes()], pa.binary()), "y": pa.array([out[1].tobytes()], pa.binary())})

        passes = [counted(first) for first in range(0, rounds, per_pass)]
        slices = reduce(DataFrame.unionByName, passes).groupBy("slice").applyInArrow(added, "slice int, code binary, n binary, y binary")
        slices = slices.repartitionByRange(cores, "slice").sortWithinPartitions("slice").persist()  # the same order on every run
        self.merged.append(slices)
        return slices, slices.agg(F.sum(F.length("code") / 8)).first()[0]

    def _packed_slices(self, slices, bases):
        """Blocks of `_packed` from the slices of `_drawn`."""
        sizes, folds, kind = [*[len(e) + 1 for e in self.edges], len(self.sums)], np.array(sorted(self.sums), np.int32), self.kind

        def run(batches):
            for batch in batches:
                for _, code, n, y in zip(*(c.to_pylist() for c in batch.columns)):
                    *bins, fold = np.unravel_index(np.frombuffer(code, np.int64), sizes)
                    margin = np.repeat(np.asarray(bases, float)[:, None], len(fold), axis=1)
                    yield _row(np.stack(bins).astype(kind).tobytes(), y, None, folds[fold].tobytes(), n, margin.tobytes(), None)

        return slices.mapInArrow(run, _BLOCK)

    def _cells(self, more=1):
        cells = len(self.sums) * more
        for e in self.edges:
            cells *= len(e) + 1
        return cells

    def boost(self, jobs: list, make_tree, every=None, scored=False):
        """(models, bases, held-out rows or None), see `boost_many`; the held-out rows have a count `n` of equal ones."""
        p, kind, width, every = len(self.features), self.kind, self.width, every or MARGIN_EVERY
        bases = [self.base(job) for job in jobs]
        shares, rounds = {job.subsample for job in jobs}, max(job.n_estimators for job in jobs)
        if len(shares) == 1 and min(shares) < 1.0 and not scored and rounds and self._cells() <= min(sum(v[0] for v in self.sums.values()) / 2, DRAWN_BYTES // 16):
            table, n = self._drawn(min(shares), rounds)
            row, packed = 28 + 16 * rounds, lambda parts, bases: self._packed_slices(parts, bases)
        else:
            table, edges, n = self._merged(jobs, scored)
            row, packed = 20 if table is self.table else 28, lambda parts, bases: _packed(parts, self.features, edges, kind, bases)
        if n * (p * np.dtype(kind).itemsize + row) <= TASK_BYTES:
            models, held_out = _in_tasks(packed(table, []), jobs, bases, p, kind, width, make_tree, scored)
            return models, bases, held_out
        models = [_Grown(job, p, make_tree) for job in jobs]
        parts, held_out = spread(table), None
        tasks = parts.select(F.spark_partition_id().alias("p")).distinct().count()
        for lot in _lots(jobs, p, width):
            state = _train([models[k] for k in lot], packed(parts, [bases[k] for k in lot]), max(tasks, 1), p, kind, width, every)
            if scored:
                rows = _held_rows(state, [(k, jobs[k].held) for k in lot], p, kind)
                held_out = rows if held_out is None else held_out.unionByName(rows)
        return models, bases, held_out


def boost_many(df: DataFrame, features, target, jobs: list, make_tree, key=None, fold=None, max_bins=64, every=None, scored=False, counted=False):
    """(models with `trees` and `gains`, edges, bases, held-out rows or None) for every `Options` in jobs.

    Rows with nulls are left out. `fold` names a column of whole numbers; a job with `held` learns without that fold. With `scored`,
    the held-out table (job, fold, y, margin) has every row of the fold that each job left out, and the models' trees may be missing;
    with `counted`, equal rows may be one with their number `n`.
    """
    drawn = any(j.subsample < 1.0 for j in jobs)
    if drawn and key is None:
        raise ValueError("subsample needs the key column")
    binned = Binned(df, features, target, key if drawn else None, fold, max_bins, jobs[0].seed)
    try:
        models, bases, held_out = binned.boost(jobs, make_tree, every, scored)
        if scored and not counted:
            held_out = held_out.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).drop("_i", "n")
        return models, binned.edges, bases, held_out
    finally:
        binned.release()


def _train(models, packed, tasks, p, kind, width, every):
    """Grow the models of a lot; returns the checkpointed blocks with their final margins."""
    jobs = len(models)
    held = [_Held(packed.persist(), tasks)]
    pending = [None] * jobs
    rounds = max(m.job.n_estimators for m in models)
    for round_ in range(rounds):
        live = [k for k, m in enumerate(models) if round_ < m.job.n_estimators]
        for k in live:
            models[k].begin(round_)
        depth = 0
        while live:
            state = held[-1]
            new, found = None, {}
            for i, part in enumerate(_passes(models, live, width)):
                leaves = pending if depth == 0 and i == 0 else None
                frame, got = _pass(state, models, part, round_, p, kind, width, jobs, leaves)
                if frame is not None:
                    new = frame
                    state = _Held(new, tasks)
                for k, nodes in got.items():
                    found.setdefault(k, {}).update(nodes)
            if new is not None:
                held[-1].frame.unpersist()
                held = [state]
                pending = [None] * jobs
            for k in live:
                models[k].split(found[k], last=depth + 1 >= models[k].job.max_depth)
            depth += 1
            live = [k for k in live if models[k].open and depth < models[k].job.max_depth]
        for k, m in enumerate(models):
            if round_ < m.job.n_estimators:
                m.trees.append(m.tree)
                pending[k] = m.tree.frozen()
        if (round_ + 1) % every == 0:
            held = [_Held(_cut(held[-1].frame), tasks)]
    done = _cut(_with_leaves(held[-1].frame, pending, [m.job.learning_rate for m in models], p, kind, jobs))
    held[-1].frame.unpersist()
    return done


def _cut(frame):
    out = cut_lineage(frame.filter(F.col("bins").isNotNull()))
    frame.unpersist()
    return out


def _passes(models, live, width):
    """The live models in as many passes as `MAX_CELLS` asks for; one model's open nodes stay together."""
    part, cells = [], 0
    for k in live:
        own = 3 * len(models[k].build) * len(models[k].chosen) * width
        if part and cells + own > MAX_CELLS:
            yield part
            part, cells = [], 0
        part.append(k)
        cells += own
    if part:
        yield part


def _with_leaves(frame, leaves, rates, p, kind, jobs):
    def run(batches):
        for raw in batches:
            for i in range(raw.num_rows):
                if raw.column(0)[i].as_py() is None:
                    continue
                rows = _Rows(raw, i, p, kind, jobs)
                margin = rows.margin.copy()
                for k, tree in enumerate(leaves):
                    if tree is not None:
                        margin[k] += rates[k] * tree[4][walk_bins(tree, rows.bins)]
                yield _row(*(raw.column(c)[i].as_py() for c in range(5)), margin.tobytes(), None)

    return frame.mapInArrow(run, _BLOCK)


def _held_rows(state, jobs, p, kind):
    def run(batches):
        for raw in batches:
            for i in range(raw.num_rows):
                rows = _Rows(raw, i, p, kind, len(jobs))
                for k, (job, held) in enumerate(jobs):
                    at = np.flatnonzero(rows.fold == held) if held is not None else np.zeros(0, np.int64)
                    if len(at):
                        count = np.ones(len(at)) if rows.n is None else rows.n[at]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), job, np.int32)), pa.array(rows.fold[at]), pa.array(rows.y[at] / count), pa.array(rows.margin[k][at]), pa.array(count.astype(np.int64))],
                            names=_HELD,
                        )

    return state.mapInArrow(run, _HELD_SCHEMA)


def candidates_by_fold(candidates: list, folds: list, **common) -> list:
    """An `Options` for every candidate and fold, in that order."""
    base = Options(**common)
    return [replace(base, **c, held=int(f)) for c in candidates for f in folds]
