"""Tree ensembles that MLlib lacks: extremely randomised trees and second-order boosting.

Trees grow level by level. Every level is a Spark aggregate over all rows that
returns a few sums per open node; the driver holds only the trees, whose size
the parameters bound. Rows never move: each task walks the trees itself.
"""

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.hashing import hash32, uniform_draws
from rowloom.functions.lineage import cut_lineage, forget
from rowloom.functions.moments import sum_over_rows
from rowloom.functions.nulls import complete_rows
from rowloom.functions.quantiles import exact_quantiles
from rowloom.functions.spreading import settle
from rowloom.models import boosting, forests

MARGIN_EVERY = 8  # boosting rounds between two written margins
MAX_SLOTS = 50_000  # open nodes judged in one pass
MAX_CELLS = 4_000_000  # histogram sums returned by one pass
MAX_CUTS = 4_000  # nodes whose exact cuts are sought in one pass
SWEEP_ROWS = 1 << 12  # rows that a sweep's candidates predict together
DRIVER_NODES = 2_000_000  # a forest that may have more nodes stays on the cluster


class Tree:
    """Growing arrays of nodes; feature -1 marks a leaf. x <= threshold goes left."""

    def __init__(self):
        self.feature, self.threshold = [-1], [0.0]
        self.left, self.right, self.value = [-1], [-1], [0.0]
        self.rows = {}

    def split(self, node, feature, threshold):
        first = len(self.feature)
        self.feature[node], self.threshold[node] = feature, threshold
        self.left[node], self.right[node] = first, first + 1
        for _ in range(2):
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(self.value[node])
        return first, first + 1

    @classmethod
    def of(cls, arrays, mean):
        """From grown arrays (feature, threshold, left, right, value around the mean)."""
        tree = cls()
        tree.feature, tree.threshold, tree.left, tree.right = arrays[:4]
        tree.value = arrays[4] + mean
        return tree

    def graft(self, node, arrays, mean):
        """A grown subtree in place of a leaf."""
        feature, threshold, left, right, value = (np.asarray(a).tolist() for a in arrays[:5])
        shift = len(self.feature) - 1  # the subtree's root takes the leaf's place
        self.feature[node], self.threshold[node], self.value[node] = feature[0], threshold[0], value[0] + mean
        if feature[0] >= 0:
            self.left[node], self.right[node] = left[0] + shift, right[0] + shift
        self.feature += feature[1:]
        self.threshold += threshold[1:]
        self.left += [v + shift if v >= 0 else -1 for v in left[1:]]
        self.right += [v + shift if v >= 0 else -1 for v in right[1:]]
        self.value += [v + mean for v in value[1:]]

    def frozen(self):
        return tuple(np.asarray(a) for a in (self.feature, self.threshold, self.left, self.right, self.value))


def _walk(frozen, x):
    """Leaf node per row."""
    return forests.walk(*frozen[:4], x)


class Forest:
    """Sum or mean of trees, plus a base value."""

    def __init__(self, features, trees, scale=1.0, base=0.0, link=None, importances=None):
        self.features, self.trees = list(features), [t.frozen() for t in trees]
        self.scale, self.base, self.link = scale, base, link
        self.importances = importances

    def raw(self, x):
        """Sums of the trees' values for the rows of a feature matrix."""
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += self.scale * t[4][_walk(t, x)]
        return out

    def finish(self, df, raw, name="prediction", probability=None):
        """Turns a column of sums into the prediction; for the logistic link also the probability of class 1."""
        if self.link != "logistic":
            return df.withColumn(name, raw)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_raw")))
        out = df.withColumn("_raw", raw).withColumn(name, (F.col("_raw") > 0).cast("int"))
        return (out.withColumn(probability, p) if probability else out).drop("_raw")

    def score(self, df, name="prediction", probability=None):
        """Adds the prediction; for the logistic link also the probability of class 1."""

        @F.pandas_udf("double")
        def total(*columns: pd.Series) -> pd.Series:
            return pd.Series(self.raw(np.column_stack(columns)))

        return self.finish(df, total(*[F.col(f).cast("double") for f in self.features]), name, probability)

    def table(self, spark):
        rows = [
            (i, n, int(t[0][n]), float(t[1][n]), int(t[2][n]), int(t[3][n]), float(t[4][n]))
            for i, t in enumerate(self.trees) for n in range(len(t[0]))
        ]
        return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double")


class SpreadForest:
    """A forest whose subtrees stay a table (`forests.grow_below`); the driver holds the levels above them.

    Rows are scored by their trees' subtrees where these are: no task holds more than one of them.
    """

    link = None

    def __init__(self, features, upper, grown, rows, mean, scale=1.0, importances=None):
        self.features, self.upper, self.parts, self.rows = list(features), upper, grown, rows
        self.mean, self.scale, self.importances = mean, scale, importances
        counts = self.grown.select("tree", "node", (F.length("feature") / 2).cast("bigint").alias("n")).collect()
        self.below = {(r["tree"], r["node"]): r["n"] for r in counts}

    @property
    def grown(self):
        return forests.of_parts(self.parts)

    def _jobs(self, size):
        """[(trees, subtrees)] for all trees in order, so many at a time that about `forests.DEALT_BYTES` travel, `size` being one tree's."""
        owner = {i: k for k, (some, _) in enumerate(self.parts) for i in some}
        for some in forests._together(list(range(len(self.upper))), size):
            held = sorted({owner[i] for i in some if i in owner})
            grown = forests.of_parts([self.parts[k] for k in held]) if held else self.grown.limit(0)
            yield set(some), grown.filter(F.col("tree").between(some[0], some[-1]))

    def score(self, df, name="prediction", probability=None):
        """Adds the prediction."""
        held = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
        number, scale, p = held.count(), self.scale, len(self.features)
        pieces = max(1, -(-number // max(self.rows, 1)))  # more rows than trained the trees go to copies of the subtrees
        frozen, below = [t.frozen() for t in self.upper], set(self.below)

        def total(parts):
            order = np.argsort(parts.column("tree").to_numpy(), kind="stable")
            places = [np.frombuffer(v.as_py(), np.int32) for v in parts.column("place")]
            out = np.zeros(1 + max(int(v.max()) for v in places))
            for i in order:  # tree by tree, so that the sum is the same on every run; the sum of the trees before is tree -1
                value = np.frombuffer(parts.column("value")[int(i)].as_py(), float)
                out[places[i]] += value if parts.column("tree")[int(i)].as_py() < 0 else scale * value
            return parts.column("block")[0].as_py(), out

        def added(parts):
            block, out = total(parts)
            return pa.table({"_row": pa.array(block + np.arange(len(out))), "_sum": pa.array(out)})

        def so_far(parts):
            block, out = total(parts)
            place = np.arange(len(out), dtype=np.int32).tobytes()
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.table([pa.array([v], k) for v, k in zip((-1, block, place, out.tobytes()), kinds)], names=["tree", "block", "place", "value"])

        jobs, before = list(self._jobs(number * (8 * p + 32))), None
        for k, (some, grown) in enumerate(jobs):
            asked = forests.ask(held, self.features, frozen, below, pieces, trees=some)
            answers = forests.answered(asked, grown, p, self.mean, pieces)
            answers = answers if before is None else answers.unionByName(before)
            if k < len(jobs) - 1:
                before = cut_lineage(answers.groupBy("block").applyInArrow(so_far, "tree int, block bigint, place binary, value binary"))
                del asked, answers
                forget(df.sparkSession)
        sums = answers.groupBy("block").applyInArrow(added, "_row bigint, _sum double")
        return held.join(sums, "_row").withColumn(name, F.col("_sum")).select(*[c for c in df.columns if c != name], name)

    def table(self, spark):
        """The nodes as rows, numbered as in `Forest.table`."""
        sizes, shift = [len(t.feature) for t in self.upper], {}
        for (i, node), n in sorted(self.below.items()):
            shift[(i, node)] = sizes[i] - 1  # the subtree's root takes the leaf's place
            sizes[i] += n - 1
        schema, mean = "tree int, node int, feature int, threshold double, left int, right int, value double", self.mean

        def opened(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    feature, threshold, left, _, value, *_ = forests.read_grown(r)
                    by = shift[(r["tree"], r["node"])]
                    ids, left = by + np.arange(len(feature)), np.where(left >= 0, left + by, -1)
                    ids[0] = r["node"]
                    kinds = (np.int32, np.int32, np.int32, float, np.int32, np.int32, float)
                    found = (np.full(len(ids), r["tree"]), ids, feature, threshold, left, np.where(left >= 0, left + 1, -1), value + mean)
                    yield pa.RecordBatch.from_arrays([pa.array(v.astype(t)) for v, t in zip(found, kinds)], names=[c.split()[0] for c in schema.split(", ")])

        above = [
            (i, n, t.feature[n], float(t.threshold[n]), t.left[n], t.right[n], float(t.value[n]))
            for i, t in enumerate(self.upper) for n in range(len(t.feature)) if (i, n) not in self.below
        ]
        return spark.createDataFrame(above, schema).unionByName(self.grown.mapInArrow(opened, schema))


def _slots(open_nodes, trees):
    """Per tree: node id -> position among all open nodes, -1 elsewhere."""
    where = [np.full(len(t.feature), -1, dtype=np.int64) for t in trees]
    for s, (i, node) in enumerate(open_nodes):
        where[i][node] = s
    return where


def _pieces(items, size, as_slices=False):
    cuts = [slice(i, i + size) for i in range(0, len(items), size)]
    return cuts if as_slices else [items[c] for c in cuts]


def _feature_count(max_features, p):
    if max_features in (None, "all"):
        return p
    if max_features in ("sqrt", "log2"):
        return max(1, int(np.sqrt(p) if max_features == "sqrt" else np.log2(p)))
    if isinstance(max_features, str) or max_features <= 0:
        raise ValueError("max_features is None, sqrt, log2, a number or a share")
    return max(1, min(p, int(max_features * p) if isinstance(max_features, float) and max_features <= 1 else int(max_features)))


def extra_trees_regress(
    df, features, target, n_estimators=100, max_depth=None, min_samples_split=2, min_samples_leaf=1, max_features=None, seed=42
) -> Forest:
    """Extremely randomised trees: one random cut per node and feature, the best feature wins.

    `max_depth` None grows until no node can be split. `max_features` (None, "sqrt", "log2", a number or a share) draws so many
    of the features that vary in a node. No bootstrap. Nodes whose rows fit `forests.TASK_BYTES` are finished inside tasks; above
    them two aggregates per level serve all trees: extents per open node, then sums left of each drawn cut. Forests that may have more
    than `DRIVER_NODES` nodes stay on the cluster.
    """
    features = list(features)
    growth = forests.Growth(max_depth, min_samples_split, min_samples_leaf, _feature_count(max_features, len(features)), seed)
    return forest_of(df, features, target, growth, n_estimators)


def decision_tree(df, features, target, max_depth=None, min_samples_split=2, min_samples_leaf=1, max_features=None, seed=42, large=False):
    """One regression tree of any depth on exact cuts; a 0/1 target gives shares of class 1 (variance and Gini agree there).

    With `large`, tables beyond `forests.TASK_BYTES` are sorted by every feature on the cluster, which finds the cuts of the nodes
    above that size; without it they are refused.
    """
    features = list(features)
    growth = forests.Growth(max_depth, min_samples_split, min_samples_leaf, _feature_count(max_features, len(features)), seed, best=True)
    return forest_of(df, features, target, growth, 1, large=large)


def random_forest(df, features, target, key, n_estimators=100, max_depth=None, min_samples_split=2, min_samples_leaf=1, max_features=None, seed=42, large=False):
    """Bootstrapped trees of any depth on exact cuts; the key's hash decides how often a tree's sample holds a row; `large` as for a tree."""
    features = list(features)
    growth = forests.Growth(max_depth, min_samples_split, min_samples_leaf, _feature_count(max_features, len(features)), seed, best=True, bootstrap=True)
    return forest_of(df, features, target, growth, n_estimators, key, large)


def _centred(df, features, target, key):
    table = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("_y"), (hash32(key) if key else F.lit(0)).cast("double").alias("_u"))
    table = settle(table.transform(complete_rows))
    n, mean = table.agg(F.count(F.lit(1)), F.avg("_y")).first()
    return table.withColumn("_y", F.col("_y") - F.lit(mean or 0.0)), table, n, mean or 0.0


def forest_of(df, features, target, growth, n_estimators, key=None, large=False):
    """A `Forest`, or a `SpreadForest` if it may have more than `DRIVER_NODES` nodes."""
    centred, table, n, mean = _centred(df, features, target, key)
    growths = [(i, growth) for i in range(n_estimators)]
    try:
        if not n:
            raise ValueError("no complete rows")
        if n * 8 * (len(features) + 2) <= forests.TASK_BYTES:
            trees, gains = [Tree() for _ in growths], np.zeros(len(features))
            grown = [(list(range(n_estimators)), forests.grow_whole(centred, [*features, "_y", "_u"], growths))]
        elif growth.best and not large:
            raise ValueError("trees on exact cuts need a table within forests.TASK_BYTES, unless they are asked for with large=True")
        else:
            trees, gains, grown = _upper_levels(centred, features, growths, mean, n)
    finally:
        table.unpersist()
    subtrees = forests.of_parts(grown) if grown else None
    for r in sorted(subtrees.select("tree", "node", "gains").collect(), key=lambda r: (r["tree"], r["node"])) if grown else []:
        gains += np.frombuffer(r["gains"], float)
    importances = gains / gains.sum() if gains.sum() > 0 else gains
    most = min(2 * n // max(1, growth.min_samples_leaf), 2 ** (min(growth.max_depth or 0, 60) + 1) if growth.max_depth is not None else 2 * n)
    if grown and n_estimators * most > DRIVER_NODES:
        return SpreadForest(features, trees, grown, n, mean, 1.0 / n_estimators, importances)
    for r in subtrees.orderBy("tree", "node").toLocalIterator() if grown else []:
        if len(trees[r["tree"]].feature) == 1:
            trees[r["tree"]] = Tree.of(forests.read_grown(r), mean)
        else:
            trees[r["tree"]].graft(r["node"], forests.read_grown(r), mean)
    return Forest(features, trees, scale=1.0 / n_estimators, importances=importances)


def sweep_forests(train, holdout, features, target, candidates, n_estimators=100, seed=42):
    """(candidate, y, prediction) on the holdout for extra trees of every candidate; trees of all candidates share the tasks.

    Beyond `forests.TASK_BYTES`, candidates that differ in depth and least rows to split alone share their trees: the trees of the
    deepest hold those of the others, which end earlier.
    """
    centred, table, n, mean = _centred(train, features, target, None)
    plain = {"max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": None, "n_estimators": n_estimators}
    candidates = [{**plain, **c} for c in candidates]
    try:
        if n * 8 * (len(features) + 2) > forests.TASK_BYTES:
            return _shared_trees(centred, holdout, features, target, candidates, n, mean, seed)
        growths = []
        for c in candidates:
            g = forests.Growth(c["max_depth"], c["min_samples_split"], c["min_samples_leaf"], _feature_count(c["max_features"], len(features)), seed)
            growths.append([(i, g) for i in range(c["n_estimators"])])
        return forests.scores_of(centred, [*features, "_y", "_u"], growths, holdout, features, target, mean)
    finally:
        table.unpersist()


def _shared_trees(table, holdout, features, target, candidates, n, mean, seed):
    p, families, growths, members = len(features), {}, [], []
    for k, c in enumerate(candidates):
        families.setdefault((_feature_count(c["max_features"], p), c["min_samples_leaf"]), []).append(k)
    for (tried, leaf), alike in families.items():
        depths = [candidates[k]["max_depth"] for k in alike]
        growth = forests.Growth(None if None in depths else max(depths), min(candidates[k]["min_samples_split"] for k in alike), leaf, tried, seed)
        for i in range(max(candidates[k]["n_estimators"] for k in alike)):
            growths.append((i, growth))
            members.append([k for k in alike if i < candidates[k]["n_estimators"]])
    trees, _, grown = _upper_levels(table, features, growths, mean, n, sized=True)
    grown = forests.of_parts(grown) if grown else table.sparkSession.createDataFrame([], forests._GROWN)
    limits = [
        (np.inf if c["max_depth"] is None else c["max_depth"], max(c["min_samples_split"], 2 * c["min_samples_leaf"]), c["n_estimators"]) for c in candidates
    ]
    paths = {}
    for i, t in enumerate(trees):
        open_ = [(0, ())]
        for node, path in open_:
            path = (*path, (t.rows[node], t.value[node]))
            if t.feature[node] >= 0:
                open_ += [(t.left[node], path), (t.right[node], path)]
            else:
                paths[(i, node)] = path
    below = {(r["tree"], r["node"]) for r in grown.select("tree", "node").collect()}
    held = cut_lineage(holdout.select(*features, target).withColumn("_row", F.monotonically_increasing_id()))
    pieces = max(1, -(-held.count() // n))
    asked = forests.ask(held, features, [t.frozen() for t in trees], below, pieces, (target,), SWEEP_ROWS)
    return forests.swept(asked, grown, p, mean, members, limits, paths, pieces)


def _upper_levels(table, features, growths, mean, rows, sized=False):
    """(trees, gains, subtrees as of `forests.grow_below`): aggregates until a node's rows fit a task, which then finishes it; growths:
    (number, growth) of every tree."""
    p = len(features)
    trees, gains, by_feature = [Tree() for _ in growths], np.zeros(p), []
    labels, open_nodes, finish = {(i, 0): "0" for i in range(len(growths))}, [(i, 0) for i in range(len(growths))], {}
    for depth in itertools.count():
        if not open_nodes:
            break
        stats = {}
        for part in _pieces(open_nodes, MAX_SLOTS):
            stats.update(_extents(table, features, growths, trees, part))
        candidates = []
        for i, node in open_nodes:
            n, total, square, lo, hi = stats[(i, node)]
            trees[i].value[node], trees[i].rows[node] = mean + total / n, n
            if n * 8 * (p + 2) <= forests.TASK_BYTES:
                finish[(i, node)] = labels[(i, node)]
            elif forests.may_split(growths[i][1], depth, n, total, square) and (hi > lo).any():
                candidates.append((i, node, stats[(i, node)]))
        if candidates and growths[0][1].best and not by_feature:
            by_feature = [forests.sorted_by(table, [*features, "_y", "_u"], f) for f in features]
        open_nodes = []
        for part in _pieces(candidates, MAX_CUTS if by_feature else MAX_SLOTS):
            cut = (_best_of_all if by_feature else _best_of_drawn)(by_feature or table, features, growths, trees, labels, part)
            for (i, node, _), (gain, feature, threshold) in zip(part, cut):
                if feature < 0:
                    continue
                gains[feature] += gain
                for child, bit in zip(trees[i].split(node, feature, threshold), "01"):
                    labels[(i, child)] = labels[(i, node)] + bit
                    open_nodes.append((i, child))
    grown = forests.grow_below(table, [*features, "_y", "_u"], growths, [t.frozen() for t in trees], finish, rows, sized) if finish else []
    return trees, gains, grown


def _best_of_drawn(table, features, growths, trees, labels, part):
    """(gain, feature or -1, threshold) for each (tree, node, statistics): the best of the cuts drawn for it."""
    cuts = [forests.drawn_cuts(growths[i][1], growths[i][0], [labels[(i, node)]], lo[None], hi[None])[0] for i, node, (*_, lo, hi) in part]
    left, out = _left_sums(table, features, "_y", 0.0, trees, [c[:2] for c in part], np.array(cuts)), []
    for s, (i, _, (n, total, *_)) in enumerate(part):
        nl, sl = left[s, :, 0], left[s, :, 1]
        nr, sr = n - nl, total - sl
        least = growths[i][1].min_samples_leaf
        valid = (nl >= least) & (nr >= least) & ~np.isnan(cuts[s])
        gain = np.where(valid, sl**2 / np.maximum(nl, 1) + sr**2 / np.maximum(nr, 1) - total**2 / n, -np.inf)
        best = int(gain.argmax())
        out.append((gain[best], best if valid.any() else -1, float(cuts[s][best])))
    return out


def _best_of_all(by_feature, features, growths, trees, labels, part):
    """The same among all cuts between two values."""
    tried = np.array([forests.chosen_features(growths[i][1], growths[i][0], [labels[(i, node)]], (hi > lo)[None])[0] for i, node, (*_, lo, hi) in part])
    n, total = (np.array([c[2][k] for c in part]) for k in range(2))
    least = np.array([max(growths[i][1].min_samples_leaf, 1e-9) for i, *_ in part])
    where = _slots([c[:2] for c in part], trees)
    gain, feature, threshold = forests.exact_cuts(by_feature, features, growths, [t.frozen() for t in trees], where, tried, n, total, least)
    return [(gain[s], int(feature[s]), float(threshold[s])) for s in range(len(part))]


def _extents(table, features, growths, trees, open_nodes):
    """{(tree, node): (n, sum y, sum y^2, min x, max x)} with y around its mean."""
    p, k = len(features), len(open_nodes)
    frozen, where = [t.frozen() for t in trees], _slots(open_nodes, trees)

    wanted = [w >= 0 for w in where]
    ways = [forests.on_the_way(*(t[c] for c in (0, 2, 3)), v) for t, v in zip(frozen, wanted)]

    def partial(batches):
        sums = np.zeros((k, 3))
        lo, hi = np.full((k, p), np.inf), np.full((k, p), -np.inf)
        for block in forests._chunks(batches):
            across = np.ascontiguousarray(block.T)
            y, hashes = across[p], across[p + 1]
            for t, w, v, way, (number, growth) in zip(frozen, where, wanted, ways, growths):
                for node, at in forests.routed(t, v, way, across[:p]):
                    weight, s = forests._weights(growth, number, hashes[at]), w[node]
                    if weight is not None:
                        at, weight = at[weight > 0], weight[weight > 0]
                    if not len(at):
                        continue
                    own = y[at]
                    weighed = own if weight is None else weight * own
                    sums[s] += len(at) if weight is None else weight.sum(), weighed.sum(), (weighed * own).sum()
                    for j in range(p):
                        x = across[j, at]
                        lo[s, j], hi[s, j] = min(lo[s, j], x.min()), max(hi[s, j], x.max())
        seen = np.flatnonzero(sums[:, 0])
        if len(seen):
            listed = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(list(v[seen]), listed) for v in (sums, lo, hi)]], names=["slot", "sums", "lo", "hi"])

    columns = [F.col(f"`{c}`") for c in [*features, "_y", "_u"]]
    parts = table.select(*columns).mapInArrow(partial, "slot bigint, sums array<double>, lo array<double>, hi array<double>")
    rows = parts.groupBy("slot").agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(3)]).alias("sums"),
        F.array(*[F.min(F.col("lo")[j]) for j in range(p)]).alias("lo"),
        F.array(*[F.max(F.col("hi")[j]) for j in range(p)]).alias("hi"),
    ).collect()
    return {tuple(open_nodes[r["slot"]]): (*r["sums"], np.array(r["lo"]), np.array(r["hi"])) for r in rows}


def _left_sums(table, features, target, mean, trees, nodes, cuts):
    """[slot, feature, (n, sum y)] of the rows at or below each cut."""
    p, k = len(features), len(nodes)
    frozen, where = [t.frozen() for t in trees], _slots(nodes, trees)

    wanted = [w >= 0 for w in where]
    ways = [forests.on_the_way(*(t[c] for c in (0, 2, 3)), v) for t, v in zip(frozen, wanted)]

    def partial(batches):
        out = np.zeros((k, p, 2))
        for block in forests._chunks(batches):
            across = np.ascontiguousarray(block.T)
            y = across[p] - mean
            for t, w, v, way in zip(frozen, where, wanted, ways):
                for node, at in forests.routed(t, v, way, across[:p]):
                    s, own = w[node], y[at]
                    for j in range(p):
                        below = across[j, at] <= cuts[s, j]
                        out[s, j] += np.count_nonzero(below), own @ below
        seen = np.flatnonzero(out.any(axis=(1, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array([v.ravel() for v in out[seen]], pa.list_(pa.float64()))], names=["slot", "sums"])

    columns = [F.col(f"`{c}`") for c in [*features, target]]
    parts = table.select(*columns).mapInArrow(partial, "slot bigint, sums array<double>")
    found = parts.groupBy("slot").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(2 * p)]).alias("sums")).collect()
    sums = np.zeros((k, p, 2))
    for r in found:
        sums[r["slot"]] = np.array(r["sums"]).reshape(p, 2)
    return sums


def bin_edges(df, features, max_bins) -> list:
    """Per feature: sorted cut values between bins, the exact quantiles of all rows."""
    shares = [i / max_bins for i in range(1, max_bins)]
    found = exact_quantiles(df, {f: shares for f in features})
    return [np.unique(np.array([v for q in shares if (v := found[(f, q)]) is not None], dtype=float)) for f in features]


def boosted_trees(
    df, features, target, key=None, loss="squared", n_estimators=100, learning_rate=0.3, max_depth=6, reg_lambda=1.0,
    gamma=0.0, min_child_weight=1.0, min_samples_leaf=1, subsample=1.0, colsample=1.0, max_bins=64, seed=42,
) -> Forest:
    """Second-order boosting on features binned once by a sketch over every row.

    One pass per level gives the sums of gradients, curvatures and rows per (open node, feature, bin), see `boosting`. gain = 1/2 [GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)] - gamma;
    leaf = -G/(H+l). Rows are sampled per round by their key hash, columns by the seed.
    """
    features = list(features)
    options = boosting.Options(
        loss, n_estimators, learning_rate, max_depth, reg_lambda, gamma, min_child_weight, min_samples_leaf, subsample, colsample, seed
    )
    (model,), edges, (base,), _ = boosting.boost_many(df, features, target, [options], Tree, key, max_bins=max_bins, every=MARGIN_EVERY)
    _from_bins(model.trees, edges)
    total = model.gains.sum()
    link = "logistic" if loss == "logistic" else None
    return Forest(features, model.trees, learning_rate, base, link=link, importances=model.gains / total if total > 0 else model.gains)


def _binned(table, features, edges):
    """The table with every feature's bin, the number of cut values below it, in its place."""

    def run(batches):
        for pdf in batches:
            for f, e in zip(features, edges):
                pdf[f] = np.searchsorted(e, pdf[f].to_numpy(float), side="left").astype(np.int16)
            yield pdf

    kinds = ", ".join(f"`{f}` smallint" for f in features)
    return table.select(*features, "_y", "_u", "_margin").mapInPandas(run, f"{kinds}, _y double, _u double, _margin double")


def _from_bins(trees, edges):
    """Thresholds in values instead of bins."""
    for tree in trees:
        tree.threshold = [float(edges[f][int(t)]) if f >= 0 else 0.0 for f, t in zip(tree.feature, tree.threshold)]


def _with_margin(table, features, fresh, rate):
    @F.pandas_udf("double")
    def gain(*columns: pd.Series) -> pd.Series:
        x = np.column_stack(columns)
        return pd.Series(sum(rate * t[4][_walk(t, x)] for t in fresh))

    return table.withColumn("_margin", F.col("_margin") + gain(*[F.col(f) for f in features]))


def _grow_boosted(
    table, features, chosen, edges, width, fresh, rate, loss, round_, subsample, max_depth, lam, gamma,
    min_child_weight, min_samples_leaf, gain_by_feature,
):
    p, q = len(features), len(chosen)
    tree = Tree()
    open_nodes = [0]
    for depth in range(max_depth):
        frozen = tree.frozen()

        def histograms(nodes):
            k = len(nodes)
            where = _slots([(0, n) for n in nodes], [tree])[0]
            sums = sum_over_rows(table, [*features, "_y", "_u", "_margin"], lambda z: block(z, where, k), 3 * k * q * width)
            return sums.reshape(3, k, q, width)

        def block(z, where, k):
            x, y, u, margin = z[:, :p], z[:, p], z[:, p + 1], z[:, p + 2].copy()
            slot = where[_walk(frozen, x)]
            ok = slot >= 0
            if subsample < 1.0:
                ok &= uniform_draws(u, round_) < subsample
            x, y, margin, slot = x[ok], y[ok], margin[ok], slot[ok]
            for t in fresh:
                margin += rate * t[4][_walk(t, x)]
            g, h = boosting.gradients(loss, y, margin)
            out = np.zeros((3, k, q, width))
            for a, j in enumerate(chosen):
                cell = slot * width + x[:, j].astype(np.int64)
                for b, v in enumerate((g, h, None)):
                    out[b, :, a, :] = np.bincount(cell, v, minlength=k * width).reshape(k, width)
            return out.ravel()

        per_pass = max(1, MAX_CELLS // (3 * q * width))
        g, h, n = np.concatenate([histograms(part) for part in _pieces(open_nodes, per_pass)], axis=1)
        next_open = []
        for s, node in enumerate(open_nodes):
            total_g, total_h, total_n = g[s, 0].sum(), h[s, 0].sum(), n[s, 0].sum()
            tree.value[node] = -total_g / (total_h + lam) if total_h + lam > 0 else 0.0
            gl, hl, nl = (np.cumsum(v[s], axis=1)[:, :-1] for v in (g, h, n))
            gr, hr, nr = total_g - gl, total_h - hl, total_n - nl
            valid = (hl >= min_child_weight) & (hr >= min_child_weight) & (nl >= min_samples_leaf) & (nr >= min_samples_leaf)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = 0.5 * (gl**2 / (hl + lam) + gr**2 / (hr + lam) - total_g**2 / (total_h + lam)) - gamma
            gain = np.where(valid, gain, -np.inf)
            a, b = np.unravel_index(gain.argmax(), gain.shape)
            if not gain[a, b] > 1e-12 * max(1.0, total_n):
                continue
            gain_by_feature[chosen[a]] += gain[a, b]
            children = tree.split(node, chosen[a], float(b))
            for child, gg, hh in zip(children, (gl[a, b], gr[a, b]), (hl[a, b], hr[a, b])):
                tree.value[child] = -gg / (hh + lam) if hh + lam > 0 else 0.0
            next_open += children
        open_nodes = next_open
        if not open_nodes:
            break
    return tree


def hist_gradient_boosting(df, features, target, max_iter=100, learning_rate=0.1, max_depth=5, min_samples_leaf=20, **options):
    """The binned core with plain leaves (no penalty)."""
    return boosted_trees(
        df, features, target, n_estimators=max_iter, learning_rate=learning_rate, max_depth=max_depth, reg_lambda=0.0,
        min_child_weight=0.0, min_samples_leaf=min_samples_leaf, max_bins=255, **options,
    )


def huber_boosting(
    df, features, target, n_estimators=100, learning_rate=0.1, max_depth=3, alpha=0.9, min_samples_leaf=1, max_bins=64,
    key=None, subsample=1.0, seed=42,
) -> Forest:
    """Boosting under Huber loss: clipped residuals shape each tree, robust means fill its leaves.

    Per round, on all rows or the share that the key hash draws: the alpha quantile of |residual| sets the clip, the tree fits the
    clipped residual, and each leaf takes its median plus the mean clipped rest.
    """
    features = list(features)
    if subsample < 1.0 and key is None:
        raise ValueError("subsample needs the key column")
    u = hash32(key, seed).cast("double") if subsample < 1.0 else F.lit(0.0)
    table = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("_y"), u.alias("_u")).transform(complete_rows)
    base = exact_quantiles(table, {"_y": [0.5]})[("_y", 0.5)]
    raw = settle(table.withColumn("_margin", F.lit(base)))
    edges = bin_edges(raw, features, max_bins)
    table = settle(_binned(raw, features, edges))
    held = [raw, table]
    width = max(len(e) for e in edges) + 1
    trees, fresh = [], []
    p = len(features)
    schema = T.StructType([T.StructField("leaf", T.LongType()), T.StructField("r", T.DoubleType())])

    def residuals(source, steps, round_, tree=None):
        def run(batches):
            for pdf in batches:
                if subsample < 1.0:
                    pdf = pdf[uniform_draws(pdf["_u"].to_numpy(float), round_) < subsample]
                x = pdf[features].to_numpy(float)
                r = pdf["_y"].to_numpy(float) - pdf["_margin"].to_numpy(float)
                for t in steps:
                    r = r - learning_rate * t[4][_walk(t, x)]
                leaf = _walk(tree, x) if tree is not None else np.zeros(len(r), dtype=np.int64)
                yield pd.DataFrame({"leaf": leaf, "r": r})

        return source.select(*features, "_y", "_u", "_margin").mapInPandas(run, schema)

    try:
        for round_ in range(n_estimators):
            if len(fresh) == MARGIN_EVERY:
                table = cut_lineage(_with_margin(table, features, fresh, learning_rate))
                fresh = []
            sizes = residuals(table, fresh, round_ + 1).select(F.abs("r").alias("r")).persist()
            delta = exact_quantiles(sizes, {"r": [alpha]})[("r", float(alpha))]
            sizes.unpersist()
            steps = list(fresh)

            def clipped(batches, steps=steps, delta=delta):
                for pdf in batches:
                    x = pdf[features].to_numpy(float)
                    r = pdf["_y"].to_numpy(float) - pdf["_margin"].to_numpy(float)
                    for t in steps:
                        r = r - learning_rate * t[4][_walk(t, x)]
                    out = pdf[features].copy()
                    out["_y"], out["_u"], out["_margin"] = np.clip(r, -delta, delta), pdf["_u"], 0.0
                    yield out

            names = [*features, "_y", "_u", "_margin"]
            work = table.mapInPandas(clipped, ", ".join(f"`{c}` double" for c in names)).persist()
            tree = _grow_boosted(
                work, features, list(range(p)), edges, width, [], 1.0, "squared", round_ + 1, subsample, max_depth, 0.0, 0.0,
                0.0, min_samples_leaf, np.zeros(p),
            )
            work.unpersist()
            leaves = residuals(table, fresh, round_ + 1, tree.frozen()).persist()
            ids = [n for n, f in enumerate(tree.feature) if f < 0]
            each = leaves.select(*[F.when(F.col("leaf") == n, F.col("r")).alias(f"l{n}") for n in ids])
            middle = exact_quantiles(each, {f"l{n}": [0.5] for n in ids})
            center = F.lit(None).cast("double")
            for n in ids:
                center = F.when(F.col("leaf") == n, F.lit(middle[(f"l{n}", 0.5)])).otherwise(center)
            gap = F.col("r") - center
            rest = F.greatest(F.least(gap, F.lit(delta)), F.lit(-delta))
            for r in leaves.groupBy("leaf").agg(F.avg(rest).alias("v")).collect():
                tree.value[r["leaf"]] = middle[(f"l{r['leaf']}", 0.5)] + r["v"]
            leaves.unpersist()
            trees.append(tree)
            fresh = fresh + [tree.frozen()]
    finally:
        for t in held:
            t.unpersist()
    _from_bins(trees, edges)
    return Forest(features, trees, learning_rate, base)
