"""Trees of any depth, finished inside tasks.

A tree's upper levels come from aggregates over all rows (`trees.extra_trees_regress`); a node whose rows fit `TASK_BYTES` is grown to its
leaves by one task that holds just these rows. A table that fits as a whole is shipped once, and every task grows whole trees from it.
Draws depend on (seed, tree, node, feature) alone, a node being named by its path from the root, so both ways give the same trees.

What tasks grow stays a table of packed subtrees. Rows go to their subtrees in packed chunks, for growing as well as for scoring, so that
neither the driver nor one task needs a whole forest.
"""

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.hashing import text_units, uniform_draws
from rowloom.functions.lineage import cut_lineage, forget

TASK_BYTES = 64 << 20  # rows of a node, as doubles, that one task finishes by itself
CHUNK_ROWS = 1 << 15  # rows that travel to the subtrees together
DEALT_BYTES = 2 << 30  # rows that travel to their subtrees in one job, about
WALKED_ROWS = 1 << 18  # rows of several chunks that go through a subtree together
CACHE_ROWS = 1 << 16  # rows whose nodes are grown to their leaves together
SORTED_ROWS = 500_000  # rows in a partition of a sorted copy of the table, about


@dataclass(frozen=True)
class Growth:
    """`best` looks at every cut between two values, otherwise one cut a feature is drawn; `features` is the number tried in a node."""

    max_depth: int | None
    min_samples_split: int
    min_samples_leaf: int
    features: int
    seed: int
    best: bool = False
    bootstrap: bool = False


def drawn_cuts(growth: Growth, tree: int, labels: list, lo, hi):
    """For each node (a line of lo and hi) a cut between least and largest value of the features to be tried, NaN for the others."""
    varies = chosen_features(growth, tree, labels, hi > lo)
    draw = _draws(growth, tree, labels, varies, 0.0)
    return np.where(varies, np.minimum(lo + draw * (hi - lo), np.nextafter(hi, lo)), np.nan)


def chosen_features(growth: Growth, tree: int, labels: list, varies):
    """Which of the varying features each node tries."""
    if growth.features >= varies.shape[1]:
        return varies
    order = np.argsort(_draws(growth, tree, labels, varies, np.inf, ":pick"), axis=1, kind="stable")[:, : growth.features]
    out = np.zeros_like(varies)
    np.put_along_axis(out, order, True, axis=1)
    return out & varies


def _draws(growth, tree, labels, wanted, other, kind=""):
    """The draw of every node and wanted feature, `other` in the places that are not wanted."""
    out, start = np.full(wanted.shape, other), f"{growth.seed}:{tree}:"
    for j in range(wanted.shape[1]):
        at = np.flatnonzero(wanted[:, j])
        out[at, j] = text_units([f"{start}{labels[s]}:{j}{kind}" for s in at.tolist()])
    return out


def may_split(growth: Growth, depth: int, n, total, square):
    spread = square - total * total / np.maximum(n, 1)
    deep = growth.max_depth is not None and depth >= growth.max_depth
    return (not deep) & (n >= max(growth.min_samples_split, 2 * growth.min_samples_leaf)) & (spread > 1e-12 * np.maximum(square, 1e-300))


def _best_cuts(ranks, values, y, w, sizes, tried, least):
    """(gain, feature, threshold, last rank to its left) of the best cut of every node; rows lie node by node, with the rank of every
    feature's value among `values`."""
    k, p = tried.shape
    first, n = np.cumsum(sizes) - sizes, len(y)
    wy = y if w is None else w * y
    total_n = sizes.astype(float) if w is None else np.add.reduceat(w, first)
    total = np.add.reduceat(wy, first)
    gain, feature, threshold, last = np.full(k, -np.inf), np.full(k, -1), np.zeros(k), np.zeros(k, np.int64)
    for j in range(p):
        nodes = np.flatnonzero(tried[:, j])
        if not len(nodes):
            continue
        many = sizes[nodes]
        rows = np.arange(n) if len(nodes) == k else np.flatnonzero(np.repeat(tried[:, j], sizes))
        order, v = _ordered(np.repeat(np.arange(len(nodes)), many), ranks[j][rows] if len(nodes) < k else ranks[j], len(values[j]))
        order = rows[order] if len(nodes) < k else order
        start = np.cumsum(many) - many
        ends = start + many - 1
        cs, cn = np.cumsum(wy[order]), np.arange(1.0, len(order) + 1) if w is None else np.cumsum(w[order])
        before_n, before = (np.concatenate([[0.0], c[ends[:-1]]]) for c in (cn, cs))
        ok = np.zeros(len(v), bool)
        ok[:-1] = v[1:] > v[:-1]
        ok[ends] = False
        ok = np.flatnonzero(ok)
        many = np.diff(np.searchsorted(ok, np.append(start, len(v))))
        cn, cs = cn[ok] - np.repeat(before_n, many), cs[ok] - np.repeat(before, many)
        rest_n, rest = np.repeat(total_n[nodes], many) - cn, np.repeat(total[nodes], many) - cs
        fit = (cn >= least) & (rest_n >= least)
        g = np.where(fit, cs * cs / np.maximum(cn, 1e-300) + rest * rest / np.maximum(rest_n, 1e-300), -np.inf)
        some = np.flatnonzero(many)
        if not len(some):
            continue
        top = np.maximum.reduceat(g, (np.cumsum(many) - many)[some])
        at = np.flatnonzero((g == np.repeat(top, many[some])) & fit)
        line = np.repeat(np.arange(len(nodes)), many)[at]
        line, one = np.unique(line, return_index=True)
        at, s = at[one], nodes[line]
        better = g[at] > gain[s] * (1 + 1e-15)
        at, s = at[better], s[better]
        gain[s], feature[s], last[s] = g[at], j, v[ok[at]]
        a, b = values[j][last[s]], values[j][v[ok[at] + 1]]
        middle = a + (b - a) / 2
        threshold[s] = np.where(middle < b, middle, a)
    return gain - total**2 / np.maximum(total_n, 1e-300), feature, threshold, last


def _ordered(slot, rank, ranks):
    """(order, rank) of the rows by slot, which ascends, and rank; equals keep their order."""
    n, at = len(slot), np.arange(len(slot))
    low, mid = max(1, (n - 1).bit_length()), max(1, (ranks - 1).bit_length())
    if n and low + mid + int(slot[-1]).bit_length() < 63:
        key = np.sort((slot.astype(np.int64) << (low + mid)) | (rank.astype(np.int64) << low) | at)
        return key & ((1 << low) - 1), (key >> low) & ((1 << mid) - 1)
    order = np.lexsort((rank, slot))
    return order, rank[order].astype(np.int64)


def _sums(values, first):
    return np.add.reduceat(values, first) if len(first) else np.zeros(0)


def _halves(side, go, sizes):
    """(order, sizes) that put the rows of every node that goes on left half first; side is true for a row of the right half."""
    sizes_on, first = sizes[go], np.cumsum(sizes) - sizes
    right = np.add.reduceat(side, first, dtype=np.int64)[go] if len(go) else np.zeros(0, np.int64)
    left = sizes_on - right
    if len(go) < len(sizes):
        on = np.zeros(len(sizes), bool)
        on[go] = True
        on = np.repeat(on, sizes)
        at_left, at_right = np.flatnonzero(on & ~side), np.flatnonzero(on & side)
    else:
        at_left, at_right = np.flatnonzero(~side), np.flatnonzero(side)
    order = np.empty(len(at_left) + len(at_right), np.int64)
    order[np.arange(len(at_left)) + np.repeat(np.cumsum(right) - right, left)] = at_left
    order[np.arange(len(at_right)) + np.repeat(np.cumsum(left), right)] = at_right
    return order, np.column_stack([left, right]).ravel()


def grow(x, y, growth: Growth, tree: int, label: str = "0", depth: int = 0, weight=None):
    """(feature, threshold, left, right, value, gain by feature, rows) of the tree below a node.

    Nodes are judged level by level, their rows lying node by node; from `CACHE_ROWS` rows on neighbouring nodes are taken to their leaves
    by themselves, so that their rows stay in a core's cache. Nodes are numbered level by level."""
    p = x.shape[1]
    rows = slice(None) if weight is None else np.flatnonzero(weight > 0)
    y, w, columns, values = np.ascontiguousarray(y[rows]), None if weight is None else weight[rows], [], []
    for j in range(p):
        v = np.ascontiguousarray(x[rows, j])
        if growth.best:
            distinct, v = np.unique(v, return_inverse=True)
            values.append(distinct)
            v = v.astype(np.int32)
        columns.append(v)
    gains, levels = np.zeros(p), []
    ahead = [(0, columns, y, w, np.array([len(y)]), [label])] if len(y) else []
    while ahead:
        level, columns, y, w, sizes, labels = ahead.pop()
        k, first = len(sizes), np.cumsum(sizes) - sizes
        wy = y if w is None else w * y
        n = sizes.astype(float) if w is None else _sums(w, first)
        total, square = _sums(wy, first), _sums(wy * y, first)
        if level == len(levels):
            levels.append([])
        here, cut = np.full(k, -1), np.zeros(k)
        levels[level].append((here, cut, total / np.maximum(n, 1e-300), n))
        nodes = np.flatnonzero(may_split(growth, depth + level, n, total, square))
        if not len(nodes):
            continue
        if len(nodes) < k:  # only rows of nodes that may be split go on
            on = np.zeros(k, bool)
            on[nodes] = True
            on = np.flatnonzero(np.repeat(on, sizes))
            columns, y, w = [c[on] for c in columns], y[on], None if w is None else w[on]
            sizes, labels = sizes[nodes], [labels[s] for s in nodes.tolist()]
            n, total, first = n[nodes], total[nodes], np.cumsum(sizes) - sizes
        lo, hi = (np.column_stack([f.reduceat(c, first) for c in columns]) for f in (np.minimum, np.maximum))
        if growth.best:
            tried = chosen_features(growth, tree, labels, hi > lo)
            gain, best, threshold, last = _best_cuts(columns, values, y, w, sizes, tried, max(growth.min_samples_leaf, 1e-9))
        else:
            cuts = drawn_cuts(growth, tree, labels, lo, hi)
            gain, best, below = np.full(len(sizes), -np.inf), np.full(len(sizes), -1), []
            for j, c in enumerate(columns):
                below.append(c <= np.repeat(cuts[:, j], sizes))
                nl = np.add.reduceat(below[j], first, dtype=np.int64).astype(float) if w is None else _sums(w * below[j], first)
                sl = _sums(below[j] * (y if w is None else w * y), first)
                valid = (nl >= growth.min_samples_leaf) & (n - nl >= growth.min_samples_leaf) & ~np.isnan(cuts[:, j])
                g = np.where(valid, sl**2 / np.maximum(nl, 1) + (total - sl) ** 2 / np.maximum(n - nl, 1) - total**2 / np.maximum(n, 1), -np.inf)
                better = g > gain
                gain[better], best[better] = g[better], j
            threshold = cuts[np.arange(len(sizes)), np.maximum(best, 0)]
        go = np.flatnonzero(best >= 0)
        if not len(go):
            continue
        here[nodes[go]], cut[nodes[go]] = best[go], threshold[go]
        gains += np.bincount(best[go], gain[go], minlength=p)
        side, chosen = np.zeros(len(y), bool), np.repeat(best, sizes)
        for j, c in enumerate(columns):
            side |= (chosen == j) & ((c > np.repeat(last, sizes)) if growth.best else ~below[j])
        order, sizes = _halves(side, go, sizes)
        columns, y, w = [c[order] for c in columns], y[order], None if w is None else w[order]
        labels = [labels[s] + b for s in go.tolist() for b in "01"]
        pieces, start, end = [], 0, np.cumsum(sizes)
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(end, (end[start - 1] if start else 0) + CACHE_ROWS, side="right")))
            a, b = int(end[start - 1]) if start else 0, int(end[stop - 1])
            pieces.append((level + 1, [c[a:b] for c in columns], y[a:b], None if w is None else w[a:b], sizes[start:stop], labels[start:stop]))
            start = stop
        ahead += pieces[::-1]
    feature, threshold, value, sizes = (np.concatenate([part[c] for level in levels for part in level]) if levels else np.zeros(0) for c in range(4))
    inner = feature >= 0
    # the nodes below a level's come in the order of their parents
    left = np.where(inner, 2 * np.cumsum(inner) - 1, -1)
    return feature.astype(np.int16), threshold, left.astype(np.int32), np.where(left >= 0, left + 1, -1).astype(np.int32), value, gains, sizes


def _weights(growth, tree, hashes):
    """How often a bootstrap sample holds each row: a Poisson count by the row's hash."""
    if not growth.bootstrap:
        return None
    steps, p = [np.exp(-1.0)], np.exp(-1.0)
    for k in range(1, 11):
        p /= k
        steps.append(steps[-1] + p)
    return np.searchsorted(np.array(steps), uniform_draws(hashes, growth.seed * 1_000_003 + tree + 1), side="right").astype(float)


_GROWN = "tree int, node bigint, feature binary, threshold binary, value binary, gains binary, rows binary"


def walk(feature, threshold, left, right, x):
    """Leaf node per row."""
    out, at, node = np.zeros(len(x), np.int64), np.arange(len(x)), np.zeros(len(x), np.int64)
    while len(at):
        f = feature[node]
        inner = f >= 0
        if not inner.all():
            ends = ~inner
            out[at[ends]] = node[ends]
            at, node, f = at[inner], node[inner], f[inner]
        node = np.where(x[at, f] <= threshold[node], left[node], right[node])
    return out


def on_the_way(feature, left, right, wanted):
    """Marks the nodes from which a wanted node can be reached."""
    out = np.array(wanted, bool)
    for node in np.flatnonzero(np.asarray(feature) >= 0)[::-1].tolist():  # children have larger numbers
        out[node] |= out[left[node]] | out[right[node]]
    return out


def routed(tree, wanted, way, columns):
    """(node, places of its rows in order) for every wanted node that rows come to, by the features' columns; `way` as of `on_the_way`."""
    feature, threshold, left, right = tree[:4]
    ahead = [(0, None)] if way[0] and len(columns[0]) else []
    while ahead:
        node, at = ahead.pop()
        if wanted[node]:
            yield node, np.arange(len(columns[0])) if at is None else at
        if feature[node] < 0 or not (way[left[node]] or way[right[node]]):
            continue
        v = columns[feature[node]]
        below = (v if at is None else v[at]) <= threshold[node]
        for child, side in ((right[node], ~below), (left[node], below)):
            if way[child]:
                part = np.flatnonzero(side) if at is None else at[side]
                if len(part):
                    ahead.append((child, part))


def _grown_row(tree, node, found, sized=False):
    """A packed subtree: thresholds of inner nodes only, numbers of rows only if asked for, children by their order."""
    feature = np.asarray(found[0], np.int16)
    raw = [feature, np.asarray(found[1], float)[feature >= 0], np.asarray(found[4], float), np.asarray(found[5], float)]
    raw = [v.tobytes() for v in raw] + [np.asarray(found[6], float).tobytes() if sized else None]
    return pa.table([pa.array([tree], pa.int32()), pa.array([node], pa.int64()), *[pa.array([v], pa.binary()) for v in raw]], names=[c.split()[0] for c in _GROWN.split(", ")])


def read_grown(row):
    feature = np.frombuffer(row["feature"], np.int16).astype(np.int64)
    inner, threshold = feature >= 0, np.zeros(len(feature))
    threshold[inner] = np.frombuffer(row["threshold"], float)
    left = np.where(inner, 2 * np.cumsum(inner) - 1, -1)
    return (
        feature, threshold, left, np.where(inner, left + 1, -1), np.frombuffer(row["value"], float), np.frombuffer(row["gains"], float),
        None if row["rows"] is None else np.frombuffer(row["rows"], float),
    )


def grow_whole(table: DataFrame, columns, growths: list) -> DataFrame:
    """Trees (node 0) grown by tasks from a table of checked size (features, target, row hash); growths: (number, growth) of every tree."""
    spark = table.sparkSession
    rows = table.select(*columns).toPandas().to_numpy(float)
    shipped = spark.sparkContext.broadcast(rows[np.lexsort(rows.T[::-1])])  # the same order on every run

    def run(batches):
        x, y, hashes = np.ascontiguousarray(shipped.value[:, :-2]), shipped.value[:, -2], shipped.value[:, -1]
        for batch in batches:
            for i in batch.column(0).to_pylist():
                tree, growth = growths[i]
                yield from _grown_row(i, 0, grow(x, y, growth, tree, weight=_weights(growth, tree, hashes))).to_batches()

    return cut_lineage(spark.range(0, len(growths), 1, len(growths)).select(F.col("id").cast("int").alias("tree")).mapInArrow(run, _GROWN))


def _chunks(batches, size=None):
    """Numeric Arrow batches as matrices of about `CHUNK_ROWS` rows."""
    size = size or CHUNK_ROWS
    parts, n = [], 0
    for batch in batches:
        if batch.num_rows:
            parts.append(np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]))
            n += batch.num_rows
        if n >= size:
            yield np.concatenate(parts)
            parts, n = [], 0
    if n:
        yield np.concatenate(parts)


def grow_below(table: DataFrame, columns, growths: list, frozen: list, finish: dict, rows: int, sized: bool = False) -> list:
    """The subtrees below `finish` {(tree, node): path} from a table of `rows` rows (features, target, row hash), a group being finished
    by one task; `frozen` has the trees grown so far. Returns [(trees, subtrees)]: so many trees at a time that about `DEALT_BYTES` of
    rows travel."""
    p = len(columns) - 2
    where = [np.full(len(t[0]), False) for t in frozen]
    for i, node in finish:
        where[i][node] = True
    ways = [on_the_way(*(t[c] for c in (0, 2, 3)), w) for t, w in zip(frozen, where)]

    def deal(batches, some):
        for block in _chunks(batches):
            across = np.ascontiguousarray(block.T)
            for i in some:
                number, growth = growths[i]
                nodes, raw = [], []
                for node, at in routed(frozen[i], where[i], ways[i], across[:p]):
                    weight = _weights(growth, number, across[-1][at])
                    if weight is None:
                        held = block[at, : p + 1]
                    else:
                        held = np.column_stack([block[at, : p + 1], weight])[weight > 0]
                    if len(held):
                        nodes.append(node)
                        raw.append(held.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), i, np.int32)), pa.array(nodes, pa.int64()), pa.array(raw, pa.binary())], names=["tree", "node", "rows"])

    def run(group):
        i, node = group.column("tree")[0].as_py(), group.column("node")[0].as_py()
        number, growth = growths[i]
        block = np.concatenate([np.frombuffer(v.as_py(), float) for v in group.column("rows")]).reshape(-1, p + 1 + growth.bootstrap)
        block = block[np.lexsort(block.T[::-1])]
        label = finish[(i, node)]
        weight = block[:, p + 1] if growth.bootstrap else None
        return _grown_row(i, node, grow(np.ascontiguousarray(block[:, :p]), block[:, p], growth, number, label, len(label) - 1, weight), sized)

    out = []
    for some in _together([i for i, w in enumerate(where) if w.any()], rows * 8 * (p + 2)):
        dealt = table.select(*columns).mapInArrow(lambda batches, some=some: deal(batches, some), "tree int, node bigint, rows binary")
        out.append((some, cut_lineage(dealt.groupBy("tree", "node").applyInArrow(run, _GROWN))))
        del dealt
        forget(table.sparkSession)
    return out


def of_parts(parts: list) -> DataFrame:
    """All subtrees of `grow_below`."""
    return functools.reduce(DataFrame.unionByName, [grown for _, grown in parts])


def _together(trees, size):
    """Lists of trees in order, each of which moves `size` bytes."""
    many = max(1, int(DEALT_BYTES // max(1, size)))
    return [trees[i : i + many] for i in range(0, len(trees), many)]


_ASKED = "tree int, node bigint, piece int, block bigint, place binary, x binary, value binary"


def ask(rows: DataFrame, features, frozen: list, below: set, pieces: int = 1, carry=(), size=None, trees=None) -> DataFrame:
    """Packed chunks of the rows (`_row`, features) for every tree (or those of the set `trees`): the rows that end in a node of `below` with their features, the others
    with their value. `_row` counts on within a partition. With columns to `carry` all rows have their features and these."""

    def run(batches):
        marks, leaves = ([np.full(len(t[0]), False) for t in frozen] for _ in range(2))
        for i, node in below:
            marks[i][node] = True
        for t, leaf in zip(frozen, leaves):
            leaf[t[0] < 0] = True
        everywhere = [np.full(len(t[0]), True) for t in frozen]
        for block in _chunks(batches, size):
            ids, x = block[:, 0], np.ascontiguousarray(block[:, 1:])
            across = np.ascontiguousarray(x.T)
            if (np.diff(ids) != 1).any():
                raise ValueError("row numbers do not count on")
            first = int(ids[0])
            for i, t in enumerate(frozen):
                if trees is not None and i not in trees:
                    continue
                out = []
                for v, place in routed(t, leaves[i], everywhere[i], across):
                    found = (x[place].tobytes(), None) if marks[i][v] or carry else (None, np.full(len(place), t[4][v]).tobytes())
                    out.append((i, int(v), first % pieces, first, place.astype(np.int32).tobytes(), *found))
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[c.split()[0] for c in _ASKED.split(", ")])

    return rows.select("_row", *[F.col(f"`{c}`").cast("double") for c in [*features, *carry]]).mapInArrow(run, _ASKED)


def answered(asked: DataFrame, grown: DataFrame, p: int, mean: float, pieces: int = 1) -> DataFrame:
    """(tree, block, place, value): the chunks of `ask` through the subtrees they wait for."""
    schema = "tree int, block bigint, place binary, value binary"
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())

    def run(left, right):
        out, found = [], read_grown(right.slice(0, 1).to_pylist()[0]) if right.num_rows else None
        start = 0
        while start < left.num_rows:  # many chunks at a time
            stop, parts, many = start, [], 0
            while stop < left.num_rows and many < WALKED_ROWS:
                x = left.column("x")[stop].as_py()
                parts.append(np.frombuffer(x or b"", float).reshape(-1, p))
                many += len(parts[-1])
                stop += 1
            values = found[4][walk(*found[:4], np.concatenate(parts))] + mean if many else None
            ends = np.cumsum([len(x) for x in parts])
            for i, x, end in zip(range(start, stop), parts, ends.tolist()):
                tree, block, place, value = (left.column(c)[i].as_py() for c in ("tree", "block", "place", "value"))
                out.append((tree, block, place, values[end - len(x) : end].tobytes() if value is None else value))
            start = stop
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds)], names=[c.split()[0] for c in schema.split(", ")])

    by = ["tree", "node", "piece"]
    below = grown.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    return asked.groupBy(*by).cogroup(below.groupBy(*by)).applyInArrow(run, schema)


def stopped(found, x, depth, deep, need):
    """[candidate, row]: the values of a grown subtree where each candidate's tree would have ended, by its depth or its least rows to split."""
    feature, threshold, left, right, value, _, rows = found
    node, line = np.zeros(len(x), np.int64), np.arange(len(x))
    out, going = np.zeros((len(deep), len(x))), np.ones((len(deep), len(x)), bool)
    while True:
        f = feature[node]
        ends = going & ((depth >= deep)[:, None] | (rows[node] < need[:, None]) | (f < 0))
        out = np.where(ends, value[node], out)
        going &= ~ends
        if not going.any():
            return out
        node = np.where(f >= 0, np.where(x[line, np.maximum(f, 0)] <= threshold[node], left[node], right[node]), node)
        depth += 1


def swept(asked: DataFrame, grown: DataFrame, p: int, mean: float, members: list, limits: list, paths: dict, pieces: int = 1) -> DataFrame:
    """(candidate, y, prediction): the chunks of `ask` (with y carried) through trees that several candidates share. `members` lists a
    tree's candidates, `limits` a candidate's (depth, least rows to split, trees), `paths` the (rows, value) from a tree's root to a node
    that ends its upper levels; the value of a node that `grown` goes on from is its subtree's."""
    schema = "tree int, block bigint, place binary, value binary, y binary"
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def run(left, right):
        out, found = [], read_grown(right.slice(0, 1).to_pylist()[0]) if right.num_rows else None
        for i in range(left.num_rows):
            tree, node, block, place, raw = (left.column(c)[i].as_py() for c in ("tree", "node", "block", "place", "x"))
            x, path = np.frombuffer(raw, float).reshape(-1, p + 1), paths[(tree, node)]
            above = path[:-1] if found else path
            values, going = np.zeros((len(members[tree]), len(x))), []
            for a, k in enumerate(members[tree]):
                end = [v for d, (n, v) in enumerate(above) if d >= limits[k][0] or n < limits[k][1]]
                if end or not found:
                    values[a] = end[0] if end else above[-1][1]
                else:
                    going.append(a)
            if going:
                deep, need = (np.array([limits[members[tree][a]][c] for a in going]) for c in range(2))
                values[going] = stopped(found, x, len(path) - 1, deep, need) + mean
            out.append((tree, block, place, values.tobytes(), np.ascontiguousarray(x[:, p]).tobytes() if tree == 0 else None))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], names=[c.split()[0] for c in schema.split(", ")])

    def added(parts):
        order = np.argsort(parts.column("tree").to_numpy(), kind="stable")
        places = [np.frombuffer(v.as_py(), np.int32) for v in parts.column("place")]
        n = 1 + max(int(v.max()) for v in places)
        out, y = np.zeros((len(limits), n)), np.zeros(n)
        for i in order.tolist():
            ks, truth = members[parts.column("tree")[i].as_py()], parts.column("y")[i].as_py()
            out[np.ix_(ks, places[i])] += np.frombuffer(parts.column("value")[i].as_py(), float).reshape(len(ks), -1)
            if truth is not None:
                y[places[i]] = np.frombuffer(truth, float)
        out /= np.array([c[2] for c in limits])[:, None]
        candidate = np.repeat(np.arange(len(limits), dtype=np.int32), n)
        return pa.table({"candidate": candidate, "y": np.tile(y, len(limits)), "prediction": out.ravel()})

    by = ["tree", "node", "piece"]
    below = grown.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    answers = asked.groupBy(*by).cogroup(below.groupBy(*by)).applyInArrow(run, schema)
    return answers.groupBy("block").applyInArrow(added, "candidate int, y double, prediction double")


def sorted_by(table: DataFrame, columns, feature) -> DataFrame:
    """A written copy sorted by a feature; `_part` numbers its even parts in order. Equal values may lie in several parts."""
    number, cores = table.count(), table.sparkSession.sparkContext.defaultParallelism
    order = [F.col(f"`{feature}`"), F.col("_y"), F.hash(*[F.col(f"`{c}`") for c in columns])]
    placed = table.select(*columns).repartitionByRange(max(cores, -(-number // SORTED_ROWS)), *order).sortWithinPartitions(F.col(f"`{feature}`"))
    return cut_lineage(placed.withColumn("_part", F.spark_partition_id().cast("double")))


def _of_slots(batches, j, p, frozen, growths, where, tried):
    """(part, slot, value, weight, weighted target) of a sorted part's rows that lie in a node which tries feature j, by tree, in order."""
    blocks = [np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) for b in batches if b.num_rows]
    if not blocks:
        return
    across = np.ascontiguousarray(np.concatenate(blocks).T)
    del blocks
    part, y, hashes = int(across[-1, 0]), across[p], across[p + 1]
    for t, w, (number, growth) in zip(frozen, where, growths):
        wanted = (w >= 0) & tried[w, j]
        if not wanted.any():
            continue
        nodes = sorted((int(w[node]), at) for node, at in routed(t, wanted, on_the_way(*(t[c] for c in (0, 2, 3)), wanted), across[:p]))
        if not nodes:
            continue
        at, slot = np.concatenate([v for _, v in nodes]), np.repeat([s for s, _ in nodes], [len(v) for _, v in nodes])
        weight = _weights(growth, number, hashes[at])
        if weight is not None:
            kept = weight > 0
            at, slot, weight = at[kept], slot[kept], weight[kept]
        if len(at):
            weighed = np.ones(len(at)) if weight is None else weight
            yield part, slot, across[j, at], weighed, weighed * y[at]


def exact_cuts(sorted_tables: list, features, growths: list, frozen: list, where: list, tried, total_n, total, least):
    """(gain, feature, threshold) of the best cut of every slot among all cuts between two values, as `_best_cuts` finds them.

    Two passes over the copy sorted by a feature: the sums of every part, then the cuts inside the parts, given the sums before them and
    the value that follows. `where` tells the slot of a tree's nodes (-1: none), `tried` which features a slot tries."""
    p, k = len(features), len(tried)
    columns = [F.col(f"`{c}`") for c in [*features, "_y", "_u", "_part"]]
    gain, feature, threshold = np.full(k, -np.inf), np.full(k, -1), np.zeros(k)
    for j, table in enumerate(sorted_tables):
        if not tried[:, j].any():
            continue

        def sums(batches, j=j):
            for part, slot, v, n, s in _of_slots(batches, j, p, frozen, growths, where, tried):
                seen, first = np.unique(slot, return_index=True)
                found = (np.full(len(seen), part), seen, np.add.reduceat(n, first), np.add.reduceat(s, first), v[first])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["part", "slot", "n", "s", "first"])

        rows = table.select(*columns).mapInArrow(sums, "part bigint, slot bigint, n double, s double, first double").toPandas()
        parts = np.unique(rows["part"])
        before_n, before_s, after = np.zeros((len(parts), k)), np.zeros((len(parts), k)), np.full((len(parts) + 1, k), np.nan)
        line, slot = np.searchsorted(parts, rows["part"]), rows["slot"].to_numpy()
        before_n[line, slot], before_s[line, slot], after[line, slot] = rows["n"], rows["s"], rows["first"]
        before_n, before_s = (np.vstack([np.zeros(k), np.cumsum(v, axis=0)[:-1]]) for v in (before_n, before_s))
        for i in range(len(parts) - 1, -1, -1):  # the next part that holds rows of the slot
            after[i] = np.where(np.isnan(after[i]), after[i + 1], after[i])

        def cuts(batches, j=j, parts=parts, before_n=before_n, before_s=before_s, after=after):
            for part, slot, v, n, s in _of_slots(batches, j, p, frozen, growths, where, tried):
                i = int(np.searchsorted(parts, part))
                seen, first, size = np.unique(slot, return_index=True, return_counts=True)
                ends = first + size - 1
                cn, cs = (np.cumsum(c) for c in (n, s))
                cn += np.repeat(before_n[i, seen] - cn[first] + n[first], size)
                cs += np.repeat(before_s[i, seen] - cs[first] + s[first], size)
                follows = np.append(v[1:], np.nan)
                follows[ends] = after[i + 1, seen]
                rest_n, rest = total_n[slot] - cn, total[slot] - cs
                ok = (follows > v) & (cn >= least[slot]) & (rest_n >= least[slot])
                g = np.where(ok, cs**2 / np.maximum(cn, 1e-300) + rest**2 / np.maximum(rest_n, 1e-300), -np.inf)
                top = np.repeat(np.maximum.reduceat(g, first), size)
                at = np.flatnonzero((g == top) & ok)
                at = at[np.unique(slot[at], return_index=True)[1]]
                found = (np.full(len(at), part), slot[at], g[at], v[at], follows[at])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["part", "slot", "g", "v", "follows"])

        best = table.select(*columns).mapInArrow(cuts, "part bigint, slot bigint, g double, v double, follows double").toPandas()
        best = best.sort_values(["slot", "g", "part"], ascending=[True, False, True]).drop_duplicates("slot")
        s, g, v, follows = (best[c].to_numpy() for c in ("slot", "g", "v", "follows"))
        better = g > gain[s] * (1 + 1e-15)
        s, g, v, follows = (c[better] for c in (s, g, v, follows))
        gain[s], feature[s] = g, j
        middle = v + (follows - v) / 2
        threshold[s] = np.where(middle < follows, middle, v)
    return gain - total**2 / np.maximum(total_n, 1e-300), feature, threshold


def scores_of(table: DataFrame, columns, growths: list, holdout: DataFrame, features, target, mean) -> DataFrame:
    """(candidate, y, prediction): the holdout scored by the forest of every list in growths. The training table, of checked size, is
    shipped; a task grows one candidate's forest tree by tree and adds its predictions up, so no forest is held whole. Blocks of the
    holdout are dealt to the candidates by an explode."""
    spark = table.sparkSession
    rows = table.select(*columns).toPandas().to_numpy(float)
    shipped = spark.sparkContext.broadcast(rows[np.lexsort(rows.T[::-1])])
    p = len(features)
    held = holdout.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("y"))
    held = held.withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(len(growths) - 1))))

    def run(block):
        k = block.column("candidate")[0].as_py()
        x, y = np.ascontiguousarray(shipped.value[:, :-2]), shipped.value[:, -2]
        asked = np.column_stack([block.column(c).to_numpy(zero_copy_only=False) for c in features])
        out, line = np.zeros(len(asked)), np.arange(len(asked))
        for tree, growth in growths[k]:
            feature, threshold, left, right, value, *_ = grow(x, y, growth, tree)
            node = np.zeros(len(asked), np.int64)
            while (inner := feature[node] >= 0).any():
                go = asked[line, np.maximum(feature[node], 0) % p] <= threshold[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
            out += value[node]
        return pa.table({"candidate": block.column("candidate"), "y": block.column("y"), "prediction": pa.array(out / len(growths[k]) + mean)})

    return held.groupBy("candidate").applyInArrow(run, "candidate int, y double, prediction double")
