"""Exact k-nearest-neighbour join.

A point table of checked size travels to every task and queries are scanned
once. A larger one is cut into cells around pivot rows. Each query first
searches its closest cells, which gives a distance it must beat, and then only
the cells that the triangle inequality cannot rule out. Cells are cut into
bounded blocks of points and bounded chunks of queries, so one hot cell never
lands in one task, and every task emits at most k rows per query, never all
pairs. Copies of one vector are reduced to the few smallest ids that any result
can contain before the search.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.hashing import hash32
from rowloom.functions.lineage import cut_lineage, forget, rows_within
from rowloom.functions.nulls import complete_rows

BROADCAST_POINTS = 20_000
MAX_PIVOTS = 8_192
BLOCK_ROWS = 40_000
MATRIX_CELLS = 4_000_000
LINES, TILE = 200, 2_000  # queries and points whose measures in single precision are held at once, which stay in a core's cache
SOME = 4  # one of so many points tells first how far off a query's best are at most
MAX_NEAR = 256  # points a query measures exactly beyond the k it wants, before it measures all
BOX_FEATURES = 8  # with more, boxes rule out too little
BOX_ROWS = 32


def _measure(q, x, p):
    """Sum of |difference|^p, added feature by feature in order."""
    total = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        gap = q[:, j, None] - x[None, :, j]
        total += gap * gap if p == 2 else np.abs(gap) if p == 1 else np.abs(gap) ** p
    return total


def _nearest(m, take):
    """Places of the `take` smallest entries of every line in ascending order, those of equals being the first ones."""
    near = np.argpartition(m, take - 1, axis=1)[:, :take] if take < m.shape[1] else np.tile(np.arange(take), (len(m), 1))
    limit = np.take_along_axis(m, near, axis=1).max(axis=1)
    # where more than k points are within the limit, the partition chose among equals at random
    for i in np.flatnonzero((m <= limit[:, None]).sum(axis=1) > take):
        close = np.flatnonzero(m[i] <= limit[i])
        near[i] = close[np.argsort(m[i][close], kind="stable")][:take]
    near.sort(axis=1)
    return near


def _measured_pairs(q, x, qi, xi, p):
    """`_measure` of single pairs, by the same sums in the same order."""
    total = np.zeros(len(qi))
    for j in range(q.shape[1]):
        gap = q[qi, j] - x[xi, j]
        total += gap * gap if p == 2 else np.abs(gap) if p == 1 else np.abs(gap) ** p
    return total


class _Points:
    """Points as a search over many chunks of queries uses them: a copy in single precision around their mean, and their sizes."""

    def __init__(self, x):
        self.x = x
        self.middle = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        self.near = np.ascontiguousarray((x - self.middle).astype(np.float32).T)
        self.square = (self.near * self.near).sum(axis=0)
        with np.errstate(all="ignore"):
            self.product = np.vstack([-2 * self.near, self.square, np.ones_like(self.square)])  # |q - x|^2 as one product
        self.reach = float(max(np.abs(x).max(initial=0.0), np.abs(self.middle).max(initial=0.0)))

    def asked(self, q, p):
        """(queries in single precision around the mean, a bound on the error of each one's rough measures) for p of 1 or 2; the bound is
        infinite where a rough measure may not be finite."""
        part = (q - self.middle).astype(np.float32)
        f, unit = q.shape[1], float(np.finfo(np.float32).eps)
        lost = float(np.finfo(float).eps) * max(self.reach, float(np.abs(q).max(initial=0.0)))  # by taking the mean off
        own, largest = (part * part).sum(axis=1), float(self.square.max())
        both = own.astype(float) + largest
        if p == 2:
            # inputs, products and sums are each off by at most a unit of the largest term
            slack = 4 * (f + 8) * unit * both + 8 * lost * np.sqrt(f * both) + 1e-36 * f
            part = np.column_stack([part, np.ones_like(own), own])
        else:
            size = np.sqrt(f * own.astype(float)) + np.sqrt(f * largest)  # the sum of sizes is at most sqrt(f) times the length
            slack = 4 * (f + 8) * unit * size + 8 * lost * f + 1e-36 * f
        return part, np.where(both < 1e38, slack, np.inf)

    def rough(self, part, p, at=slice(None)):
        """Measures in single precision between queries, as `asked` gives them, and the points `at`."""
        if p == 2:
            return part @ self.product[:, at]
        near = self.near[:, at]
        m = np.zeros((len(part), near.shape[1]), np.float32)
        for a in range(0, len(part), 16):
            for b in range(0, m.shape[1], 2_048):  # tiles that stay in the cache
                tile, line = m[a : a + 16, b : b + 2_048], near[:, b : b + 2_048]
                gap = np.empty(tile.shape, np.float32)
                for j in range(len(near)):
                    np.subtract(part[a : a + 16, j, None], line[j], out=gap)
                    np.abs(gap, out=gap)
                    tile += gap
        return m

    def within(self, part, p, reach):
        """(line, place) of all points up to every line's reach in single precision, tile by tile; reach may also be a function of the
        measures, which then are made all at once."""
        tiles = [slice(a, a + TILE) for a in range(0, len(self.x), TILE)]
        lines, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in [slice(0, None)] if callable(reach) else tiles:
            m = self.rough(part, p, at)
            most = reach(m) if callable(reach) else reach
            with np.errstate(over="ignore"):
                keep = m <= np.nextafter(most.astype(np.float32), np.float32(np.inf))[:, None]
            line, place = np.divmod(np.flatnonzero(keep), keep.shape[1])
            lines.append(line)
            places.append(place + at.start)
        return np.concatenate(lines), np.concatenate(places)


def _best(q, points, k, p, limit=None):
    """(query index, point index, measure) of the k best points per query, ties by point order. With `limit`, a measure for every query,
    points beyond it may be left out.

    Few features: points and queries are cut into small boxes, and a box of queries meets only those boxes of points that may hold one of
    its best. More features, p of 1 or 2: measures in single precision tell which points can be among the best. Either way these points
    are then measured exactly; lines with very many of them, as with many equal distances, are measured in full.
    """
    points = points if isinstance(points, _Points) else _Points(points)
    x = points.x
    take = min(k, len(x))
    boxes = q.shape[1] <= BOX_FEATURES and len(x) >= 4 * BOX_ROWS and np.isfinite(x).all() and np.isfinite(q).all()
    found = _best_in_boxes(q, x, take, p, limit) if boxes else _best_in_lines(q, points, take, p, limit)
    qi, xi, m = (np.concatenate(v) for v in zip(*found))
    order = np.argsort(qi, kind="stable")
    return qi[order], xi[order], m[order]


def _in_full(q, x, take, p):
    m = _measure(q, x, p)
    near = _nearest(m, take)
    values = np.take_along_axis(m, near, axis=1)
    order = np.argsort(values, axis=1, kind="stable")
    return np.take_along_axis(near, order, axis=1), np.take_along_axis(values, order, axis=1)


def _least(m, take):
    """The measure of every line's `take`th entry in ascending order, or of its last."""
    take = min(take, m.shape[1])
    return np.partition(m, take - 1, axis=1)[:, take - 1]


def _best_in_lines(q, points, take, p, limit):
    x = points.x
    some = p in (1, 2) and take * 4 < len(x) and q.shape[1] > 3
    few = some and p == 2 and len(x) >= 4 * SOME * take  # the product is cheap, so that a part of the points can be measured twice
    step = max(1, min(LINES, MATRIX_CELLS // max(1, len(x))) if some else MATRIX_CELLS // max(1, len(x)))
    for start in range(0, len(q), step):
        part = q[start : start + step]
        whole = np.arange(len(part))
        if some:
            with np.errstate(all="ignore"):
                asked, slack = points.asked(part, p)
            if np.isfinite(slack).all():
                if limit is not None:
                    reach = limit[start : start + step] * (1 + 1e-9) + slack
                else:
                    reach = lambda m: _least(m, take) + 2 * slack
                    reach = reach(points.rough(asked, p, slice(None, None, SOME))) if few else reach
                qi, xi = points.within(asked, p, reach)
                many = np.bincount(qi, minlength=len(part)) > take + MAX_NEAR
                if many.any() and not callable(reach):  # the limit, or what a part of the points told, is far beyond the best
                    lines, kept = np.flatnonzero(many), ~many[qi]
                    line, place = points.within(asked[lines], p, lambda m: np.minimum(reach[lines], _least(m, take) + 2 * slack[lines]))
                    qi, xi = np.concatenate([qi[kept], lines[line]]), np.concatenate([xi[kept], place])
                many = np.bincount(qi, minlength=len(part)) > take + MAX_NEAR
                whole, kept = np.flatnonzero(many), ~many[qi]
                qi, xi = qi[kept], xi[kept]
                m = _measured_pairs(part, x, qi, xi, p)
                order = np.lexsort((xi, m, qi))
                qi, xi, m = qi[order], xi[order], m[order]
                best = np.arange(len(qi)) - np.searchsorted(qi, qi) < take
                yield start + qi[best], xi[best], m[best]
        if len(whole):
            xi, m = _in_full(part[whole], x, take, p)
            yield np.repeat(start + whole, take), xi.ravel(), m.ravel()


def _boxes(v, rows):
    """Places of the rows of v in boxes of at most `rows`, halved at the middle of the widest side."""
    open_, out = [np.arange(len(v))], []
    while open_:
        at = open_.pop()
        if len(at) <= rows:
            out.append(at)
            continue
        part = v[at]
        side = int((part.max(axis=0) - part.min(axis=0)).argmax())
        half = len(at) // 2
        order = np.argpartition(part[:, side], half)
        open_ += [at[order[:half]], at[order[half:]]]
    return out


def _best_in_boxes(q, x, take, p, limit):
    held = _boxes(x, BOX_ROWS)
    lo, hi = (np.array([f(x[at], axis=0) for at in held]) for f in (np.min, np.max))
    sizes = np.array([len(at) for at in held])
    for asked in _boxes(q, 2 * BOX_ROWS):
        part = q[asked]
        gap = np.maximum(np.maximum(lo - part.max(axis=0), part.min(axis=0) - hi), 0.0)
        least = _measure(gap, np.zeros((1, q.shape[1])), p)[:, 0]
        if limit is None:
            order = np.argsort(least, kind="stable")
            some = order[: max(int(np.searchsorted(np.cumsum(sizes[order]), take)) + 1, int((least == 0).sum()))]
            m = _measure(part, x[np.concatenate([held[i] for i in some])], p)
            reach = np.partition(m, take - 1, axis=1)[:, take - 1].max()
        else:
            reach = limit[asked].max()
        near = np.flatnonzero(least <= reach * (1 + 1e-9))
        if not len(near):
            continue
        at = np.sort(np.concatenate([held[i] for i in near]))
        few = min(take, len(at))
        step = max(1, MATRIX_CELLS // len(at))
        for a in range(0, len(asked), step):
            xi, m = _in_full(part[a : a + step], x[at], few, p)
            yield np.repeat(asked[a : a + step], few), at[xi].ravel(), m.ravel()
    yield np.zeros(0, int), np.zeros(0, int), np.zeros(0)


def _vectors(table, features, key, extra=()):
    """(_id, _v, extras); rows with a missing feature cannot be compared and are left out."""
    v = F.array(*[F.col(f).cast("double") for f in features])
    return complete_rows(table, list(features)).select(F.col(key).alias("_id"), v.alias("_v"), *extra)


def _matrix(series):
    return np.array(series.tolist(), dtype=float)


def _result_schema(points, queries, carry):
    fields = [
        T.StructField("_q", queries.schema["_id"].dataType),
        T.StructField("_n", points.schema["_id"].dataType),
        T.StructField("_m", T.DoubleType()),
    ]
    return T.StructType(fields + [T.StructField(c, points.schema[c].dataType) for c in carry])


def _frame(q_ids, x_frame, qi, xi, m, carry):
    out = {"_q": np.asarray(q_ids, dtype=object)[qi], "_n": x_frame["_id"].to_numpy()[xi], "_m": m}
    for c in carry:
        out[c] = x_frame[c].to_numpy()[xi]
    return pd.DataFrame(out)


def knn_join(
    queries: DataFrame,
    points: DataFrame,
    features,
    key: str,
    k: int,
    p: int = 2,
    exclude_self: bool = False,
    carry=(),
    broadcast_points: int = BROADCAST_POINTS,
) -> DataFrame:
    """(query_id, neighbor_id, rank, distance, carried point columns) for the k nearest points.

    Distance ties go to the smaller id. `exclude_self` drops the pair of equal ids.
    """
    carry = list(carry)
    want = k + 1 if exclude_self else k
    q = _vectors(queries, features, key)
    x = _vectors(points, features, key, [F.col(c) for c in carry])
    if rows_within(x, broadcast_points):
        ranked = _scan_with_all_points(q, x, want, p, carry, exclude_self).filter(F.col("rank") <= k)
    else:
        copies = Window.partitionBy("_v").orderBy("_id")
        few = x.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= want).drop("_copy")
        found = _search_cells(q, few, _pivots(x), want, p, carry)
        if exclude_self:
            found = found.filter(F.col("_q") != F.col("_n"))
        best = Window.partitionBy("_q").orderBy("_m", "_n")
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    distance = F.sqrt("_m") if p == 2 else F.pow("_m", F.lit(1.0 / p)) if p != 1 else F.col("_m")
    return ranked.select(
        F.col("_q").alias("query_id"), F.col("_n").alias("neighbor_id"), "rank", distance.alias("distance"), *carry
    )


def _scan_with_all_points(q, x, k, p, carry, exclude_self):
    """Every query meets all points in one task, so its ranks are known there: no shuffle."""
    frame = x.toPandas().sort_values("_id", ignore_index=True)  # size was checked
    matrix = _matrix(frame["_v"]) if len(frame) else None

    def scan(batches):
        points = _Points(matrix) if matrix is not None else None
        for pdf in batches:
            if len(pdf) and points is not None:
                qi, xi, m = _best(_matrix(pdf["_v"]), points, k, p)
                out = _frame(pdf["_id"].to_numpy(), frame, qi, xi, m, carry)
                keep = (out["_q"] != out["_n"]).to_numpy() if exclude_self else np.ones(len(out), dtype=bool)
                out["rank"] = np.cumsum(keep.reshape(len(pdf), -1), axis=1).ravel()
                yield out[keep]

    schema = T.StructType([*_result_schema(x, q, carry).fields, T.StructField("rank", T.IntegerType())])
    return q.mapInPandas(scan, schema)


def _pivots(x):
    """About sqrt(n) random rows, so that finding a cell costs as much as searching it."""
    m = int(min(MAX_PIVOTS, max(16, x.count() ** 0.5)))
    rows = x.select("_id", "_v").orderBy(hash32("_id", 7), "_id").limit(m).collect()
    return np.unique(np.array([r["_v"] for r in rows], dtype=float), axis=0)


def _search_cells(q, x, pivots, k, p, carry):
    def true_distance(v):
        d = _measure(v, pivots, p)
        return np.sqrt(d) if p == 2 else d ** (1.0 / p)

    def in_chunks(v):
        step = max(1, MATRIX_CELLS // len(pivots))
        return [slice(i, i + step) for i in range(0, len(v), step)]

    @F.pandas_udf("struct<cell:int,d:double>")
    def nearest_pivot(v: pd.Series) -> pd.DataFrame:
        _, cell, m = _best(_matrix(v), pivots, 1, p)
        return pd.DataFrame({"cell": cell.astype("int32"), "d": np.sqrt(m) if p == 2 else m ** (1.0 / p)})

    spark = q.sparkSession
    x = cut_lineage(x.withColumn("_c", nearest_pivot("_v")).select("*", "_c.*").drop("_c"))
    forget(spark)
    stats = x.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()
    count = np.zeros(len(pivots))
    radius = np.full(len(pivots), -np.inf)  # an empty cell is never visited
    for r in stats:
        count[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    filled = np.flatnonzero(count)

    @F.pandas_udf("array<int>")
    def first_cells(v: pd.Series) -> pd.Series:
        take = min(k, len(filled))
        cells = filled[_best(_matrix(v), pivots[filled], take, p)[1].reshape(-1, take)]
        need = (np.cumsum(count[cells], axis=1) < k).sum(axis=1) + 1
        return pd.Series([c[:e] for c, e in zip(cells, need)], dtype=object)

    # first the closest cells, for a measure that each query must beat; then whole bundles of cells, so that a query travels once to
    # each bundle and not to each of its cells
    sizes = {i: int(c) for i, c in enumerate(count) if c}
    rows = _block_rows(q.sparkSession, int(count.sum()))
    numbered = q.withColumns({"_row": F.monotonically_increasing_id(), "_limit": F.lit(None).cast("double")})  # ids may repeat or be null
    start = cut_lineage(numbered.withColumn("_cells", first_cells("_v")))
    first = _visit(start, x, sizes, k, p, [], rows, measures=True)
    reach = first.groupBy("_row").agg(F.sort_array(F.flatten(F.collect_list("_m"))).alias("_all"))  # k a block at most
    reach = reach.select("_row", F.try_element_at("_all", F.lit(k)).alias("_limit"))
    limit = F.sqrt("_limit") if p == 2 else F.pow("_limit", F.lit(1.0 / p)) if p != 1 else F.col("_limit")
    known = start.drop("_cells", "_limit").join(reach, "_row")
    bundles = list(_bundles(pivots, count, rows))
    bundle = np.zeros(len(pivots), int)
    for i, cells in enumerate(bundles):
        bundle[cells] = i
    totals = {i: int(count[cells].sum()) for i, cells in enumerate(bundles)}
    placed = q.sparkSession.createDataFrame([(int(c), int(bundle[c])) for c in filled], "cell int, _bundle int")
    x = x.join(F.broadcast(placed), "cell").drop("cell").withColumnRenamed("_bundle", "cell")
    boxes = pivots.shape[1] <= BOX_FEATURES
    if boxes:
        sides = [f(F.col("_v")[j]).alias(f"{n}{j}") for n, f in (("lo", F.min), ("hi", F.max)) for j in range(pivots.shape[1])]
        at = {r["cell"]: r for r in x.groupBy("cell").agg(*sides).collect()}
        lo, hi = (np.array([[at[i][f"{n}{j}"] for j in range(pivots.shape[1])] for i in range(len(bundles))]) for n in ("lo", "hi"))

    @F.pandas_udf("array<int>")
    def open_bundles(v: pd.Series, limit: pd.Series) -> pd.Series:
        reach, rows, out = limit.to_numpy(dtype=float), _matrix(v), []
        reach = np.where(np.isnan(reach), np.inf, reach) * (1 + 1e-9) + 1e-9
        for part in in_chunks(rows):
            q, r = rows[part], reach[part][:, None]
            if boxes:
                gap = np.maximum(np.maximum(lo[None] - q[:, None], q[:, None] - hi[None]), 0.0)
                d = _measure(gap.reshape(-1, q.shape[1]), np.zeros((1, q.shape[1])), p).reshape(len(q), -1)
                out += [np.flatnonzero(ok) for ok in ~((np.sqrt(d) if p == 2 else d ** (1.0 / p)) > r)]
            else:
                d = true_distance(q)
                # two lower bounds on the distance to a cell's points: its radius, and that its
                # points are at least as close to their own pivot as to the query's
                open_ = (d - radius[None, :] <= r) & ((d - d.min(axis=1, keepdims=True)) / 2 <= r) & (count > 0)[None, :]
                out += [np.unique(bundle[ok]) for ok in open_]
        return pd.Series(out, dtype=object)

    more = cut_lineage(known.withColumn("_cells", open_bundles("_v", limit)))
    del start, first, reach, known  # the search to come needs the disk that these take
    forget(spark)
    return _visit(more, x, totals, k, p, carry, rows)


def _block_rows(spark, n):
    """Rows of a block: enough blocks for all cores, and never more than BLOCK_ROWS."""
    return int(min(BLOCK_ROWS, max(1_000, n / (4 * spark.sparkContext.defaultParallelism) ** 0.5)))


def _bundles(pivots, count, rows):
    """Lists of neighbouring cells of about `rows` points, halved along the widest side; a larger cell is one by itself."""
    open_ = [np.flatnonzero(count)]
    while open_:
        cells = open_.pop()
        if count[cells].sum() <= rows or len(cells) < 2:
            if len(cells):
                yield cells
            continue
        part = pivots[cells]
        order = cells[np.argsort(part[:, int((part.max(axis=0) - part.min(axis=0)).argmax())], kind="stable")]
        half = min(max(int(np.searchsorted(np.cumsum(count[order]), count[order].sum() / 2)), 1), len(order) - 1)
        open_ += [order[:half], order[half:]]


def _visit(queries, x, sizes, k, p, carry, rows, measures=False):
    """k best points per (query, block) for every cell in the query's list; with `measures` only their measures, one row a query."""
    visits = queries.select("_id", "_row", "_v", "_limit", F.explode("_cells").alias("cell"))
    load = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}
    plan = [(c, -(-sizes[c] // rows), -(-n // rows)) for c, n in load.items() if c in sizes]
    schema = _result_schema(x, queries, carry)
    if measures:
        schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_m", T.ArrayType(T.DoubleType()))])
    spark = queries.sparkSession
    if not plan:
        return spark.createDataFrame([], schema)
    plan = F.broadcast(spark.createDataFrame(plan, "cell int, _blocks int, _chunks int"))
    part = lambda n: F.pmod(F.xxhash64("_id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    by_row = F.pmod(F.xxhash64("_row"), F.col("_chunks")).cast("int")
    left = visits.join(plan, "cell").withColumn("_chunk", by_row if measures else part(F.col("_chunks"))).withColumn("_block", every(F.col("_blocks")))
    right = x.join(plan, "cell").withColumn("_block", part(F.col("_blocks"))).withColumn("_chunk", every(F.col("_chunks")))

    def search(q_frame, x_frame):
        if not len(q_frame) or not len(x_frame):
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in schema.fields})
        x_frame = x_frame if measures else x_frame.sort_values("_id", ignore_index=True)
        limit = q_frame["_limit"].to_numpy(dtype=float)
        limit = None if measures else np.where(np.isnan(limit), np.inf, limit)
        qi, xi, m = _best(_matrix(q_frame["_v"]), _matrix(x_frame["_v"]), k, p, limit)
        if measures:
            first = np.searchsorted(qi, np.arange(len(q_frame) + 1))
            return pd.DataFrame({"_row": q_frame["_row"], "_m": [m[a:b] for a, b in zip(first[:-1], first[1:])]})
        return _frame(q_frame["_id"].to_numpy(), x_frame, qi, xi, m, carry)

    group, ids = ["cell", "_block", "_chunk"], [] if measures else ["_id"]  # measures alone need no ids
    return (
        left.select(*ids, "_row", "_v", "_limit", *group).groupBy(*group)
        .cogroup(right.select(*ids, "_v", *carry, *group).groupBy(*group))
        .applyInPandas(search, schema)
    )


def neighbour_graph(df, features, key, k, p=2) -> DataFrame:
    """Symmetric fuzzy neighbour graph: (a, b, weight).

    Each row's edges get exp(-(d - nearest) / sigma), with sigma set so that the
    weights add up to log2(k); the two directions combine as a + b - ab.
    """
    edges = knn_join(df, df, features, key, k, p=p, exclude_self=True)
    lists = edges.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near")  # k entries at most
    )
    target = float(np.log2(k))

    @F.pandas_udf("array<double>")
    def weights(near: pd.Series) -> pd.Series:
        d = np.full((len(near), k), np.inf)  # a missing neighbour weighs nothing
        for i, ds in enumerate(near):
            d[i, : len(ds)] = ds
        gap = d - d.min(axis=1, keepdims=True)
        lo, hi, sigma = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
        for _ in range(64):
            wide = np.exp(-gap / sigma[:, None]).sum(axis=1) > target
            hi, lo = np.where(wide, sigma, hi), np.where(wide, lo, sigma)
            sigma = np.where(np.isinf(hi), sigma * 2, (lo + np.minimum(hi, 1e300)) / 2)
        w = np.exp(-gap / np.maximum(sigma, 1e-12)[:, None])
        return pd.Series([row[: len(ds)] for row, ds in zip(w, near)], dtype=object)

    weighted = lists.withColumn("w", weights(F.transform("near", lambda e: e["distance"])))
    directed = weighted.select(
        F.col("query_id").alias("a"), F.explode(F.arrays_zip(F.col("near.neighbor_id").alias("b"), F.col("w").alias("w"))).alias("e")
    ).select("a", F.col("e.b").alias("b"), F.col("e.w").alias("w"))
    both = directed.union(directed.select("b", "a", "w"))
    total = F.sum("w")
    return both.groupBy("a", "b").agg(
        F.when(F.count(F.lit(1)) == 1, total).otherwise(total - F.min("w") * F.max("w")).alias("weight")
    )


def knn_predict(
    queries, points, features, key, target, k, p=2, weights="uniform", task="regress", exclude_self=False, **search
) -> DataFrame:
    """(key, prediction): mean or vote of the k nearest targets.

    'distance' weighs by 1/distance; exact matches, where there are any, decide alone.
    """
    near = knn_join(queries, points, features, key, k, p=p, exclude_self=exclude_self, carry=[target], **search)
    return predict_from_neighbors(near, target, weights, task).withColumnRenamed("query_id", key)


def predict_from_neighbors(near, target, weights="uniform", task="regress", by=()):
    """(query_id, by, prediction). `weights` is 'uniform', 'distance' or a column of these."""
    group = ["query_id", *by]
    weights = F.lit(weights) if isinstance(weights, str) else weights
    exact = F.max(F.when(F.col("distance") == 0.0, 1).otherwise(0)).over(Window.partitionBy(*group))
    inverse = F.when(exact == 1, F.when(F.col("distance") == 0.0, 1.0).otherwise(0.0)).otherwise(
        F.try_divide(F.lit(1.0), F.col("distance"))
    )
    weighted = near.withColumn("_w", F.when(weights == "uniform", F.lit(1.0)).otherwise(inverse))
    if task == "regress":
        return weighted.groupBy(*group).agg((F.sum(F.col("_w") * F.col(target)) / F.sum("_w")).alias("prediction"))
    votes = weighted.groupBy(*group, target).agg(F.sum("_w").alias("_votes"))
    return votes.groupBy(*group).agg(
        F.min_by(target, F.struct(-F.round("_votes", 12), F.col(target))).alias("prediction")
    )
