"""The neighbour join against brute force, through both of its paths, with copies and ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.operators import neighbors as N
from rowloom.operators import resample as R


def frame(spark, x, y=None):
    y = y if y is not None else [0] * len(x)
    rows = [(i, int(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y))]
    names = ", ".join(f"f{j} double" for j in range(len(x[0])))
    return spark.createDataFrame(rows, f"id long, y int, {names}").repartition(4)


def brute(x, k, p, skip_self):
    m = (np.abs(x[:, None] - x[None]) ** p).sum(2)
    out = {}
    for i in range(len(x)):
        order = [j for j in sorted(range(len(x)), key=lambda j: (m[i, j], j)) if not (skip_self and i == j)][:k]
        out[i] = order
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = r["neighbor_id"]
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


def points_with_copies(n=300):
    """A third of all rows are one vector, and integer grids give many equal distances."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, size=(n, 3)).astype(float)
    x[: n // 3] = [1.0, 2.0, 3.0]
    return x


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("limit", [20_000, 10])
def test_join_is_exact(spark, monkeypatch, p, limit):
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    x = points_with_copies()
    df = frame(spark, x)
    got = found(N.knn_join(df, df, ["f0", "f1", "f2"], "id", 4, p=p, exclude_self=True, broadcast_points=limit))
    assert got == brute(x, 4, p, True)


def test_fewer_points_than_k(spark):
    df = frame(spark, [[0.0], [1.0], [5.0]])
    for limit in (100, 1):
        got = found(N.knn_join(df, df, ["f0"], "id", 10, broadcast_points=limit))
        assert got == {0: [0, 1, 2], 1: [1, 0, 2], 2: [2, 1, 0]}


def test_empty_points(spark):
    df = frame(spark, [[0.0], [1.0]])
    assert N.knn_join(df, df.limit(0), ["f0"], "id", 2).count() == 0


def test_carried_columns_and_vote(spark):
    x = [[0.0], [0.1], [0.2], [5.0], [5.1]]
    df = frame(spark, x, [1, 1, 0, 0, 0])
    got = {r["id"]: r["prediction"] for r in N.knn_predict(df, df, ["f0"], "id", "y", 3, task="classify").collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0}


def test_exact_match_decides_alone(spark):
    df = frame(spark, [[0.0], [1.0], [2.0]], [10, 20, 30])
    got = {r["id"]: r["prediction"] for r in N.knn_predict(df, df, ["f0"], "id", "y", 3, weights="distance").collect()}
    assert got == {0: 10.0, 1: 20.0, 2: 30.0}


def test_graph_weights(spark):
    rng = np.random.default_rng(0)
    df = frame(spark, rng.normal(size=(60, 3)))
    w = {(r["a"], r["b"]): r["weight"] for r in N.neighbour_graph(df, ["f0", "f1", "f2"], "id", 8).collect()}
    assert all(w[(b, a)] == pytest.approx(v) for (a, b), v in w.items())
    assert all(0 < v <= 1 + 1e-9 for v in w.values())


def imbalanced(spark, n=120):
    rng = np.random.default_rng(5)
    y = (rng.random(n) < 0.2).astype(int)
    return frame(spark, rng.normal(size=(n, 2)), y), y


def test_resampled_counts(spark):
    df, y = imbalanced(spark)
    big, small = (y == 0).sum(), (y == 1).sum()
    assert R.class_counts(R.random_oversample(df, "id", "y"), "y") == {0: big, 1: big}
    assert R.class_counts(R.random_undersample(df, "id", "y"), "y") == {0: small, 1: small}
    assert R.class_counts(R.smote(df, "id", "y", ["f0", "f1"]), "y") == {0: big, 1: big}
    over = R.random_oversample(df, "id", "y", targets={1: 77})
    assert R.class_counts(over, "y") == {0: big, 1: 77}


def test_few_rows_make_many_draws(spark, monkeypatch):
    df = frame(spark, [[float(i)] for i in range(3)], [1, 0, 0])
    out = R.random_oversample(df, "id", "y", targets={0: 2, 1: 500})
    assert R.class_counts(out, "y") == {0: 2, 1: 500}
    assert out.filter("y = 1").select("copy_no").distinct().count() == 500
    monkeypatch.setattr(R, "DRAWS_PER_ROW", 10)
    df = spark.createDataFrame([(1, 0, "a"), (2, 0, "a"), (3, 1, "a")], "id long, y int, g string")
    out = R.adjust_proportion(df, "id", "y", ["g"], 100)
    assert out.filter("y = 0").select("copy_no").distinct().count() == 199 and out.count() == 200


def test_synthetic_rows_lie_between_minority_rows(spark):
    df, _ = imbalanced(spark)
    rows = R.smote(df, "id", "y", ["f0", "f1"], k=3)
    minority = df.filter("y = 1").toPandas().set_index("id")
    near = found(N.knn_join(df.filter("y = 1"), df.filter("y = 1"), ["f0", "f1"], "id", 3, exclude_self=True))
    for r in rows.filter("copy_no > 0").collect():
        base = minority.loc[r["id"], ["f0", "f1"]].to_numpy(float)
        made = np.array([r["f0"], r["f1"]])
        ok = False
        for n in near[r["id"]]:
            step = minority.loc[n, ["f0", "f1"]].to_numpy(float) - base
            u = np.dot(made - base, step) / np.dot(step, step)
            ok = ok or (-1e-9 <= u < 1 and np.allclose(base + u * step, made))
        assert ok


def test_one_member_class_is_refused(spark):
    with pytest.raises(ValueError):
        R.smote(frame(spark, [[0.0], [1.0], [2.0]], [0, 0, 1]), "id", "y", ["f0"])


def test_adjust_proportion(spark):
    rows = [(i, int(i % 4 == 0), "a" if i < 40 else "b" if i < 60 else "c") for i in range(70)]
    df = spark.createDataFrame([(i, 0 if g == "c" else y, g) for i, y, g in rows], "id long, y int, g string")
    got = {(r["group_value"], r["y"]): r["count"] for r in R.adjust_proportion(df, "id", "y", ["g"], 2).groupBy("group_value", "y").count().collect()}
    assert got == {("a", 0): 60, ("a", 1): 5, ("b", 0): 30, ("b", 1): 2}


def test_tomek_and_edited(spark):
    df = frame(spark, [[0.0], [0.1], [5.0], [5.1], [5.2], [9.0]], [0, 1, 0, 0, 0, 0])
    assert [tuple(r)[:2] for r in R.tomek_links(df, "id", "y", ["f0"]).collect()] == [(0, 1)]
    assert R.remove_tomek_links(df, "id", "y", ["f0"]).count() == 5
    assert R.remove_tomek_links(df, "id", "y", ["f0"], remove="all").count() == 4
    kept = {r["id"] for r in R.edited_nearest_neighbours(df, "id", "y", ["f0"]).collect()}
    assert kept == {3, 4, 5} or kept == {2, 3, 4, 5}
    assert df.filter(F.col("id") == 1).count() == 1


@pytest.mark.parametrize("p", [1, 2])
def test_few_pairs_are_measured_in_full(monkeypatch, p):
    """Points that can't be among the best are told by one product, or by their boxes, not by a sum over all features."""
    rng = np.random.default_rng(11)
    cells, measure = [], N._measure
    monkeypatch.setattr(N, "_measure", lambda q, x, p: cells.append(len(q) * len(x)) or measure(q, x, p))
    for f, share in ((64, 0.02), (3, 0.4)):
        x = rng.uniform(size=(3_000, f)) + 50
        x[::50] = x[7]  # copies: ties go to the first ones
        q = x[::2] + 0.01
        cells.clear()
        qi, xi, m = N._best(q, x, 5, p)
        assert sum(cells) < share * len(q) * len(x)
        want = (np.abs(q[:, None] - x[None]) ** p).sum(2)
        assert qi.tolist() == np.repeat(np.arange(len(q)), 5).tolist()
        assert xi.reshape(-1, 5).tolist() == np.argsort(np.round(want, 9), axis=1, kind="stable")[:, :5].tolist()
        assert np.allclose(m.reshape(-1, 5), np.sort(want, axis=1)[:, :5])


@pytest.mark.parametrize("p", [1, 2])
def test_bundles_of_cells_in_many_features(spark, monkeypatch, p):
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)) + 4 * rng.integers(0, 3, size=(400, 1))
    x[:30] = x[0]
    df = frame(spark, x)
    got = found(N.knn_join(df, df, [f"f{j}" for j in range(12)], "id", 4, p=p, exclude_self=True, broadcast_points=10))
    assert got == brute(x, 4, p, True)


def test_rows_with_repeated_ids_are_searched_each_by_itself(spark, monkeypatch):
    """A row that comes twice finds itself twice; this must not close the cells of its other neighbours."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    x = np.random.default_rng(2).normal(size=(120, 3))
    df = frame(spark, x)
    got = found(N.knn_join(df.union(df), df.union(df), ["f0", "f1", "f2"], "id", 3, exclude_self=True, broadcast_points=10))
    near = brute(x, 2, 2, True)
    assert got == {i: [near[i][0], near[i][0], near[i][0]] for i in range(120)}


def test_rough_measures_are_held_in_tiles(monkeypatch):
    """Searching many points holds no line of measures whole, and a part of the points far from the queries misleads nobody."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5_000, 24))
    x[::4] += 40  # one of four points, as the first look takes them, is far off
    x[::500] = x[1]
    q = np.concatenate([x[1:400:4], x[:40:4] + 0.1])
    want = ((q[:, None] - x[None]) ** 2).sum(2)
    order, seen = np.argsort(want, axis=1, kind="stable"), []
    rough = N._Points.rough
    monkeypatch.setattr(N._Points, "rough", lambda self, *a: seen.append(rough(self, *a)) or seen[-1])
    best = np.take_along_axis(want, order, axis=1)[:, 2]
    for limit in (None, best, best * 3):
        seen.clear()
        qi, xi, m = N._best(q, x, 3, 2, limit)
        assert qi.tolist() == np.repeat(np.arange(len(q)), 3).tolist()
        assert xi.reshape(-1, 3).tolist() == order[:, :3].tolist()
        assert np.allclose(m.reshape(-1, 3), np.take_along_axis(want, order, axis=1)[:, :3])
        if limit is best:  # a looser one may need the whole lines of a few queries
            assert seen and max(v.size for v in seen) <= N.LINES * N.TILE
    seen.clear()
    far = np.vstack([q[:3], np.full((1, 24), 1e30)])  # too large for single precision: measured in full
    want = ((far[:, None] - x[None]) ** 2).sum(2)
    assert N._best(far, x, 3, 2)[1].reshape(-1, 3)[:3].tolist() == np.argsort(want, axis=1, kind="stable")[:3, :3].tolist()
    assert not seen


@pytest.mark.parametrize("p", [1, 2])
def test_a_loose_limit_measures_few_pairs(monkeypatch, p):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3_000, 24))
    q = x[:200] + 0.01
    cells, measure = [], N._measure
    monkeypatch.setattr(N, "_measure", lambda q, x, p: cells.append(len(q) * len(x)) or measure(q, x, p))
    want = (np.abs(q[:, None] - x[None]) ** p).sum(2)
    qi, xi, m = N._best(q, x, 3, p, np.full(len(q), 1e3))
    assert sum(cells) < 0.02 * want.size
    assert xi.reshape(-1, 3).tolist() == np.argsort(want, axis=1, kind="stable")[:, :3].tolist()
    assert np.allclose(m.reshape(-1, 3), np.sort(want, axis=1)[:, :3])


def test_first_visit_moves_no_ids(spark):
    """The first visit asks for measures alone; ids, as wide as the vectors, would fill the disk twice more."""
    v = F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double"))
    rows = lambda: spark.range(60).select(F.md5(F.col("id").cast("string")).alias("_id"), v.alias("_v"), F.lit(0).alias("cell"), F.col("id").alias("_row"))
    x = rows().drop("_row")
    q = rows().drop("cell").withColumns({"_limit": F.lit(None).cast("double"), "_cells": F.array(F.lit(0))})
    found = N._visit(q, x, {0: 60}, 3, 2, [], 25, measures=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = plan[: plan.index("Project", plan.index("FlatMapCoGroups"))].split("FlatMapCoGroups")[1].splitlines()[0]
    assert "_id#" not in grouped and "_row#" in grouped
    got = {}
    for r in found.collect():
        got.setdefault(r["_row"], []).extend(r["_m"])
    points = np.array([r["_v"] for r in q.collect()])
    for r in q.collect():
        assert np.allclose(sorted(got[r["_row"]])[:3], sorted(((points - np.array(r["_v"])) ** 2).sum(axis=1))[:3])
