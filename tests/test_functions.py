import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.functions import quantiles, spreading
from rowloom.functions.lineage import cut_lineage, scratch_path
from rowloom.functions.moments import grouped_moments, moments, sum_over_rows
from rowloom.functions.nulls import complete_rows
from rowloom.functions.ranking import hash_rank, order_index


def numbers(spark, n=5000, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, float(rng.normal()), float(rng.integers(0, 7)), "hot" if i % 3 else f"v{i}") for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, k double, s string").repartition(5)


def test_order_index_counts_in_sort_order(spark):
    df = numbers(spark)
    indexed, n = order_index(df, F.col("k"), F.col("id"))
    rows = indexed.select("k", "id", "idx").collect()
    assert n == len(rows) == 5000
    want = {i: p for p, (_, i) in enumerate(sorted((r["k"], r["id"]) for r in rows))}
    assert all(want[r["id"]] == r["idx"] for r in rows)


@pytest.mark.parametrize("by", [[], ["s"], ["k", "s"]])
def test_hash_rank_is_a_dense_rank_per_group(spark, by):
    ranked = hash_rank(numbers(spark), "id", by=by).collect()
    groups = {}
    for r in ranked:
        groups.setdefault(tuple(r[c] for c in by), []).append(r)
    for rows in groups.values():
        assert sorted(r["rank"] for r in rows) == list(range(len(rows)))
        assert {r["rank_n"] for r in rows} == {len(rows)}


def test_hash_rank_does_not_depend_on_partitions(spark):
    df = numbers(spark, 500)
    a = {r["id"]: r["rank"] for r in hash_rank(df.repartition(1), "id", by=["s"]).collect()}
    b = {r["id"]: r["rank"] for r in hash_rank(df.repartition(7), "id", by=["s"]).collect()}
    assert a == b


def test_hash_rank_groups_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, g string")
    assert sorted((r["g"] or "", r["rank"]) for r in hash_rank(df, "id", by=["g"]).collect()) == [("", 0), ("", 1), ("a", 0)]


@pytest.mark.parametrize("bracket_rows, sample", [(20_000, (1_000_000, 1_000_000)), (50, (2_000, 2_000))])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, bracket_rows, sample):
    monkeypatch.setattr(quantiles, "MAX_BRACKET_ROWS", bracket_rows)
    monkeypatch.setattr(quantiles, "SAMPLE_VALUES", sample)
    df = numbers(spark).withColumn("gap", F.when(F.col("id") % 5 > 0, F.col("x")))
    wanted = {"x": [0.0, 0.001, 0.25, 0.5, 0.97, 1.0], "k": [0.1, 0.5, 0.9], "gap": [0.5]}
    got = quantiles.exact_quantiles(df, wanted, small=0)
    pdf = df.toPandas()
    for (c, q), v in got.items():
        assert v == pytest.approx(pdf[c].quantile(q), abs=1e-12)


def test_quantiles_with_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id").cast("double")).alias("x"))
    got = quantiles.exact_quantiles(df, {"x": [0.2, 0.333, 0.34, 0.5]}, small=0)
    pdf = df.toPandas()
    assert all(v == pytest.approx(pdf["x"].quantile(q)) for (_, q), v in got.items())


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantiles.exact_quantiles(df, {"x": [0.5]}) == {("x", 0.5): None}
    assert quantiles.exact_quantiles(df.limit(0), {"x": [0.5]}, small=0) == {("x", 0.5): None}


def test_moments_match_numpy_and_merge(spark):
    df = numbers(spark, 1000)
    m = moments(df, ["x", "k"])
    z = df.select("x", "k").toPandas().to_numpy()
    assert np.allclose(m.comoment, np.cov(z.T, bias=True) * 1000)
    parts = grouped_moments(df.withColumn("g", F.col("id") % 3), ["x", "k"], "g")
    merged = parts[0].merge(parts[1]).merge(parts[2])
    assert np.allclose(merged.comoment, m.comoment) and np.allclose(merged.mean, m.mean)
    back = merged.merge(parts[2], -1)
    assert np.allclose(back.comoment, parts[0].merge(parts[1]).comoment)


def test_wide_moments(spark):
    cols = [F.col("x").alias("c0")] + [(F.col("x") * i + F.col("k")).alias(f"c{i}") for i in range(1, 15)]
    df = numbers(spark, 400).select(*cols)
    z = df.toPandas().to_numpy()
    assert np.allclose(moments(df, df.columns).comoment, np.cov(z.T, bias=True) * 400)


def test_balanced_sum(spark):
    from rowloom.functions.moments import balanced_sum

    for n in (1, 2, 5, 64):
        assert spark.range(1).select(balanced_sum([F.lit(i) for i in range(n)])).first()[0] == sum(range(n))


def test_grouped_wide_moments(spark):
    df = numbers(spark, 200).select((F.col("id") % 2).alias("g"), *[(F.col("x") + i * F.col("k")).alias(f"c{i}") for i in range(14)])
    names = [f"c{i}" for i in range(14)]
    parts = grouped_moments(df, names, "g")
    assert np.allclose(parts[0].merge(parts[1]).comoment, moments(df, names).comoment)


def test_long_sums(spark):
    total = sum_over_rows(numbers(spark, 100), ["x"], lambda z: np.full(5000, float(len(z))), 5000)
    assert (total == 100).all()


def test_complete_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "a long, b double")
    assert complete_rows(df).collect() == [(2, 3.0)]


def test_checkpoint_folder_is_taken_from_the_session(spark):
    df = cut_lineage(spark.range(3))
    assert df.count() == 3
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert "x-" in scratch_path(spark, "x")


def test_many_quantiles_of_a_column_come_from_one_sort(spark, monkeypatch):
    rows = spark.createDataFrame([(None if i % 11 == 0 else float(i * 7919 % 1009), float(i % 3)) for i in range(3_000)], "v double, w double")
    wanted = {"v": [i / 64 for i in range(65)], "w": [0.5]}
    want = quantiles.exact_quantiles(rows, wanted)
    narrowed, plain = [], quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda table, targets, round_: narrowed.extend(t.column for t in targets) or plain(table, targets, round_))
    assert quantiles.exact_quantiles(rows, wanted, small=0) == pytest.approx(want, rel=1e-12) and set(narrowed) == {"w"}


def test_partitions_of_many_rows_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(spreading, "PART_ROWS", 100)
    even, skewed = spark.range(0, 300, 1, 4), spark.range(0, 300, 1, 4).select(F.when(F.col("id") < 270, 0).otherwise(F.col("id")).alias("id")).repartition(8, "id")
    assert spreading.spread(even) is even
    for df, most in ((skewed, 90), (spark.range(0, 1000, 1, 4), 110)):
        out = spreading.settle(df)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= most and sum(sizes) == df.count()
        assert sorted(r[0] for r in out.collect()) == sorted(r[0] for r in df.collect())
        out.unpersist()
