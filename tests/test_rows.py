"""Hand tables: nulls, ties, constants, empty input."""

import pytest
from pyspark.sql import functions as F

from rowloom.operators import clean, encode, profile, relevance, select, split
from rowloom.sources import tables


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(1, 1.0, None, "b", 5.0), (2, 2.0, 10.0, "a", 5.0), (3, 3.0, None, None, 5.0), (4, 100.0, 20.0, "a", 5.0)],
        "id long, x double, gap double, s string, one double",
    )


def test_null_profile_and_column_drops(small):
    assert sorted(map(tuple, clean.null_count_profile(small).collect())) == [("gap", 2), ("s", 1)]
    assert select.drop_columns_with_nulls(small).columns == ["id", "x", "one"]
    assert select.drop_constant_columns(small)[0].columns == ["id", "x", "gap", "s"]


def test_an_all_null_column_is_not_constant(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b double")
    assert select.constant_columns(df) == []


def test_median_fill_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert clean.fill_median(df).filter("x = 2.5").count() == 1


def test_fence_keeps_nulls(small):
    kept = clean.iqr_fence_upper(small, ["x", "gap"], 0.0, 0.5, 1.5)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 3]


def test_sequential_trim_differs_from_snapshot(spark):
    df = spark.createDataFrame([(float(i), float((i * 7) % 20)) for i in range(20)], "a double, b double")
    ranges = {"a": (0.1, 0.9), "b": (0.1, 0.9)}
    a = clean.quantile_trim_sequential(df, ranges)
    pdf = df.toPandas()
    for c, (lo, hi) in ranges.items():
        pdf = pdf[(pdf[c] >= pdf[c].quantile(lo)) & (pdf[c] <= pdf[c].quantile(hi))]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, pdf.to_numpy().tolist()))
    whole = df.toPandas()
    for c, (lo, hi) in ranges.items():
        whole = whole[(whole[c] >= df.toPandas()[c].quantile(lo)) & (whole[c] <= df.toPandas()[c].quantile(hi))]
    assert clean.quantile_trim_snapshot(df, ranges).count() == len(whole)


def test_duplicates(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, None)], "id long, v string")
    flags = {r["id"]: r["is_duplicate"] for r in clean.flag_duplicates(df, "id", ["v"]).collect()}
    assert flags == {1: False, 3: True, 2: False, 4: False, 5: True}
    assert clean.duplicate_rows(df, ["v"]).count() == 2


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert tables.nan_to_null(df).filter("x is null").count() == 1


def test_label_codes(spark, small):
    state = encode.label_dictionary(small, columns=["s"])
    assert sorted(((r["value"] or "~"), r["code"]) for r in state.collect()) == [("a", 0), ("b", 1), ("~", 2)]
    other = spark.createDataFrame([("z",), ("b",), (None,)], "s string")
    assert sorted(r["s"] for r in encode.label_encode(other, state, ["s"], unseen="last").collect()) == [1, 2, 3]
    assert [r["s"] for r in encode.label_encode(other, state, ["s"]).collect()].count(None) == 1
    with pytest.raises(Exception):
        encode.label_encode(other, state, ["s"], unseen="error").collect()


def test_numbers_are_coded_in_numeric_order(spark):
    df = spark.createDataFrame([(10, 0.5), (2, None), (-3, 7.0)], "i long, x double")
    out = encode.label_encode(df, encode.label_dictionary(df, columns=["i", "x"]), ["i", "x"])
    assert sorted(map(tuple, out.collect())) == [(0, 1), (1, 2), (2, 0)]


def test_shuffled_dictionary_join_gives_the_same_codes(spark, small, monkeypatch):
    state = encode.label_dictionary(small, columns=["s"])
    a = sorted(map(tuple, encode.label_encode(small, state, ["s"]).select("id", "s").collect()))
    monkeypatch.setattr(encode, "BROADCAST_CODES", 0)
    assert a == sorted(map(tuple, encode.label_encode(small, state, ["s"]).select("id", "s").collect()))


def test_scalers_leave_constants_alone(small):
    for fit in (encode.standard_state, encode.minmax_state, encode.robust_state):
        out = encode.apply_scale(small, fit(small, ["one", "x"]))
        assert {r["one"] for r in out.collect()} == {0.0}


def test_correlation_of_a_constant_is_null(small):
    r = {(a, b): v for a, b, v in relevance.correlation_matrix(small, ["x", "one", "id"]).collect()}
    assert r[("x", "one")] is None and r[("one", "one")] is None
    assert r[("x", "x")] == pytest.approx(1.0)
    assert r[("x", "id")] == pytest.approx(small.toPandas()[["x", "id"]].corr().iloc[0, 1])


def test_wide_correlation_equals_narrow(small, monkeypatch):
    cols = ["x", "gap", "one", "id"]
    a = {(r[0], r[1]): r[2] for r in relevance.correlation_matrix(small, cols).collect()}
    monkeypatch.setattr(relevance, "WIDE_PAIRS", 1)
    b = {(r[0], r[1]): r[2] for r in relevance.correlation_matrix(small, cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], abs=1e-9)


def test_mutual_information_of_itself_is_entropy(spark):
    df = spark.createDataFrame([("a", "a", "c")] * 2 + [("b", "b", "c")] * 2, "x string, y string, z string")
    got = {r["column_name"]: r["mi"] for r in relevance.mutual_information(df, ["x", "z"], "y").collect()}
    assert got["x"] == pytest.approx(0.6931471805599453) and got["z"] == pytest.approx(0.0)


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "x", bins=5).collect()}
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    assert profile.histogram(df.limit(0), "x").count() == 0


def test_splits_partition_the_table(spark):
    df = spark.range(1000)
    train, held = split.holdout_split(df, "id", 0.3)
    assert train.count() + held.count() == 1000 and train.join(held, "id").count() == 0
    exact = split.holdout_split_exact(df, "id", 0.1)
    assert (exact[0].count(), exact[1].count()) == (900, 100)


@pytest.mark.parametrize("n, k", [(10, 3), (7, 7), (2, 5), (100, 8)])
def test_contiguous_folds(spark, n, k):
    folds = split.kfold_contiguous(spark.range(n).repartition(3), "id", k).orderBy("id").collect()
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    want = [f for f, s in enumerate(sizes) for _ in range(s)]
    assert [r["fold"] for r in folds] == want


def test_stratified_folds_are_even(spark):
    df = spark.range(103).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    counts = split.kfold_stratified(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r["y"] == y]
        assert max(sizes) - min(sizes) <= 1


def test_prediction_slice(spark):
    got = clean.prediction_slice(spark.range(50).repartition(4), "id", 10, 12).collect()
    assert sorted(map(tuple, got)) == [(10, 10), (11, 11), (12, 12)]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1), (2, 0.25)], "id long, p double")
    tables.write_predictions(df, str(tmp_path / "p"), "id", "p", names=("Id", "preco"), prediction_first=True)
    back = tables.scan_csv(spark, str(tmp_path / "p"))
    assert back.columns == ["preco", "Id"] and sorted(map(tuple, back.collect())) == [(0.1, 1), (0.25, 2)]


def test_template_check(spark):
    got = tables.submission_template_check(
        spark.createDataFrame([(1,), (1,), (9,)], "id long"), spark.createDataFrame([(1,), (2,)], "id long"), "id"
    ).first()
    assert tuple(got) == (1, 1, 1, 1)
