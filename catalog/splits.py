"""Splits and folds."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import CLF, REG, fx_clf, fx_reg, h32, held, with_
from rowloom.operators import split as K
from rowloom.operators.resample import random_oversample


@query("holdout_split", with_(REG) + f"SELECT id, {held('id', 0.1)} AS is_holdout FROM fx_reg")
def holdout_split(spark, sf):
    return K.mark_holdout(fx_reg(spark, sf).select("id"), "id", 0.1)


@query(
    "holdout_split_exact",
    with_(REG, f"r AS (SELECT id, row_number() OVER (ORDER BY {h32('id')}, id) AS rn, count(*) OVER () AS n FROM fx_reg)") + "SELECT id FROM r WHERE rn <= ceil(0.3 * n)",
)
def holdout_split_exact(spark, sf):
    return K.holdout_split_exact(fx_reg(spark, sf).select("id"), "id", 0.3)[1]


@query("kfold_shuffled", with_(REG) + f"SELECT id, CAST({h32('id')} % 5 AS INTEGER) AS fold FROM fx_reg")
def kfold_shuffled(spark, sf):
    return K.kfold_shuffled(fx_reg(spark, sf).select("id"), "id", 5)


@query("kfold_contiguous", with_(REG) + "SELECT id, CAST(ntile(7) OVER (ORDER BY id) - 1 AS INTEGER) AS fold FROM fx_reg")
def kfold_contiguous(spark, sf):
    return K.kfold_contiguous(fx_reg(spark, sf).select("id"), "id", 7)


@query("kfold_stratified", with_(CLF) + f"SELECT id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY {h32('id')}, id) - 1) % 10 AS INTEGER) AS fold FROM fx_clf")
def kfold_stratified(spark, sf):
    return K.kfold_stratified(fx_clf(spark, sf).select("id", "y"), "id", "y", 10)


@query("leak_free_holdout", with_(CLF) + f"SELECT DISTINCT id, {held('id', 0.3)} AS is_holdout FROM fx_clf WHERE NOT {held('id', 0.3)} OR {held('id', 0.3)}")
def leak_free_holdout(spark, sf):
    """Oversampled rows lose every held-out key; both parts are listed once per key."""
    c = fx_clf(spark, sf).select("id", "y")
    train, holdout = K.leak_free_holdout(c, random_oversample(c, "id", "y"), "id", 0.3)
    return (
        train.select("id").distinct().withColumn("is_holdout", F.lit(False))
        .unionByName(holdout.select("id").withColumn("is_holdout", F.lit(True)))
    )
