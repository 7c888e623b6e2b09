"""Reproducible splits and folds.

Random splits come from key hashes: they need no shuffle and give the same rows
on every run. Exact-size and stratified variants use hash ranks.
"""

from pyspark.sql import functions as F

from rowloom.functions.hashing import SPAN, hash32
from rowloom.functions.ranking import hash_rank, order_index


def mark_holdout(df, key, share, seed=42, name="is_holdout"):
    return df.withColumn(name, hash32(key, seed) < F.lit(int(share * SPAN)))


def holdout_split(df, key, share, seed=42):
    """(train, holdout): two disjoint filters of the same scan."""
    cut = hash32(key, seed) < F.lit(int(share * SPAN))
    return df.filter(~cut), df.filter(cut)


def holdout_split_exact(df, key, share, seed=42):
    """(train, holdout) with ceil(share * n) held-out rows."""
    ranked = hash_rank(df, key, seed=seed, name="_r")
    cut = F.col("_r") < F.ceil(F.lit(float(share)) * F.col("_r_n"))
    return ranked.filter(~cut).drop("_r", "_r_n"), ranked.filter(cut).drop("_r", "_r_n")


def kfold_shuffled(df, key, k=5, seed=42, name="fold"):
    return df.withColumn(name, (hash32(key, seed) % k).cast("int"))


def kfold_contiguous(df, key, k=5, name="fold"):
    """Unshuffled blocks in key order; the first n mod k blocks hold one row more.

    Only the keys are sorted. The k - 1 keys at the block starts come back to the
    driver, and the fold is a comparison with them: the table itself never moves.
    """
    indexed, n = order_index(df.select(key), F.col(key), name="_i")
    small, extra = divmod(n, k)
    starts = [f * small + min(f, extra) for f in range(1, k)]
    first_keys = [r[0] for r in indexed.filter(F.col("_i").isin([s for s in starts if s < n])).orderBy("_i").select(key).collect()]
    fold = F.lit(0)
    for i, first in enumerate(first_keys):
        fold = F.when(F.col(key) >= F.lit(first), F.lit(i + 1)).otherwise(fold)
    return df.withColumn(name, fold)


def kfold_stratified(df, key, label, k=10, seed=42, name="fold"):
    """Each class dealt round-robin over the folds in hash order."""
    ranked = hash_rank(df, key, by=[label], seed=seed, name="_r")
    return ranked.withColumn(name, (F.col("_r") % k).cast("int")).drop("_r", "_r_n")


def leak_free_holdout(original, resampled, key, share, seed=42):
    """(resampled train, original holdout): held-out keys leave the resampled table.

    The holdout is a function of the key, so the exclusion is a filter on the
    hash and needs no anti join.
    """
    cut = hash32(key, seed) < F.lit(int(share * SPAN))
    return resampled.filter(~cut), original.filter(cut)
