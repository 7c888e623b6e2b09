"""Fixed blocks of rows in a reproducible random order, for algorithms that go through rows one after another.

A row's place is the rank of its hash, so blocks and the order inside them are the same
on any partitioning, and no block outgrows its size however often a row repeats.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.nulls import complete_rows
from rowloom.functions.ranking import hash_rank
from rowloom.functions.spreading import settle

SHARD_ROWS = 20_000
SHARD_BYTES = 16 * 2**20
_FAN_IN = 64  # vectors added up by one task


def packed_shards(df: DataFrame, columns, key=None, rows=SHARD_ROWS, seed=42) -> DataFrame:
    """(shard, n, block): complete rows as float64 blocks of at most `rows` rows and SHARD_BYTES; the caller unpersists.

    Rows are ordered by the hash of `key`, which has to be unique, or without one by the hash
    of their values; equal rows are then interchangeable.
    """
    columns = list(columns)
    rows = max(1, min(int(rows), SHARD_BYTES // (8 * len(columns))))
    values = [F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)]
    name = F.col(key).cast("string") if key else F.md5(F.concat_ws(",", *[F.col(c).cast("double").cast("string") for c in columns]))
    table = df.select(*columns, *([key] if key and key not in columns else [])).transform(lambda d: complete_rows(d, columns))
    placed = hash_rank(table.select(F.coalesce(name, F.lit("")).alias("_key"), *values), "_key", seed=seed, name="_place")
    names = [f"_v{i}" for i in range(len(columns))]

    def pack(pdf):
        block = pdf.sort_values("_place")[names].to_numpy(dtype=np.float64)
        return pd.DataFrame({"shard": [int(pdf["_shard"].iloc[0])], "n": [len(block)], "block": [block.tobytes()]})

    shard = F.floor(F.col("_place") / F.lit(rows)).cast("bigint").alias("_shard")
    dealt = placed.select(shard, "_place", *names)
    return settle(dealt.groupBy("_shard").applyInPandas(pack, "shard bigint, n bigint, block binary"))


def pass_over_shards(table: DataFrame, width: int, work) -> tuple:
    """(sum of n * v / sum of n, sum of s) where work(shard, X) returns the vectors v and s of one block.

    Vectors are added in the order of the shards, in fixed groups, so the sums don't depend on
    where a block was worked on. At most _FAN_IN vectors reach the driver.
    """

    def each(batches):
        for pdf in batches:
            out = [work(k, np.frombuffer(b, dtype=np.float64).reshape(-1, width)) for k, b in zip(pdf["shard"], pdf["block"])]
            weighted = [n * np.asarray(v, dtype=float) for n, (v, _) in zip(pdf["n"], out)]
            yield pd.DataFrame({"shard": pdf["shard"], "n": pdf["n"], "v": weighted, "s": [np.asarray(s, dtype=float) for _, s in out]})

    def added(pdf):
        pdf = pdf.sort_values("shard")
        total = {"v": [_in_order(pdf["v"])], "s": [_in_order(pdf["s"])]}
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0]) // _FAN_IN], "n": [int(pdf["n"].sum())], **total})

    schema = "shard bigint, n bigint, v array<double>, s array<double>"
    parts, last = table.mapInPandas(each, schema), table.agg(F.max("shard")).first()[0]
    while last is not None and last >= _FAN_IN:
        parts = parts.groupBy(F.floor(F.col("shard") / F.lit(_FAN_IN))).applyInPandas(added, schema)
        last //= _FAN_IN
    rows = sorted(parts.collect())
    if not rows:
        raise ValueError("no complete row to fit on")
    n = sum(r["n"] for r in rows)
    return _in_order([r["v"] for r in rows]) / n, _in_order([r["s"] for r in rows])


def _in_order(vectors):
    total = 0.0
    for v in vectors:
        total = total + np.asarray(v, dtype=float)
    return total
