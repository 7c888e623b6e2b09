"""Row positions without a single-task window.

`order_index` numbers a whole table in sort order; `hash_rank` numbers rows in a
random but reproducible order inside each group. Neither puts one group or the
whole table into one task, whatever the group sizes are.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.functions.hashing import hash32
from rowloom.functions.lineage import cut_lineage

_ID_BITS = 33  # monotonically_increasing_id keeps the in-partition position in the low 33 bits


def order_index(df: DataFrame, *order, name="idx"):
    """(table with a 0-based position in sort order, row count).

    A range-partitioned sort fixes the in-partition positions; they are written
    once, since range bounds come from sampling and must not be drawn again.
    Only one row count per partition reaches the driver.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", _ID_BITS)
    sizes = sorted(placed.groupBy(part.alias("_part")).count().collect())
    starts, total = [], 0
    for pid, n in sizes:
        starts.append((pid, total))
        total += n
    spark = df.sparkSession
    offsets = spark.createDataFrame(starts, "_part bigint, _start bigint")
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << _ID_BITS) - 1)))
        .drop("_part", "_start", "_mid")
    )
    return numbered, total


def hash_rank(df: DataFrame, key: str, by=(), seed=0, name="rank", bits=16) -> DataFrame:
    """0-based rank inside each `by` group, ordered by hash of the key, then key.

    The hash prefix cuts every group into 2^bits even slices. Slice counts give
    each slice its offset; the window then only spans one slice. `{name}_n` is
    the size of the group.
    """
    slice_ = F.shiftright("_h", 32 - bits)
    # one array column stands for all group columns: nulls compare equal in it, and join and
    # window share its partitioning
    group = F.array(*[F.col(c).cast("string") for c in by]) if by else F.lit(0)
    hashed = df.withColumn("_h", hash32(key, seed)).withColumn("_slice", slice_).withColumn("_group", group)
    counts = hashed.groupBy("_group", "_slice").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_group")  # at most 2^bits rows per group
    offsets = counts.select(
        "_group",
        "_slice",
        (F.sum("_c").over(whole.orderBy("_slice")) - F.col("_c")).alias("_off"),
        F.sum("_c").over(whole).alias(f"{name}_n"),
    )
    within = Window.partitionBy("_group", "_slice").orderBy("_h", key)
    return (
        hashed.join(offsets, ["_group", "_slice"])
        .withColumn(name, F.col("_off") + F.row_number().over(within) - 1)
        .drop("_h", "_slice", "_group", "_off")
    )
