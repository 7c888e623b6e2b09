"""Input layout for algorithms that pass over one table many times."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_ROWS = 500_000  # rows that one task reads in a pass, about


def spread(df: DataFrame) -> DataFrame:
    """The table dealt out over all cores, when its source has fewer partitions than there are cores or some with over `PART_ROWS` rows.

    Other tables stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    if len(sizes) >= cores and max(sizes) <= PART_ROWS:
        return df
    return df.repartition(max(cores, -(-sum(sizes) // PART_ROWS)))


def settle(df: DataFrame) -> DataFrame:
    """`spread`, kept in memory and disk for the passes to come; the caller unpersists."""
    held = df.persist()
    out = spread(held)
    if out is held:
        return held
    out = out.persist()
    out.count()
    held.unpersist()
    return out
