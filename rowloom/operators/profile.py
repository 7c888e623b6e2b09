"""Descriptive tables: summaries, frequencies, histograms, density curves."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.hashing import hash32
from rowloom.functions.moments import WIDE, moments
from rowloom.functions.nulls import complete_rows
from rowloom.functions.quantiles import exact_quantiles


def describe_table(df: DataFrame, columns) -> DataFrame:
    """column_name, count, mean, std (n-1), min, q25, q50, q75, max."""
    spark = df.sparkSession
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c)
        for c in columns
    ]
    basics = df.agg(*per_column).select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")
    middle = spark.createDataFrame(
        [(c, *[quartiles[(c, q)] for q in (0.25, 0.5, 0.75)]) for c in columns],
        "column_name string, q25 double, q50 double, q75 double",
    )
    return basics.join(F.broadcast(middle), "column_name")


def quantile_table(df, columns, probabilities) -> DataFrame:
    found = exact_quantiles(df, {c: list(probabilities) for c in columns})
    return df.sparkSession.createDataFrame(
        [(c, float(q), found[(c, float(q))]) for c in columns for q in probabilities],
        "column_name string, q double, value double",
    )


def value_counts(df, column):
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column)


def distinct_values(df, column):
    return df.select(column).distinct()


def n_unique(df, columns):
    """Distinct non-null values per column: one pass per column set, no Expand over all pairs.

    The long form lets every (column, value) pair pre-aggregate in its own task.
    """
    long = _long_text(df, columns)
    pairs = long.groupBy("column_name", "value").count()
    seen = pairs.groupBy("column_name").agg(F.count("value").alias("n_unique"))
    return seen


def _long_text(df, columns):
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )


def class_balance(df, group, target):
    """Per group value with both classes: majority and minority class and their counts."""
    counts = df.groupBy(group, target).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n_classes"),
            F.max_by(target, F.struct(F.col("n"), -F.col(target))).alias("majority"),
            F.max("n").alias("n_majority"),
            F.min_by(target, F.struct(F.col("n"), -F.col(target))).alias("minority"),
            F.min("n").alias("n_minority"),
        )
        .filter("n_classes = 2")
        .drop("n_classes")
    )


def column_extents(tables, columns):
    """Smallest and largest value of each column over several tables."""
    both = [t.select(*[F.col(c).cast("double").alias(c) for c in columns]) for t in tables]
    merged = both[0]
    for t in both[1:]:
        merged = merged.unionByName(t)
    stats = merged.agg(*[F.struct(F.lit(c).alias("column_name"), F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    return stats.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("s")).select("s.*")


def score_summary(scores, value="score", by=()):
    """Mean and population standard deviation of fold scores."""
    return scores.groupBy(*by).agg(
        F.avg(value).alias("mean_score"), F.stddev_pop(value).alias("std_score"), F.count(F.lit(1)).alias("n_folds")
    )


def histogram(df, column, bins=30, by=()):
    """Equal-width bins over the whole column; `by` columns count separately in the same bins."""
    lo, hi = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if lo is None:
        return df.limit(0).groupBy(*by, F.lit(0).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins or 1.0
    bin_ = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counted = df.filter(F.col(column).isNotNull()).groupBy(*by, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))


def kde_curve(df, column, by, grid_size=30):
    """Gaussian density per class on a shared grid, each class weighted by its share.

    Bandwidth is n^(-1/5) times the class standard deviation; the grid runs over
    the data extent. Equal values are counted first, so a value shared by many
    rows is evaluated once per grid point.
    """
    x = F.col(column).cast("double")
    table = df.select(F.col(by), x.alias("x")).transform(complete_rows)
    stats = {
        r[by]: r
        for r in table.groupBy(by).agg(
            F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")
        ).collect()
    }
    total = sum(r["n"] for r in stats.values())
    lo, hi = min(r["lo"] for r in stats.values()), max(r["hi"] for r in stats.values())
    step = (hi - lo) / (grid_size - 1)
    widths = [(c, r["n"] ** -0.2 * r["s"]) for c, r in stats.items() if r["s"]]
    bandwidth = F.lit(None).cast("double")
    for c, h in widths:
        bandwidth = F.when(F.col(by) == F.lit(c), F.lit(h)).otherwise(bandwidth)
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(lo + i * step).alias("g")) for i in range(grid_size)]))
    weighted = table.groupBy(by, "x").agg(F.count(F.lit(1)).alias("w")).withColumn("h", bandwidth)
    points = weighted.filter("h is not null").select(by, "x", "w", "h", grid.alias("p"))
    u = (F.col("p.g") - F.col("x")) / F.col("h")
    kernel = F.col("w") * F.exp(-0.5 * u * u) / (F.col("h") * F.lit(total * math.sqrt(2 * math.pi)))
    return points.groupBy(by, F.col("p.i").alias("grid_i"), F.col("p.g").alias("grid_x")).agg(
        F.sum(kernel).alias("density")
    )


def scatter_sample(df, key, columns, share, seed=0):
    """Reproducible sample of plot points: a row is in when its key hashes below the share."""
    return df.filter(hash32(key, seed) < F.lit(int(share * 2**32))).select(key, *columns)


def gram_table(df, columns):
    """Long form of the centred cross products: column_a, column_b, n, sum_product."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    if len(columns) > WIDE:
        m = moments(df, columns)
        rows = [(a, b, m.n, float(m.comoment[m.columns.index(a), m.columns.index(b)])) for a, b in pairs]
        return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, n bigint, sum_product double")
    full = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).transform(complete_rows)
    wide = full.agg(
        F.count(F.lit(1)).alias("n"), *[F.covar_pop(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), (F.col(f"{i}") * F.col("n")).alias("sum_product"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select("n", F.explode(F.array(*cells)).alias("c")).select("c.column_a", "c.column_b", "n", "c.sum_product")


def sorted_top(df, column, n, key, descending=True):
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return df.orderBy(order, F.col(key)).limit(n)

