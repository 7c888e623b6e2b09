"""Null policies, duplicates, quantile trims, fences and row filters."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.nulls import complete_rows
from rowloom.functions.quantiles import exact_quantiles
from rowloom.functions.ranking import order_index
from rowloom.operators.select import columns_of_kind


def null_count_profile(df: DataFrame) -> DataFrame:
    """column_name, n_null for the columns that hold nulls."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "n_null").filter("n_null > 0")


def drop_null_rows(df, drop=()):
    return df.drop(*drop).transform(complete_rows)


def medians(df, columns) -> dict:
    found = exact_quantiles(df, {c: [0.5] for c in columns})
    return {c: found[(c, 0.5)] for c in columns}


def fill_median(df, columns=None, stats_from=None):
    """Numeric nulls become the column median of `stats_from` (default: the table itself)."""
    columns = columns_of_kind(df, "number") if columns is None else columns
    values = medians(df if stats_from is None else stats_from, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(values[c])) for c in columns})


def distinct_rows(df, subset=None):
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def duplicate_rows(df, subset=None):
    """(values, copies) of every repeated row; counted before the shuffle, so hot rows are cheap."""
    subset = list(subset or df.columns)
    return df.groupBy(*subset).agg(F.count(F.lit(1)).alias("n_copies")).filter("n_copies > 1")


def flag_duplicates(df, key, subset):
    """is_duplicate: the row repeats an earlier row (the smallest unique key comes first).

    The first key per value is a pre-aggregated minimum, and rows are matched to
    it by key, so a value shared by many rows meets in no task.
    """
    first = df.groupBy(*subset).agg(F.min(key).alias(key)).select(key, F.lit(True).alias("_first"))
    return df.join(first, key, "left").withColumn("is_duplicate", F.col("_first").isNull()).drop("_first")


def bounds_predicate(bounds: dict):
    """Conjunction of inclusive ranges {column: (lo, hi)}; nulls fail, as with any comparison."""
    return reduce(lambda a, b: a & b, [F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()])


def quantile_bounds(df, ranges: dict) -> dict:
    found = exact_quantiles(df, {c: list(q) for c, q in ranges.items()})
    return {c: (found[(c, float(q[0]))], found[(c, float(q[1]))]) for c, q in ranges.items()}


def quantile_trim_sequential(df, ranges: dict):
    """Columns in order; each range is measured on the rows that the earlier ranges left.

    The bounds found so far are plain numbers, so every step is one filtered scan
    of the source and the result is a single conjunctive filter.
    """
    bounds = {}
    for column, q in ranges.items():
        kept = df.filter(bounds_predicate(bounds)) if bounds else df
        bounds.update(quantile_bounds(kept, {column: q}))
    return df.filter(bounds_predicate(bounds)) if bounds else df


def quantile_trim_snapshot(df, ranges: dict):
    """All ranges from the untouched table, applied together."""
    return df.filter(bounds_predicate(quantile_bounds(df, ranges))) if ranges else df


def quantile_trim_component_space(df, components, low, high):
    """Snapshot trim of every component column; (0, 1) keeps all rows."""
    if low == 0 and high == 1:
        return df
    return quantile_trim_snapshot(df, {c: (low, high) for c in components})


def _fences(df, columns, q_low, q_high, factor):
    bounds = quantile_bounds(df, {c: (q_low, q_high) for c in columns})
    return {c: (lo - factor * (hi - lo), hi + factor * (hi - lo)) for c, (lo, hi) in bounds.items() if lo is not None}


def _outside(condition):
    return F.coalesce(condition, F.lit(False))  # a null is never outside


def iqr_fence_upper(df, columns, q_low=0.25, q_high=0.75, factor=1.5):
    """Drop rows above q_high + factor * (q_high - q_low) in any column; nulls stay."""
    fences = _fences(df, columns, q_low, q_high, factor)
    high = [_outside(F.col(c) > F.lit(b)) for c, (_, b) in fences.items()]
    return df.filter(~reduce(lambda a, b: a | b, high)) if high else df


def iqr_fence_two_sided(df, columns, q_low=0.25, q_high=0.75, factor=1.5, use_factor=True):
    """Both fences; without the factor the quantiles themselves are the fences."""
    fences = _fences(df, columns, q_low, q_high, factor if use_factor else 0.0)
    out = [_outside((F.col(c) < F.lit(a)) | (F.col(c) > F.lit(b))) for c, (a, b) in fences.items()]
    return df.filter(~reduce(lambda a, b: a | b, out)) if out else df


def range_filter(df, column, low, high):
    return df.filter(F.col(column).between(low, high))


def equality_subset(df, column, value):
    return df.filter(F.col(column) == F.lit(value))


def exclude_ids(df, ids, key):
    """Rows whose key is not in `ids`."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def attach_by_key(left, right, key, columns, how="left"):
    """Columns of a keyed table; missing keys give null."""
    return left.join(right.select(key, *columns), key, how)


def prediction_slice(df, order, first, last):
    """Rows first..last (0-based, inclusive) in key order; a slice deep in the table needs no single task."""
    numbered, _ = order_index(df, order, name="position")
    return numbered.filter(F.col("position").between(first, last)).withColumn("position", F.col("position").cast("int"))
