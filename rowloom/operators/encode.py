"""Label dictionaries, scalers and polynomial terms: fit gives a small table, apply uses it."""

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.functions.lineage import rows_within
from rowloom.functions.quantiles import exact_quantiles
from rowloom.functions.ranking import order_index
from rowloom.operators.select import columns_of_kind

BROADCAST_CODES = 200_000
BROADCAST_BYTES = 32 << 20  # of values in such a dictionary


def label_dictionary(*tables, columns) -> DataFrame:
    """(column_name, value, code): rank of each value among the sorted distinct values.

    Null is a class of its own, after all others. Several tables give the
    dictionary of their union. All columns share one distinct and one sort.
    """
    columns = list(columns)
    long = None
    for t in tables:
        part = t.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
        long = part if long is None else long.union(part)
    values = long.distinct()
    numeric = [c for c in columns if c in columns_of_kind(tables[0], "number")]
    number = F.when(F.col("column_name").isin(numeric), F.col("value").try_cast("double"))  # 2 before 10
    indexed, _ = order_index(values, F.col("column_name"), number.asc_nulls_last(), F.col("value").asc_nulls_last())
    starts = indexed.groupBy("column_name").agg(F.min("idx").alias("_first"))
    return indexed.join(F.broadcast(starts), "column_name").select(
        "column_name", "value", (F.col("idx") - F.col("_first")).alias("code")
    )


def dictionary_sizes(state) -> dict:
    return {r["column_name"]: r["n"] for r in state.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}


def label_encode(df, state, columns, unseen="null"):
    """Codes in place of values. Unseen values: 'null', 'last' (number of known values) or 'error'.

    A dictionary of checked rows and bytes is broadcast; a larger one joins by shuffle,
    where adaptive skew splitting takes care of a hot value.
    """
    small = rows_within(state, BROADCAST_CODES) and (state.agg(F.sum(F.octet_length("value"))).first()[0] or 0) <= BROADCAST_BYTES
    sizes = dictionary_sizes(state) if unseen == "last" else {}
    out = df
    for c in columns:
        codes = state.filter(F.col("column_name") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        codes = F.broadcast(codes) if small else codes
        joined = out.join(codes, F.col(c).cast("string").eqNullSafe(F.col("_value")), "left")
        code = F.col("_code")
        if unseen == "last":
            code = F.coalesce(code, F.lit(sizes.get(c, 0)).cast("bigint"))
        elif unseen == "error":
            code = F.coalesce(code, F.raise_error(F.concat(F.lit(f"unseen value in {c}: "), F.col(c))).cast("bigint"))
        out = joined.withColumn(c, code).drop("_value", "_code")
    return out


def label_encode_independent(train, score, columns):
    """Each table coded by a dictionary of its own; codes of the two need not agree."""
    return tuple(label_encode(t, label_dictionary(t, columns=columns), columns) for t in (train, score))


def label_encode_union(train, score, columns):
    """One dictionary over the values of both tables."""
    state = label_dictionary(train, score, columns=columns)
    return tuple(label_encode(t, state, columns) for t in (train, score))


def _stats_table(df, per_column) -> DataFrame:
    names = list(per_column)
    wide = df.agg(*[F.struct(F.lit(c).alias("column_name"), *per_column[c]).alias(f"s{i}") for i, c in enumerate(names)])
    return wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(names))])).alias("s")).select("s.*")


def standard_state(df, columns) -> DataFrame:
    """(column_name, center, scale): mean and population standard deviation, scale 0 becomes 1."""
    return _stats_table(
        df,
        {
            c: [
                F.avg(c).alias("center"),
                F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(F.lit(1.0)).alias("scale"),
            ]
            for c in columns
        },
    )


def minmax_state(df, columns) -> DataFrame:
    """(column_name, center, scale, min, max, factor, range): scaled x is x * factor - min * factor."""
    per_column = {}
    for c in columns:
        lo, hi = F.min(F.col(c).cast("double")), F.max(F.col(c).cast("double"))
        span = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
        per_column[c] = [
            lo.alias("center"), span.alias("scale"), lo.alias("min"), hi.alias("max"),
            (F.lit(1.0) / span).alias("factor"), (hi - lo).alias("range"),
        ]
    return _stats_table(df, per_column)


def robust_state(df, columns) -> DataFrame:
    """(column_name, center, scale): median and inter-quartile range, range 0 becomes 1."""
    found = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    rows = [(c, found[(c, 0.5)], (found[(c, 0.75)] - found[(c, 0.25)]) or 1.0) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, center double, scale double")


def _scale_map(state):
    return {r["column_name"]: (r["center"], r["scale"]) for r in state.select("column_name", "center", "scale").collect()}


def apply_scale(df, state):
    """(x - center) / scale for every column of the state table, as plain expressions."""
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in _scale_map(state).items()})


def inverse_scale(df, state, mapping=None):
    """Back to original units; `mapping` sends a table column to the state column it was scaled by."""
    known = _scale_map(state)
    mapping = mapping or {c: c for c in known}
    return df.withColumns({c: F.col(c) * F.lit(known[s][1]) + F.lit(known[s][0]) for c, s in mapping.items()})


def polynomial_features(df, columns, keep=(), degree=2, bias=True):
    """Bias, columns and their products up to `degree`, as columns named a, a__b, ..."""
    terms = [F.lit(1.0).alias("1")] if bias else []
    for d in range(1, degree + 1):
        for group in combinations_with_replacement(columns, d):
            product = F.col(group[0]).cast("double")
            for c in group[1:]:
                product = product * F.col(c).cast("double")
            terms.append(product.alias("__".join(group)))
    return df.select(*keep, *terms)


def polynomial_names(columns, degree=2):
    return ["__".join(g) for d in range(1, degree + 1) for g in combinations_with_replacement(columns, d)]


def threshold_to_class(df, column, cut=0.5, name="label"):
    return df.withColumn(name, (F.col(column) > F.lit(cut)).cast("int"))


def nest_vector(df, column, name=None):
    """A length-p array becomes a p x 1 nested array per row."""
    return df.withColumn(name or column, F.transform(F.col(column), lambda x: F.array(x)))
