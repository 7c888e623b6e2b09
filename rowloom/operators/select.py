"""Column selection: by list, by type, by what the data holds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    "string": (T.StringType,),
    "float": (T.DoubleType, T.FloatType),
    "int": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
}
_KINDS["number"] = _KINDS["float"] + _KINDS["int"]


def columns_of_kind(df: DataFrame, kind: str) -> list:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _KINDS[kind])]


def drop_columns(df, *names):
    return df.drop(*names)


def select_columns(df, names):
    return df.select(*names)


def select_by_dtype(df, kind, keep=()):
    return df.select(*keep, *[c for c in columns_of_kind(df, kind) if c not in keep])


def rename_columns(df, mapping):
    return df.withColumnsRenamed(mapping)


def add_missing_column(df, name, value=None, dtype="double"):
    return df.withColumn(name, F.lit(value).cast(dtype))


def truncate_to_int(df, columns=None):
    """Floats to integers toward zero; all float columns by default."""
    columns = columns_of_kind(df, "float") if columns is None else columns
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def columns_with_nulls(df) -> list:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c]]


def drop_columns_with_nulls(df):
    return df.drop(*columns_with_nulls(df))


def constant_columns(df) -> list:
    """Columns with exactly one distinct non-null value."""
    exprs = [F.min(c).eqNullSafe(F.max(c)) & (F.count(c) > 0) for c in df.columns]
    row = df.agg(*[e.alias(c) for e, c in zip(exprs, df.columns)]).first()
    return [c for c in df.columns if row[c]]


def drop_constant_columns(train, *others):
    """The columns constant in `train` leave every table."""
    names = constant_columns(train)
    return tuple(t.drop(*names) for t in (train, *others))


def reorder_to_training_columns(score, train, exclude=()):
    return score.select(*[c for c in train.columns if c not in exclude])


def column_set_difference(df, exclude) -> list:
    return [c for c in df.columns if c not in set(exclude)]


def name_components(df, array_column, k, prefix="PC"):
    """Array elements become columns PC1..PCk."""
    parts = [F.col(array_column)[i].alias(f"{prefix}{i + 1}") for i in range(k)]
    return df.select(*[c for c in df.columns if c != array_column], *parts)
