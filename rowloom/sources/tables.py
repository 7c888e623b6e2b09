"""Reading labelled tables, writing predictions and result tables, schema checks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers become NULL; Spark would otherwise order NaN above every number."""
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Comma-separated file with a header. Without a schema Spark reads the file twice."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def write_predictions(df: DataFrame, path: str, key: str, prediction: str, names=None, prediction_first=False):
    """Two-column CSV with a header; `names` renames (key, prediction)."""
    key_name, prediction_name = names or (key, prediction)
    cols = [F.col(key).alias(key_name), F.col(prediction).alias(prediction_name)]
    df.select(*(cols[::-1] if prediction_first else cols)).write.option("header", True).csv(path)


def write_results_tsv(df: DataFrame, path: str):
    df.write.option("header", True).option("sep", "\t").csv(path)


def scan_results_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", "\t").csv(path)


def submission_template_check(predictions: DataFrame, template: DataFrame, key: str) -> DataFrame:
    """One row: ids missing from, extra in and repeated in the predictions."""
    got = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("_got"))
    want = template.groupBy(key).agg(F.count(F.lit(1)).alias("_want"))
    return got.join(want, key, "full_outer").agg(
        F.count_if(F.col("_got").isNull()).alias("n_missing"),
        F.count_if(F.col("_want").isNull()).alias("n_extra"),
        F.count_if(F.col("_got") > 1).alias("n_duplicate"),
        F.count_if(F.col("_got").isNotNull() & F.col("_want").isNotNull()).alias("n_matched"),
    )


def schema_profile(train: DataFrame, score: DataFrame, target: str) -> DataFrame:
    """Per column: type, presence in the scoring table, non-null count, row count."""
    spark = train.sparkSession
    score_names = set(score.columns)
    wide = train.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in train.columns])
    long = wide.unpivot("_rows", train.columns, "column_name", "n_present")
    facts = spark.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.name in score_names, f.name == target) for f in train.schema.fields],
        "column_name string, type string, in_score boolean, is_target boolean",
    )
    return long.join(F.broadcast(facts), "column_name").withColumnRenamed("_rows", "n_rows")
