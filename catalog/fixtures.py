"""Labelled tables derived by expression from the given ones, once for Spark and once as SQL."""

from pyspark.sql import functions as F

from rowloom.functions.hashing import SPAN


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fx_clf(spark, sf):
    """labels joined to documents: imbalanced binary target y."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    return d.join(l, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("y"),
        "toxic",
        "n_chars",
        F.size(F.split("text", " ")).cast("bigint").alias("n_words"),
        "lang",
        "source",
        F.when(F.col("doc_id") % 7 != 0, F.col("n_chars").cast("double")).alias("gap"),
        F.lit(1.0).alias("one"),
    )


CLF = """fx_clf AS (
  SELECT d.doc_id AS id, l.quality AS y, l.toxic, d.n_chars,
         CAST(len(string_split(d.text, ' ')) AS BIGINT) AS n_words, d.lang, d.source,
         CASE WHEN d.doc_id % 7 <> 0 THEN CAST(d.n_chars AS DOUBLE) END AS gap, CAST(1 AS DOUBLE) AS one
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def fx_reg(spark, sf):
    """lineitem as a regression table with a correlated, a null-bearing and a constant column."""
    li = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    return li.select(
        F.md5(F.concat_ws("-", *parts, F.round(price * 100).cast("bigint").cast("string"))).alias("id"),
        price.alias("y"),
        "l_quantity",
        "l_discount",
        "l_tax",
        (price * (1 - F.col("l_discount"))).alias("net"),
        (1000 * F.col("l_quantity") - price).alias("neg"),
        F.nullif("l_quantity", F.lit(7.0)).alias("gap"),
        F.lit(1.0).alias("one"),
        "l_returnflag",
        "l_linestatus",
    )


REG = """fx_reg AS (
  SELECT md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT))) AS id,
         l_extendedprice AS y, l_quantity, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) AS net, 1000 * l_quantity - l_extendedprice AS neg,
         nullif(l_quantity, 7.0) AS gap, CAST(1 AS DOUBLE) AS one, l_returnflag, l_linestatus
  FROM lineitem)"""

REG_COLUMNS = ["id", "y", "l_quantity", "l_discount", "l_tax", "net", "neg", "gap", "one", "l_returnflag", "l_linestatus"]
REG_NUMBERS = ["y", "l_quantity", "l_discount", "l_tax", "net", "neg", "gap", "one"]

DIMS = [f"e{i}" for i in range(64)]


def fx_vec(spark, sf):
    """All 64 embedding dimensions and a rare binary target."""
    e = table(spark, sf, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        "label",
        (F.col("label") == 0).cast("int").alias("y"),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)],
    )


VEC = "fx_vec AS (SELECT vec_id AS id, label, CAST(label = 0 AS INTEGER) AS y, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)
) + " FROM embeddings)"


def fx_bin(spark, sf):
    """Binary target with a learnable boundary in two of three features of like size."""
    return fx_reg(spark, sf).select(
        "id",
        (F.col("y") > 30000 + 800 * F.col("l_quantity")).cast("int").alias("y"),
        (F.col("net") / 10000).alias("a"),
        (F.col("l_quantity") / 5).alias("b"),
        (F.col("l_discount") * 50).alias("c"),
    )


BIN_FEATURES = ["a", "b", "c"]


def fx_pred(spark, sf):
    return fx_reg(spark, sf).withColumn("p", F.col("y") * (1 + 0.1 * F.col("l_discount")) + 10 * F.col("l_quantity"))


PRED = REG + ", fx_pred AS (SELECT *, y * (1 + CAST(0.1 AS DOUBLE) * l_discount) + 10 * l_quantity AS p FROM fx_reg)"


def fx_cls_pred(spark, sf):
    return fx_clf(spark, sf).withColumn("p", (F.col("n_words") > 200).cast("int"))


CLS_PRED = CLF + ", fx_cls_pred AS (SELECT *, CAST(n_words > 200 AS INTEGER) AS p FROM fx_clf)"


def h32(key, seed=42):
    """SQL text of the row hash."""
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def h60(key, seed=42):
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def held(key, share, seed=42):
    return f"({h32(key, seed)} < {int(share * SPAN)})"


def with_(*parts):
    return "WITH " + ", ".join(parts) + " "


def union_all(selects):
    return " UNION ALL ".join(selects)
