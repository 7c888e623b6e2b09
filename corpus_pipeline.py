"""Corpus preparation: documents through five stages, each reread from Parquet by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.bpe import default_tokenizer, encode_decode
from rowloom.llm.common import settled
from rowloom.llm.decontaminate import drop_contaminated
from rowloom.llm.language import keep_identified
from rowloom.llm.near_dups import keep_one
from rowloom.llm.surrogates import replace_entities

#: Hashed samples and keyed draws are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal or similar texts."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages for a twentieth of their words."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; n_chars follows the text."""
    out = replace_entities(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian uint32) of every text, their number and a hash of the decoded text."""
    done = encode_decode(docs, default_tokenizer())
    return done.select("doc_id", "lang", "source", "text", "n_chars", "token_ids", F.col("n_token_ids").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", replace_personal_data),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
