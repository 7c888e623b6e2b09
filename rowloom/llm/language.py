"""Language identification by Bayesian fusion of evidence.

Each language's byte trigrams are counted over all texts that declare it. A text's likelihoods are then combined, as logarithms, with
the declared markup language (a declaration is right with a stated probability), the address suffix (country suffixes speak for their
languages) and the host's prior: the shares of languages among the host's other texts, smoothed towards its domain's, those towards
its suffix's, those towards the whole table's. The shares are grouped sums of posteriors by text alone.

Every declared language with `LEAST_TEXTS` different texts is a class, however rare in the table; its trigrams are smoothed towards
those of all languages together. One more class, the background, finds all trigrams alike: it wins where no language explains a text.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import settled, text_chunks, text_key

SLOTS = 1 << 13
EFFECTIVE_TRIGRAMS = 60  # neighbouring trigrams tell much the same: longer texts count as so many independent ones
DECLARED_RIGHT = 0.85
SUFFIX_RIGHT = 0.7
SMOOTHING = 20.0
ACCEPT = 0.5
LEAST_TEXTS = 20  # declared values with fewer different texts cannot be estimated
POOLED = 2_000.0  # trigrams of all languages together that smooth each one's own

EVIDENCE = ("text", "declared", "host", "domain", "suffix")

# Country suffixes and their main language.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "it": "it", "nl": "nl", "pt": "pt", "br": "pt", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh"}


def _trigrams(texts):
    """(slot of every trigram, its text) of lower-cased texts, white space and digits as one kind of gap each."""
    data = [re.sub(r"[\s\d]+", " ", (t or "").lower()).encode() for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    joined = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    if len(joined) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    slot = ((joined[:-2] * np.uint32(0x9E3779B1)) ^ (joined[1:-1] * np.uint32(0x85EBCA77)) ^ (joined[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(7)
    slot = (slot ^ (slot >> np.uint32(11))) % np.uint32(SLOTS)
    inside = owner[:-2] == owner[2:]
    return slot[inside].astype(np.int64), owner[:-2][inside]


def _counted(rows: DataFrame, languages: list[str]) -> np.ndarray:
    """Trigram counts by declared language: one small row a task and language is summed on the cluster."""

    def run(batches):
        total = np.zeros((len(languages), SLOTS), np.int64)
        of = {v: i for i, v in enumerate(languages)}
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                slot, owner = _trigrams(texts)
                said = np.array([of.get(d, -1) for d in batch.column(1).to_pylist()])[owner]
                total += np.bincount(said[said >= 0] * SLOTS + slot[said >= 0], minlength=total.size).reshape(total.shape)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.reshape(-1)[at])], names=["at", "n"])

    sums = rows.select("text", "declared").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(len(languages) * SLOTS)
    for r in sums.collect():  # at most languages x slots
        out[r["at"]] = r["n"]
    return out.reshape(len(languages), SLOTS)


def _likelihoods(rows: DataFrame, logs: np.ndarray) -> DataFrame:
    names = [c for c in rows.columns if c != "text"]
    shipped = rows.sparkSession.sparkContext.broadcast(logs.astype(np.float64))

    def run(batches):
        table = shipped.value
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                slot, owner = _trigrams(texts)
                n = np.bincount(owner, minlength=len(texts))
                scale = np.where(n > 0, np.minimum(1.0, EFFECTIVE_TRIGRAMS / np.maximum(n, 1)), 0.0)
                sums = np.stack([np.bincount(owner, weights=row[slot], minlength=len(texts)) * scale for row in table], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, len(table), dtype=np.int32)), pa.array(np.round(sums, 9).reshape(-1)))
                letters = pa.array([bool(t) and re.search(r"[^\W\d_]", t) is not None for t in texts], pa.bool_())
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), lists, letters], names=[*names, "logs", "letters"])

    schema = rows.drop("text").withColumn("logs", F.array(F.lit(0.0))).withColumn("letters", F.lit(True)).schema
    return rows.mapInArrow(run, schema)


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def identify(rows: DataFrame) -> DataFrame:
    """Adds language, posterior and accepted to rows with text, declared, host, domain and suffix (each may be null); drops text.

    Other columns of any name pass through, however long the texts are; columns named like the three results are replaced.

    Accepted: the text has a letter and the best class is a language with a posterior of at least a half. Null, empty and letterless
    texts are rejected, and so are texts that the background explains best (their language is null); ties go to the first language
    by name. A declared language without enough texts speaks for the background. Without any language nothing is known and all rows
    are rejected. Repeated rows are judged alike.
    """
    rows = rows.drop("language", "posterior", "accepted")
    # columns that only pass through travel under numbered names, so that none clashes with a working column
    held = {c: f"_rowloom_{i}" for i, c in enumerate(rows.columns) if c not in EVIDENCE}
    return _identified(rows.withColumnsRenamed(held)).withColumnsRenamed({v: c for c, v in held.items()})


def _identified(rows: DataFrame) -> DataFrame:
    texts = rows.filter(F.col("declared").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = texts.groupBy("declared").agg(F.approx_count_distinct(F.xxhash64("text"), 0.01).alias("count"))
    languages = sorted(r["declared"] for r in counts.filter(F.col("count") >= LEAST_TEXTS).collect() if r["declared"])
    if not languages:
        return rows.drop("text").select("*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))
    n = len(languages) + 1  # the background is last
    own = _counted(rows, languages)
    pooled = own.sum(axis=0) + 0.5
    grams = own + 0.5 + POOLED * pooled / pooled.sum()
    grams = np.vstack([grams, np.ones(SLOTS)])
    base = settled(_likelihoods(rows, np.log(grams / grams.sum(axis=1, keepdims=True))), "likelihoods")
    base = base.withColumn("own", F.when(F.col("letters"), _posterior(F.col("logs"))).otherwise(F.array(*[F.lit(1.0 / n)] * n)))
    # host, domain and suffix in one chain of grouped sums, each smoothed by the next
    sums = [F.sum(F.get("own", F.lit(i))).alias(f"s{i}") for i in range(n)]

    def added(df):
        return df.withColumn("sums", F.array(*[f"s{i}" for i in range(n)])).drop(*[f"s{i}" for i in range(n)])

    hosts = settled(added(base.groupBy("host", "domain", "suffix").agg(*sums, F.count(F.lit(1)).alias("n"))), "hosts")
    parts = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(n)] + [F.sum("n").alias("n")]
    domains = added(hosts.groupBy("domain", "suffix").agg(*parts))
    suffixes = added(hosts.groupBy("suffix").agg(*parts))
    whole = hosts.agg(*parts).first()
    overall = F.array(*[F.lit(((whole[f"s{i}"] or 0.0) + 1.0 / n) / ((whole["n"] or 0) + 1)) for i in range(n)])

    def smoothed(sums, count, prior):
        return F.zip_with(sums, prior, lambda s, p: (s + SMOOTHING * p) / (count + SMOOTHING))

    suffixes = suffixes.select(F.col("suffix").alias("_s"), smoothed(F.col("sums"), F.col("n"), overall).alias("of_suffix"))
    domains = domains.join(suffixes, F.col("suffix").eqNullSafe(F.col("_s"))).select(F.col("domain").alias("_d"), F.col("suffix").alias("_ds"), smoothed(F.col("sums"), F.col("n"), F.col("of_suffix")).alias("of_domain"))
    hosts = hosts.join(domains, F.col("domain").eqNullSafe(F.col("_d")) & F.col("suffix").eqNullSafe(F.col("_ds")))
    hosts = settled(hosts.select(F.col("host").alias("_h"), F.col("domain").alias("_hd"), F.col("suffix").alias("_hs"), "sums", "n", "of_domain"), "host-priors")
    fused = base.join(hosts, F.col("host").eqNullSafe(F.col("_h")) & F.col("domain").eqNullSafe(F.col("_hd")) & F.col("suffix").eqNullSafe(F.col("_hs")))
    others = F.zip_with("sums", "own", lambda s, o: F.greatest(s - o, F.lit(0.0)))
    prior = smoothed(others, F.col("n") - 1, F.col("of_domain"))
    said = F.when(F.col("declared").isin(languages), F.col("declared")).when(F.col("declared").isNotNull(), "")  # "": a language without a model
    declared = [F.when(said == v, math.log(DECLARED_RIGHT)).when(said.isNotNull(), math.log((1 - DECLARED_RIGHT) / (n - 1))).otherwise(0.0) for v in [*languages, ""]]
    spoken = F.element_at(F.create_map(*[F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv]), F.coalesce("suffix", F.lit("")))
    suffix = [F.when(spoken.isNull() | ~spoken.isin(languages), 0.0).when(spoken == v, math.log(SUFFIX_RIGHT)).otherwise(math.log((1 - SUFFIX_RIGHT) / (n - 1))) for v in [*languages, ""]]
    evidence = F.array(*[F.get("logs", F.lit(i)) + F.log(F.get(prior, F.lit(i)) + 1e-12) + declared[i] + suffix[i] for i in range(n)])
    fused = fused.withColumn("shares", _posterior(evidence))
    best = F.array_max("shares")
    language = F.get(F.array(*map(F.lit, languages), F.lit(None)), (F.array_position("shares", best) - 1).cast("int"))
    keep = [c for c in rows.columns if c != "text"]
    return fused.select(
        *keep,
        language.alias("language"),
        F.round(best, 6).alias("posterior"),
        (F.col("letters") & (best >= ACCEPT) & language.isNotNull()).alias("accepted"),
    )


def primary_subtag(tag: Column) -> Column:
    """The language of a tag such as de-AT or fil_PH, in lower case, whatever its length."""
    return F.lower(F.substring_index(F.translate(tag, "_", "-"), "-", 1))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents as evidence rows: the declared language is their label, the source their host."""
    return docs.select("doc_id", text_key().alias("text_key"), primary_subtag(F.col("lang")).alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("suffix"), "text")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages as evidence rows: lang of the html tag, host, last two labels and last label of the address, text without tags."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/:?#]*)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\blang=[\"']?([a-zA-Z]+)", 1))
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    some = [F.when(c != "", c) for c in (declared, host, F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.regexp_extract(host, r"([^.]+)$", 1))]
    return pages.select("page_id", *[c.alias(n) for c, n in zip(some, ("declared", "host", "domain", "suffix"))], plain.alias("text"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that identification accepts, with their columns."""
    rows = document_evidence(docs).withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")
    bad = identify(rows).filter(~F.col("accepted")).select("_id", "_key", F.col("declared").alias("_said"), F.col("host").alias("_host")).distinct()
    bad = settled(bad, "unidentified")
    on = docs["doc_id"].eqNullSafe(bad["_id"]) & (text_key() == bad["_key"]) & primary_subtag(docs["lang"]).eqNullSafe(bad["_said"]) & docs["source"].eqNullSafe(bad["_host"])
    return docs.join(bad, on, "left_anti")


@query("op3_evidence_fusion")
def op3_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (page_id null) and all pages (doc_id null), each table with its own model."""
    docs = identify(document_evidence(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    pages = identify(page_evidence(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    none = F.lit(None).cast("bigint")
    told = ["declared", "language", "posterior", "accepted"]
    return docs.select("doc_id", none.alias("page_id"), *told).union(pages.select(none.alias("doc_id"), "page_id", *told))
