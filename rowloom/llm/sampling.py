"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is a set of lower-cased words, each weighted by how often it occurs. For every word and sample k a hash of both gives two
gamma(2, 1) draws r and c and a uniform draw b. With t = floor(ln(weight) / r + b), the word's value is c * exp(-r * (t - b + 1));
the least value over the text's words is the sample. Two texts share a sample with a probability equal to their generalised
Jaccard similarity, the sum of the lesser weights over the sum of the greater ones.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowloom.llm import query
from rowloom.llm.common import text_key

SAMPLES = 32
DOCS_PER_RANGE = 2_000
MAX_RANGES = 20_000
_DIGITS = 8


def _uniform(bits: Column, n: int) -> Column:
    return (bits.bitwiseAND(F.lit((1 << n) - 1)).cast("double") + 0.5) / float(1 << n)


def _value(term: Column, log_weight: Column, k: int) -> Column:
    first, second = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.log(_uniform(first, 24) * _uniform(F.shiftrightunsigned(first, 24), 24))
    c = -F.log(_uniform(second, 32) * _uniform(F.shiftrightunsigned(second, 32), 32))
    b = _uniform(F.shiftrightunsigned(first, 48), 16)
    return c * F.exp(-r * (F.floor(log_weight / r + b) - b + 1.0))


def fingerprints(df: DataFrame, keys: list[str], text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(keys, fingerprint): eight hex digits a sample; the empty string for null texts and texts without words.

    Rows equal in all keys count as one text. Nothing is shuffled where the rows are already partitioned by some of the keys.
    """
    words = df.select(*keys, F.explode_outer(F.split(F.lower(F.col(text)), r"[ \t\n\x0B\f\r]+")).alias("word"))
    terms = words.select(*keys, F.when(F.col("word") != "", F.xxhash64("word")).alias("term"))
    counts = terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))
    # a null term has a null weight and so no value; without a CASE around it, code generation shares the hashes
    weighed = counts.select(*keys, "term", F.when(F.col("term").isNotNull(), F.log(F.col("n").cast("double"))).alias("weight"))
    least = weighed.groupBy(*keys).agg(*[F.min(_value(F.col("term"), F.col("weight"), k)).alias(f"s{k}") for k in range(samples)])
    digits = [F.lpad(F.lower(F.hex(F.xxhash64(f"s{k}").bitwiseAND(F.lit((1 << 4 * _DIGITS) - 1)))), _DIGITS, "0") for k in range(samples)]
    return least.select(*keys, F.when(F.col("s0").isNull(), F.lit("")).otherwise(F.concat(*digits)).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints, 0 to 1; two empty ones are alike, an empty one is unlike all others."""
    places = F.sequence(F.lit(1), F.length(a), F.lit(_DIGITS))
    same = F.size(F.filter(places, lambda p: a.substr(p, F.lit(_DIGITS)) == b.substr(p, F.lit(_DIGITS))))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(same / (F.length(a) / _DIGITS)).cast("double")


def _ranges(docs: DataFrame, doc_id: str):
    """Bounds that cut the ids into ranges of some 2,000 rows, found by a sketch over all ids. The bounds only balance the
    work; any would do. At most `MAX_RANGES` numbers reach the driver."""
    rows = docs.count()
    n = min(MAX_RANGES, max(1, math.ceil(rows / DOCS_PER_RANGE)))
    if n == 1:
        return []
    at = docs.agg(F.percentile_approx(doc_id, [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0] or []
    return sorted(set(at))


def _range_of(value: Column, bounds: list) -> Column:
    """1 + the number of bounds not above the value, by halving; 0 for null."""
    if not bounds:
        return F.when(value.isNull(), 0).otherwise(1)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(table, at + s - 1) <= value), at + s).otherwise(at))
    return F.when(value.isNull(), 0).otherwise(found + 1)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(range, place, guest, doc_id, text, next_text): each row with the text of the next one by descending id, the last with the first's.

    Ids are cut into ranges, each a window of its own. The first row of every range also stands, as a guest, at the end of the range
    before it. Equal ids are ordered by a hash of their text, null ids come last. One shuffle.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds = _ranges(rows, "doc_id")
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), bounds))
    tops = sorted(((r["range"], r["top"]) for r in rows.groupBy("range").agg(F.max("doc_id").alias("top")).collect()), reverse=True)
    if not tops:
        return rows.select("range", F.lit(0).alias("place"), F.lit(False).alias("guest"), "doc_id", "text", F.col("text").alias("next_text"))
    host = {r: tops[i - 1][0] for i, (r, _) in enumerate(tops)}  # the range above; the topmost visits the lowest
    size = max(host) + 1
    top_of = F.array(*[F.lit(dict(tops).get(r)).cast("long") for r in range(size)])
    host_of = F.array(*[F.lit(host.get(r, 0)) for r in range(size)])
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    visit = F.struct(F.get(host_of, F.col("range")).alias("range"), F.lit(True).alias("guest"))
    rows = rows.withColumn("at", F.explode(F.when(F.col("doc_id").eqNullSafe(F.get(top_of, F.col("range"))), F.array(own, visit)).otherwise(F.array(own))))
    rows = rows.select("at.range", "at.guest", "doc_id", "text")
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), text_key())
    return rows.select("range", F.row_number().over(order).alias("place"), "guest", "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edit_check(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, and the likeness to the next document.

    The edited text has its last floor(n / 2) characters replaced by the first as many (or all) of the next document's. Null texts
    count as empty. A lone document is its own next one. Repeated rows each give a row. An empty table gives an empty result.
    """
    rows = with_next(docs, doc_id, text)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next_text").substr(F.lit(1), half))
    told = rows.filter(~F.col("guest")).select("range", "place", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"))
    both = F.when(F.col("guest"), F.array(F.struct(F.lit(0).alias("edit"), F.col("text")))).otherwise(F.array(F.struct(F.lit(0).alias("edit"), F.col("text")), F.struct(F.lit(1).alias("edit"), edited.alias("text"))))
    texts = rows.select("range", "place", F.explode(both).alias("v")).select("range", (F.col("place") * 2 + F.col("v.edit")).alias("version"), F.col("v.text").alias("text"))
    prints = fingerprints(texts, ["range", "version"], samples=samples)
    prints = prints.groupBy("range", F.floor(F.col("version") / 2).cast("int").alias("place")).agg(
        F.max(F.when(F.col("version") % 2 == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("version") % 2 == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    after = F.lead("fingerprint").over(Window.partitionBy("range").orderBy("place"))
    prints = prints.withColumn("next_fingerprint", after)
    out = told.join(prints, ["range", "place"])
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


@query("op2_weighted_sampling")
def op2_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
