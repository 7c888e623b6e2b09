"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words of a text are hashed in runs of five. From every stretch of 13 words the run with the least hash (the last one on ties)
is kept as a fingerprint, so a span of 13 words that a document shares with a benchmark item has the same fingerprint at the
same place in both. Fingerprints are joined; each hit is then extended over the windows around it and compared word by word.
Items of fewer than 13 words are one window of their own length and get fingerprints made for that length.

A first pass takes only the fingerprints' hashes and finds the documents that share any; a second pass places and extends them in
those documents alone. What is shuffled is one narrow row a document and the hits. The benchmark's tables are written first, so
Spark knows their true size: small ones are broadcast below its own limit, larger ones are joined by shuffle.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import UPPER, let, lower_ascii, settled, text_key

WINDOW = 13
RUN = 5
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLACE_BITS = 28
_PLACES = (1 << _PLACE_BITS) - 1
_HASHES = (1 << 35) - 1


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def _over(base: Column, n: int, f) -> Column:
    """For every place, f over the n values from there on, by doubling; the last n - 1 places hold partial values."""

    def grow(powers, size):
        if 2 * size <= n:
            return let(_pairs(powers[-1], powers[-1], size, f), lambda wider: grow([*powers, wider], 2 * size))
        out, done = powers[-1], size
        for k in range(len(powers) - 2, -1, -1):
            if done + (1 << k) <= n:
                out, done = _pairs(out, powers[k], done, f), done + (1 << k)
        return out

    return grow([base], 1)


def _pairs(left: Column, right: Column, shift: int, f) -> Column:
    return F.zip_with(left, F.slice(right, shift + 1, F.lit(1 << 30)), f)


def _runs(hashes: Column, length: int) -> Column:
    """Hashes of the runs of words that start at every place, as non-negative numbers of 35 bits."""
    return F.transform(_over(hashes, min(RUN, length), lambda a, b: F.xxhash64(a, b)), lambda h: h.bitwiseAND(F.lit(_HASHES)))


def _least(values: Column, size: Column, length: int) -> Column:
    """The distinct values that are least in some stretch of `length` words; `size`: words of the text."""
    stretch = length - min(RUN, length) + 1
    return F.array_distinct(F.slice(_over(values, stretch, lambda a, b: F.least(a, b)), 1, F.greatest(size - (length - 1), F.lit(0))))


def _prints(hashes: Column, length: int) -> Column:
    """Fingerprints of a text, each with the length they are made for in its last four bits."""
    return F.transform(let(_runs(hashes, length), lambda r: _least(r, F.size(hashes), length)), lambda h: F.shiftleft(h, 4).bitwiseOR(F.lit(length).cast("long")))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _neighbourhoods(words: Column, length: int) -> Column:
    """Fingerprints, each at its last place in every stretch, with the words around that any window over the run can reach."""
    reach = length - min(RUN, length)

    def placed(hashes):
        at = F.transform(_runs(hashes, length), lambda h, i: F.shiftleft(h, _PLACE_BITS).bitwiseOR(F.lit(_PLACES) - i.cast("long")))
        return let(at, lambda r: _least(r, F.size(hashes), length))

    def around(x):
        place = (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).cast("int")
        first = F.greatest(place - reach, F.lit(0))
        return F.struct(
            F.lit(length).alias("length"),
            F.shiftleft(F.shiftright(x, _PLACE_BITS), 4).bitwiseOR(F.lit(length).cast("long")).alias("print"),
            first.alias("first"),
            F.slice(words, first + 1, place + length - first).alias("near"),
        )

    return F.transform(let(_hashes(words), placed), around)


def _windows(words: Column, length: Column) -> Column:
    """Place and text of every window of `length` words."""
    return F.when(
        F.size(words) >= length,
        F.transform(F.sequence(F.lit(0), F.size(words) - length), lambda s: F.struct(s.alias("start"), F.concat_ws(" ", F.slice(words, s + 1, length)).alias("gram"))),
    ).otherwise(F.array().cast("array<struct<start:int,gram:string>>"))


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(length, gram, item_id): the distinct windows of every item; an item of fewer than 13 words is one window."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.lit(WINDOW), F.size("words")))
    found = items.select("item_id", "length", F.explode(_windows(F.col("words"), F.col("length"))).alias("w"))
    return found.select("length", F.col("w.gram").alias("gram"), "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Per document: words, words hit, the items found and the verdict.

    Returns doc_id, text_key (hash of the text), n_words, n_hit, item_ids (array, sorted as strings), contaminated. A word is hit
    if it lies in an occurrence of a window. Contaminated: hits cover at least a twentieth of the words. Null and empty texts have
    no words and are clean; items without words match nothing; an item without id counts for hits but is not listed. Rows repeated
    in doc_id and text come back as often as they stand in the input. Empty tables give an empty result or clean documents.
    """
    windows = settled(benchmark_windows(benchmark, item_id, text), "benchmark-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # 13 values at most
    grams = windows.select("length", "gram").distinct()

    none = F.array().cast("array<bigint>")
    prints = grams.select(F.explode(let(_hashes(F.split("gram", " ")), lambda hs: F.concat(none, *[F.when(F.col("length") == n, _prints(hs, n)).otherwise(none) for n in lengths]))).alias("print"))
    prints = settled(prints.distinct().withColumn("shared", F.lit(True)), "benchmark-prints")

    texts = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), words_of(F.col(text)).alias("words"))
    counted = F.array(F.lit(-1).cast("long") - F.size("words"))  # a row for the document itself: its words, below zero
    rows = texts.select("doc_id", "text_key", F.explode(F.concat(counted, let(_hashes(F.col("words")), lambda hs: F.concat(none, *[_prints(hs, n) for n in lengths])))).alias("print"))
    rows = rows.join(prints, "print", "left").filter((F.col("print") < 0) | F.col("shared"))
    seen = rows.groupBy("doc_id", "text_key").agg(
        (F.lit(-1).cast("long") - F.min("print")).alias("n_words"),
        F.sum(F.when(F.col("print") < 0, 1).otherwise(0)).alias("copies"),
        F.max(F.col("print") >= 0).alias("candidate"),
    )
    seen = settled(seen, "documents-seen")

    # extend the hits of the documents that have any
    open_ = seen.filter("candidate").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    texts = texts.join(open_, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi")
    texts = texts.select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    empty = F.array().cast("array<struct<length:int,print:bigint,first:int,near:array<string>>>")
    near = texts.select("doc_id", "text_key", F.explode(F.concat(empty, *[_neighbourhoods(F.col("words"), n) for n in lengths])).alias("x")).select("doc_id", "text_key", "x.*")
    near = near.join(prints.select("print"), "print", "left_semi")
    near = near.select("doc_id", "text_key", "length", "first", F.explode(_windows(F.col("near"), F.col("length"))).alias("w"))
    near = near.select("doc_id", "text_key", "length", (F.col("first") + F.col("w.start")).alias("start"), F.col("w.gram").alias("gram"))
    near = near.join(settled(grams, "benchmark-grams"), ["length", "gram"], "left_semi")
    per_doc = near.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set(F.struct("length", "gram")).alias("grams"))
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).cast("long").alias("n"),
        ),
        lambda a: a["n"],
    )
    per_doc = per_doc.select("doc_id", "text_key", covered.alias("n_hit"), F.explode("grams").alias("g")).select("doc_id", "text_key", "n_hit", "g.*")
    per_doc = per_doc.join(windows, ["length", "gram"], "left").groupBy("doc_id", "text_key", "n_hit").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    per_doc = settled(per_doc, "documents-hit").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "n_hit", "item_ids")

    out = seen.join(per_doc, seen["doc_id"].eqNullSafe(per_doc["_id"]) & (seen["text_key"] == per_doc["_key"]), "left")
    out = out.select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns; see `contamination`."""
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    bad = settled(bad, "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (text_key() == bad["_key"]), "left_anti")


OP6_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
il AS (SELECT item_id, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM il)),
dw AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM il) WHERE len(w) >= n)),
h AS (SELECT r, n, s, item_id FROM dw JOIN iw USING (n, g)),
hw AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(s, s + n)) AS p FROM h)) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""


@query("op6_winnowing", OP6_SQL)
def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
