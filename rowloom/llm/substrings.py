"""Repeated passages by Relative Lempel-Ziv parsing against an index of the whole corpus.

A text is parsed into phrases cut at content-defined places: every window of 35 words is named by the least hash among its 28 runs
of eight words (the last of equals), and a phrase is a row of windows named by one run. Equal windows have equal names, so all
text is the reference: an index by name, dealt over the cluster, holds the phrases of every document. A phrase that the index holds more than
once is a whole factor; adjoining factors grow together. Phrases that share their name with another phrase but not their words
are factors only in part: they are checked window by window, which finds those that cross a factor's boundary. A literal parse
would need the reference blocks' text in every task; names bring a phrase to the few places that can match it.
Words covered by a repeated window are the duplicate spans, exactly (up to 64-bit hash collisions).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm import query
from rowloom.llm.common import settled, span_hash, text_chunks, text_key, word_spans

WINDOW = 35
RUN = 8
HOT = 1_000  # a key with more than this part of all rows is hot; there are fewer of them than this
MARK_WORDS = 1 << 19  # words of 64 marks that are sent to all tasks, at most


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # on space and \t\n\v\f\r alone


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every place the last of the least hashes among the `width` from there on."""
    best = np.arange(len(hashes))

    def join(left, right):
        return np.where(hashes[right] <= hashes[left], right, left)

    size = 1
    while 2 * size <= width:
        best = join(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return join(best[: len(best) - rest], best[rest:]) if rest else best


def phrases(texts: list[str | None], window: int = WINDOW, run: int = RUN):
    """(text, start, windows, name, words' hash) of all phrases, as arrays; starts count words within the text."""
    prefix, starts, ends, counts = word_spans([_words(t) for t in texts])
    first = np.cumsum(counts) - counts
    none = np.zeros(0, np.int64)
    if len(starts) < window:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    runs = span_hash(prefix, starts[: len(starts) - run + 1], ends[run - 1 :])
    least = _least_places(runs, window - run + 1)
    full = np.maximum(counts - window + 1, 0)
    owner = np.repeat(np.arange(len(texts)), full)
    at = first[owner] + np.arange(len(owner)) - (np.cumsum(full) - full)[owner]
    least = least[at]
    begins = np.ones(len(at), bool)
    begins[1:] = least[1:] != least[:-1]
    begin = np.flatnonzero(begins)
    size = np.diff(np.concatenate([begin, [len(at)]]))
    head = at[begin]
    return owner[begin], head - first[owner[begin]], size, runs[least[begin]], span_hash(prefix, starts[head], ends[head + size + window - 2])


def _phrase_table(df: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                owner, start, size, name, words = phrases(texts, window)
                node = batch.column(0).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([node, *(pa.array(x.astype(np.int32)) for x in (start, size)), *(pa.array(x.view(np.int64)) for x in (name, words))], names=["node", "start", "size", "name", "words"])

    return df.select("node", "text").mapInArrow(run, "node bigint, start int, size int, name bigint, words bigint")


def _window_table(df: DataFrame, window: int) -> DataFrame:
    """(node, place, times, window): the hash of every window in the given phrases (start, size, times) of a text."""

    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                prefix, starts, ends, counts = word_spans([_words(t) for t in texts])
                first = np.cumsum(counts) - counts
                lists = batch.column(2)
                flat, offsets = lists.flatten(), np.asarray(lists.offsets)
                start, size, times = (np.asarray(flat.field(k)).astype(np.int64) for k in range(3))
                owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
                each = np.repeat(np.arange(len(size)), size)
                place = start[each] + np.arange(len(each)) - (np.cumsum(size) - size)[each]
                at = first[owner[each]] + place
                h = span_hash(prefix, starts[at], ends[at + window - 1])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[each])), pa.array(place.astype(np.int32)), pa.array(times[each]), pa.array(h.view(np.int64))], names=["node", "place", "times", "window"])

    return df.select("node", "text", "parts").mapInArrow(run, "node bigint, place int, times bigint, window bigint")


def _within(rows: DataFrame, keys: DataFrame, by: list[str], size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is among `keys` (one row a key, with n, at least the number of its rows), as two tables: those of hot keys and the rest.

    A key is hot with more than a thousandth of `size` rows. As n adds up to `size` at most, fewer than a thousand keys are hot: they are
    sent to all tasks, and no task gathers the rows of one. The rest is joined by key.
    """
    bound = (rows.count() if size is None else size) // HOT
    hot = F.broadcast(keys.filter(F.col("n") > bound).select(*by))
    rest = keys.filter(F.col("n") <= bound).select(*by)
    return rows.join(hot, by, "left_semi"), rows.join(hot, by, "left_anti").join(rest, by, "left_semi")


def _split_by_marks(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among `keys` (all that are and some others), and those whose key surely is not.

    Every key sets one bit of a table that is sent to all tasks, so that rows without a partner need not travel to a join. The table has
    about 32 bits a key until it is full; from then on more rows travel for nothing.
    """
    words = min(MARK_WORDS, max(1, -(-keys.count() // 2)))
    slot, bit = F.pmod(F.shiftrightunsigned(key, 6), F.lit(words)), F.col(key).bitwiseAND(F.lit(63)).cast("int")
    marks = keys.select(slot.alias("_rowloom_slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("mark"))
    marks = marks.groupBy("_rowloom_slot").agg(F.bit_or("mark").alias("_rowloom_marks"))
    placed = rows.withColumn("_rowloom_slot", slot).join(F.broadcast(marks), "_rowloom_slot", "left")
    marked = F.coalesce(F.bit_get("_rowloom_marks", bit) == 1, F.lit(False))
    return placed.filter(marked).select(*rows.columns), placed.filter(~marked).select(*rows.columns)


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """(node, spans): for the hash of every text with repeated windows, the (start, size) rows of windows that repeat.

    A copy of a text repeats all its windows; a window may also repeat within its own text.
    """
    base = docs.select(text_key(text).alias("node"), F.col(text).alias("text"))
    index = settled(_phrase_table(base, window), "phrases")
    live = settled(index.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "live-phrases")
    place = ["name", "words", "node", "start", "size"]
    # grouped apart: the hot part is dealt by the whole place, the rest stays where the join put it
    hot, rest = (part.groupBy(*place).agg(F.count(F.lit(1)).alias("times")) for part in _within(index, live, ["name"]))
    shared = settled(hot.union(rest), "shared-phrases")

    total = shared.groupBy("name", "words").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "start", "size")).alias("one"))
    total = settled(total, "phrase-counts")
    hot, rest = _within(shared, total.filter("times > 1"), ["name", "words"])
    whole = hot.union(rest).select("node", "start", "size")

    mixed = total.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("times").alias("least")).filter("n > 1 and least = 1")
    hot, rest = _within(total.drop("n"), settled(mixed, "mixed-names"), ["name"], total.count())
    parts = hot.union(rest).select("one.*", "times")
    parts = settled(parts.groupBy("node").agg(F.collect_list(F.struct("start", "size", "times")).alias("parts")), "phrase-parts")
    texts = _split_by_marks(base, "node", parts.select("node"))[0].join(parts.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    windows = settled(_window_table(texts.join(parts, "node"), window), "windows")
    again = windows.groupBy("window").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n")).filter("times > 1")
    hot, rest = _within(windows.filter("times = 1"), settled(again, "repeated-windows"), ["window"], windows.count())
    crossing = hot.union(rest).select("node", F.col("place").alias("start"), F.lit(1).alias("size"))
    return whole.union(crossing).groupBy("node").agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def remove_repeated(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every row with n_words, n_removed and kept: the words outside repeated windows, joined by one space.

    Windows are judged on the input. Null, empty and short texts lose nothing; null is kept as the empty text. Repeated rows lose all
    their windows. Empty tables give empty results. Other columns pass through; columns named like the results are replaced.
    """
    docs = docs.drop(*[c for c in ("n_words", "n_removed", "kept") if c != text])
    names = docs.columns
    spans = settled(repeated_spans(docs, text, window), "repeated-spans")
    spans = spans.select(F.col("node").alias("_rowloom_node"), F.col("spans").alias("_rowloom_spans"))
    near, far = _split_by_marks(docs.withColumn("_rowloom_node", text_key(text)), "_rowloom_node", spans.select("_rowloom_node"))
    near = near.join(spans, "_rowloom_node", "left").select(*names, "_rowloom_spans")
    rows = near.unionByName(far.select(*names, F.lit(None).cast(spans.schema["_rowloom_spans"].dataType).alias("_rowloom_spans")))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, text):
                spans_of = batch.column(batch.num_columns - 1)
                n, removed, kept = [], [], []
                for i, t in enumerate(texts):
                    words = _words(t)
                    n.append(len(words))
                    own = spans_of[i]
                    if own.is_valid:
                        start, size = (np.asarray(own.values.field(k)).astype(np.int64) for k in range(2))
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + size + window - 1, -1)
                        left = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                        removed.append(len(words) - len(left))
                        words = [words[j] for j in left]
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT r, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
b AS (SELECT r, s FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM b),
k AS (SELECT r, count(*) AS n, list(p) AS ps FROM c GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce((SELECT string_agg(x, ' ' ORDER BY i) FROM (SELECT unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i) WHERE ps IS NULL OR NOT list_contains(ps, i)), '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@query("op10_relative_lempel_ziv", OP10_SQL)
def op10_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
