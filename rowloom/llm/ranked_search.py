"""Ranked lexical search over bit-sliced Bloom signatures.

The index is cut into blocks of documents with signatures of one width. A block holds, for every bit of the signature, a bitmap over its
documents (a slice), and below them its dictionary (terms and the documents that hold them) and the documents' term numbers. A term is
entered once for being there, once more for two or more occurrences, and once more for four or more.

A search ands the slices of each term of an item, which never misses a document but may name too many; the sums of the terms' weights
over these bitmaps, level by level, bound each document's score from above. Documents are scored exactly in the order of their bounds
until no bound reaches the worst of the best `top` scores found so far by the task; what is left is provably excluded.

Terms stand for 64-bit hashes; two different ones fall together with probability n^2 / 2^65.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import mix, settled, span_hash, text_chunks, word_spans

TOP = 10
#: Documents, signature cells and term numbers of a block, at most; a longer document is a block by itself.
BLOCK_DOCS = 4_096
BLOCK_CELLS = 1 << 24
BLOCK_TERMS = 1 << 19
SLICES_PER_TERM = 4
BITS_PER_ENTRY = 8  # at least, at most twice as many
LEVELS = (1, 2, 4)  # occurrences from which a term is entered once more
#: Blocks of a file of the index, which a task holds whole when it writes and when it reads them.
FILE_BLOCKS = 4
#: Terms of all items searched for in one pass over the index.
PASS_TERMS = 200_000

_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_INDEX = "width int, docs binary, known binary, lengths binary, slices binary, dictionary binary, df binary, numbers binary, tf binary"
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]


def term_counts(texts):
    """(hashes, occurrences, owner) of the distinct terms of each text, by owner and hash, and the number of terms of each text."""
    parts = [(t or "").encode().lower().translate(_PLAIN).split() for t in texts]
    prefix, starts, ends, counts = word_spans(parts)
    hashes, owner = span_hash(prefix, starts, ends), np.repeat(np.arange(len(parts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return hashes[first], np.diff(np.append(first, len(hashes))), owner[first], counts


def places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """Slices of each term at a level, `SLICES_PER_TERM` columns."""
    base = mix(hashes ^ np.uint64(0x9E3779B97F4A7C15 >> level))
    step = mix(base) | np.uint64(1)
    steps = np.arange(SLICES_PER_TERM, dtype=np.uint64)
    return ((base[:, None] + steps * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def _block(width: int, held: list):
    """One row of the index from (doc_id, length, hashes, occurrences) of its documents."""
    n = len(held)
    hashes, tf = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
    doc = np.repeat(np.arange(n), [len(h[2]) for h in held])
    cells = np.zeros((width, n), bool)
    for level, least in enumerate(LEVELS):
        on = tf >= least
        cells[places(hashes[on], level, width), doc[on][:, None]] = True
    words, numbers, df = np.unique(hashes, return_inverse=True, return_counts=True)
    ids = np.array([-1 if h[0] is None else h[0] for h in held], np.int64)
    known = np.array([h[0] is not None for h in held], np.uint8)
    lengths = np.array([h[1] for h in held], np.int64)
    sizes = np.array([len(h[2]) for h in held], np.int64)
    return (width, ids.tobytes(), known.tobytes(), np.concatenate([lengths, sizes]).tobytes(), np.packbits(cells, axis=1).tobytes(), words.tobytes(), df.astype(np.int32).tobytes(), numbers.astype(np.int32).tobytes(), tf.astype(np.int32).tobytes())


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, one row a block; documents without terms are left out. One pass over the texts, no shuffle."""
    kinds = [pa.int32(), *[pa.binary()] * (len(_NAMES) - 1)]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_NAMES)

    def run(batches):
        held, terms = {}, {}
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                ids = batch.column(0).to_pylist()
                hashes, tf, owner, counts = term_counts(texts)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                entries = sum(np.bincount(owner[tf >= least], minlength=len(texts)) for least in LEVELS)
                for i in np.flatnonzero(counts):
                    width = 1 << int(BITS_PER_ENTRY * max(int(entries[i]), 8) - 1).bit_length()
                    held.setdefault(width, []).append((ids[i], int(counts[i]), hashes[cuts[i] : cuts[i + 1]].copy(), tf[cuts[i] : cuts[i + 1]].copy()))
                    terms[width] = terms.get(width, 0) + int(cuts[i + 1] - cuts[i])
                    if len(held[width]) >= max(1, min(BLOCK_DOCS, BLOCK_CELLS // width)) or terms[width] >= BLOCK_TERMS:
                        yield packed([_block(width, held.pop(width))])
                        terms.pop(width)
        for width in sorted(held):
            yield packed([_block(width, held[width])])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _INDEX)


class _Block:
    def __init__(self, batch, i):
        def get(name, kind):
            return np.frombuffer(batch.column(_NAMES.index(name))[i].as_py(), kind)

        self.width = batch.column(0)[i].as_py()
        self.ids, self.known = get("docs", np.int64), get("known", np.uint8)
        n = len(self.ids)
        both = get("lengths", np.int64)
        self.lengths, sizes = both[:n], both[n:]
        self.slices = get("slices", np.uint8).reshape(self.width, -1)
        self.dictionary, self.df = get("dictionary", np.uint64), get("df", np.int32)
        self.tf = get("tf", np.int32).astype(np.int64)
        owner = np.repeat(np.arange(n), sizes)
        self.keys = owner * len(self.dictionary) + get("numbers", np.int32)
        first = np.cumsum(sizes) - sizes
        self.most = np.maximum.reduceat(self.tf, first)

    def parts(self, tf, m):
        return (1_000_000_000 * tf) // (1_000 * tf + 8 * m)

    def bounds(self, terms, weights, m):
        """Score of every document, from above."""
        n = len(self.ids)
        sums = np.zeros((len(LEVELS), n))
        for a in range(0, len(terms), 256):
            for level in range(len(LEVELS)):
                at = places(terms[a : a + 256], level, self.width)
                bits = self.slices[at[:, 0]]
                for k in range(1, SLICES_PER_TERM):
                    bits = bits & self.slices[at[:, k]]
                some = bits.any(axis=1)
                if some.any():
                    sums[level] += weights[a : a + 256][some].astype(float) @ np.unpackbits(bits[some], axis=1, count=n)
        tops = [self.parts(np.minimum(self.most, least - 1), m) for least in LEVELS[1:]] + [self.parts(self.most, m)]
        total, below = np.zeros(n, np.int64), 0
        for s, top in zip(sums.astype(np.int64), tops):
            total += s * (top - below)
            below = top
        return total

    def scores(self, docs, terms, weights, m):
        """Exact scores of the documents at places `docs`."""
        at = np.minimum(np.searchsorted(self.dictionary, terms), len(self.dictionary) - 1)
        here = self.dictionary[at] == terms
        at, weights = at[here], weights[here]
        total = np.zeros(len(docs), np.int64)
        step = max(1, (1 << 20) // max(len(at), 1))
        for a in range(0, len(docs), step):
            part = docs[a : a + step]
            want = part[:, None] * len(self.dictionary) + at
            found = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            tf = np.where(self.keys[found] == want, self.tf[found], 0)
            total[a : a + step] = (weights * self.parts(tf, m[part][:, None])).sum(axis=1)
        return total


def search_block(block: _Block, items: list, best: list, total_docs: int, total_terms: int, top: int) -> int:
    """Merge a block's documents into the best of each item, as (-score, no id, id); the number of documents scored exactly."""
    m = 25 + (75 * block.lengths * total_docs) // total_terms
    scored = 0
    for k, (terms, weights) in enumerate(items):
        bound = block.bounds(terms, weights, m)
        order = np.argsort(-bound, kind="stable")
        a, size = 0, top
        while a < len(order):  # first the most promising, then ever more of them, while their bounds reach the worst kept score
            least = -best[k][-1][0] if len(best[k]) >= top else 1
            part = order[a : a + size]
            part = part[bound[part] >= max(least, 1)]
            if not len(part):
                break
            score = block.scores(part, terms, weights, m)
            scored += len(part)
            good = score >= max(least, 1)
            best[k] += [(-int(s), 1 - int(block.known[d]), int(block.ids[d])) for s, d in zip(score[good], part[good])]
            best[k].sort()
            del best[k][top:]
            a, size = a + size, size * 4
    return scored


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, terms, counts) of the distinct items that have terms."""

    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                hashes, tf, owner, counts = term_counts(texts)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(some)),
                        batch.column(1).take(pa.array(some)),
                        pa.array([hashes[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                        pa.array([tf[cuts[i] : cuts[i + 1]].astype(np.int64).tobytes() for i in some], pa.binary()),
                    ],
                    names=["item", "item_id", "terms", "counts"],
                )

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    rows = rows.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text")
    schema = rows.select("item", "item_id", F.lit(b"").alias("terms"), F.lit(b"").alias("counts")).schema
    return rows.mapInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of highest positive score for each item; of equal scores the smaller doc_id
    comes first, an unknown one last.

    Every row of the indexed table is a document, so repeated rows can all be ranked. Equal rows of `items` are one item; items without
    terms have no rows. Items are dealt to passes by their hash, with some `PASS_TERMS` terms a pass, so what is shipped with the tasks
    doesn't grow with the table of documents or that of items.
    """
    spark = index.sparkSession
    wanted = settled(_item_terms(items, item_id, text), "items")
    totals = index.select("lengths").mapInArrow(_lengths, "n bigint, terms bigint").agg(F.sum("n"), F.sum("terms")).first()
    size = totals[0] or 0
    terms = wanted.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    ranked = None
    passes = max(1, math.ceil(terms / 8 / PASS_TERMS))
    for p in range(passes):
        rows = wanted.filter(F.pmod("item", F.lit(passes)) == p).collect() if size else []
        if not rows:
            continue
        found = _search_pass(index, rows, int(totals[0]), int(totals[1]), top)
        found = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"_k int, item_id {wanted.schema['item_id'].dataType.simpleString()}").join(found, "_k")
        found = found.withColumn("_item", F.lit(p).cast("bigint") * (1 << 32) + F.col("_k")).drop("_k")
        ranked = found if ranked is None else ranked.unionByName(found)
    if ranked is None:
        return wanted.limit(0).select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _lengths(batches):
    for batch in batches:
        n = total = 0
        for raw in batch.column(0).to_pylist():
            both = np.frombuffer(raw, np.int64)
            n, total = n + len(both) // 2, total + int(both[: len(both) // 2].sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "terms"])


def _search_pass(index: DataFrame, rows: list, total_docs: int, total_terms: int, top: int) -> DataFrame:
    """(_k, doc_id, score): for each item of the pass the best of every task."""
    context = index.sparkSession.sparkContext
    items = [(np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["counts"], np.int64)) for r in rows]
    vocabulary = np.unique(np.concatenate([t for t, _ in items]))
    shipped = context.broadcast(vocabulary)

    def frequencies(batches):
        total = np.zeros(len(shipped.value), np.int64)
        for batch in batches:
            for words, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, df = np.frombuffer(words, np.uint64), np.frombuffer(df, np.int32)
                at = np.minimum(np.searchsorted(words, shipped.value), len(words) - 1)
                total += np.where(words[at] == shipped.value, df[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    counts = index.select("dictionary", "df").mapInArrow(frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for r in counts.collect():  # a number for each term of the pass
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    ready = context.broadcast([(t, n * weight[np.searchsorted(vocabulary, t)]) for t, n in items])

    def run(batches):
        best = [[] for _ in ready.value]
        for batch in batches:
            for i in range(batch.num_rows):
                search_block(_Block(batch, i), ready.value, best, total_docs, total_terms, top)
        out = [(k, None if unknown else doc, -score) for k, kept in enumerate(best) for score, unknown, doc in kept]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], names=["_k", "doc_id", "score"])

    return index.select(*_NAMES).mapInArrow(run, "_k int, doc_id bigint, score bigint")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """`search` of items (item_id, text) over documents (doc_id, text), with an index written to the shared folder.

    Null and empty texts, and texts without letters and digits, hold no term: such documents are not counted and never ranked. Empty
    tables give an empty result. Long texts are blocks of their own. Other columns are not read.
    """
    return search(settled(build_index(docs), "signatures", file_rows=FILE_BLOCKS), items, top=top)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""WITH d AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
 tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
 len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
 c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
 w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, docs),
 q AS (SELECT item_id, t, count(*) AS reps FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
 s AS (SELECT item_id, doc_id, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
   FROM q JOIN tf USING (t) JOIN w USING (t) JOIN len USING (doc_id), c GROUP BY item_id, doc_id),
 r AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


@query("op11_bit_sliced_search", ORACLE)
def op11_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
