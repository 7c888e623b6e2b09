"""Near-duplicate documents by DartMinHash signatures, banded joins and exact checks.

A text is a multiset of five-word shingles; a shingle that occurs m times owns the weight region [0, m), cut into m cells. Every
cell has its own stream of darts, a Poisson process of ranks made by hashing, and every dart falls on one of 100 coordinates. The
dart of least rank on a coordinate is that coordinate's sample; two texts share it with a probability equal to their generalised
Jaccard similarity. Darts are thrown only up to the rank that fills all coordinates (about K ln K darts a text, so the time is the
number of shingles plus K ln K); a text with an empty coordinate gets a higher limit.

Signatures are cut into 20 bands of 5. Texts that share a band form a bucket. A bucket's leader, the text that shares most bands
with others, is compared with the bucket's texts on the full shingle multisets. Texts like their leader need no more comparison among themselves:
they are in one group. Only texts unlike it are compared with the other texts of that leader's buckets, chunk against chunk. No
candidate pair is lost, and none is written out: tasks return spanning forests.
A pair of similarity 0.8 shares no band with probability 0.0004. Groups are the connected components of the checked links.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm import query
from rowloom.llm.common import mix, settled, span_hash, text_chunks, text_key, word_spans

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
BAND_ROWS = 5
BLOCK = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CELL = np.uint64(0xC2B2AE3D27D4EB4F)


def cells_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(cells, bounds): 64-bit cells of all texts, those of text i, all distinct, at bounds[i]:bounds[i + 1].

    A text of fewer than five words is one shingle; one without words has no cell.
    """
    prefix, starts, ends, counts = word_spans([(t or "").encode().split() for t in texts])
    first = np.cumsum(counts) - counts
    shingles = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    owner = np.repeat(np.arange(len(texts)), shingles)
    at = first[owner] + np.arange(bounds[-1]) - bounds[owner]
    last = np.minimum(at + SHINGLE, first[owner] + counts[owner]) - 1
    h = span_hash(prefix, starts[at], ends[last])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        h[a:b].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    place = np.arange(len(h))
    nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return mix(h + nth.astype(np.uint64) * _CELL), bounds


def signatures(cells: np.ndarray, bounds: np.ndarray, samples: int) -> np.ndarray:
    """One row of dart identities a text; rows of texts without cells are zero."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), samples), np.uint64)
    limit = np.where(sizes > 0, samples * (math.log(samples) + 2) / np.maximum(sizes, 1), 0.0)
    open_ = np.flatnonzero(sizes > 0)
    seeds = cells
    while len(open_):
        picked, seed = np.repeat(open_, sizes[open_]), seeds
        top, rank, found = limit[picked], np.zeros(len(picked)), []
        nth = 0
        while len(picked):
            nth = (nth + int(_STEP)) & (1 << 64) - 1
            dart = mix(seed + np.uint64(nth))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            hit = rank <= top
            picked, seed, top, rank = picked[hit], seed[hit], top[hit], rank[hit]
            found.append((picked, rank, mix(dart[hit] + _CELL)))
        who, when, what = (np.concatenate(x) for x in zip(*found))
        slot = who * samples + (what % np.uint64(samples)).astype(np.int64)
        late_first = np.argsort(when, kind="stable")[::-1]
        full = np.zeros((len(sizes), samples), bool)
        full.reshape(-1)[slot] = True
        out.reshape(-1)[slot[late_first]] = what[late_first]  # the last one written, the earliest, stays
        open_ = open_[~full[open_].all(axis=1)]
        limit[open_] *= 4
        seeds = np.concatenate([cells[bounds[i] : bounds[i + 1]] for i in open_]) if len(open_) else cells
    return out


def band_hashes(sigs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros((len(sigs), bands), np.uint64)
    cut = sigs.reshape(len(sigs), bands, rows)
    for r in range(rows):
        h = mix(h * _STEP + cut[:, :, r])
    return mix(h + np.arange(bands, dtype=np.uint64) * _CELL).view(np.int64)


def _banded(df: DataFrame, bands: int, rows: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                cells, bounds = cells_of(texts)
                h = band_hashes(signatures(cells, bounds, bands * rows), bands, rows)
                held = np.repeat(np.diff(bounds) > 0, bands)
                offsets = np.arange(0, len(texts) * bands + 1, bands, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.reshape(-1), pa.int64(), mask=~held))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "node", "bands"])

    return df.select("doc_id", "node", "text").mapInArrow(run, df.select("doc_id", "node").schema.add("bands", T.ArrayType(T.LongType())))


def _with_cells(df: DataFrame) -> DataFrame:
    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                cells, bounds = cells_of(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.sort(cells[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())], names=["node", "cells"])

    return df.select("node", "text").mapInArrow(run, "node bigint, cells binary")


def _alike(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of (node, leader, a, b) the pairs whose cell sets are alike enough."""

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int(np.count_nonzero(y[at] == x))
                keep.append(both >= threshold * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["node", "leader"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("node", "leader", "a", "b").mapInArrow(run, "node bigint, leader bigint")


def _in_blocks(told: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """Links (node, leader) of texts that are unlike their leader with the other texts of that leader's buckets.

    Texts that are both like their leader are in one group already, so every other pair of a bucket has a text to ask here. Both sides
    are cut into chunks of some 256 texts; a task gets one chunk of askers and one of all, and returns a spanning forest of links.
    """
    sizes = told.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("linked").isNull()).alias("w")).filter("w > 0 and n > 1")
    sides = told.join(sizes, "leader").join(cells, "node")
    own = F.pmod(F.xxhash64("node"), F.ceil(F.col("w") / BLOCK)).cast("int")
    other = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).cast("int")
    asks = sides.filter(F.col("linked").isNull()).select("leader", own.alias("x"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / BLOCK).cast("int") - 1)).alias("y"), F.lit(True).alias("asks"), "node", "cells")
    held = sides.select("leader", F.explode(F.sequence(F.lit(0), F.ceil(F.col("w") / BLOCK).cast("int") - 1)).alias("x"), other.alias("y"), F.lit(False).alias("asks"), "node", "cells")

    def run(table):
        asks, node = table.column("asks").to_numpy(), table.column("node").to_numpy()
        sets = [np.frombuffer(c.as_buffer(), np.uint64) for c in table.column("cells")]
        held = np.flatnonzero(~asks)
        size = np.array([len(sets[i]) for i in held])
        every, owner = np.concatenate([sets[i] for i in held] or [np.zeros(0, np.uint64)]), np.repeat(np.arange(len(held)), size)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        root, out = {}, []

        def top(v):
            while root.setdefault(v, v) != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        for i in np.flatnonzero(asks):
            low, high = np.searchsorted(every, sets[i]), np.searchsorted(every, sets[i], "right")
            many = high - low
            at = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
            both = np.bincount(owner[at], minlength=len(held))
            for k in np.flatnonzero(both >= threshold * (len(sets[i]) + size - both)):
                a, b = int(node[i]), int(node[held[k]])
                if top(a) != top(b):
                    root[top(a)] = top(b)
                    out.append((a, b))
        return pa.table({"node": pa.array([o[0] for o in out], pa.int64()), "leader": pa.array([o[1] for o in out], pa.int64())})

    return asks.union(held).groupBy("leader", "x", "y").applyInArrow(run, "node bigint, leader bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root): connected components of (node, leader) links, root the least node.

    Every node takes the least label among its neighbours', then its label's label, until nothing changes. Each round is written to
    the shared folder. Sums are pre-aggregated and joins are split where one node has very many links.
    """
    edges = settled(links.select("node", "leader").union(links.select("leader", "node")).distinct(), "links")
    labels = settled(edges.groupBy("node").agg(F.least("node", F.min("leader")).alias("root")), "labels")
    while True:
        seen = edges.join(labels.select(F.col("node").alias("leader"), F.col("root").alias("near")), "leader")
        low = seen.groupBy("node").agg(F.min("near").alias("near"))
        step = settled(labels.join(low, "node", "left").select("node", "root", F.least("root", "near").alias("low")), "labels-step")
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        moved = settled(step.join(jump, "low", "left").select("node", F.least("low", "lower").alias("next"), F.col("root").alias("old")), "labels")
        if moved.filter("next != old").isEmpty():
            return moved.select("node", F.col("old").alias("root"))
        labels = moved.select("node", F.col("next").alias("root"))


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = BAND_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, class_id, class_size, keep): every document with its group.

    class_id is the least id of the group, class_size its rows; keep marks the least id (repeated rows of it alike). Equal texts are
    always one group, null counting as the empty text; texts without words are alike only when equal. Null ids come after all
    others. Repeated rows come back as often as they stand. An empty table gives an empty result.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("node"), F.col(text).alias("text"))
    banded = settled(_banded(base, bands, rows), "bands")
    buckets = banded.select("node", F.explode("bands").alias("bucket")).filter(F.col("bucket").isNotNull()).distinct()
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = settled(buckets.join(sizes, "bucket"), "buckets")
    weight = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    active = settled(weight, "active")
    once = base.join(active.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    cells = settled(_with_cells(once), "cells")

    leaders = shared.select("bucket", "node").join(active, "node").groupBy("bucket").agg(F.max_by("node", F.struct("weight", "node")).alias("leader"))
    pairs = settled(shared.select("bucket", "node").join(leaders, "bucket").filter("node != leader").select("node", "leader").distinct(), "pairs")
    of_leaders = cells.join(pairs.select("leader").distinct(), cells["node"] == F.col("leader"), "left_semi").select(F.col("node").alias("leader"), F.col("cells").alias("b"))
    compared = pairs.join(cells.select("node", F.col("cells").alias("a")), "node").join(of_leaders, "leader")
    found = settled(_alike(compared, threshold), "alike")
    told = settled(pairs.join(found.withColumn("linked", F.lit(True)), ["node", "leader"], "left"), "told")
    links = settled(found.select("node", "leader").union(_in_blocks(told, cells, threshold)), "all-links")

    members = banded.select("doc_id", "node")
    if links.isEmpty():
        grouped = members.withColumn("class", F.col("node"))
    else:
        roots = components(links)
        grouped = members.join(roots, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("class"))
    grouped = settled(grouped, "grouped")
    classes = grouped.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))).alias("first"))
    out = grouped.join(classes, "class")
    keep = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node")) == F.col("first")
    return out.select("doc_id", F.col("node").alias("text_key"), "class_id", "class_size", keep.alias("keep"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of every group, with its columns: the one of least id; of repeated rows one. See `duplicate_groups`."""
    rows = settled(duplicate_groups(docs).filter("keep").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count(F.lit(1)).alias("n")), "kept")

    def those(part):
        return docs.join(part, docs["doc_id"].eqNullSafe(part["_id"]) & (text_key() == part["_key"]), "left_semi")

    again = rows.filter("n > 1")
    out = those(rows.filter("n = 1"))
    if again.isEmpty():
        return out
    names = docs.columns
    one = those(again).groupBy("doc_id", text_key().alias("_key")).agg(F.first(F.struct(*names)).alias("row")).select("row.*")
    return out.union(one.select(*names))


@query("op8_dart_min_hash")
def op8_dart_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicate_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "class_id", "class_size", "keep")
