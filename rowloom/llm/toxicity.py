"""Toxicity scores after noisy-channel deobfuscation.

A character trigram model is counted over all texts. Spots that look disguised (signs or digits inside words, letters repeated three
times or more, single letters set apart) become lattices: every sign may stand for a letter, for itself or for nothing, a repetition
for one, two or all its letters, a separator for itself or for nothing. Viterbi's algorithm finds the likeliest path under channel and
character model, and the spot is replaced by what the path spells. The restored text is then scored by a logistic regression on its
words, their beginnings and endings.

Labels come from a bounded sample, `LABELLED` documents of least id hash; their features are counted on the cluster, and the `KEPT` of
them that tell the classes apart best enter the regression. Everything else covers all texts.
"""

import functools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import mix, settled, span_hash, text_chunks, word_spans

LABELLED = 20_000
KEPT = 4_096
SLOTS = 1 << 18
LEAST_ROWS = 3  # labelled documents that must hold a feature
SYMBOLS = 64  # blank, a-z, 36 classes of other letters, one of digits and signs
_OTHER = SYMBOLS - 1

# What signs and digits commonly stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou", "&": "aeiou",
}
SEPARATORS = " .-_*~/"
# Natural logarithms of the channel's probabilities.
SAME, SIGN, SWAPPED, MASKED, DROPPED, REPEATED, PARTED = (math.log(p) for p in (0.9, 0.05, 0.03, 0.01, 0.003, 0.02, 0.2))


def symbols(codes: np.ndarray) -> np.ndarray:
    """Symbol of every code point of a lower-cased text."""
    out = np.full(len(codes), _OTHER, np.int64)
    letter = (codes >= 97) & (codes <= 122)
    out[letter] = codes[letter] - 96
    wide = codes >= 192
    out[wide] = 27 + codes[wide] % 36
    out[(codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 160)] = 0
    return out


_SIGNS = np.zeros(128, bool)
_SIGNS[[ord(c) for c in STANDS_FOR if ord(c) < 128]] = True
_AT_END = np.zeros(128, bool)  # signs that often just follow a word
_AT_END[[ord(c) for c in "!|+(*#%&"]] = True
_PARTS = np.zeros(128, bool)
_PARTS[[ord(c) for c in SEPARATORS]] = True
_TRIMMED = ".,;:!?\"'()[]{}<>"


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def spots(low: str, codes: np.ndarray) -> list:
    """(start, end) of the disguised spots of a lower-cased text, in order and apart from each other."""
    n = len(codes)
    if not n:
        return []
    small = np.minimum(codes, 127)
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 192)
    sign = (codes < 128) & _SIGNS[small]
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 160)

    def shifted(mask, by):  # mask at i + by, False beyond the ends
        out = np.zeros(n, bool)
        if by > 0:
            out[:-by] = mask[by:]
        else:
            out[-by:] = mask[:by]
        return out

    before, after = shifted(letter, -1), shifted(letter, 1)
    inside = sign & np.where((codes < 128) & _AT_END[small], before & (after | shifted(sign, 1) & shifted(letter, 2)), before | after)
    same = np.zeros(n, bool)
    same[:-1] = codes[:-1] == codes[1:]
    again = letter & same & shifted(same, 1)
    alone = letter & ~before & ~after
    part = (codes < 128) & _PARTS[small]
    apart = alone & shifted(part, 1) & shifted(alone, 2) & shifted(part, 3) & shifted(alone, 4) & shifted(part, 5) & shifted(alone, 6)
    seeds = np.flatnonzero(inside | again | apart)
    if not len(seeds):
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]  # tokens between white space
    found = []
    for i in seeds.tolist():
        if found and i < found[-1][1]:
            continue
        if apart[i]:
            j = i  # a sign between parted letters may be a letter itself
            while j + 2 < n and part[j + 1] and alone[j + 2]:
                j += 2
            found.append((i, j + 1))
        else:
            k = int(np.searchsorted(starts, i, side="right")) - 1
            a, b = int(starts[k]), int(ends[k])
            if found:
                a = max(a, found[-1][1])
            while a < i and low[a] in _TRIMMED:
                a += 1
            while b > i + 1 and low[b - 1] in _TRIMMED:
                b -= 1
            found.append((a, b))
    return found


class CharacterModel:
    """Interpolated trigrams over `SYMBOLS` symbols."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 8 * p1) / (two.sum(axis=1, keepdims=True) + 8)
        self.log = np.log((three + 8 * p2) / (three.sum(axis=2, keepdims=True) + 8)).reshape(-1).tolist()


_RUN = re.compile(r"(.)\1*", re.S)


def lattice(spot: str) -> list:
    """Edges (start, end, spelt, log probability) of a lower-cased spot."""
    edges = []
    parted = len(spot) >= 7 and all(c in SEPARATORS for c in spot[1::2])
    for m in _RUN.finditer(spot):
        i, j, c = m.start(), m.end(), m.group(1)
        for k in range(i, j):
            edges.append((k, k + 1, c, SAME if c.isalnum() or c in SEPARATORS else SIGN))
            for x in STANDS_FOR.get(c, ""):
                edges.append((k, k + 1, x, MASKED if len(STANDS_FOR[c]) > 2 else SWAPPED))
            if parted and k % 2 == 1:
                edges.append((k, k + 1, "", PARTED))
            elif not c.isalnum():
                edges.append((k, k + 1, "", DROPPED))
        if j - i >= 3 and c.isalpha():
            edges += [(i, j, c, REPEATED), (i, j, c * 2, REPEATED)]
    return edges


def decode(spot: str, model: CharacterModel) -> str:
    """What the likeliest path through the spot's lattice spells, as a word of its own."""
    n = len(spot)
    leaving = [[] for _ in range(n)]
    for i, j, spelt, p in lattice(spot):
        leaving[i].append((j, spelt, symbols(_codes(spelt)).tolist(), p))
    log, width = model.log, SYMBOLS
    states = [{} for _ in range(n + 1)]  # (last two symbols) -> (log probability, previous place and state, spelt)
    states[0][0] = (0.0, None, None, "")
    for i in range(n):
        for state, (p, *_) in states[i].items():
            for j, spelt, syms, cost in leaving[i]:
                q, last = p + cost, state
                for s in syms:
                    q += log[last * width + s]
                    last = last % width * width + s
                old = states[j].get(last)
                if old is None or q > old[0]:
                    states[j][last] = (q, i, state, spelt)
    place = n
    state = max(states[n], key=lambda s: states[n][s][0] + log[s * width])
    out = []
    while place:
        _, place, state, spelt = states[place][state]
        out.append(spelt)
    return "".join(reversed(out))


_DECORATION = re.compile(r"([^\w\s])\1{2,}(?=\s|$|[^\w\s])")


def restore(texts: list, decoded) -> list:
    """Lower-cased texts with their disguised spots replaced by `decoded(spot)`; runs of three or more of one sign after a word become
    blanks."""
    out = []
    for text in texts:
        low = _DECORATION.sub(" ", (text or "").lower())
        at, parts = 0, []
        for a, b in spots(low, _codes(low)):
            parts += [low[at:a], decoded(low[a:b])]
            at = b
        out.append("".join(parts) + low[at:] if parts else low)
    return out


_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def features(texts: list):
    """(slots, owner) of restored texts by owner: their distinct words, and the first and last 3, 4 and 5 bytes of longer ones."""
    n = len(texts)
    prefix, starts, ends, counts = word_spans([t.encode("utf-8", "replace").translate(_PLAIN).split() for t in texts])
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(n), counts)
    words = span_hash(prefix, starts, ends)
    order = np.lexsort((words, owner))
    new = np.ones(len(order), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    keep = order[new]
    starts, ends, owner, words = starts[keep], ends[keep], owner[keep], words[keep]
    found, owners = [words], [owner]
    for size in (3, 4, 5):
        long = ends - starts > size
        a, b, o = starts[long], ends[long], owner[long]
        found += [span_hash(prefix, a, a + size) ^ np.uint64(size), span_hash(prefix, b - size, b) ^ np.uint64(size + 8)]
        owners += [o, o]
    slots = mix(np.concatenate(found)) & np.uint64(SLOTS - 1)
    pairs = np.unique(np.concatenate(owners).astype(np.uint64) << np.uint64(32) | slots)
    return (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64), (pairs >> np.uint64(32)).astype(np.int64)


def character_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigrams of symbols over all texts; at most 262,144 numbers reach the driver."""

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for whole in batches:
            for _, texts in text_chunks(whole, "text"):
                s = symbols(_codes("  ".join(_DECORATION.sub(" ", t.lower()) for t in texts if t)))
                if len(s) > 2:
                    total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(SYMBOLS**3)
    for cell, n in sums.collect():
        out[cell] = n
    return out


def _restorer(model: CharacterModel):
    decoded = functools.lru_cache(1 << 16)(lambda spot: decode(spot, model))
    return lambda texts: restore(texts, decoded)


def _sample(docs: DataFrame, labels: DataFrame, model, labelled: int) -> DataFrame:
    """(doc_id, toxic, slots) of the labelled sample, one row a doc_id; a doc_id with several labels is toxic if one says so."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("toxic")).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = settled(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled), "chosen")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        restored = _restorer(shipped.value)
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                slots, owner = features(restored(texts))
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                packed = [slots[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "toxic", "slots"])

    schema = rows.select("doc_id", "toxic", F.lit(b"").alias("slots")).schema
    one = F.min(F.struct("slots", "toxic")).alias("one")
    return settled(rows.mapInArrow(run, schema).groupBy("doc_id").agg(one).select("doc_id", "one.toxic", "one.slots"), "labelled-features")


def _telling(sample: DataFrame, kept: int) -> np.ndarray:
    """Slots with the most information about the label, by the likelihood ratio of their counts."""

    def run(batches):
        total = np.zeros((2, SLOTS), np.int64)
        for batch in batches:
            for toxic, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[int(toxic > 0), np.frombuffer(raw, np.int32)] += 1
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], names=["slot", "clean", "toxic"])

    counts = sample.select("toxic", "slots").mapInArrow(run, "slot bigint, clean bigint, toxic bigint").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rows = [tuple(r) for r in counts.filter(F.col("clean") + F.col("toxic") >= LEAST_ROWS).collect()]  # SLOTS rows at most
    if not rows:
        return np.zeros(0, np.int64)
    slot, clean, toxic = (np.array(x, float) for x in zip(*rows))
    n0, n1 = (float(x or 0) for x in sample.agg(F.sum(F.when(F.col("toxic") <= 0, 1)), F.sum(F.when(F.col("toxic") > 0, 1))).first())

    def part(seen, want):
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(want, 1e-12))

    share = (clean + toxic) / (n0 + n1)
    gain = part(toxic, share * n1) + part(clean, share * n0) + part(n1 - toxic, (1 - share) * n1) + part(n0 - clean, (1 - share) * n0)
    order = np.lexsort((slot, -np.round(gain, 6)))
    return np.sort(slot[order[:kept]].astype(np.int64))


def _regression(at, of, y, size, steps=300, ridge=0.3):
    """(weights, bias) of a logistic regression on rows of ones, by gradients with scaled steps."""
    n = len(y)
    w, b = np.zeros(size), math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1.0 / (1.0 + np.exp(-np.clip(np.bincount(of, weights=w[at], minlength=n) + b, -40, 40)))
        error = p - y
        g, gb = np.bincount(at, weights=error[of], minlength=size) + ridge * w, error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 - t / (steps + 1)) * math.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w, b = w - rate * m / (np.sqrt(v) + 1e-8), b - rate * mb / (math.sqrt(vb) + 1e-8)
    return w, b


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, kept: int = KEPT):
    """(character model, weights by slot, bias); without labels of both kinds the weights are None and the bias the labels' share."""
    model = CharacterModel(character_counts(docs))
    sample = _sample(docs, labels, model, labelled)
    toxic, n = sample.agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)), F.count(F.lit(1))).first()
    if not toxic or toxic == n:
        return model, None, 1.0 if toxic else 0.0
    chosen = _telling(sample, kept)

    def run(batches):
        for batch in batches:
            packed = []
            for raw in batch.column(2).to_pylist():
                slots = np.frombuffer(raw, np.int32)
                at = np.minimum(np.searchsorted(chosen, slots), max(len(chosen) - 1, 0))
                packed.append(at[chosen[at] == slots].astype(np.int16).tobytes() if len(chosen) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "toxic", "slots"])

    schema = sample.schema
    table = sample.mapInArrow(run, schema).toPandas().sort_values("doc_id")  # `labelled` rows of at most 2 * `kept` bytes
    rows = [np.frombuffer(b, np.int16).astype(np.int64) for b in table["slots"]]
    at, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, b = _regression(at, of, (table["toxic"].to_numpy() > 0).astype(float), len(chosen))
    weights = np.zeros(SLOTS)
    weights[chosen] = w
    return model, weights, b


def score(docs: DataFrame, labels: DataFrame, fitted=None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document (doc_id, text), learnt from labels (doc_id, toxic).

    Labels of rows with crc32(doc_id as text) mod 5 = 0 are not learnt from (held_out); neither are null ones. Null and empty texts are
    scored as texts without words. Equal texts get equal scores, repeated rows a row each. Without labels of both kinds every score is 1
    or 0, as the labels are (0 without labels). Long texts are scored whole. An empty table gives an empty result. Other columns are
    not read.
    """
    model, weights, bias = fit(docs, labels) if fitted is None else fitted
    shipped = docs.sparkSession.sparkContext.broadcast((model, weights, bias))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), "text")

    def run(batches):
        model, weights, bias = shipped.value
        restored = _restorer(model)
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                if weights is None:
                    p = np.full(len(texts), bias)
                else:
                    slots, owner = features(restored(texts))
                    z = np.bincount(owner, weights=weights[slots], minlength=len(texts)) + bias
                    p = np.round(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))), 9)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p)], names=["doc_id", "held_out", "score"])

    done = rows.mapInArrow(run, rows.select("doc_id", "held_out", F.lit(0.0).alias("score")).schema)
    return done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op13_deobfuscation")
def op13_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
