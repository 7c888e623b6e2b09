"""Language-model scores by context-tree weighting, beside a smoothed word-unigram base.

A text is its lower-cased words joined by one space, with an end sign. Every byte is eight binary decisions; the context of a decision
is the byte's bits so far and up to `DEPTH` bytes before. Counts of (context, next byte) over all training texts give, at every
node of the tree of contexts, a Krichevsky-Trofimov estimate; a node's weight against its children follows from the probabilities
that both give to the training data, and a decision's probability mixes the estimates along its path with these weights. Where a
longer context has never been seen, its weight stays with the longest one that has. The model is fixed after training.

Distinct contexts grow with the corpus and are never brought to one place. Subtrees below three bytes of context are computed in groups,
ranges of contexts; the nodes of two bytes stay on the cluster and reach only the groups below them; the driver sees the two topmost
levels alone (at most 65,536 nodes). Texts lie in blocks of some 32 MB, cut where they are read, so copies of one row spread over
blocks. A block sends each group one row with its distinct (context, byte) pairs as differences of some two bytes, and their numbers;
the group sends the row back with the costs, and the block's texts are scored with these. Counts of words travel the same way.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import settled, span_hash, word_spans

DEPTH = 6  # a pair of context and byte takes 56 of a key's 64 bits
TOP = 3  # bytes of context that a group's subtrees share
GROUP_BYTES = 16 << 20  # text for each group of contexts
LEAST_GROUPS = 96
SAMPLED = 2_000  # texts of least hash that the bounds of the groups come from; any bounds give the same costs
BLOCK_BYTES = 32 << 20
_END = 10  # the end sign; white space never is part of a word
_END_WORD = -1
_CHUNK = 1 << 20
_ASKED = "block bigint, group int, keys binary, n binary"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in seven bits a byte, the last byte of each with its top bit clear."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1) << np.uint64(7 * k) if 7 * k < 64 else 0
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max()) if len(sizes) else 0):
        on = sizes > k
        more = (sizes[on] > k + 1).astype(np.uint8) << np.uint8(7)
        out[(ends - sizes)[on] + k] = ((values[on] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    last = np.flatnonzero(data < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out, sizes = np.zeros(len(last), np.uint64), last - first + 1
    for k in range(int(sizes.max()) if len(sizes) else 0):
        on = sizes > k
        out[on] |= (data[first[on] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return out


def packed_sorted(keys: np.ndarray) -> bytes:
    """Ascending signed keys as the differences between neighbours."""
    up = keys.view(np.uint64) ^ (np.uint64(1) << np.uint64(63))  # keeps the order of signed numbers
    return packed(np.diff(up, prepend=np.uint64(0)))


def unpacked_sorted(raw: bytes) -> np.ndarray:
    return (np.cumsum(unpacked(raw), dtype=np.uint64) ^ (np.uint64(1) << np.uint64(63))).view(np.int64)


def _sequences(texts, depth: int = 4):
    """(words of each text, hashes of all words in order, their numbers, keys of all bytes, their numbers by text)."""
    parts = [(t or "").encode().lower().split() for t in texts]
    prefix, starts, ends, counts = word_spans(parts)
    words = span_hash(prefix, starts, ends).view(np.int64)
    words[words == _END_WORD] = 0
    pad = bytes([_END]) * depth
    data = np.frombuffer(b"".join(pad + b" ".join(p) + pad[:1] for p in parts), np.uint8)
    sizes = np.array([sum(map(len, p)) + max(len(p) - 1, 0) + 1 for p in parts], np.int64)
    own = np.ones(len(data), bool)
    begins = np.cumsum(sizes + depth) - (sizes + depth)
    for j in range(depth):
        own[begins + j] = False
    at = np.flatnonzero(own)
    keys = data[at].astype(np.uint64)
    for j in range(1, depth + 1):
        keys |= data[at - j].astype(np.uint64) << np.uint64(8 * (depth - j + 1))
    return words, counts, keys.view(np.int64), sizes


def _chunked(table, text: str):
    """Row ranges of some 1 MB of text."""
    texts = table.column(text)
    sizes = np.cumsum([len(t) if t else 0 for t in texts.to_pylist()])
    cuts = [0, *(np.flatnonzero(np.diff(sizes // _CHUNK)) + 1).tolist(), table.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield a, b


def _summed(keys, n):
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _distinct(values, train):
    """Distinct values with their number in training texts."""
    tagged, n = np.unique(values.view(np.uint64) << np.uint64(1) | train.astype(np.uint64), return_counts=True)
    return (tagged >> np.uint64(1)).view(np.int64), n * (tagged & np.uint64(1)).astype(np.int64)


def _asked(rows: DataFrame, bounds, word_groups: int) -> DataFrame:
    """One row for each block and group it has keys of: distinct keys and their numbers in the block's training texts. Groups from 0 on
    hold pairs, by ranges of their latest `TOP` bytes; those below 0 words. A block read by two tasks has rows from either."""
    bounds = np.asarray(bounds, np.int64)

    def rows_of(block, found):
        for kind, parts in enumerate(found):
            if not parts:
                continue
            keys, n = _summed(*(np.concatenate(x) for x in zip(*parts)))
            if kind == 0:
                group = np.searchsorted(bounds, keys >> 8 * (DEPTH - TOP + 1), side="left")
            else:
                group = -1 - ((keys >> 32) % word_groups)
            order = np.argsort(group, kind="stable")
            keys, n, group = keys[order], n[order], group[order]
            cuts = np.flatnonzero(np.diff(group)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                yield block, int(group[a]), packed_sorted(keys[a:b]), packed(n[a:b])

    def batch_of(out):
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["block", "group", "keys", "n"])

    def run(batches):
        block, found = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            blocks = table.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for c, d in zip(cuts[:-1], cuts[1:]):
                if d == c:
                    continue
                if block != int(blocks[c]):
                    if found is not None:
                        yield batch_of(list(rows_of(block, found)))
                    block, found = int(blocks[c]), ([], [])
                piece = table.slice(c, d - c)
                for a, b in _chunked(piece, "text"):
                    part = piece.slice(a, b - a)
                    train = ~np.array(part.column("held_out").to_pylist(), bool)
                    words, counts, keys, sizes = _sequences(part.column("text").to_pylist(), DEPTH)
                    found[0].append(_distinct(keys, np.repeat(train, sizes)))
                    order = np.argsort(words, kind="stable")
                    found[1].append(_summed(words[order], np.repeat(train, counts)[order].astype(np.int64)))
                    found[1].append((np.array([_END_WORD]), np.array([int(train.sum())])))
                    for kind in (0, 1):
                        if len(found[kind]) >= 16:
                            found[kind][:] = [_summed(*(np.concatenate(x) for x in zip(*found[kind])))]
        if found is not None:
            yield batch_of(list(rows_of(block, found)))

    return rows.mapInArrow(run, _ASKED)


def _merged(table):
    """(keys, numbers, keys of every row) of a group's rows."""
    each = [unpacked_sorted(x) for x in table.column("keys").to_pylist()]
    n = [unpacked(x).astype(np.int64) for x in table.column("n").to_pylist()]
    return *_summed(np.concatenate(each), np.concatenate(n)), each


def _log_gamma(x):
    y = x + 8.0
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    for i in range(8):
        out -= np.log(x + i)
    return out


def _log_kt(a, b):
    """Logarithm of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)


def _gathered(nodes, *values):
    order = np.argsort(nodes, kind="stable")
    nodes = nodes[order]
    first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
    return nodes[first], *(np.add.reduceat(v[order], first) for v in values)


def _weights(a, b, below):
    """(log weight of the own estimate against the children's, log probability of the node)."""
    own = _log_kt(a, b)
    return own - below, np.logaddexp(own, below) - math.log(2)


def subtree(keys: np.ndarray, n: np.ndarray, depth: int = 4, top: int = 2):
    """Levels depth .. top of the tree: {level: (nodes, a, b, log weight)} and the log probabilities of the nodes at `top`.

    A node is its context (latest byte first) followed by the bits so far, led by a 1.
    """
    ctx, sym = keys >> 8, keys & 255
    nodes = np.concatenate([ctx << 8 | (1 << j) | (sym >> (8 - j)) for j in range(8)])
    one = np.concatenate([(sym >> (7 - j)) & 1 for j in range(8)])
    many = np.tile(n, 8).astype(np.float64)
    nodes, a, b = _gathered(nodes, many * (1 - one), many * one)
    levels, log_p = {depth: (nodes, a, b, np.full(len(nodes), np.inf))}, _log_kt(a, b)
    for d in range(depth - 1, top - 1, -1):
        nodes, a, b, below = _gathered((nodes >> 16) << 8 | nodes & 255, a, b, log_p)
        weight, log_p = _weights(a, b, below)
        levels[d] = (nodes, a, b, weight)
    return levels, log_p


def costs(keys: np.ndarray, levels: dict, depth: int = 4) -> np.ndarray:
    """log10 probability of each key's byte after its context."""
    total = np.zeros(len(keys))
    ctx, sym = keys >> 8, keys & 255
    for j in range(8):
        bits, one = (1 << j) | (sym >> (8 - j)), (sym >> (7 - j)) & 1
        p, seen = np.full(len(keys), 0.5), np.zeros(len(keys), bool)
        for d in range(depth, -1, -1):
            nodes, a, b, weight = levels[d]
            node = (ctx >> 8 * (depth - d)) << 8 | bits
            at = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
            here = nodes[at] == node
            kt = (np.where(one == 1, b[at], a[at]) + 0.5) / (a[at] + b[at] + 1.0)
            share = 1.0 / (1.0 + np.exp(-np.clip(weight[at], -700, 700)))
            p = np.where(here, np.where(seen, share * kt + (1 - share) * p, kt), p)
            seen |= here
        total += np.log10(p)
    return total


def _none():
    return np.array([-1]), np.zeros(1), np.zeros(1), np.zeros(1)


def _bounds(rows: DataFrame, groups: int) -> list:
    """Ranges of the `TOP` latest bytes that hold about equally many distinct pairs of the texts sampled."""
    few = rows.select("text").filter(F.col("text").isNotNull()).orderBy(F.xxhash64("text")).limit(SAMPLED)

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for a, b in _chunked(table, "text"):
                keys = _sequences(table.slice(a, b - a).column("text").to_pylist(), DEPTH)[2]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(keys))], names=["key"])

    lead = F.shiftright("key", 8 * (DEPTH - TOP + 1))
    found = few.mapInArrow(run, "key bigint").distinct().agg(F.percentile_approx(lead, [i / groups for i in range(1, groups)], max(10_000, 20 * groups))).first()[0]
    return sorted(set(found or []))


def _uppers(grouped: DataFrame) -> DataFrame:
    """(node, a, b, weight, p) of the level above the groups, from sums over the subtrees' topmost nodes."""
    schema = "node bigint, a double, b double, p double"

    def run(table):
        keys, n, _ = _merged(table)
        keys, n = keys[n > 0], n[n > 0]
        if not len(keys):
            return pa.table({"node": pa.array([], pa.int64()), "a": pa.array([], pa.float64()), "b": pa.array([], pa.float64()), "p": pa.array([], pa.float64())})
        levels, log_p = subtree(keys, n, DEPTH, TOP)
        nodes, a, b, _ = levels[TOP]
        return pa.table(dict(zip(("node", "a", "b", "p"), map(pa.array, _gathered((nodes >> 16) << 8 | nodes & 255, a, b, log_p)))))

    def weigh(batches):
        for batch in batches:
            node, a, b, p = batch.columns
            weight, log_p = _weights(a.to_numpy(), b.to_numpy(), p.to_numpy())
            yield pa.RecordBatch.from_arrays([node, a, b, pa.array(weight), pa.array(log_p)], names=["node", "a", "b", "weight", "p"])

    parts = grouped.groupBy("group").applyInArrow(run, schema)
    sums = parts.groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("p").alias("p"))
    return settled(sums.mapInArrow(weigh, "node bigint, a double, b double, weight double, p double"), "upper-nodes")


def _tops(uppers: DataFrame) -> dict:
    """Levels 0 and 1, from sums over level 2."""
    node = F.shiftleft(F.shiftright("node", 16), 8).bitwiseOR(F.col("node").bitwiseAND(F.lit(255)))
    rows = uppers.groupBy(node.alias("node")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("p").alias("p")).orderBy("node").toPandas()
    nodes, a, b = rows["node"].to_numpy(np.int64), rows["a"].to_numpy(float), rows["b"].to_numpy(float)
    if not len(nodes):
        return {0: _none(), 1: _none()}
    weight, log_p = _weights(a, b, rows["p"].to_numpy(float))
    root, ra, rb, below = _gathered(nodes & 255, a, b, log_p)
    return {1: (nodes, a, b, weight), 0: (root, ra, rb, _weights(ra, rb, below)[0])}


_ANSWER = "block bigint, group int, keys binary, value binary"


def _answer(table, values, kind=np.float32):
    cells = [pa.array([np.asarray(v, kind).tobytes() for v in values], pa.binary())]
    return pa.table([table.column("block"), table.column("group"), table.column("keys"), *cells], names=["block", "group", "keys", "value"])


def _costed(grouped: DataFrame, uppers: DataFrame, bounds) -> DataFrame:
    """The rows of the pairs' groups with the costs of their keys."""
    shipped = grouped.sparkSession.sparkContext.broadcast(_tops(uppers))
    bounds = np.asarray(bounds, np.int64)

    def below(batches):  # a node of two bytes is above 256 leads, and so above a run of groups
        for batch in batches:
            lead = (batch.column(0).to_numpy() >> 8) << 8
            first, last = np.searchsorted(bounds, lead, side="left"), np.searchsorted(bounds, lead + 255, side="left")
            at = np.repeat(np.arange(len(lead)), last - first + 1)
            group = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]) if len(lead) else np.zeros(0, np.int64)
            taken = [c.take(pa.array(at)) for c in batch.columns[:4]]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(group.astype(np.int32))], names=["node", "a", "b", "weight", "below"])

    over = uppers.select("node", "a", "b", "weight").mapInArrow(below, "node bigint, a double, b double, weight double, below int")

    def run(table, above):
        if not table.num_rows:
            return _answer(table, [])
        keys, n, each = _merged(table)
        known = n > 0
        levels = subtree(keys[known], n[known], DEPTH, TOP)[0] if known.any() else {d: _none() for d in range(TOP, DEPTH + 1)}
        upper = [above.column(c).to_numpy() for c in ("node", "a", "b", "weight")]
        order = np.argsort(upper[0])
        levels[TOP - 1] = tuple(x[order] for x in upper) if len(order) else _none()
        cost = costs(keys, {**shipped.value, **levels}, DEPTH)
        return _answer(table, [cost[np.searchsorted(keys, x)] for x in each])

    return grouped.groupBy("group").cogroup(over.groupBy("below")).applyInArrow(run, _ANSWER)


def _counted(words: DataFrame) -> tuple[DataFrame, int, int]:
    """(the rows of the words' groups with the words' numbers in all training texts, tokens, distinct words)."""

    def run(table):
        keys, n, each = _merged(table)
        return _answer(table, [n[np.searchsorted(keys, x)] for x in each], np.float64)

    def totals(table):
        _, n, _ = _merged(table)
        return pa.table({"n": pa.array([int(n.sum())]), "kinds": pa.array([int((n > 0).sum())])})

    total, kinds = words.groupBy("group").applyInArrow(totals, "n bigint, kinds bigint").agg(F.sum("n"), F.sum("kinds")).first()
    return words.groupBy("group").applyInArrow(run, _ANSWER), total or 0, kinds or 0


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out=None) -> DataFrame:
    """(doc_id, held_out, n_bytes, n_tokens, n_known, train_tokens, base_score, score) of every text, scores as log10 probabilities.

    `held_out` is a boolean column of rows not to learn from; by default those with crc32(doc_id as text) mod 7 = 2. Null texts count as
    empty: the end sign alone is scored. A null id is never held out. Repeated rows are learnt from and scored each. With no
    training rows every decision has probability one half and the base counts are zero. An empty table gives an empty result.
    """
    held = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2 if held_out is None else held_out
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held, F.lit(False)).alias("held_out"))
    size, many = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = size or 0
    each = max(1, int(many * BLOCK_BYTES / max(size, 1)))  # rows of a block
    at = F.monotonically_increasing_id()
    place = at.bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftleft(F.shiftright(at, 33), 32) + F.floor(place / each).cast("bigint")
    rows = settled(rows.withColumn("block", block), "blocks", "zstd")
    groups = max(LEAST_GROUPS, math.ceil(size / GROUP_BYTES))
    bounds = _bounds(rows, groups)
    asked = settled(_asked(rows, bounds, groups), "asked")
    pairs = asked.filter(F.col("group") >= 0)
    counts, total, kinds = _counted(asked.filter(F.col("group") < 0))
    told = _costed(pairs, _uppers(pairs), bounds).unionByName(counts)

    def run(texts, answers):
        if not texts.num_rows:
            return texts.select(["doc_id", "held_out"]).append_column("n_bytes", pa.array([], pa.int64())).append_column("n_tokens", pa.array([], pa.int64())).append_column("n_known", pa.array([], pa.int64())).append_column("base_score", pa.array([], pa.float64())).append_column("score", pa.array([], pa.float64()))
        found = sorted(zip(*(answers.column(c).to_pylist() for c in ("group", "keys", "value"))))
        known = []
        for kind, some in ((np.float32, [x for x in found if x[0] >= 0]), (np.float64, [x for x in found if x[0] < 0])):
            key = np.concatenate([unpacked_sorted(x[1]) for x in some] or [np.zeros(1, np.int64)])
            value = np.concatenate([np.frombuffer(x[2], kind) for x in some] or [np.zeros(1, kind)]).astype(np.float64)
            order = np.argsort(key, kind="stable")
            known.append((key[order], value[order]))
        (gram_keys, gram_costs), (word_keys, word_counts) = known
        unit = -math.log10(total + kinds + 1)
        end = float(word_counts[word_keys == _END_WORD].max(initial=0.0))
        out = {c: [] for c in ("n_bytes", "n_tokens", "n_known", "base_score", "score")}
        for a, b in _chunked(texts, "text"):
            words, counts, keys, sizes = _sequences(texts.slice(a, b - a).column("text").to_pylist(), DEPTH)
            owner, of_byte = np.repeat(np.arange(b - a), counts), np.repeat(np.arange(b - a), sizes)
            at = np.minimum(np.searchsorted(word_keys, words), len(word_keys) - 1)
            c = np.where(word_keys[at] == words, word_counts[at], 0.0)
            out["n_bytes"].append(sizes)
            out["n_tokens"].append(counts + 1)
            out["n_known"].append(np.bincount(owner, weights=c > 0, minlength=b - a).astype(np.int64) + int(end > 0))
            out["base_score"].append(np.bincount(owner, weights=np.log10(c + 1), minlength=b - a) + math.log10(end + 1) + (counts + 1) * unit)
            order = np.argsort(keys)  # neighbouring keys are looked up in neighbouring places
            cost = np.empty(len(keys))
            cost[order] = gram_costs[np.searchsorted(gram_keys, keys[order])]
            out["score"].append(np.bincount(of_byte, weights=cost, minlength=b - a))
        for c, parts in out.items():
            texts = texts.append_column(c, pa.array(np.concatenate(parts)))
        return texts.select(["doc_id", "held_out", *out])

    schema = rows.select("doc_id", "held_out", *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_tokens", "n_known")], *[F.lit(0.0).alias(c) for c in ("base_score", "score")]).schema
    done = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)
    return done.withColumn("train_tokens", F.lit(total).cast("long"))


@query("op9_context_tree")
def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"))
