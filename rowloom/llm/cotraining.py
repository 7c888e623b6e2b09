"""Quality and toxicity classifiers by co-training over two views.

The text view has the words present in a text (hashed) and measures of the text as a whole; the metadata view has the language, the
source and the length a document is listed with. Two logistic regressions learn from labelled documents; in each round either one
marks all unlabelled documents it is sure about, and these join the other one's training set. Both are then calibrated on labelled
documents held back, and combined there; the combined score is computed for all documents in one pass.

The features of every row are extracted once, packed and written; the fit and the scoring read these few bytes, texts are never moved.
The labelled side is a bounded sample: `LABELLED` documents of least id hash. The unlabelled side is every row without a label: each
round marks it anew on the cluster, and each step of a fit adds up gradients over it there. Slots that fewer than `LEAST_ROWS` rows
in use hold keep weight 0, as one or two rows would only be learnt by heart. The marks of a class weigh together at most as much as the labelled rows' share of that class, so both
classes keep their proportion and no sure row is left out. The weights (65,536 and 4,096 numbers a target) are shipped with the tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import query
from rowloom.llm.common import mix, settled, span_hash, text_chunks, word_spans

LABELLED = 6_000
ROUNDS = 3
SURE = 0.9
LIFT = 4.0  # times the prior odds of a class that a pseudo-label takes
FIRST_STEPS = 80  # on labelled rows alone
STEPS = 12  # a round, from the weights of the round before
LEAST_ROWS = 5
GATHERED = 32  # vectors that reach the driver at once; more tasks' sums meet on the cluster first
WORD_SLOTS = 1 << 16
META_SLOTS = 1 << 12
_BINS = 12
_MEASURES = 8
TEXT_SLOTS = WORD_SLOTS + _MEASURES * _BINS


_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))  # words are of letters and digits


def _binned(x):
    return np.clip((np.asarray(x) * _BINS).astype(np.int64), 0, _BINS - 1)


def text_features(texts):
    """(slots, owner): distinct slots of each text in order; a text without words has only its measures."""
    n = len(texts)
    raw = [(t or "").encode() for t in texts]
    parts = [r.lower().translate(_PLAIN).split() for r in raw]
    prefix, starts, ends, counts = word_spans(parts)
    words = span_hash(prefix, starts, ends)
    owner = np.repeat(np.arange(n), counts)
    pairs = np.unique(owner.astype(np.uint64) << np.uint64(32) | (words & np.uint64(0xFFFFFFFF)))
    distinct = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=n)
    slots = np.unique((pairs >> np.uint64(32)) << np.uint64(32) | (mix(pairs & np.uint64(0xFFFFFFFF)) & np.uint64(WORD_SLOTS - 1)))
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(r) for r in raw])
    of = np.repeat(np.arange(n), sizes)
    some = np.maximum(sizes, 1)

    def share(mask):
        return np.bincount(of[mask], minlength=n) / some

    many = np.maximum(counts, 1)
    measures = [
        distinct / many,
        share((data >= 65) & (data <= 90)),
        share((data >= 48) & (data <= 57)) * 4,
        share(data == ord("!")) * 4,
        share((data == ord("|")) | (data == ord("#")) | (data == ord("$")) | (data == ord("%")) | (data == ord("*"))) * 4,
        share(data == 10) * 20,
        np.log2(some) / 20,
        (sizes / many) / 24,
    ]
    bins = np.stack([WORD_SLOTS + k * _BINS + _binned(m) for k, m in enumerate(measures)], axis=1)
    at = np.concatenate([(slots & np.uint64(0xFFFFFFFF)).astype(np.int64), bins.reshape(-1)])
    owner = np.concatenate([(slots >> np.uint64(32)).astype(np.int64), np.repeat(np.arange(n), _MEASURES)])
    order = np.argsort(owner, kind="stable")
    return at[order], owner[order]


def _slot(text: str) -> int:
    h = 1469598103934665603
    for b in text.encode():
        h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return (h ^ h >> 29) % META_SLOTS


def meta_features(langs, sources, lengths):
    """Four slots a document: language, source, both together, and the length's power of two."""
    rows = [(_slot(f"l={a}"), _slot(f"s={b}"), _slot(f"l={a} s={b}"), _slot(f"n={int(c or 0).bit_length()}")) for a, b, c in zip(langs, sources, lengths)]
    return np.array(rows, np.int64).reshape(-1), np.repeat(np.arange(len(rows)), 4)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class _View:
    """Sparse rows of ones; `logits` sums the weights of a row's slots."""

    def __init__(self, rows, size):
        self.size = size
        self.at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n = len(rows)

    def logits(self, w, bias):
        return np.bincount(self.of, weights=w[self.at], minlength=self.n) + bias

    def gradient(self, model, y, use):
        error = use * (y - _sigmoid(self.logits(model.w, model.bias)))
        return np.bincount(self.at, weights=error[self.of], minlength=self.size), error.sum()


class _Model:
    """Logistic regression with an L1 penalty, learnt by steps scaled by the gradients' history."""

    def __init__(self, size):
        self.w, self.bias, self.gw, self.gb = np.zeros(size), 0.0, np.full(size, 1e-8), 1e-8

    def step(self, g, b, penalty=1e-3):
        self.gw += g * g
        self.gb += b * b
        self.w += 0.3 * g / np.sqrt(self.gw)
        self.w = np.sign(self.w) * np.maximum(np.abs(self.w) - 0.3 * penalty / np.sqrt(self.gw), 0.0)
        self.bias += 0.3 * b / np.sqrt(self.gb)


def _platt(z, y):
    """Weights of a small logistic regression on the columns of z, by Newton steps."""
    x = np.column_stack([np.ones(len(y)), z])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.1] * (x.shape[1] - 1))
    for _ in range(30):
        p = _sigmoid(x @ w)
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge
        w += np.linalg.solve(h, x.T @ (y - p) - ridge @ w)
    return w


SIZES = (TEXT_SLOTS, META_SLOTS)


PACKED = ("words", "bins", "meta")


def _unpacked(batch):
    """The (slots, owner) of both views of a batch of packed rows."""
    n = batch.num_rows
    words, bins, meta = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in PACKED)
    counts = np.array([len(w) // 2 for w in words], np.int64)
    at = np.frombuffer(b"".join(words), np.uint16).astype(np.int64)
    bins = np.frombuffer(b"".join(bins), np.uint8).astype(np.int64) + WORD_SLOTS
    meta = np.frombuffer(b"".join(meta), np.uint16).astype(np.int64)
    rows = np.arange(n)
    return (np.concatenate([at, bins]), np.concatenate([np.repeat(rows, counts), np.repeat(rows, _MEASURES)])), (meta, np.repeat(rows, 4))


def packed_features(docs: DataFrame) -> DataFrame:
    """(doc_id, words, bins, meta): the slots of every row in a few hundred bytes."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))

    def run(batches):
        for whole in batches:
            for batch, texts in text_chunks(whole, "text"):
                at, of = text_features(texts)
                cut = np.searchsorted(of, np.arange(len(texts) + 1))
                words = at.astype(np.uint16)
                meta, _ = meta_features(*(batch.column(k).to_pylist() for k in (2, 3, 4)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([words[a : b - _MEASURES].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                        pa.array([(at[b - _MEASURES : b] - WORD_SLOTS).astype(np.uint8).tobytes() for b in cut[1:]], pa.binary()),
                        pa.array([m.astype(np.uint16).tobytes() for m in meta.reshape(-1, 4)], pa.binary()),
                    ],
                    names=["doc_id", *PACKED],
                )

    return rows.mapInArrow(run, rows.select("doc_id", *[F.lit(b"").alias(c) for c in PACKED]).schema)


def _pool(packed: DataFrame, labels: DataFrame) -> DataFrame:
    """Packed features of every row without a label, those without an id among them."""
    known = labels.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct().hint("merge")  # one plan at every size
    rest = packed.filter(F.col("doc_id").isNotNull()).join(known, "doc_id", "left_anti")
    return rest.select(*PACKED).unionByName(packed.filter(F.col("doc_id").isNull()).select(*PACKED))


def _summed(pool: DataFrame, jobs: list) -> list:
    """For each job (view, its model or None, teacher's model, least probability for 1 and for 0, weight of 1 and of 0): the sums over
    the rows the teacher is sure about, as (slots, two numbers). Without a model: rows by slot, rows of class 1 and 0; with one: its
    gradient by slot, that of the bias and 0."""
    shipped = pool.sparkSession.sparkContext.broadcast(jobs)

    def run(batches):
        out = [np.zeros(SIZES[view] + 2) for view, *_ in shipped.value]
        for batch in batches:
            views, n = _unpacked(batch), batch.num_rows
            for total, (view, model, (tw, tb), (least1, least0), (use1, use0)) in zip(out, shipped.value):
                at, of = views[1 - view]
                p = _sigmoid(np.bincount(of, weights=tw[at], minlength=n) + tb)
                one, zero = p >= least1, 1 - p >= least0
                at, of = views[view]
                if model is None:
                    total[:-2] += np.bincount(at[(one | zero)[of]], minlength=SIZES[view])
                    total[-2:] += one.sum(), zero.sum()
                else:
                    z = np.bincount(of, weights=model[0][at], minlength=n) + model[1]
                    error = (one * use1 + zero * use0) * (one - _sigmoid(z))
                    total[:-2] += np.bincount(at, weights=error[of], minlength=SIZES[view])
                    total[-2] += error.sum()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(out).tobytes()], pa.binary())], names=["sums"])

    def add(batches):
        total = sum(np.frombuffer(raw, np.float64) for batch in batches for raw in batch.column(0).to_pylist())
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    tasks = max(8, 2 * pool.sparkSession.sparkContext.defaultParallelism)
    parts = pool.coalesce(tasks).mapInArrow(run, "sums binary")
    while tasks > GATHERED:
        tasks = max(8, tasks // 16)
        parts = parts.repartition(tasks).mapInArrow(add, "sums binary")
    whole = sum(np.frombuffer(row[0], np.float64) for row in parts.collect())
    cuts = np.cumsum([SIZES[view] + 2 for view, *_ in jobs])[:-1]
    shipped.unpersist()
    if np.isscalar(whole):
        return [(np.zeros(SIZES[view]), np.zeros(2)) for view, *_ in jobs]
    return [(x[:-2], x[-2:]) for x in np.split(whole, cuts)]


def co_train(views, targets: dict, back, pool: DataFrame, rounds: int = ROUNDS) -> tuple[dict, list]:
    """({target: ((weights, bias) of both views, calibration lines, combination)}, marked rows by round) for 0/1 labels by target
    (-1: none); back: held-back rows."""
    use = {t: ((y >= 0) & ~back).astype(float) for t, y in targets.items()}
    prior = {t: float(y[use[t] > 0].mean()) if use[t].any() else 0.5 for t, y in targets.items()}
    own = {t: [np.bincount(v.at[u[v.of] > 0], minlength=v.size) for v in views] for t, u in use.items()}
    models = {t: [_Model(v.size) for v in views] for t in targets}
    for t, y in targets.items():
        for v, model, slots in zip(views, models[t], own[t]):
            for _ in range(FIRST_STEPS):
                g, b = v.gradient(model, np.where(y >= 0, y, 0.0), use[t])
                total = max(use[t].sum(), 1.0)
                model.step(g * (slots >= LEAST_ROWS) / total, b / total)
    history = []
    for _ in range(rounds):
        jobs, keys = [], [(t, k) for t in targets for k in (0, 1)]
        for t, k in keys:
            teacher = models[t][1 - k]
            odds = [LIFT * s / max(1 - s, 1e-9) for s in (prior[t], 1 - prior[t])]  # a common class alone makes no view sure
            jobs.append((k, None, (teacher.w.copy(), teacher.bias), tuple(max(SURE, o / (1 + o)) for o in odds), (0.0, 0.0)))
        marked = _summed(pool, jobs)
        history.append(int(sum(n.sum() for _, n in marked)))
        if not history[-1]:
            break
        weights, often, totals = [], [], []
        for (t, k), (slots, n) in zip(keys, marked):
            base = max(use[t].sum(), 1.0)
            weights.append(tuple(min(1.0, s * base / max(c, 1.0)) for s, c in zip((prior[t], 1 - prior[t]), n)))
            often.append(own[t][k] + slots >= LEAST_ROWS)
            totals.append(base + float(np.dot(weights[-1], n)))
        for _ in range(STEPS):
            now = [(k, (models[t][k].w, models[t][k].bias), teacher, least, w) for (t, k), (_, _, teacher, least, _), w in zip(keys, jobs, weights)]
            for (t, k), (g, (b, _)), some, total in zip(keys, _summed(pool, now), often, totals):
                y = targets[t]
                g0, b0 = views[k].gradient(models[t][k], np.where(y >= 0, y, 0.0), use[t])
                models[t][k].step((g + g0) * some / total, (b + b0) / total)
    out = {}
    for t, y in targets.items():
        held = back & (y >= 0)
        if len(set(y[held])) < 2:
            held = y >= 0
        z = [v.logits(m.w, m.bias) for v, m in zip(views, models[t])]
        lines = [_platt(x[held][:, None], y[held]) for x in z]
        calibrated = np.column_stack([line[0] + line[1] * x for line, x in zip(lines, z)])
        out[t] = [(m.w, m.bias) for m in models[t]], lines, _platt(calibrated[held], y[held])
    return out, history


def _labelled(packed: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """Features and labels of the sample, one row a doc_id however often it is repeated; of different labels of one id the larger holds."""
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(F.col(t).cast("double")).alias(t) for t in ("quality", "toxic")])
    marks = marks.join(packed.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    one = F.min(F.struct(*PACKED, "quality", "toxic")).alias("one")
    return packed.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(one).select("doc_id", "one.*")  # `labelled` ids


def fit(packed: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> dict:
    """Models for quality and toxic from packed rows: a bounded sample of labelled ones and all others; a target whose labels are all
    alike or missing gets none."""
    table = _labelled(packed, labels, labelled).toPandas().sort_values("doc_id")
    targets = {t: table[t].astype(float).fillna(-1).to_numpy() for t in ("quality", "toxic")}
    targets = {t: y for t, y in targets.items() if {0.0, 1.0} <= set(y)}
    if not targets:
        return {}
    slots = [np.concatenate([np.frombuffer(w, np.uint16).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64) + WORD_SLOTS]) for w, b in zip(table["words"], table["bins"])]
    text = _View(slots, TEXT_SLOTS)
    meta = _View([np.frombuffer(b, np.uint16).astype(np.int64) for b in table["meta"]], META_SLOTS)
    back = mix(table["doc_id"].to_numpy(np.int64).view(np.uint64)) % np.uint64(4) == 0
    return co_train((text, meta), targets, back, settled(_pool(packed, labels), "unlabelled", "zstd"))[0]


def classify(docs: DataFrame, labels: DataFrame, models: dict | None = None) -> DataFrame:
    """(doc_id, quality_score, quality, toxic_score, toxic, keep) of every document; scores are probabilities.

    keep: of good quality and not toxic. Missing metadata is a value of its own; null and empty texts are judged by their measures and
    metadata. Without usable labels for a target its score and verdict are null and do not count against a document. Repeated rows
    are judged alike, equal texts with equal metadata too; an id with different labels counts as positive. Long texts are read whole, other
    columns are not read. An empty table gives an empty result.
    """
    packed = packed_features(docs)
    if models is None:
        packed = settled(packed, "features", "zstd")
        models = fit(packed, labels)
    shipped = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            n, views, columns = batch.num_rows, _unpacked(batch), [batch.column(0)]
            for t in ("quality", "toxic"):
                if t in shipped.value:
                    weights, lines, both = shipped.value[t]
                    z = both[0]
                    for (at, of), (w, bias), line, share in zip(views, weights, lines, both[1:]):
                        z = z + share * (line[0] + line[1] * (np.bincount(of, weights=w[at], minlength=n) + bias))
                    columns.append(pa.array(np.round(_sigmoid(z), 9)))
                else:
                    columns.append(pa.nulls(n, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality_score", "toxic_score"])

    schema = packed.select("doc_id", *[F.lit(None).cast("double").alias(c) for c in ("quality_score", "toxic_score")]).schema
    done = packed.mapInArrow(run, schema)
    quality, toxic = F.col("quality_score") >= 0.5, F.col("toxic_score") >= 0.5
    keep = F.coalesce(quality, F.lit(True)) & ~F.coalesce(toxic, F.lit(False))
    return done.select("doc_id", "quality_score", quality.alias("quality"), "toxic_score", toxic.alias("toxic"), keep.alias("keep"))


@query("op7_co_training")
def op7_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
