import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import prefix_trie, ranked_search, toxicity

TURNS = "conv_id bigint, turn bigint, role string, text string"
DOC = "doc_id bigint, text string"


def brute_trie(rows, rebuild):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
        own = {c: own.get(c - c % 100, [])[: h[c]] + t[h[c] :] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in sorted(own.items()):
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    leaves = [k for k in members if not any(len(o) == len(k) + 1 and o[: len(k)] == k for o in members)]
    out = []
    for k, m in members.items():
        below = [o for o in members if o[: len(k)] == k]
        out.append((
            min(m), len(k), min(members[k[:-1]]) if k else None, len(m), sum(len(o) == len(k) + 1 for o in below), sum(o in leaves for o in below),
            sum((len(members[o]) - 1) * len(o[-1][1]) for o in below if o), hashlib.sha256(",".join(map(str, ends.get(k, []))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_equals_brute_force(spark, rebuild):
    r = random.Random(5)
    rows = []
    for c in [*range(0, 40), 100, 103, 207, 1201]:
        rows += [(c, t if r.random() < 0.9 else None, r.choice(["user", None]), r.choice(["a", "bb", "É😀", "", None])) for t in range(r.randint(1, 6))]
    rows += [(c, 0, "user", "hello") for c in range(500, 540)]  # many ends at one node
    rows += [(300, t, "user", f"t{t}") for t in range(60)]  # one long conversation
    rows += rows[:3] + [(None, 1, "user", "nobody's")]
    df = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("mine")).repartition(3)
    got = sorted((tuple(x) for x in prefix_trie.conversation_trie(df, rebuild, local=20).collect()), key=str)
    assert got == brute_trie(rows, rebuild)


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_list_places_and_running_sums_cross_blocks(spark):
    n = 9_000
    order = np.random.default_rng(1).permutation(n).tolist()
    rows = [(x, order[i - 1] if i else None, order[i + 1] if i + 1 < n else None) for i, x in enumerate(order)]
    got = {r.item: r.place for r in prefix_trie.list_places(spark.createDataFrame(rows, "item bigint, prv bigint, nxt bigint"), local=500).collect()}
    assert got == {x: i for i, x in enumerate(order)}
    sums = prefix_trie.running_sums(spark.range(n).select(F.col("id").alias("at"), (F.col("id") % 7).alias("v")), "at", ["v"])
    want = np.cumsum(np.arange(n) % 7)
    assert all(r.v_sum == want[r.at] for r in sums.collect())


def test_end_hashes_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    df = spark.range(1_000).select((F.col("id") % 3).alias("k1"), F.lit(0).cast("bigint").alias("k2"), (F.col("id") * 37 % 1_000).alias("conv_id"))
    for r in prefix_trie._end_hashes(df).collect():
        ids = sorted(i * 37 % 1_000 for i in range(1_000) if i % 3 == r.k1)
        assert r.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def brute_rank(docs, items):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        q = Counter(terms(text))
        w = {t: k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t, k in q.items()}
        scored = []
        for d, c in held:
            m = 25 + (75 * sum(c.values()) * n) // total
            scored.append((-sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in q), d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(x for x in scored if x[0] < 0)[:10])]
    return sorted(out, key=str)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "PASS_TERMS", 10)  # several passes
    r = random.Random(7)
    words = [f"w{i}" for i in range(80)] + ["Straße", "中文", "x9"]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 60)))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, " -- "), (403, "w1 " * 4_000), (None, docs[5][1]), *docs[:3], (404, docs[7][1].upper())]
    items = [(i, " ".join(r.choice(words) for _ in range(12))) for i in range(12)] + [(50, None), (51, "unseen"), (52, "w1 w1 w1"), (None, "w2 w3"), (52, "w1 w1 w1")]
    df = spark.createDataFrame(docs, DOC).withColumn("score", F.lit("mine")).repartition(4)
    got = ranked_search.rank(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_rank(docs, items)
    assert ranked_search.rank(df.limit(0), spark.createDataFrame(items, "item_id bigint, text string")).collect() == []
    assert ranked_search.rank(df, spark.createDataFrame([], "item_id bigint, text string")).collect() == []


def test_index_files_hold_few_blocks(spark, monkeypatch):
    """Blocks are megabytes each: a task must not gather all of its own in one file."""
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", 5)
    seen, settled = [], ranked_search.settled
    monkeypatch.setattr(ranked_search, "settled", lambda df, name, **options: seen.append((name, settled(df, name, **options))) or seen[-1][1])
    docs = spark.createDataFrame([(i, f"a{i} b{i % 9} c") for i in range(200)], DOC).coalesce(1)
    got = ranked_search.rank(docs, spark.createDataFrame([(1, "a7 b3")], "item_id bigint, text string")).collect()
    index = dict(seen)["signatures"]
    assert index.count() == 40
    assert max(r["count"] for r in index.groupBy(F.input_file_name()).count().collect()) <= ranked_search.FILE_BLOCKS
    assert sorted(map(tuple, got), key=str) == brute_rank([(i, f"a{i} b{i % 9} c") for i in range(200)], [(1, "a7 b3")])


def test_search_bounds_hold_and_exclude():
    r = random.Random(2)
    words = [f"v{i}" for i in range(3_000)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(30, 60))) for _ in range(600)]
    hashes, tf, owner, counts = ranked_search.term_counts(texts)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    held = [(i, int(counts[i]), hashes[a:b], tf[a:b]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    import pyarrow as pa

    row = ranked_search._block(1_024, held)
    block = ranked_search._Block(pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=ranked_search._NAMES), 0)
    terms, weights = np.sort(hashes[:40]), np.full(40, 5_000, np.int64)
    m = 25 + (75 * block.lengths * 600) // int(counts.sum())
    exact = block.scores(np.arange(600), terms, weights, m)
    assert (block.bounds(terms, weights, m) >= exact).all()
    best = [[]]
    assert ranked_search.search_block(block, [(terms, weights)], best, 600, int(counts.sum()), 10) < 300
    assert [-s for s, _, _ in best[0]] == sorted(exact, reverse=True)[:10]


CLEAN = "the river runs over stones near our house while children sing about summer and winter".split()
BAD = "idiot moron stupid worthless".split()


def model_of(texts):
    counts = np.zeros(toxicity.SYMBOLS**3)
    s = toxicity.symbols(toxicity._codes("  ".join(texts)))
    np.add.at(counts, (s[:-2] * 64 + s[1:-1]) * 64 + s[2:], 1)
    return toxicity.CharacterModel(counts)


def test_viterbi_equals_all_paths():
    model = model_of([" ".join(CLEAN + BAD)] * 50)

    def paths(spot, at=0):
        if at == len(spot):
            yield "", 0.0
        for i, j, spelt, p in toxicity.lattice(spot):
            if i == at:
                yield from ((spelt + rest, p + q) for rest, q in paths(spot, j))

    def total(spelt, p):
        s = [0, 0, *toxicity.symbols(toxicity._codes(spelt)).tolist(), 0]
        return p + sum(model.log[(a * 64 + b) * 64 + c] for a, b, c in zip(s, s[1:], s[2:]))

    for spot in ["1d10t", "m0r*n", "stuuupid", "i d i o t", "w0$s!", "a1b2"]:
        best = max(total(s, p) for s, p in paths(spot))
        found = toxicity.decode(spot, model)
        assert any(s == found and abs(total(s, p) - best) < 1e-9 for s, p in paths(spot))


def test_disguised_words_are_restored():
    model = model_of([" ".join(CLEAN + BAD)] * 50)
    restored = toxicity.restore(["You 1d10t! A s t u p i d river, m.o.r.o.n; w0rthle$$ and stuuuupid at 12:30 in 2024", "Sing### about&&& it***", None, ""], lambda s: toxicity.decode(s, model))
    assert restored[0] == "you idiot! a stupid river, moron; worthless and stupid at 12:30 in 2024"
    assert restored[1].split() == ["sing", "about", "it"]
    assert restored[2:] == ["", ""]
    long = "1d10t." * 20_000 + " x" * 50_000 + "9" * 50_000
    assert "idiot" in toxicity.restore([long], lambda s: toxicity.decode(s, model))[0]


def test_toxicity_on_held_out_and_odd_tables(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = r.random() < 0.3
        w = [r.choice(CLEAN) for _ in range(30)]
        if toxic:
            bad = r.choice(BAD)
            w[r.randrange(30)] = r.choice([bad, bad.replace("i", "1").replace("o", "0"), " ".join(bad)])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(1_000, None), (1_001, ""), (None, rows[0][1]), rows[0]]
    df = spark.createDataFrame(rows, DOC).withColumn("score", F.lit("mine"))
    marks = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id bigint, toxic int")
    got = toxicity.score(df, marks).collect()
    assert len(got) == len(rows)
    by, want = {}, dict(labels)
    for x in got:
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and x.predicted == int(x.score >= 0.5) and 0 <= x.score <= 1
        by.setdefault(x.doc_id, set()).add(x.score)
    assert by[None] == by[0] and len(by[0]) == 1 and by[1_000] == by[1_001]
    held = [(min(by[d]) >= 0.5) == bool(t) for d, t in want.items() if zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean(held) > 0.95
    assert toxicity.score(df.limit(0), marks).collect() == []
    assert {x.score for x in toxicity.score(df, marks.limit(0)).collect()} == {0.0}
