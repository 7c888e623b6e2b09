"""Conversation prefix trie by the Euler-tour technique.

A node is a distinct sequence of first turns; its key adds up 124-bit hashes of (turn, position), so keys of all prefixes are running
sums. Nodes are numbered in the order (parent's key, key), so siblings have consecutive numbers and the arcs of the tour follow from one
row per family: entering a node leads to its first child or to its exit, leaving it to the next sibling or to the parent's exit.
The tour is ranked by splicing out local minima of a random priority, round by round, until few arcs are left; these are ranked in one
task, and the spliced ones then get their places back in reverse order. Leaves and savings of a subtree are differences of running
sums at the places of a node's two arcs.

No step holds a conversation, a family or the conversations that end at a node in one task: running sums go by blocks, and lists of
ends are cut into chunks of `CHUNK` ids, which alone pass through the hash of their node.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.functions.ranking import order_index
from rowloom.llm import query
from rowloom.llm.common import settled

#: Arcs that one task ranks by itself.
LOCAL_ARCS = 100_000
#: Conversation ids joined into one text before they are hashed.
CHUNK = 1_024
_BLOCK = 12  # bits of a place inside a block of running sums
_NONE = hashlib.sha256(b"").hexdigest()


def running_sums(rows: DataFrame, place: str, values: list, by: str | None = None) -> DataFrame:
    """Adds `<value>_sum`, the sum up to and with each row in the order of the whole numbers in `place`, inside each `by`.

    Places are cut into blocks, the blocks of a group into larger ones; no window is longer than 4,096 rows, or than the number of the
    larger blocks.
    """
    keys = [by] if by else []
    rows = rows.withColumn("_block", F.shiftright(place, _BLOCK))
    inside = Window.partitionBy(*keys, "_block").orderBy(place)
    rows = rows.select("*", *[F.sum(v).over(inside).alias(f"{v}_sum") for v in values])
    totals = rows.groupBy(*keys, "_block").agg(*[F.max(F.struct(place, f"{v}_sum"))[f"{v}_sum"].alias(v) for v in values])
    totals = totals.withColumn("_upper", F.shiftright("_block", _BLOCK))
    among = Window.partitionBy(*keys, "_upper").orderBy("_block")
    totals = totals.select("*", *[(F.sum(v).over(among) - F.col(v)).alias(f"{v}_off") for v in values])
    uppers = totals.groupBy(*keys, "_upper").agg(*[F.sum(v).alias(v) for v in values])
    above = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_upper")  # one row for 16,777,216 places
    uppers = uppers.select(*keys, "_upper", *[(F.sum(v).over(above) - F.col(v)).alias(f"{v}_up") for v in values])
    offsets = totals.join(uppers, [*keys, "_upper"]).select(*keys, "_block", *[(F.col(f"{v}_off") + F.col(f"{v}_up")).alias(f"{v}_off") for v in values])
    sums = [(F.col(f"{v}_sum") + F.col(f"{v}_off")).alias(f"{v}_sum") for v in values]
    kept = [c for c in rows.columns if c != "_block" and c not in {f"{v}_sum" for v in values}]
    return rows.join(offsets, [*keys, "_block"]).select(*kept, *sums)


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, a, b, size) of every turn, (conv_id, n_turns)); a and b are hashes of role and text, size the text's length."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        F.length(text).cast("bigint").alias("size"),
    )
    rows, _ = order_index(rows, "conv_id", F.col("turn").asc_nulls_first(), "a", "b", name="idx")
    rows = rows.withColumn("_part", F.shiftright("idx", _BLOCK))
    parts = settled(rows.groupBy("conv_id", "_part").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n")), "turn-parts")
    whole = parts.groupBy("conv_id").agg(F.min("first").alias("first"), F.sum("n").alias("n_turns"))
    parts = parts.select("conv_id", "_part").join(whole.select("conv_id", "first"), "conv_id")
    turns = rows.join(parts, ["conv_id", "_part"]).select("conv_id", (F.col("idx") - F.col("first")).alias("pos"), "a", "b", "size")
    return turns, whole.select("conv_id", "n_turns")


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Turns after every conversation c has taken over the first h = crc32(c) % 6 turns of conversation c - c % 100."""
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    heads = turns.filter((F.col("pos") < 5) & (F.col("conv_id") % 100 == 0)).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "size"))).alias("heads"))  # five at most
    convs = settled(convs.join(heads, "base", "left").withColumn("heads", F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), 1, F.col("h").cast("int"))), "rebuilt")
    taken = convs.select("conv_id", F.inline("heads"))
    parts = turns.withColumn("_part", F.shiftright("pos", _BLOCK))
    shift = convs.select("conv_id", "h", F.size("heads").alias("k"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("n_turns"), _BLOCK))).alias("_part"))
    own = parts.join(shift, ["conv_id", "_part"]).filter(F.col("pos") >= F.col("h"))
    return taken.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "a", "b", "size"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, size): the node of every conversation at every depth, and its parent's key."""
    whole = [F.xxhash64("a", "b", "pos"), F.xxhash64("b", "a", F.lit(1), "pos")]
    low = F.lit((1 << 31) - 1)
    pieces = [x for h in whole for x in (F.shiftrightunsigned(h, 33), h.bitwiseAND(low))]  # 31 bits each: sums can't overflow
    rows = turns.select("conv_id", "pos", "size", *[x.alias(f"h{i}") for i, x in enumerate(pieces)])
    names = [f"h{i}" for i in range(4)]
    rows = running_sums(rows, "pos", names, by="conv_id")
    here = [F.col(f"{v}_sum") for v in names]
    before = [F.col(f"{v}_sum") - F.col(v) for v in names]

    def key(sums, depth):
        return [F.when(depth == 0, F.lit(0)).otherwise(F.xxhash64(*x, depth)).cast("bigint") for x in (sums, sums[::-1])]

    own, parent = key(here, F.col("pos") + 1), key(before, F.col("pos"))
    return rows.select("conv_id", (F.col("pos") + 1).alias("depth"), own[0].alias("k1"), own[1].alias("k2"), parent[0].alias("p1"), parent[1].alias("p2"), "size")


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) from (k1, k2, conv_id)."""
    ends = ends.repartitionByRange("k1", "k2", "conv_id").sortWithinPartitions("k1", "k2", "conv_id").withColumn("_chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK.bit_length() - 1))
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = ends.groupBy("k1", "k2", "_chunk").agg(F.min("conv_id").alias("first"), F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"))
    chunks = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")

    def run(batches):
        last, state = None, None
        for batch in batches:
            out = []
            for k1, k2, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (k1, k2) == last:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((*last, state.hexdigest()))
                last, state = (k1, k2), hashlib.sha256(ids.encode())
            yield _rows(out)
        if state is not None:
            yield _rows([(*last, state.hexdigest())])

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["k1", "k2", "ends_sha256"])

    return chunks.mapInArrow(run, "k1 bigint, k2 bigint, ends_sha256 string")


def list_places(links: DataFrame, local: int = LOCAL_ARCS) -> DataFrame:
    """(item, place) of a doubly linked list (item, prv, nxt) whose ends have nulls; the first item gets place 0.

    Each round splices out the items whose hashed priority is below both neighbours', a third of all; total work is in proportion to
    the list. At most `local` items are ranked in one task.
    """
    current = settled(links.withColumn("w", F.lit(1).cast("bigint")), "tour-0")
    rounds, left = [], current.count()
    while left > local:
        salt = F.lit(len(rounds))
        own, before, after = (F.xxhash64(salt, c) for c in ("item", "prv", "nxt"))
        low = F.col("prv").isNotNull() & F.col("nxt").isNotNull() & (own < before) & (own < after)
        out = current.filter(low)
        behind = out.select(F.col("item").alias("nxt"), F.col("nxt").alias("n_nxt"), F.col("w").alias("n_w"))
        ahead = out.select(F.col("item").alias("prv"), F.col("prv").alias("p_prv"))
        step = current.filter(~low).join(behind, "nxt", "left").join(ahead, "prv", "left")
        spliced = F.col("n_nxt").isNotNull()
        step = settled(
            step.select(
                "item",
                F.coalesce("p_prv", "prv").alias("prv"),
                F.coalesce("n_nxt", "nxt").alias("nxt"),
                (F.col("w") + F.coalesce("n_w", F.lit(0))).alias("w"),
                F.when(spliced, F.col("nxt")).alias("gone"),
                F.when(spliced, F.col("w")).alias("ahead"),
            ),
            f"tour-{len(rounds) + 1}",
        )
        rounds.append(step)
        current = step.select("item", "prv", "nxt", "w")
        left = current.count()

    def rank(batches):
        parts = list(batches)
        item, nxt, w = (np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
        order = np.argsort(item)
        item, nxt, w = item[order], nxt[order], w[order]
        at = np.searchsorted(item, nxt)
        first = np.ones(len(item), bool)
        first[at[nxt >= 0]] = False
        place, here, total = np.zeros(len(item), np.int64), int(np.flatnonzero(first)[0]) if len(item) else -1, 0
        while here >= 0:
            place[here], total = total, total + int(w[here])
            here = int(at[here]) if nxt[here] >= 0 else -1
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(place)], names=["item", "place"])

    places = settled(current.select("item", F.coalesce("nxt", F.lit(-1)).alias("nxt"), "w").coalesce(1).mapInArrow(rank, "item bigint, place bigint"), "places")
    for i, step in reversed(list(enumerate(rounds))):
        gone = step.filter(F.col("gone").isNotNull()).select("item", "gone", "ahead").join(places, "item")
        places = settled(places.unionByName(gone.select(F.col("gone").alias("item"), (F.col("place") + F.col("ahead")).alias("place"))), f"places-{i}")
    return places


def _tour(nodes: DataFrame, families: DataFrame) -> DataFrame:
    """Arcs of the tour, 2v for entering node v and 2v + 1 for leaving it, with their neighbours."""
    enter, leave = lambda c: F.col(c) * 2, lambda c: F.col(c) * 2 + 1
    begun = families.select(F.col("first").alias("node"), F.col("parent").alias("of_first"))
    ended = families.select(F.col("last").alias("node"), F.col("parent").alias("of_last"))
    over = families.select(F.col("parent").alias("node"), "first", "last")
    rows = nodes.select("node").join(begun, "node", "left").join(ended, "node", "left").join(over, "node", "left")
    root = F.col("node") == 0
    before = F.when(root, F.lit(None)).when(F.col("of_first").isNotNull(), enter("of_first")).otherwise(leave("node") - 2)
    after = F.when(root, F.lit(None)).when(F.col("of_last").isNotNull(), leave("of_last")).otherwise(enter("node") + 2)
    arcs = F.array(
        F.struct(enter("node").alias("item"), before.alias("prv"), F.coalesce(enter("first"), leave("node")).alias("nxt")),
        F.struct(leave("node").alias("item"), F.coalesce(leave("last"), enter("node")).alias("prv"), after.alias("nxt")),
    )
    return rows.select(F.inline(arcs))


def prefix_trie(turns: DataFrame, convs: DataFrame, local: int = LOCAL_ARCS) -> DataFrame:
    """One row for every node of the trie of the conversations in `convs` (conv_id) with `turns` (conv_id, pos, a, b, size).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Conversations
    without turns are members of the root. With no conversations at all there is no node. Two different sequences fall together with
    probability below n^2 / 2^120.
    """
    paths = settled(_prefixes(turns), "paths")
    nodes = paths.groupBy("k1", "k2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("size").alias("size"))
    nodes, _ = order_index(nodes, "p1", "p2", "k1", "k2", name="node")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    root = root.select(zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("depth"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"), zero.alias("size"), F.lit(-1).cast("bigint").alias("node"))
    nodes = settled(nodes.unionByName(root).withColumn("node", F.col("node") + 1), "nodes")
    parts = nodes.filter(F.col("p1").isNotNull()).groupBy("p1", "p2", F.shiftright("node", _BLOCK).alias("_part")).agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    parts = settled(parts.join(above, ["p1", "p2"]), "family-parts")
    families = settled(parts.groupBy("parent").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n_children")), "families")
    places = list_places(_tour(nodes, families), local)

    sizes = nodes.join(families.select(F.col("parent").alias("node"), "n_children"), "node", "left").withColumn("n_children", F.coalesce("n_children", zero))
    values = sizes.select("node", (F.col("n_children") == 0).cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    arcs = places.select(F.shiftright("item", 1).alias("node"), (F.col("item") % 2 == 0).alias("enters"), "place").join(values, "node")
    arcs = arcs.withColumns({c: F.when(F.col("enters"), F.col(c)).otherwise(zero) for c in ("leaf", "saved")})
    sums = running_sums(arcs, "place", ["leaf", "saved"])
    inside = [(F.max(F.when(~F.col("enters"), F.col(f"{c}_sum"))) - F.max(F.when(F.col("enters"), F.col(f"{c}_sum") - F.col(c)))).alias(n) for c, n in (("leaf", "n_leaves"), ("saved", "saved_tokens"))]
    subtrees = sums.groupBy("node").agg(*inside)

    longest = convs.select("conv_id", "n_turns")
    last = paths.join(longest, (paths["conv_id"] == longest["conv_id"]) & (paths["depth"] == longest["n_turns"])).select("k1", "k2", paths["conv_id"])
    turnless = longest.filter("n_turns = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id")
    ends = _end_hashes(last.unionByName(turnless))
    of_parent = parts.select("p1", "p2", "_part", "parent_conv_id")
    out = sizes.withColumn("_part", F.shiftright("node", _BLOCK)).join(of_parent, ["p1", "p2", "_part"], "left").join(subtrees, "node").join(ends, ["k1", "k2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, rebuild: bool = True, local: int = LOCAL_ARCS) -> DataFrame:
    """`prefix_trie` of a table (conv_id, turn, role, text).

    Turns are ordered by turn, null first, ties by their hashes; null roles and texts are empty; rows without a conv_id belong to no
    conversation and are left out; repeated rows are turns of their own. With `rebuild`, every conversation first takes over the
    opening turns of its hundred's first one. An empty table gives no node.
    """
    turns, convs = numbered_turns(conversations)
    if rebuild:
        turns, convs = settled(turns, "turns"), convs
        own = convs
        turns = settled(rebuilt_turns(turns, convs), "rebuilt-turns")
        parts = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n_turns"))
        convs = settled(own.select("conv_id").join(parts, "conv_id", "left").withColumn("n_turns", F.coalesce("n_turns", F.lit(0).cast("bigint"))), "convs")
    return prefix_trie(turns, convs, local)


_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"
)

ORACLE = f"""WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
 h AS (SELECT conv_id, l, {_CRC} % 6 AS h FROM own),
 built AS (SELECT a.conv_id, CASE WHEN b.l IS NULL THEN l2 ELSE list_concat(b.l[1:a.h], l2) END AS l
   FROM (SELECT conv_id, h, l[h + 1:] AS l2 FROM h) a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
 steps AS (SELECT conv_id, len(l) AS n, unnest(range(0, len(l) + 1)) AS d, l FROM built),
 paths AS (SELECT conv_id, n, d, md5(CAST(l[1:d] AS VARCHAR) || '#' || d) AS k, CASE WHEN d > 0 THEN md5(CAST(l[1:d - 1] AS VARCHAR) || '#' || (d - 1)) END AS p,
   CASE WHEN d > 0 THEN length(l[d].t) ELSE 0 END AS size FROM steps),
 nodes AS (SELECT k, min(p) AS p, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
   coalesce(string_agg(CASE WHEN n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends FROM paths GROUP BY k),
 kids AS (SELECT p AS k, count(*) AS n FROM nodes WHERE p IS NOT NULL GROUP BY p),
 full_nodes AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN kids c USING (k)),
 below AS (SELECT DISTINCT a.k AS top, b.k AS k FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.d >= a.d),
 sums AS (SELECT top AS k, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n_convs - 1) * size) AS saved FROM below JOIN full_nodes USING (k) GROUP BY top)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums s USING (k) LEFT JOIN nodes q ON q.k = n.p"""


@query("op12_euler_tour", ORACLE)
def op12_euler_tour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
