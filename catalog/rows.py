"""Null handling, duplicates, trims, fences, filters, ordering and scalar columns."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import CLF, PRED, REG, REG_COLUMNS, VEC, fx_clf, fx_pred, fx_reg, fx_vec, held, table, union_all, with_
from rowloom.functions.ranking import order_index
from rowloom.operators import clean as C
from rowloom.operators.encode import nest_vector, threshold_to_class
from rowloom.operators.profile import sorted_top, value_counts
from rowloom.operators.reduce import pca_fit
from rowloom.operators.split import holdout_split


@query(
    "null_count_profile",
    with_(REG) + "SELECT * FROM (" + union_all(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM fx_reg" for c in REG_COLUMNS) + ") WHERE n_null > 0",
)
def null_count_profile(spark, sf):
    return C.null_count_profile(fx_reg(spark, sf))


@query(
    "fill_median",
    with_(CLF) + f"SELECT id, coalesce(gap, (SELECT quantile_cont(gap, 0.5) FROM fx_clf WHERE NOT {held('id', 0.2)})) AS gap FROM fx_clf WHERE {held('id', 0.2)}",
)
def fill_median(spark, sf):
    train, score = holdout_split(fx_clf(spark, sf).select("id", "gap"), "id", 0.2)
    return C.fill_median(score, ["gap"], stats_from=train)


@query("fill_median_own", with_(REG) + "SELECT id, coalesce(gap, (SELECT quantile_cont(gap, 0.5) FROM fx_reg)) AS gap FROM fx_reg")
def fill_median_own(spark, sf):
    return C.fill_median(fx_reg(spark, sf).select("id", "gap"), ["gap"])


_DUP = "fx_dup AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)"


def fx_dup(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.unionByName(li.filter("l_linenumber = 1"))


@query("distinct_rows", with_(_DUP) + "SELECT DISTINCT * FROM fx_dup")
def distinct_rows(spark, sf):
    return C.distinct_rows(fx_dup(spark, sf))


@query("duplicate_rows", with_(_DUP) + "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, count(*) AS n_copies FROM fx_dup GROUP BY ALL HAVING count(*) > 1")
def duplicate_rows(spark, sf):
    return C.duplicate_rows(fx_dup(spark, sf), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@query(
    "flag_duplicates",
    with_(REG) + "SELECT id, l_quantity, l_discount, row_number() OVER (PARTITION BY l_quantity, l_discount ORDER BY id) > 1 AS is_duplicate FROM fx_reg",
)
def flag_duplicates(spark, sf):
    return C.flag_duplicates(fx_reg(spark, sf).select("id", "l_quantity", "l_discount"), "id", ["l_quantity", "l_discount"])


@query(
    "quantile_trim_sequential",
    with_(
        REG,
        "a AS (SELECT * FROM fx_reg WHERE y >= (SELECT quantile_cont(y, 0.05) FROM fx_reg) AND y <= (SELECT quantile_cont(y, 0.95) FROM fx_reg))",
        "b AS (SELECT * FROM a WHERE net >= (SELECT quantile_cont(net, 0.001) FROM a) AND net <= (SELECT quantile_cont(net, 0.98) FROM a))",
        "c AS (SELECT * FROM b WHERE l_quantity >= (SELECT quantile_cont(l_quantity, 0.1) FROM b) AND l_quantity <= (SELECT quantile_cont(l_quantity, 0.9) FROM b))",
    )
    + "SELECT id, y, net, l_quantity FROM c",
)
def quantile_trim_sequential(spark, sf):
    return C.quantile_trim_sequential(
        fx_reg(spark, sf).select("id", "y", "net", "l_quantity"), {"y": (0.05, 0.95), "net": (0.001, 0.98), "l_quantity": (0.1, 0.9)}
    )


@query(
    "quantile_trim_snapshot",
    with_(REG, "q AS (SELECT quantile_cont(y, [0.05, 0.95]) AS y, quantile_cont(net, [0.001, 0.98]) AS n FROM fx_reg)")
    + "SELECT id, r.y, net FROM fx_reg r, q WHERE r.y >= q.y[1] AND r.y <= q.y[2] AND net >= q.n[1] AND net <= q.n[2]",
)
def quantile_trim_snapshot(spark, sf):
    return C.quantile_trim_snapshot(fx_reg(spark, sf).select("id", "y", "net"), {"y": (0.05, 0.95), "net": (0.001, 0.98)})


_PCA2 = """m AS (SELECT count(*) AS n, avg(e0) AS m0, avg(e1) AS m1, covar_samp(e0, e0) AS a, covar_samp(e0, e1) AS b, covar_samp(e1, e1) AS c FROM fx_vec),
 ev AS (SELECT *, (a + c) / 2 + sqrt((a - c) * (a - c) / 4 + b * b) AS l1, (a + c) / 2 - sqrt((a - c) * (a - c) / 4 + b * b) AS l2 FROM m),
 dir AS (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS x, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS z FROM ev),
 ld AS (SELECT *, CASE WHEN abs(x) >= abs(z) THEN sign(x) ELSE sign(z) END AS s FROM dir),
 sc AS (SELECT v.id, ((v.e0 - m0) * x + (v.e1 - m1) * z) * s AS "PC1",
        (CASE WHEN abs(x) >= abs(z) THEN sign(x) ELSE sign(z) END) AS s1,
        ((v.e0 - m0) * z - (v.e1 - m1) * x) AS raw2, x, z FROM fx_vec v, ld),
 scores AS (SELECT id, "PC1", raw2 * (CASE WHEN abs(z) >= abs(x) THEN sign(z) ELSE sign(-x) END) AS "PC2" FROM sc)"""


@query(
    "quantile_trim_component_space",
    with_(VEC, _PCA2, 'q AS (SELECT quantile_cont("PC1", [0.05, 0.95]) AS q1, quantile_cont("PC2", [0.05, 0.95]) AS q2 FROM scores)')
    + 'SELECT id FROM scores, q WHERE "PC1" BETWEEN q1[1] AND q1[2] AND "PC2" BETWEEN q2[1] AND q2[2]',
)
def quantile_trim_component_space(spark, sf):
    v = fx_vec(spark, sf)
    scores = pca_fit(v, ["e0", "e1"], k=2).transform(v, keep=["id"])
    return C.quantile_trim_component_space(scores, ["PC1", "PC2"], 0.05, 0.95).select("id")


def _upper(cols, lo, hi, f, rel):
    q = ", ".join(f"quantile_cont({c}, {lo}) AS lo_{c}, quantile_cont({c}, {hi}) AS hi_{c}" for c in cols)
    cond = " OR ".join(f"coalesce({c} > hi_{c} + {f} * (hi_{c} - lo_{c}), false)" for c in cols)
    return f"SELECT id, {', '.join(cols)} FROM {rel}, (SELECT {q} FROM {rel}) q WHERE NOT ({cond})"


@query("iqr_fence_upper", with_(CLF) + _upper(["n_chars", "n_words", "gap"], 0.25, 0.75, 1.5, "fx_clf"))
def iqr_fence_upper(spark, sf):
    return C.iqr_fence_upper(fx_clf(spark, sf).select("id", "n_chars", "n_words", "gap"), ["n_chars", "n_words", "gap"])


def _both(cols, lo, hi, f):
    q = ", ".join(f"quantile_cont({c}, {lo}) AS lo_{c}, quantile_cont({c}, {hi}) AS hi_{c}" for c in cols)
    cond = " OR ".join(f"coalesce({c} < lo_{c} - {f} * (hi_{c} - lo_{c}) OR {c} > hi_{c} + {f} * (hi_{c} - lo_{c}), false)" for c in cols)
    return f"SELECT id, {', '.join(cols)} FROM fx_reg, (SELECT {q} FROM fx_reg) q WHERE NOT ({cond})"


@query("iqr_fence_two_sided", with_(REG) + _both(["y", "gap"], 0.25, 0.75, "CAST(0.25 AS DOUBLE)"))
def iqr_fence_two_sided(spark, sf):
    return C.iqr_fence_two_sided(fx_reg(spark, sf).select("id", "y", "gap"), ["y", "gap"], factor=0.25)


@query("iqr_fence_plain", with_(REG) + _both(["y", "net"], 0.05, 0.95, "0"))
def iqr_fence_plain(spark, sf):
    return C.iqr_fence_two_sided(fx_reg(spark, sf).select("id", "y", "net"), ["y", "net"], 0.05, 0.95, use_factor=False)


@query("range_filter", with_(REG) + "SELECT id, y FROM fx_reg WHERE y >= 20000 AND y <= 50000")
def range_filter(spark, sf):
    return C.range_filter(fx_reg(spark, sf).select("id", "y"), "y", 20000.0, 50000.0)


@query("equality_subset", with_(CLF) + "SELECT id, n_words FROM fx_clf WHERE y = 0")
def equality_subset(spark, sf):
    return C.equality_subset(fx_clf(spark, sf).select("id", "n_words", "y"), "y", 0).drop("y")


@query("exclude_ids", with_(REG) + f"SELECT id, y FROM fx_reg WHERE id NOT IN (SELECT id FROM fx_reg WHERE {held('id', 0.3)} AND l_quantity > 10)")
def exclude_ids(spark, sf):
    r = fx_reg(spark, sf)
    _, out = holdout_split(r.filter("l_quantity > 10"), "id", 0.3)
    return C.exclude_ids(r.select("id", "y"), out, "id")


@query("left_anti_join", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def left_anti_join(spark, sf):
    orders = table(spark, sf, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return C.exclude_ids(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), orders, "c_custkey")


@query("sort_values", with_(REG) + "SELECT id, net, row_number() OVER (ORDER BY net DESC, id) AS position FROM fx_reg ORDER BY net DESC, id")
def sort_values(spark, sf):
    """The whole table in order, each row with its place."""
    rows, _ = order_index(fx_reg(spark, sf).select("id", "net"), F.col("net").desc_nulls_last(), F.col("id"))
    return rows.select("id", "net", (F.col("idx") + 1).alias("position"))


@query("sorted_top", with_(REG) + "SELECT id, net FROM fx_reg ORDER BY net DESC, id LIMIT 500")
def sorted_top_(spark, sf):
    return sorted_top(fx_reg(spark, sf).select("id", "net"), "net", 500, "id")


@query("head", with_(REG) + "SELECT id, y FROM fx_reg ORDER BY id LIMIT 20")
def head(spark, sf):
    return fx_reg(spark, sf).select("id", "y").orderBy("id").limit(20)


@query("concat_rows", with_(CLF) + "SELECT id, n_words, NULL AS gap FROM fx_clf WHERE y = 0 UNION ALL SELECT id, NULL, gap FROM fx_clf WHERE y = 1")
def concat_rows(spark, sf):
    c = fx_clf(spark, sf)
    a, b = c.filter("y = 0").select("id", "n_words"), c.filter("y = 1").select("id", "gap")
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "math_scalars",
    with_(REG)
    + """SELECT id, sqrt(y) AS root, l_quantity * l_quantity AS squared, abs(neg) AS size, round(log10(y), 9) AS log10_y,
         CAST(floor(l_quantity / 3) AS BIGINT) AS floor_div, CAST(ceil(l_quantity / 3) AS BIGINT) AS ceil_div FROM fx_reg""",
)
def math_scalars(spark, sf):
    q = F.col("l_quantity")
    return fx_reg(spark, sf).select(
        "id", F.sqrt("y").alias("root"), (q * q).alias("squared"), F.abs("neg").alias("size"), F.round(F.log10("y"), 9).alias("log10_y"),
        F.floor(q / 3).alias("floor_div"), F.ceil(q / 3).alias("ceil_div"),
    )


@query("threshold_to_class", with_(REG) + "SELECT id, CAST(l_discount > 0.05 AS INTEGER) AS label FROM fx_reg")
def threshold_to_class_(spark, sf):
    return threshold_to_class(fx_reg(spark, sf).select("id", "l_discount"), "l_discount", 0.05).drop("l_discount")


@query(
    "reshape_rows",
    "SELECT vec_id, i - 1 AS pos, len(list_value(embedding[i])) AS width, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, 65) t(i)",
)
def reshape_rows(spark, sf):
    nested = nest_vector(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding")
    cells = nested.select("vec_id", F.posexplode("embedding").alias("pos", "cell"))
    return cells.select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), F.size("cell").cast("bigint").alias("width"), F.col("cell")[0].cast("double").alias("value")
    )


@query("prediction_sample", with_(PRED, "r AS (SELECT id, y, p, row_number() OVER (ORDER BY id) - 1 AS position FROM fx_pred)") + "SELECT * FROM r WHERE position BETWEEN 100 AND 110")
def prediction_sample(spark, sf):
    out = C.prediction_slice(fx_pred(spark, sf).select("id", "y", "p"), "id", 100, 110)
    return out.withColumn("position", F.col("position").cast("bigint"))


@query("value_counts", with_(CLF) + "SELECT source, count(*) AS n FROM fx_clf GROUP BY source ORDER BY n DESC, source")
def value_counts_(spark, sf):
    return value_counts(fx_clf(spark, sf), "source")


