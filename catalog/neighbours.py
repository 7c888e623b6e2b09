"""Nearest-neighbour prediction and class resampling."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import CLF, DIMS, REG, VEC, fx_clf, fx_reg, fx_vec, h32, h60, held, with_
from rowloom.operators import resample as R
from rowloom.operators.neighbors import knn_predict
from rowloom.operators.split import holdout_split


def square(a, b, dims=DIMS):
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in dims)


def nearest(rel, k, key="id", where="TRUE", dims=DIMS, points=None, self_pairs=False, measure=None):
    """CTE body: (q, n, rank, m) of the k nearest rows."""
    points = points or rel
    skip = "TRUE" if self_pairs else f"a.{key} <> b.{key}"
    return f"""(SELECT q, n, m, rank FROM (SELECT a.{key} AS q, b.{key} AS n, {measure or square('a', 'b', dims)} AS m,
      row_number() OVER (PARTITION BY a.{key} ORDER BY m, b.{key}) AS rank FROM {rel} a JOIN {points} b ON {skip} AND {where}) WHERE rank <= {k})"""


_SPLIT = f"te AS (SELECT * FROM fx_vec WHERE {held('id', 0.2)}), tr AS (SELECT * FROM fx_vec WHERE NOT {held('id', 0.2)})"
_ABS = " + ".join(f"abs(a.{c} - b.{c})" for c in DIMS)


def _parts(spark, sf):
    train, test = holdout_split(fx_vec(spark, sf), "id", 0.2)
    return test, train


@query(
    "knn_regress",
    with_(VEC, _SPLIT, f"nn AS {nearest('te', 7, points='tr')}") + "SELECT q AS id, round(avg(CAST(label AS DOUBLE)), 9) AS prediction FROM nn JOIN tr ON n = id GROUP BY q",
)
def knn_regress(spark, sf):
    return knn_predict(*_parts(spark, sf), DIMS, "id", "label", 7).withColumn("prediction", F.round("prediction", 9))


@query(
    "knn_regress_weighted",
    with_(VEC, _SPLIT, f"nn AS {nearest('te', 20, points='tr', measure=_ABS)}")
    + "SELECT q AS id, round(sum(label / m) / sum(1 / m), 9) AS prediction FROM nn JOIN tr ON n = id GROUP BY q",
)
def knn_regress_weighted(spark, sf):
    out = knn_predict(*_parts(spark, sf), DIMS, "id", "label", 20, p=1, weights="distance")
    return out.withColumn("prediction", F.round("prediction", 9))


@query(
    "knn_classify",
    with_(VEC, _SPLIT, f"nn AS {nearest('te', 5, points='tr')}", "v AS (SELECT q, label, count(*) AS c FROM nn JOIN tr ON n = id GROUP BY 1, 2)")
    + "SELECT q AS id, arg_min(label, label - 1000 * c) AS prediction FROM v GROUP BY q",
)
def knn_classify(spark, sf):
    return knn_predict(*_parts(spark, sf), DIMS, "id", "label", 5, task="classify")


_RANK = f"r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {h32('id')}, id) - 1 AS rk, count(*) OVER (PARTITION BY y) AS n FROM fx_clf)"


@query(
    "random_oversample",
    with_(CLF, _RANK, "c AS (SELECT y, count(*) AS n FROM fx_clf GROUP BY y)", "d AS (SELECT y, n, unnest(range((SELECT max(n) FROM c) - n)) AS j FROM c)")
    + f"SELECT id, y, 0 AS copy_no FROM fx_clf UNION ALL SELECT r.id, r.y, j + 1 FROM d JOIN r ON r.y = d.y AND r.rk = {h60('j')} % d.n",
)
def random_oversample(spark, sf):
    return R.random_oversample(fx_clf(spark, sf).select("id", "y"), "id", "y")


@query("random_undersample", with_(CLF, _RANK) + "SELECT id, y FROM r WHERE rk < (SELECT min(n) FROM r)")
def random_undersample(spark, sf):
    return R.random_undersample(fx_clf(spark, sf).select("id", "y"), "id", "y")


_REG_RANK = f"r AS (SELECT id, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY {h32('id')}, id) - 1 AS rk, count(*) OVER (PARTITION BY l_returnflag) AS n FROM fx_reg)"


@query("random_undersample_to_counts", with_(REG, _REG_RANK) + "SELECT id, l_returnflag FROM r WHERE rk < (CASE l_returnflag WHEN 'A' THEN 1000 WHEN 'N' THEN 2500 ELSE n END)")
def random_undersample_to_counts(spark, sf):
    return R.random_undersample(fx_reg(spark, sf).select("id", "l_returnflag"), "id", "l_returnflag", targets={"A": 1000, "N": 2500})


_MADE = ", ".join(f"b.{c} + u * (t.{c} - b.{c}) AS {c}" for c in DIMS)
_SMOTE = f"""mi AS (SELECT * FROM fx_vec WHERE y = 1),
 rk AS (SELECT id, row_number() OVER (ORDER BY {h32('id')}, id) - 1 AS rk, count(*) OVER () AS n FROM mi),
 nn AS {nearest('mi', 5)},
 dr AS (SELECT unnest(range((SELECT count(*) FROM fx_vec WHERE y = 0) - (SELECT count(*) FROM mi))) AS j),
 pk AS (SELECT j, rk.id AS base, nn.n AS other, {h32('j', 44)} / CAST(4294967296 AS DOUBLE) AS u
        FROM dr JOIN rk ON rk.rk = {h60('j')} % rk.n JOIN nn ON nn.q = rk.id AND nn.rank = {h32('j', 43)} % 5 + 1),
 sm AS (SELECT id, y, {', '.join(DIMS)}, 0 AS copy_no FROM fx_vec
        UNION ALL SELECT b.id, b.y, {_MADE}, j + 1 FROM pk JOIN mi b ON b.id = base JOIN mi t ON t.id = other)"""


@query("smote", with_(VEC, _SMOTE) + "SELECT * FROM sm")
def smote(spark, sf):
    return R.smote(fx_vec(spark, sf), "id", "y", DIMS)


_TOMEK = f"n1 AS {nearest('fx_vec', 1)}, tl AS (SELECT x.q AS a, x.n AS b FROM n1 x JOIN n1 z ON x.n = z.q AND z.n = x.q WHERE x.q < x.n)"


@query("tomek_links", with_(VEC, _TOMEK) + "SELECT a, b, p.y AS label_a, s.y AS label_b FROM tl JOIN fx_vec p ON p.id = a JOIN fx_vec s ON s.id = b WHERE p.y <> s.y")
def tomek_links(spark, sf):
    return R.tomek_links(fx_vec(spark, sf), "id", "y", DIMS)


@query(
    "remove_tomek_links",
    with_(VEC, _TOMEK, "bad AS (SELECT CASE WHEN p.y = 0 THEN a ELSE b END AS id FROM tl JOIN fx_vec p ON p.id = a JOIN fx_vec s ON s.id = b WHERE p.y <> s.y)")
    + "SELECT id, y FROM fx_vec WHERE id NOT IN (SELECT id FROM bad)",
)
def remove_tomek_links(spark, sf):
    return R.remove_tomek_links(fx_vec(spark, sf), "id", "y", DIMS).select("id", "y")


@query(
    "edited_nearest_neighbours",
    with_(VEC, f"n3 AS {nearest('fx_vec', 3)}", "v AS (SELECT q, min(y) AS lo, max(y) AS hi FROM n3 JOIN fx_vec ON n = id GROUP BY q)")
    + "SELECT id, y FROM fx_vec JOIN v ON id = q WHERE lo = y AND hi = y",
)
def edited_nearest_neighbours(spark, sf):
    return R.edited_nearest_neighbours(fx_vec(spark, sf), "id", "y", DIMS).select("id", "y")


_KEYED = "sk AS (SELECT *, CAST(id AS VARCHAR) || '#' || lpad(CAST(copy_no AS VARCHAR), 12, '0') AS row_key FROM sm)"


@query(
    "smote_tomek",
    with_(
        VEC, _SMOTE, _KEYED, f"n1 AS {nearest('sk', 1, key='row_key')}",
        "tl AS (SELECT x.q AS a, x.n AS b FROM n1 x JOIN n1 z ON x.n = z.q AND z.n = x.q JOIN sk p ON p.row_key = x.q JOIN sk s ON s.row_key = x.n WHERE p.y <> s.y)",
    )
    + f"SELECT row_key, y, {', '.join(DIMS)} FROM sk WHERE row_key NOT IN (SELECT a FROM tl UNION ALL SELECT b FROM tl)",
)
def smote_tomek(spark, sf):
    return R.smote_tomek(fx_vec(spark, sf), "id", "y", DIMS).select("row_key", "y", *DIMS)


@query(
    "smote_enn",
    with_(VEC, _SMOTE, _KEYED, f"n3 AS {nearest('sk', 3, key='row_key')}", "v AS (SELECT q, min(y) AS lo, max(y) AS hi FROM n3 JOIN sk ON n = row_key GROUP BY q)")
    + f"SELECT row_key, y, {', '.join(DIMS)} FROM sk JOIN v ON row_key = q WHERE lo = y AND hi = y",
)
def smote_enn(spark, sf):
    return R.smote_enn(fx_vec(spark, sf), "id", "y", DIMS).select("row_key", "y", *DIMS)


_GROUPS = """s AS (SELECT id, y, lang, source, 'lang' AS group_column, lang AS group_value FROM fx_clf
   UNION ALL SELECT id, y, lang, source, 'source', source FROM fx_clf),
 c AS (SELECT group_column, group_value, y, count(*) AS n FROM s GROUP BY ALL),
 p AS (SELECT group_column, group_value, arg_min(y, y - 10 * n) AS maj FROM c GROUP BY ALL HAVING count(*) = 2),
 r AS (SELECT s.*, p.maj, row_number() OVER (PARTITION BY group_column, group_value, y ORDER BY %s, id) - 1 AS rk,
              count(*) OVER (PARTITION BY group_column, group_value, y) AS n FROM s JOIN p USING (group_column, group_value)),
 dr AS (SELECT group_column, group_value, n, unnest(range(n)) AS j FROM c JOIN p USING (group_column, group_value) WHERE y = maj)""" % h32("id")


@query(
    "adjust_proportion",
    with_(CLF, _GROUPS)
    + f"""SELECT id, y, lang, source, group_column, group_value, 0 AS copy_no FROM r WHERE y = maj OR rk < n // 2
          UNION ALL SELECT id, y, lang, source, r.group_column, r.group_value, j + 1 FROM dr JOIN r
          ON r.group_column = dr.group_column AND r.group_value = dr.group_value AND y = maj AND rk = {h60('j')} % dr.n""",
)
def adjust_proportion(spark, sf):
    return R.adjust_proportion(fx_clf(spark, sf).select("id", "y", "lang", "source"), "id", "y", ["lang", "source"], 2)
