"""Sources, sinks and column selection."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import CLF, PRED, REG, REG_COLUMNS, fx_clf, fx_pred, fx_reg, held, table, union_all, with_
from rowloom.functions.lineage import scratch_path
from rowloom.operators import select as S
from rowloom.operators.clean import attach_by_key, drop_null_rows
from rowloom.operators.split import holdout_split
from rowloom.sources import tables as src

_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


@query("scan_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def scan_csv(spark, sf):
    path = scratch_path(spark, "orders-csv")
    names = [f.split()[0] for f in _ORDERS.split(", ")]
    table(spark, sf, "orders").select(*names).write.option("header", True).csv(path)
    return src.scan_csv(spark, path, _ORDERS)


@query("write_predictions", with_(PRED) + 'SELECT id AS "Id", p AS preco FROM fx_pred')
def write_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    src.write_predictions(fx_pred(spark, sf), path, "id", "p", names=("Id", "preco"), prediction_first=True)
    return spark.read.schema("preco double, Id string").option("header", True).csv(path)


@query(
    "write_results_tsv",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_extendedprice) AS top FROM lineitem GROUP BY 1, 2",
)
def write_results_tsv(spark, sf):
    path = scratch_path(spark, "results")
    li = table(spark, sf, "lineitem")
    out = li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.max("l_extendedprice").alias("top"))
    src.write_results_tsv(out, path)
    return src.scan_results_tsv(spark, path, "l_returnflag string, l_linestatus string, n bigint, top double")


@query(
    "submission_template_check",
    with_(
        REG,
        "pred AS (SELECT id FROM fx_reg WHERE l_quantity < 40 UNION ALL SELECT id FROM fx_reg WHERE l_quantity < 2)",
        "tpl AS (SELECT id FROM fx_reg WHERE l_quantity > 5)",
        "g AS (SELECT id, count(*) AS got FROM pred GROUP BY id)",
        "w AS (SELECT id, count(*) AS want FROM tpl GROUP BY id)",
    )
    + """SELECT count(*) FILTER (got IS NULL) AS n_missing, count(*) FILTER (want IS NULL) AS n_extra,
         count(*) FILTER (got > 1) AS n_duplicate, count(*) FILTER (got IS NOT NULL AND want IS NOT NULL) AS n_matched
         FROM g FULL JOIN w USING (id)""",
)
def submission_template_check(spark, sf):
    r = fx_reg(spark, sf)
    predictions = r.filter("l_quantity < 40").select("id").unionByName(r.filter("l_quantity < 2").select("id"))
    return src.submission_template_check(predictions, r.filter("l_quantity > 5").select("id"), "id")


_TYPES = {"id": "string", "l_returnflag": "string", "l_linestatus": "string"}


@query(
    "schema_profile",
    with_(REG)
    + union_all(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_present, '{_TYPES.get(c, 'double')}' AS type, "
        f"{str(c != 'y').lower()} AS in_score, {str(c == 'y').lower()} AS is_target FROM fx_reg"
        for c in REG_COLUMNS
    ),
)
def schema_profile(spark, sf):
    train = fx_reg(spark, sf)
    return src.schema_profile(train, train.drop("y"), "y")


@query("drop_columns", with_(REG) + "SELECT " + ", ".join(c for c in REG_COLUMNS if c not in ("one", "gap")) + " FROM fx_reg")
def drop_columns(spark, sf):
    return S.drop_columns(fx_reg(spark, sf), "one", "gap")


@query("select_columns", with_(CLF) + "SELECT id, n_chars, n_words, y FROM fx_clf")
def select_columns(spark, sf):
    return S.select_columns(fx_clf(spark, sf), ["id", "n_chars", "n_words", "y"])


@query("select_by_dtype", with_(REG) + "SELECT id, l_returnflag, l_linestatus FROM fx_reg")
def select_by_dtype(spark, sf):
    return S.select_by_dtype(fx_reg(spark, sf), "string")


@query("rename_columns", with_(PRED) + "SELECT id AS id_solicitante, p AS inadimplente FROM fx_pred")
def rename_columns(spark, sf):
    return S.rename_columns(fx_pred(spark, sf).select("id", "p"), {"id": "id_solicitante", "p": "inadimplente"})


@query("add_constant_or_missing_column", with_(REG) + "SELECT id, l_quantity, CAST(NULL AS DOUBLE) AS preco, CAST(2 AS DOUBLE) AS two FROM fx_reg")
def add_constant_or_missing_column(spark, sf):
    out = S.add_missing_column(fx_reg(spark, sf).select("id", "l_quantity"), "preco")
    return S.add_missing_column(out, "two", 2)


@query("truncate_to_int", with_(REG) + "SELECT id, CAST(trunc(y) AS BIGINT) AS y, CAST(trunc(net) AS BIGINT) AS net, CAST(trunc(neg) AS BIGINT) AS neg FROM fx_reg")
def truncate_to_int(spark, sf):
    return S.truncate_to_int(fx_reg(spark, sf).select("id", "y", "net", "neg"))


@query("drop_columns_with_nulls", with_(REG) + "SELECT " + ", ".join(c for c in REG_COLUMNS if c != "gap") + " FROM fx_reg")
def drop_columns_with_nulls(spark, sf):
    return S.drop_columns_with_nulls(fx_reg(spark, sf))


@query("drop_constant_columns", with_(REG) + "SELECT " + ", ".join(c for c in REG_COLUMNS if c not in ("one", "y")) + f" FROM fx_reg WHERE {held('id', 0.2)}")
def drop_constant_columns(spark, sf):
    train, score = holdout_split(fx_reg(spark, sf), "id", 0.2)
    return S.drop_constant_columns(train, score.drop("y"))[1]


@query("reorder_to_training_columns", with_(REG) + f"SELECT l_tax, l_quantity, l_discount FROM fx_reg WHERE {held('id', 0.2)}")
def reorder_to_training_columns(spark, sf):
    train, score = holdout_split(fx_reg(spark, sf), "id", 0.2)
    return S.reorder_to_training_columns(score, train.select("l_tax", "l_quantity", "l_discount", "y"), exclude=["y"])


@query("name_components", "SELECT vec_id, " + ", ".join(f'embedding[{i}] AS "PC{i}"' for i in range(1, 5)) + " FROM embeddings")
def name_components(spark, sf):
    return S.name_components(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", 4)


@query("attach_label", with_(REG) + f"SELECT r.id, r.l_quantity, t.y FROM fx_reg r LEFT JOIN (SELECT id, y FROM fx_reg WHERE NOT {held('id', 0.2)}) t ON r.id = t.id")
def attach_label(spark, sf):
    r = fx_reg(spark, sf)
    train, _ = holdout_split(r, "id", 0.2)
    return attach_by_key(r.select("id", "l_quantity"), train, "id", ["y"])


@query("attach_ids", with_(PRED) + f"SELECT s.id, s.l_returnflag, p.p FROM fx_reg s JOIN fx_pred p ON s.id = p.id WHERE {held('s.id', 0.2)}")
def attach_ids(spark, sf):
    _, score = holdout_split(fx_reg(spark, sf).select("id", "l_returnflag"), "id", 0.2)
    return attach_by_key(score, fx_pred(spark, sf), "id", ["p"], how="inner")


@query("column_set_difference", with_(REG) + "SELECT " + ", ".join(f"max({c}) AS {c}" for c in REG_COLUMNS if c not in ("id", "y")) + " FROM fx_reg")
def column_set_difference(spark, sf):
    r = fx_reg(spark, sf)
    return r.agg(*[F.max(c).alias(c) for c in S.column_set_difference(r, ["id", "y"])])


@query("concat_columns", with_(REG) + "SELECT a.id, a.l_quantity, a.l_tax, b.y FROM fx_reg a JOIN fx_reg b ON a.id = b.id")
def concat_columns(spark, sf):
    r = fx_reg(spark, sf)
    return attach_by_key(r.select("id", "l_quantity", "l_tax"), r, "id", ["y"], how="inner")


@query("drop_null_rows", with_(REG) + "SELECT " + ", ".join(c for c in REG_COLUMNS if c != "one") + " FROM fx_reg WHERE gap IS NOT NULL")
def drop_null_rows_(spark, sf):
    return drop_null_rows(fx_reg(spark, sf), drop=["one"])
