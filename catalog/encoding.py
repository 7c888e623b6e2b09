"""Label dictionaries, scalers and polynomial terms."""

from pyspark.sql import functions as F

from catalog import query
from catalog.fixtures import BIN_FEATURES, CLF, DIMS, REG, VEC, fx_bin, fx_clf, fx_reg, fx_vec, held, union_all, with_
from rowloom.operators import encode as E
from rowloom.operators.split import holdout_split

_CODES = "l AS (SELECT DISTINCT lang AS v, dense_rank() OVER (ORDER BY lang) - 1 AS c FROM fx_clf), s AS (SELECT DISTINCT source AS v, dense_rank() OVER (ORDER BY source) - 1 AS c FROM fx_clf)"


@query("label_encode", with_(CLF, _CODES) + "SELECT id, l.c AS lang, s.c AS source FROM fx_clf JOIN l ON lang = l.v JOIN s ON source = s.v")
def label_encode(spark, sf):
    c = fx_clf(spark, sf).select("id", "lang", "source")
    return E.label_encode(c, E.label_dictionary(c, columns=["lang", "source"]), ["lang", "source"])


@query(
    "label_dictionary",
    with_(REG)
    + "SELECT 'gap' AS column_name, CAST(gap AS VARCHAR) AS value, row_number() OVER (ORDER BY gap NULLS LAST) - 1 AS code FROM (SELECT DISTINCT gap FROM fx_reg)"
    + " UNION ALL SELECT 'l_returnflag', l_returnflag, row_number() OVER (ORDER BY l_returnflag) - 1 FROM (SELECT DISTINCT l_returnflag FROM fx_reg)",
)
def label_dictionary(spark, sf):
    return E.label_dictionary(fx_reg(spark, sf), columns=["gap", "l_returnflag"])


_TRAIN = "tr AS (SELECT * FROM fx_clf WHERE lang IN ('en', 'de'))"


def _unseen(spark, sf):
    c = fx_clf(spark, sf).select("id", "lang")
    return c.filter(F.col("lang").isin("en", "de")), c


@query(
    "label_encode_independent",
    with_(CLF, _TRAIN, "a AS (SELECT 'train' AS part, id, dense_rank() OVER (ORDER BY lang) - 1 AS lang FROM tr)", "b AS (SELECT 'score' AS part, id, dense_rank() OVER (ORDER BY lang) - 1 AS lang FROM fx_clf)")
    + "SELECT * FROM a UNION ALL SELECT * FROM b",
)
def label_encode_independent(spark, sf):
    a, b = E.label_encode_independent(*_unseen(spark, sf), ["lang"])
    return a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("score")))


_D = "d AS (SELECT lang AS v, row_number() OVER (ORDER BY lang) - 1 AS c FROM (SELECT DISTINCT lang FROM tr))"


@query("label_encode_frozen", with_(CLF, _TRAIN, _D) + "SELECT id, c AS lang, coalesce(c, (SELECT count(*) FROM d)) AS lang_kept FROM fx_clf LEFT JOIN d ON lang = v")
def label_encode_frozen(spark, sf):
    train, score = _unseen(spark, sf)
    score = score.withColumn("lang_kept", F.col("lang"))
    state = E.label_dictionary(train, columns=["lang"])
    kept = state.withColumn("column_name", F.lit("lang_kept"))
    return E.label_encode(E.label_encode(score, state, ["lang"]), kept, ["lang_kept"], unseen="last")


@query("label_encode_union", with_(CLF) + "SELECT id, dense_rank() OVER (ORDER BY lang) - 1 AS lang FROM fx_clf WHERE lang IN ('en', 'de')")
def label_encode_union(spark, sf):
    return E.label_encode_union(*_unseen(spark, sf), ["lang"])[0]


_COLS = ["y", "net", "one"]


def _std_sql(cols, where):
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}" for c in cols)
    out = ", ".join(f"round(({c} - m_{c}) / s_{c}, 7) AS {c}" for c in cols)
    return f"SELECT id, {out} FROM fx_reg, (SELECT {stats} FROM fx_reg WHERE NOT {where}) q WHERE {where}"


def _rounded(df, cols, digits=7):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("standard_scale", with_(REG) + _std_sql(_COLS, held("id", 0.2)))
def standard_scale(spark, sf):
    train, score = holdout_split(fx_reg(spark, sf).select("id", *_COLS), "id", 0.2)
    return _rounded(E.apply_scale(score, E.standard_state(train, _COLS)), _COLS)


def _mm(c):
    return f"(max({c}) - min({c}))"


@query(
    "minmax_scale",
    with_(REG, "q AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, CASE WHEN {_mm(c)} > 0 THEN {_mm(c)} ELSE 1 END AS w_{c}" for c in _COLS) + " FROM fx_reg)")
    + "SELECT id, " + ", ".join(f"({c} - lo_{c}) / w_{c} AS {c}" for c in _COLS) + " FROM fx_reg, q",
)
def minmax_scale(spark, sf):
    r = fx_reg(spark, sf).select("id", *_COLS)
    return E.apply_scale(r, E.minmax_state(r, _COLS))


@query(
    "minmax_state_table",
    with_(REG)
    + union_all(
        f"SELECT '{c}' AS column_name, min({c}) AS min, max({c}) AS max, 1 / (CASE WHEN {_mm(c)} > 0 THEN {_mm(c)} ELSE 1 END) AS factor, {_mm(c)} AS range FROM fx_reg"
        for c in _COLS
    ),
)
def minmax_state_table(spark, sf):
    return E.minmax_state(fx_reg(spark, sf), _COLS).drop("center", "scale")


@query(
    "robust_scale",
    with_(REG, "q AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS w_{c}" for c in _COLS) + " FROM fx_reg)")
    + "SELECT id, " + ", ".join(f"round(({c} - m_{c}) / (CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END), 7) AS {c}" for c in _COLS) + " FROM fx_reg, q",
)
def robust_scale(spark, sf):
    r = fx_reg(spark, sf).select("id", *_COLS)
    return _rounded(E.apply_scale(r, E.robust_state(r, _COLS)), _COLS)


@query("inverse_scale", with_(REG) + "SELECT id, round(y, 4) AS y, round(net, 4) AS net FROM fx_reg")
def inverse_scale(spark, sf):
    r = fx_reg(spark, sf).select("id", "y", "net")
    state = E.standard_state(r, ["y", "net"])
    return _rounded(E.inverse_scale(E.apply_scale(r, state), state), ["y", "net"], 4)


def _poly_sql(cols):
    terms = ['CAST(1 AS DOUBLE) AS "1"'] + [f"{c} AS {c}" for c in cols]
    terms += [f"{a} * {b} AS {a}__{b}" for i, a in enumerate(cols) for b in cols[i:]]
    return "SELECT id, " + ", ".join(terms) + " FROM fx_vec"


@query("polynomial_features", with_(VEC) + _poly_sql(DIMS[:3]))
def polynomial_features(spark, sf):
    return E.polynomial_features(fx_vec(spark, sf), DIMS[:3], keep=["id"])


@query("scaled_poly_components_model")
def scaled_poly_components_model(spark, sf):
    """Scale, degree-2 terms, ten components and a classifier as one model, judged on a holdout."""
    from rowloom.models.trees import boosted_trees
    from rowloom.operators.metrics import evaluate
    from rowloom.plans.stages import Chain, Components, Polynomial, Scale

    train, holdout = holdout_split(fx_bin(spark, sf), "id", 0.2)
    chain = Chain(
        [Scale(), Polynomial(), Components(k=10)],
        lambda df, names, y: boosted_trees(df, names, y, loss="logistic", n_estimators=5, max_depth=3, max_bins=32),
    )
    return evaluate(chain.fit(train, BIN_FEATURES, "y").score(holdout), "y", "prediction", ["accuracy", "f1"])
