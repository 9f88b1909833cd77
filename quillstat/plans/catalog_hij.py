"""Catalogue sections H (explanation), I (what-if) and J (narrative facts)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quillstat.operators import eda as E
from quillstat.operators import explain as H
from quillstat.operators import facts as J
from quillstat.operators import metrics as G
from quillstat.operators import prepare as D
from quillstat.operators import profile as P
from quillstat.operators import whatif as I
from quillstat.plans import oracle as O
from quillstat.plans import views as V
from quillstat.plans.catalog_abc import _STATS_SQL, _top_sql
from quillstat.plans.catalog_g import _CLS_METRICS_SQL, _REG_METRICS_SQL
from quillstat.plans.registry import query

_T = f"({V.LINEITEM_TARGETS_SQL})"
_H_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_H_POS = [f"f_{i}" for i in range(len(_H_FEATS))] + ["pad_0"]


def _linear_score(spark, sf):
    """Nearest-centroid linear score on the standardised features of lineitem,
    and its coefficients; features carry positional names plus one zero padding
    feature, as in the reference's aligned matrix.  A linear score is explained
    exactly by coef * (z - 0)."""
    t = V.lineitem_targets(spark, sf)
    key = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    sc = D.fit_scalers(t, {c: F.col(c) for c in _H_FEATS})
    z = t.select(key.alias("row_key"), "qty_band",
                 *[D.scale(F.col(c), *sc[c]).alias(f"f_{i}") for i, c in enumerate(_H_FEATS)],
                 F.lit(0.0).alias("pad_0"))
    return z, H.centroid_coefficients(z, "qty_band", _H_POS)


def _linear_explanation(spark, sf):
    z, coef = _linear_score(spark, sf)
    return H.linear_contributions(z, "row_key", _H_POS, coef, {f: 0.0 for f in _H_POS})


_Z_SQL = f"""WITH t AS (SELECT * FROM {_T} tt),
st AS (SELECT {", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_H_FEATS))} FROM t),
z AS (SELECT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS row_key, qty_band,
  {", ".join(f"({c} - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END AS f_{i}" for i, c in enumerate(_H_FEATS))},
  CAST(0.0 AS DOUBLE) AS pad_0 FROM t, st),
coef AS (SELECT qty_band AS class, {", ".join(f"avg({f}) AS c_{f}" for f in _H_POS)} FROM z GROUP BY 1),
contrib AS ({" UNION ALL ".join(f"SELECT z.row_key, coef.class, '{f}' AS feature, coef.c_{f} * (z.{f} - 0.0) AS contribution FROM z, coef" for f in _H_POS)}),
imp AS (SELECT feature, avg(abs(contribution)) AS importance FROM contrib GROUP BY feature),
names AS ({" UNION ALL ".join(f"SELECT 'f_{i}' AS feature, '{c}' AS name" for i, c in enumerate(_H_FEATS))}),
mapped AS (SELECT coalesce(names.name, imp.feature) AS feature, imp.importance FROM imp LEFT JOIN names ON imp.feature = names.feature),
kept AS (SELECT * FROM mapped WHERE NOT starts_with(feature, 'pad_') AND NOT starts_with(feature, 'f_')),
ranked AS (SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS position, feature, importance FROM kept)"""


def _named_importance(spark, sf):
    imp = H.feature_importance(_linear_explanation(spark, sf))
    names = H.feature_dictionary(spark, _H_FEATS)
    return H.drop_padding(H.map_feature_names(imp, names))


@query("h2_linear_contributions", f"{_Z_SQL} SELECT row_key, class, feature, round(contribution, 6) + 0.0 AS contribution FROM contrib")
def h2_linear_contributions(spark, sf):
    c = _linear_explanation(spark, sf)
    return c.select("row_key", "class", "feature", (F.round("contribution", 6) + F.lit(0.0)).alias("contribution"))


_N_BACKGROUND = 3


@query("h2_sampled_contributions", f"""{_Z_SQL},
bg AS (SELECT {", ".join(f"avg({f}) AS b_{f}" for f in _H_POS)} FROM (SELECT * FROM z ORDER BY md5(row_key), {", ".join(_H_POS)} LIMIT {_N_BACKGROUND}) x)
SELECT row_key, class, '__base' AS feature, round({" + ".join(f"c_{f} * b_{f}" for f in _H_POS)}, 6) + 0.0 AS contribution FROM z, coef, bg
""" + "".join(f"UNION ALL SELECT row_key, class, '{f}', round(c_{f} * ({f} - b_{f}), 6) + 0.0 FROM z, coef, bg\n" for f in _H_POS))
def h2_sampled_contributions(spark, sf):
    """Any model's explanation, of a model whose Shapley values SQL can state: coef * (z - mean of the background)."""
    z, coef = _linear_score(spark, sf)
    rows = z.select("row_key", F.array(*_H_POS).alias("z")).withColumn("features", array_to_vector("z"))
    table: dict = {}
    for r in coef.collect():     # classes x features
        table.setdefault(r["class"], {})[r["feature"]] = r["coef"]
    classes = sorted(table)

    def score(df):
        x = F.col("__known")
        return df.withColumn("score", F.array(*[sum((F.get(x, F.lit(j)) * F.lit(table[c][f]) for j, f in enumerate(_H_POS)), F.lit(0.0)) for c in classes]))
    taken = H.draws(H.background_rows(rows, _N_BACKGROUND), len(_H_POS), orders=_N_BACKGROUND)
    out = H.sampled_contributions(rows, "row_key", _H_POS, score, classes, taken)
    return out.select("row_key", "class", "feature", (F.round("contribution", 6) + F.lit(0.0)).alias("contribution"))


@query("h3_feature_importance", f"{_Z_SQL} SELECT feature, round(importance, 6) + 0.0 AS importance FROM imp")
def h3_feature_importance(spark, sf):
    imp = H.feature_importance(_linear_explanation(spark, sf))
    return imp.select("feature", (F.round("importance", 6) + F.lit(0.0)).alias("importance"))


@query("h4_importance_ranking", f"""{_Z_SQL}
SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS position, feature FROM imp""")
def h4_importance_ranking(spark, sf):
    return H.rank_importance(H.feature_importance(_linear_explanation(spark, sf))).select("position", "feature")


@query("h6_feature_names", f"{_Z_SQL} SELECT feature, round(importance, 6) + 0.0 AS importance FROM mapped")
def h6_feature_names(spark, sf):
    imp = H.feature_importance(_linear_explanation(spark, sf))
    m = H.map_feature_names(imp, H.feature_dictionary(spark, _H_FEATS))
    return m.select("feature", (F.round("importance", 6) + F.lit(0.0)).alias("importance"))


@query("h7_drop_padding", f"{_Z_SQL} SELECT feature FROM kept")
def h7_drop_padding(spark, sf):
    return _named_importance(spark, sf).select("feature")


@query("h8_top_features", f"""{_Z_SQL}
SELECT 20 AS top_n, position, feature FROM ranked WHERE position <= 20
UNION ALL SELECT 5, position, feature FROM ranked WHERE position <= 5""")
def h8_top_features(spark, sf):
    imp = _named_importance(spark, sf)
    return (H.top_features(imp, 20).select(F.lit(20).alias("top_n"), "position", "feature")
            .unionByName(H.top_features(imp, 5).select(F.lit(5).alias("top_n"), "position", "feature")))


@query("j4_top_feature_context", f"""{_Z_SQL}
SELECT '[' || string_agg('''' || feature || '''', ', ' ORDER BY position) || ']' AS top_features FROM ranked WHERE position <= 5""")
def j4_top_feature_context(spark, sf):
    return J.top_feature_context(H.top_features(_named_importance(spark, sf), 5))


# ===========================================================================
# I. What-if (target net_price)
# ===========================================================================

I_TARGET = "net_price"
_I_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "is_big"]


def _targets_and_sliders(spark, sf):
    t = V.lineitem_targets(spark, sf)
    info = P.collect_info(P.profile(t))
    return t, I.slider_columns(t, info, I_TARGET)


_BOUNDS_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"avg(CAST({c} AS DOUBLE)) AS mean FROM {_T} t" for i, c in enumerate(_I_COLS))


@query("i1_slider_bounds", f"SELECT position, column_name, round(min, 4) AS min, round(max, 4) AS max, round(mean, 4) AS mean FROM ({_BOUNDS_SQL}) b")
def i1_slider_bounds(spark, sf):
    t, cols = _targets_and_sliders(spark, sf)
    b = I.slider_bounds(t, cols)
    return b.select("position", "column_name", *[F.round(c, 4).alias(c) for c in ("min", "max", "mean")])


_WIDE_SQL = """(SELECT l.*, o.o_custkey, o.o_totalprice, p.p_size, p.p_retailprice, c.c_nationkey, c.c_acctbal
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey)"""
_WIDE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                 "o_custkey", "o_totalprice", "p_size", "p_retailprice", "c_nationkey", "c_acctbal"]


def _wide(spark, sf):
    """lineitem with order, part and customer attributes (a star join)."""
    li, o, p, c = (V.load_testdata(spark, sf, n) for n in ("lineitem", "orders", "part", "customer"))
    return (li.join(o.select("o_orderkey", "o_custkey", "o_totalprice"), li.l_orderkey == o.o_orderkey)
            .join(p.select("p_partkey", "p_size", "p_retailprice"), li.l_partkey == p.p_partkey)
            .join(c.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
            .drop("o_orderkey", "p_partkey", "c_custkey"))


@query("i2_first_sliders", " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name FROM (SELECT 1) x" for i, c in enumerate(
        [c for c in _WIDE_NUMERIC if c != "l_extendedprice"][:12])))
def i2_first_sliders(spark, sf):
    wide = _wide(spark, sf)
    info = P.collect_info(P.profile(wide, distinct="hybrid"))   # of the counts only the types are asked
    cols = I.slider_columns(wide, info, "l_extendedprice", limit=12)
    return I.slider_bounds(wide, cols).select("position", "column_name")


_SCEN_SQL = f"""WITH b AS ({_BOUNDS_SQL}), s AS (
  SELECT b.column_name AS swept, g.step, b.min + (b.max - b.min) * g.step / 4.0 AS v
  FROM b, (SELECT unnest(range(0, 5)) AS step) g
  UNION ALL SELECT NULL, -1, NULL)
SELECT coalesce(swept, 'baseline') || ':' || CAST(step AS VARCHAR) AS scenario, swept, CAST(step AS INTEGER) AS step,
  {", ".join(f"round(CASE WHEN swept = '{c}' THEN v ELSE (SELECT mean FROM b WHERE column_name = '{c}') END, 4) AS {c}" for c in _I_COLS)}
FROM s"""


@query("i3_scenario_table", _SCEN_SQL)
def i3_scenario_table(spark, sf):
    t, cols = _targets_and_sliders(spark, sf)
    sc = I.scenario_table(I.slider_bounds(t, cols), cols, steps=5)
    return sc.select("scenario", "swept", "step", *[F.round(c, 4).alias(c) for c in cols])


# ===========================================================================
# J. Narrative facts
# ===========================================================================

_M = f"({V.LINEITEM_MESSY_SQL})"
_J1_CAT = ["l_returnflag", "l_linestatus", "flag_text"]


def _pct(x: str) -> str:
    return f"coalesce(printf('%.2f', {x}), 'nan')"


def _n4(x: str) -> str:
    return f"coalesce(printf('%.4f', {x}), 'nan')"


@query("j1_eda_facts", f"""WITH p AS ({O.profile_sql('lineitem_messy')}), s AS ({_STATS_SQL}),
tv AS ({O.union_all([_top_sql('lineitem_messy', c) for c in _J1_CAT])}),
t3 AS (SELECT column_name, '[' || string_agg('''' || value || '''', ', ' ORDER BY value_rank) || ']' AS top3
       FROM tv WHERE value_rank <= 3 GROUP BY column_name)
SELECT p.ordinal, p.column_name, CASE
  WHEN p.semantic_type = 'numeric' THEN printf('- %s (numeric): mean=%s, std=%s, missing=%s%%', p.column_name, {_n4('s.mean')}, {_n4('s.std')}, {_pct('p.missing_pct')})
  ELSE printf('- %s (categorical): %d unique values, top: %s, missing=%s%%', p.column_name, p.n_unique, coalesce(t3.top3, '[]'), {_pct('p.missing_pct')}) END AS line
FROM p LEFT JOIN s ON p.column_name = s.column_name LEFT JOIN t3 ON p.column_name = t3.column_name
WHERE p.semantic_type IN ('numeric', 'categorical')""")
def j1_eda_facts(spark, sf):
    df = V.lineitem_messy(spark, sf)
    prof = P.profile(df)
    info = P.collect_info(prof)
    report = E.eda_report(prof, E.numeric_summary(df, info.of_type("numeric")))
    top = E.top_values(df, info.of_type("categorical"))
    return J.eda_facts(report, top)


@query("j2_result_facts", f"""WITH c AS ({_CLS_METRICS_SQL} SELECT * FROM m), r AS ({_REG_METRICS_SQL} SELECT * FROM m)
SELECT 'classification' AS task, model, ordinal, printf('- %s: Accuracy=%s, F1 Weighted=%s, F1 Macro=%s', model, {_n4('accuracy')}, {_n4('f1_weighted')}, {_n4('f1_macro')}) AS line FROM c
UNION ALL SELECT 'regression', model, ordinal, printf('- %s: R2=%s, RMSE=%s, MAE=%s', model, {_n4('r2')}, {_n4('rmse')}, {_n4('mae')}) FROM r""")
def j2_result_facts(spark, sf):
    cls = G.classification_metrics(V.order_status_rules(spark, sf))
    reg = G.regression_metrics(V.net_price_rules(spark, sf))
    return (J.result_facts(cls, "classification").select(F.lit("classification").alias("task"), "*")
            .unionByName(J.result_facts(reg, "regression").select(F.lit("regression").alias("task"), "*")))


@query("j3_question_context", f"""WITH c AS ({_CLS_METRICS_SQL} SELECT * FROM m), p AS ({O.profile_sql('orders')})
SELECT 'performance' AS section, ordinal, printf('- %s: Accuracy=%s, F1=%s', model, {_n4('accuracy')}, {_n4('f1_weighted')}) AS line FROM c
UNION ALL SELECT 'columns', ordinal, printf('- %s: %s, missing=%s%%', column_name, semantic_type, {_pct('missing_pct')}) FROM p""")
def j3_question_context(spark, sf):
    cls = G.classification_metrics(V.order_status_rules(spark, sf))
    prof = P.profile(V.relation(spark, sf, "orders"))
    return J.question_context(prof, cls, "classification")


_JSON_USER = ("json_object('task', 'regression', 'target_col', 'conv_' || CAST(conv_id AS VARCHAR), "
              "'question_type', 'prediction', 'rephrased', text)")
_REPLIES_SQL = f"""SELECT conv_id, turn, role, text AS question, CASE role
  WHEN 'assistant' THEN text
  WHEN 'user' THEN '```json' || chr(10) || CAST({_JSON_USER} AS VARCHAR) || chr(10) || '```'
  ELSE '  ' || CAST(json_object('task', 'eda', 'rephrased', text) AS VARCHAR) || chr(10) END AS reply FROM conversations"""


def _replies(spark, sf):
    """Replies derived from the conversations: assistant prose (unparseable),
    fenced JSON routes built from user turns, and bare JSON with missing keys
    built from system turns."""
    c = V.load_testdata(spark, sf, "conversations")
    user_json = F.to_json(F.struct(F.lit("regression").alias("task"),
                                   F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("target_col"),
                                   F.lit("prediction").alias("question_type"), F.col("text").alias("rephrased")))
    sys_json = F.to_json(F.struct(F.lit("eda").alias("task"), F.col("text").alias("rephrased")))
    reply = (F.when(F.col("role") == "assistant", F.col("text"))
             .when(F.col("role") == "user", F.concat(F.lit("```json\n"), user_json, F.lit("\n```")))
             .otherwise(F.concat(F.lit("  "), sys_json, F.lit("\n"))))
    return c.select("conv_id", "turn", "role", F.col("text").alias("question"), reply.alias("reply"))


_CLEAN = "regexp_replace(replace(replace(regexp_replace(reply, '^\\s+|\\s+$', '', 'g'), '```json', ''), '```', ''), '^\\s+|\\s+$', '', 'g')"


@query("j5_route_replies", f"""WITH r AS ({_REPLIES_SQL}), c AS (SELECT *, {_CLEAN} AS clean FROM r),
v AS (SELECT *, CASE WHEN json_valid(clean) THEN json_type(clean) = 'OBJECT' ELSE false END AS ok FROM c)
SELECT conv_id, turn, CASE WHEN ok THEN json_extract_string(clean, '$.task') ELSE 'eda' END AS task,
  CASE WHEN ok THEN json_extract_string(clean, '$.target_col') END AS target_col,
  CASE WHEN ok THEN json_extract_string(clean, '$.question_type') ELSE 'exploration' END AS question_type,
  CASE WHEN ok THEN json_extract_string(clean, '$.rephrased') ELSE question END AS rephrased, ok AS parsed FROM v""")
def j5_route_replies(spark, sf):
    routed = J.parse_routes(_replies(spark, sf), "reply", "question")
    return routed.select("conv_id", "turn", "task", "target_col", "question_type", "rephrased", "parsed")


@query("j6_recent_questions", """SELECT conv_id, CAST(recency AS INTEGER) AS recency, turn, text AS question FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS recency FROM conversations WHERE role = 'user') x
WHERE recency <= 5""")
def j6_recent_questions(spark, sf):
    return J.recent_questions(V.load_testdata(spark, sf, "conversations"))
