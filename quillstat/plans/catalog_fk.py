"""Catalogue sections F (models), model-backed H1/I4/I5, and K (protocol).

Fitted trees have no SQL twin: model queries return, per row, what
SQL can also tell (keys, original classes) and the properties that must hold
(probabilities, additivity, a floor for F1 or R2).  One prepared analysis per
(session, data folder, scenario) is memoised; its candidates are trained, side by
side, when a query first needs them, and the stack's fold models with them or
when a query first needs the stack.  Query fits have the library's default
size, the reference's 100 trees of depth 7.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillstat.functions.exprs import SPLIT_BOUND
from quillstat.operators import explain as H
from quillstat.operators import metrics as G
from quillstat.operators import models as M
from quillstat.operators import protocol as K
from quillstat.operators import whatif as I
from quillstat.plans import analysis as A
from quillstat.plans import views as V
from quillstat.plans.registry import query

QUERY_PARAMS = M.TreeParams()
_KEYS = ["l_orderkey", "l_linenumber"]
_SCENARIOS = {
    "binary": ("is_big", "classification", ["net_price", "qty_band"]),
    "multiclass": ("qty_band", "classification", ["net_price", "is_big"]),
    "regression": ("net_price", "regression", ["is_big", "qty_band"]),
}
_MEMO: dict = {}


def prepared(spark, sf: str, scenario: str) -> A.Analysis:
    """The scenario up to its training rows; nothing is fitted."""
    key = (spark.sparkContext.applicationId, sf, scenario)
    if key not in _MEMO:
        target, task, drop = _SCENARIOS[scenario]
        _MEMO[key] = A.prepare_training(V.lineitem_targets(spark, sf).drop(*drop), target, task, keys=_KEYS)
    return _MEMO[key]


def fitted(spark, sf: str, scenario: str, stack: bool = False) -> A.Analysis:
    a = prepared(spark, sf, scenario)
    if a.metrics is None or (stack and "stacking" not in a.models):
        A.fit(a, QUERY_PARAMS, stack=stack)
    return a


FLOOR = 0.8   # F1 or R2 that the derived, learnable targets allow every candidate
_KEY_SQL = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"
_VAL_SQL = f"(SELECT *, {_KEY_SQL} AS row_key FROM ({V.LINEITEM_TARGETS_SQL}) t WHERE md5({_KEY_SQL} || '#42') < '{SPLIT_BOUND}') v"


def _class_sql(target: str) -> str:
    return f"SELECT row_key, CAST({target} AS VARCHAR) AS actual, true AS known_class, true AS strong FROM {_VAL_SQL}"


_VALUE_SQL = f"SELECT row_key, round(net_price, 6) AS actual, true AS finite, true AS strong FROM {_VAL_SQL}"


def _checked_classes(a: A.Analysis, preds, score: float):
    """Per validation row its original class, whether the prediction decodes to a class, and whether the model's F1 reaches FLOOR."""
    names = a.label_map.select("label", F.col("value").cast("string").alias("actual"))
    return (a.decoded(preds.select("row_key", "label", "prediction")).join(names, "label", "left")
            .select("row_key", "actual", F.col("predicted_class").isNotNull().alias("known_class"), F.lit(bool(score >= FLOOR)).alias("strong")))


def _classes_of(a: A.Analysis, model: str):
    score = a.metrics.where(F.col("model") == model).first()["f1_weighted"]
    return _checked_classes(a, a.predictions.where(F.col("model") == model), score)


def _values_of(a: A.Analysis, model: str):
    """Per validation row its value (products of hundredths: six digits are no tie to round), whether the prediction is a number, and whether the model's R2 reaches FLOOR."""
    score = a.metrics.where(F.col("model") == model).first()["r2"]
    return (a.predictions.where(F.col("model") == model)
            .select("row_key", F.round("label", 6).alias("actual"), _number(F.col("prediction")).alias("finite"), F.lit(bool(score >= FLOOR)).alias("strong")))


def _number(c):
    return F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c)


def _between(x):
    return F.coalesce((x >= 0) & (x <= 1), F.lit(False))


@query("f1_boosted_classifier", _class_sql("is_big"))
def f1_boosted_classifier(spark, sf):
    return _classes_of(fitted(spark, sf, "binary"), "boosted_trees")


@query("f2_balanced_boosted_classifier", _class_sql("is_big"))
def f2_balanced_boosted_classifier(spark, sf):
    return _classes_of(fitted(spark, sf, "binary"), "boosted_trees_balanced")


@query("f3_symmetric_classifier", _class_sql("qty_band"))
def f3_symmetric_classifier(spark, sf):
    return _classes_of(fitted(spark, sf, "multiclass"), "symmetric_trees")


@query("f4_boosted_regressor", _VALUE_SQL)
def f4_boosted_regressor(spark, sf):
    return _values_of(fitted(spark, sf, "regression"), "boosted_trees")


@query("f5_boosted_regressor_min20", _VALUE_SQL)
def f5_boosted_regressor_min20(spark, sf):
    return _values_of(fitted(spark, sf, "regression"), "boosted_trees_min20")


@query("f6_symmetric_regressor", _VALUE_SQL)
def f6_symmetric_regressor(spark, sf):
    return _values_of(fitted(spark, sf, "regression"), "symmetric_trees")


@query("f7_model_leaderboard")
def f7_model_leaderboard(spark, sf):
    return fitted(spark, sf, "binary", stack=True).leaderboard()


@query("f8_class_probabilities", f"""SELECT row_key, class, true AS in_range, true AS sums_to_one
FROM {_VAL_SQL} CROSS JOIN (SELECT unnest(['high', 'low', 'mid']) AS class) c""")
def f8_class_probabilities(spark, sf):
    """Each class's probability is in 0..1 and a row's probabilities sum to one; classes by their original names."""
    a = fitted(spark, sf, "multiclass")
    p = vector_to_array("probability")
    total = F.aggregate(p, F.lit(0.0), lambda acc, v: acc + v)
    scored = a.models["boosted_trees"].transform(a.val).select("row_key", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), F.posexplode(p).alias("label", "p"))
    names = a.label_map.select(F.col("label").cast("int").alias("label"), F.col("value").alias("class"))
    return scored.join(names, "label", "left").select("row_key", "class", _between(F.col("p")).alias("in_range"), "sums_to_one")


@query("f9_stacking", _class_sql("is_big"))
def f9_stacking(spark, sf):
    a = fitted(spark, sf, "binary", stack=True)
    return _classes_of(a, "stacking")


@query("f10_base_probabilities", f"SELECT row_key, 6 AS n_probabilities, true AS in_range FROM {_VAL_SQL}")
def f10_base_probabilities(spark, sf):
    """Three base models and two classes: six probabilities a row."""
    a = fitted(spark, sf, "binary")
    meta = vector_to_array("meta")
    bases = {c.name: M._wrap(a.models[c.name], c.name) for c in M.CLASSIFICATION_CANDIDATES}
    return (M.base_probability_columns(bases, a.val, ["row_key", "label"])
            .select("row_key", F.size(meta).alias("n_probabilities"), F.forall(meta, _between).alias("in_range")))


@query("f11_capped_candidate", f"SELECT 'boosted_trees_first1000' AS model, count(*) AS n_rows, true AS strong FROM {_VAL_SQL}")
def f11_capped_candidate(spark, sf):
    a = prepared(spark, sf, "binary")
    cand = M.Candidate("boosted_trees_first1000", "boosted_trees", 0, "classification", max_train_rows=1000)
    _, preds = M.fit_all([cand], a.train, a.val, QUERY_PARAMS)
    return G.classification_metrics(preds).select("model", "n_rows", (F.col("f1_weighted") >= FLOOR).alias("strong"))


@query("f12_validation_rows", f"SELECT row_key, CAST(is_big AS VARCHAR) AS actual, true AS complete FROM {_VAL_SQL}")
def f12_validation_rows(spark, sf):
    """The kept validation rows with their original class; complete: a number for every feature."""
    a = prepared(spark, sf, "binary")
    names = a.label_map.select("label", F.col("value").cast("string").alias("actual"))
    x = vector_to_array("features")
    return (a.val.join(names, "label", "left")
            .select("row_key", "actual", ((F.size(x) == len(a.features.features)) & F.forall(x, _number)).alias("complete")))


@query("h1_tree_shap", f"SELECT row_key, count(*) AS n_rows, true AS additive FROM {_VAL_SQL} GROUP BY row_key")
def h1_tree_shap(spark, sf):
    """Per row key: rows explained, and whether contributions and base sum to the model's predictions."""
    a = fitted(spark, sf, "regression")
    sums = (a.contributions("boosted_trees").groupBy("row_key")
            .agg(F.sum("contribution").alias("total"), F.count(F.when(F.col("feature") == "__base", 1)).alias("n_rows")))
    want = a.models["boosted_trees"].transform(a.val).groupBy("row_key").agg(F.sum("prediction").alias("want"))
    close = F.abs(F.col("total") - F.col("want")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("want"))
    return sums.join(want, "row_key").select("row_key", "n_rows", close.alias("additive"))


@query("h2_stack_contributions", f"SELECT DISTINCT row_key, true AS additive FROM {_VAL_SQL}")
def h2_stack_contributions(spark, sf):
    """Per row key whether the stack's sampled contributions (an order and its reverse) and base sum to its probabilities."""
    a = fitted(spark, sf, "binary", stack=True)
    names = F.array_sort(F.collect_list(F.struct("class", "p")))
    sums = (a.contributions("stacking", orders=1, background=1).groupBy("row_key", "class").agg(F.sum("contribution").alias("p"))
            .groupBy("row_key").agg(names.alias("got")))
    whole = a.val.withColumn("__x", vector_to_array("features")).dropDuplicates(["row_key", "__x"])   # equal rows are explained once
    labels = a.label_map.select(F.col("label").cast("int").alias("label"), F.col("value").cast("string").alias("class"))
    want = (a.models["stacking"].transform(whole.drop("label", "__x")).select("row_key", F.posexplode(vector_to_array("probability")).alias("label", "v"))
            .join(labels, "label").groupBy("row_key", "class").agg(F.sum("v").alias("p")).groupBy("row_key").agg(names.alias("want")))
    close = F.forall(F.arrays_zip("got", "want"), lambda z: (z["got"]["class"] == z["want"]["class"]) & (F.abs(z["got"]["p"] - z["want"]["p"]) <= 1e-6))
    return sums.join(want, "row_key").select("row_key", (close & (F.size("got") == F.size("want"))).alias("additive"))


@query("i4_scenario_predictions")
def i4_scenario_predictions(spark, sf):
    a = fitted(spark, sf, "regression")
    t = V.lineitem_targets(spark, sf)
    cols = I.slider_columns(t, a.info, a.target)
    table = I.scenario_table(I.slider_bounds(t, cols), cols, steps=5)
    return a.score(table, "boosted_trees").select("scenario", "swept", "step", "prediction")


@query("i5_scenario_probabilities")
def i5_scenario_probabilities(spark, sf):
    a = fitted(spark, sf, "multiclass")
    t = V.lineitem_targets(spark, sf)
    cols = I.slider_columns(t, a.info, a.target)
    table = I.scenario_table(I.slider_bounds(t, cols), cols, steps=5)
    names = F.broadcast(a.label_map.select(F.col("label").cast("int").alias("class"), F.col("value").alias("class_name")))
    return I.class_probabilities(a.score(table, "boosted_trees")).join(names, "class", "left")


@query("k1_cap_per_dataset", """SELECT l_returnflag AS dataset, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS row_key
FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY
  md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '#42'), l_orderkey, l_linenumber) AS rn FROM lineitem) x
WHERE rn <= 2000""")
def k1_cap_per_dataset(spark, sf):
    li = V.load_testdata(spark, sf, "lineitem")
    capped = K.cap_per_dataset(li, "l_returnflag", _KEYS, 2000)
    return capped.select(F.col("l_returnflag").alias("dataset"),
                         F.concat_ws("|", *[F.col(k).cast("string") for k in _KEYS]).alias("row_key"))


@query("k2_drop_rare_classes", """SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (
  SELECT c_nationkey FROM customer GROUP BY c_nationkey HAVING count(*) >= 50)""")
def k2_drop_rare_classes(spark, sf):
    c = V.load_testdata(spark, sf, "customer")
    return K.drop_rare_classes(c, "c_nationkey", n_classes_hint=25).select("c_custkey", "c_nationkey")


@query("k3_rebalance", f"""WITH t AS ({V.LINEITEM_TARGETS_SQL}), c AS (SELECT is_big, count(*) AS n FROM t GROUP BY is_big)
SELECT is_big, false AS synthetic, n AS n_rows FROM c
UNION ALL SELECT is_big, true, (SELECT max(n) FROM c) - n FROM c WHERE n < (SELECT max(n) FROM c)""")
def k3_rebalance(spark, sf):
    t = V.lineitem_targets(spark, sf).withColumn("row_key", F.concat_ws("|", *[F.col(k).cast("string") for k in _KEYS]))
    out = K.rebalance(t, "is_big", "row_key", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.groupBy("is_big", "synthetic").agg(F.count(F.lit(1)).alias("n_rows"))


@query("k4_clusters", f"SELECT {_KEY_SQL} AS row_key, true AS in_range FROM lineitem")
def k4_clusters(spark, sf):
    a = prepared(spark, sf, "binary")
    _, out = K.clusters(a.assembled, k=3)
    return out.select("row_key", F.col("cluster").between(0, 2).alias("in_range"))


@query("k5_isolation_scores", f"SELECT {_KEY_SQL} AS row_key, true AS in_range FROM lineitem")
def k5_isolation_scores(spark, sf):
    a = prepared(spark, sf, "binary")
    trees = K.isolation_forest(a.assembled, "row_key", n_trees=100)
    return K.isolation_scores(a.assembled, "row_key", trees).select("row_key", _between(F.col("anomaly_score")).alias("in_range"))


@query("h5_explain_status")
def h5_explain_status(spark, sf):
    """H5 + H9: which candidates were explained, with the number of
    contribution rows; the stack, here without draws, is reported as skipped
    (``h2_stack_contributions`` explains it), and a failure is a status row
    rather than silent zero importances."""
    a = fitted(spark, sf, "binary", stack=True)
    kinds = {c.name: c.kind for c in M.CLASSIFICATION_CANDIDATES}
    contrib, status = H.explain_models(spark, a.models, kinds, a.val, "row_key", a.features.features)
    if contrib is None:
        return status.withColumn("n_rows", F.lit(None).cast("bigint"))
    counts = contrib.groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"))
    return status.join(F.broadcast(counts), "model", "left")
