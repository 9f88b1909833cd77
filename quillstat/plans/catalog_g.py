"""Catalogue section G: metrics, leaderboard and model choice on rule predictions.

The rule 'models' (views.order_status_rules / net_price_rules) are
deterministic functions of the table, so each metric has an exact SQL twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.operators import metrics as G
from quillstat.plans import views as V
from quillstat.plans.registry import query, union_all

_CLS = f"({V.ORDER_STATUS_RULES_SQL})"
_REG = f"({V.NET_PRICE_RULES_SQL})"

_CLS_METRICS_SQL = f"""WITH p AS (SELECT * FROM {_CLS} r),
c AS (SELECT model, ordinal, cls, CAST(sum(t) AS DOUBLE) AS support, CAST(sum(pp) AS DOUBLE) AS n_pred,
             CAST(sum(hit) AS DOUBLE) AS tp FROM (
  SELECT model, ordinal, CAST(label AS VARCHAR) AS cls, 1 AS t, 0 AS pp, CAST(label = prediction AS INTEGER) AS hit FROM p
  UNION ALL SELECT model, ordinal, CAST(prediction AS VARCHAR), 0, 1, 0 FROM p) x GROUP BY 1, 2, 3),
f AS (SELECT *, CASE WHEN support + n_pred > 0 THEN 2.0 * tp / (support + n_pred) ELSE 0.0 END AS f1 FROM c),
m AS (SELECT model, ordinal, round(sum(tp) / sum(support), 4) + 0.0 AS accuracy,
         round(sum(f1 * support) / sum(support), 4) + 0.0 AS f1_weighted, round(avg(f1), 4) + 0.0 AS f1_macro,
         CAST(sum(support) AS BIGINT) AS n_rows FROM f GROUP BY 1, 2)"""

_REG_METRICS_SQL = f"""WITH p AS (SELECT * FROM {_REG} r),
a AS (SELECT model, ordinal, sum((label - prediction) * (label - prediction)) AS sse,
        var_pop(label) * count(label) AS sst, avg((label - prediction) * (label - prediction)) AS mse,
        avg(abs(label - prediction)) AS mae, count(*) AS n_rows FROM p GROUP BY 1, 2),
m AS (SELECT model, ordinal,
        round(CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END) ELSE 1 - sse / sst END, 4) + 0.0 AS r2,
        round(sqrt(mse), 4) + 0.0 AS rmse, round(mae, 4) + 0.0 AS mae, n_rows FROM a)"""


def _cls(spark, sf):
    return G.classification_metrics(V.order_status_rules(spark, sf))


def _reg(spark, sf):
    return G.regression_metrics(V.net_price_rules(spark, sf))


@query("g1_accuracy", f"{_CLS_METRICS_SQL} SELECT model, accuracy FROM m")
def g1_accuracy(spark, sf):
    return _cls(spark, sf).select("model", "accuracy")


@query("g2_f1_weighted", f"{_CLS_METRICS_SQL} SELECT model, f1_weighted FROM m")
def g2_f1_weighted(spark, sf):
    return _cls(spark, sf).select("model", "f1_weighted")


@query("g3_f1_macro", f"{_CLS_METRICS_SQL} SELECT model, f1_macro FROM m")
def g3_f1_macro(spark, sf):
    return _cls(spark, sf).select("model", "f1_macro")


@query("g4_r2", f"{_REG_METRICS_SQL} SELECT model, r2 FROM m")
def g4_r2(spark, sf):
    return _reg(spark, sf).select("model", "r2")


@query("g5_rmse", f"{_REG_METRICS_SQL} SELECT model, rmse FROM m")
def g5_rmse(spark, sf):
    return _reg(spark, sf).select("model", "rmse")


@query("g6_mae", f"{_REG_METRICS_SQL} SELECT model, mae FROM m")
def g6_mae(spark, sf):
    return _reg(spark, sf).select("model", "mae")


def _band_sql(task: str) -> str:
    if task == "classification":
        return "CASE WHEN f1_weighted > 0.8 THEN 'strong' WHEN f1_weighted >= 0.6 THEN 'acceptable' ELSE 'poor' END"
    return ("CASE WHEN r2 > 0.8 THEN 'strong' WHEN r2 >= 0.5 THEN 'acceptable' WHEN r2 >= 0 THEN 'weak' "
            "ELSE 'negative' END")


@query("g7_leaderboard_classification", f"""{_CLS_METRICS_SQL}
SELECT CAST(row_number() OVER (ORDER BY f1_weighted DESC, ordinal) AS INTEGER) AS position, model, ordinal,
  accuracy, f1_weighted, f1_macro, f1_weighted = 1.0 AS suspicious, {_band_sql('classification')} AS band,
  n_rows < 200 AS small_data FROM m""")
def g7_leaderboard_classification(spark, sf):
    return G.leaderboard(_cls(spark, sf), "classification")


@query("g8_leaderboard_regression", f"""{_REG_METRICS_SQL}
SELECT CAST(row_number() OVER (ORDER BY r2 DESC, ordinal) AS INTEGER) AS position, model, ordinal,
  r2, rmse, mae, false AS suspicious, {_band_sql('regression')} AS band, n_rows < 200 AS small_data FROM m""")
def g8_leaderboard_regression(spark, sf):
    return G.leaderboard(_reg(spark, sf), "regression")


@query("g9_drop_bookkeeping", f"""{_CLS_METRICS_SQL}
SELECT model, accuracy FROM (SELECT model, accuracy FROM m
  UNION ALL SELECT '_validation', CAST(count(*) AS DOUBLE) FROM orders) x WHERE NOT starts_with(model, '_')""")
def g9_drop_bookkeeping(spark, sf):
    book = V.load_testdata(spark, sf, "orders").agg(
        F.lit("_validation").alias("model"), F.count(F.lit(1)).cast("double").alias("accuracy"))
    return G.drop_bookkeeping(_cls(spark, sf).select("model", "accuracy").unionByName(book))


@query("g10_suspicious_flag", f"{_CLS_METRICS_SQL} SELECT model, f1_weighted = 1.0 AS suspicious FROM m")
def g10_suspicious_flag(spark, sf):
    return G.leaderboard(_cls(spark, sf), "classification").select("model", "suspicious")


@query("g11_best_model", f"""WITH c AS ({_CLS_METRICS_SQL} SELECT * FROM m),
r AS ({_REG_METRICS_SQL} SELECT * FROM m)
(SELECT 'classification' AS task, model, f1_weighted AS score,
   (SELECT bool_or(f1_weighted < 1.0) FROM c) AS trusted FROM c
 ORDER BY (f1_weighted < 1.0) DESC, f1_weighted DESC, ordinal LIMIT 1)
UNION ALL
(SELECT 'regression', model, r2, (SELECT bool_or(r2 BETWEEN 0 AND 0.99) FROM r) FROM r
 ORDER BY (r2 BETWEEN 0 AND 0.99) DESC, r2 DESC, ordinal LIMIT 1)""")
def g11_best_model(spark, sf):
    return G.best_model(_cls(spark, sf), "classification").unionByName(
        G.best_model(_reg(spark, sf), "regression"))


@query("g12_metrics_long", f"""WITH c AS ({_CLS_METRICS_SQL} SELECT * FROM m), r AS ({_REG_METRICS_SQL} SELECT * FROM m)
SELECT model, 'accuracy' AS variable, accuracy AS value FROM c UNION ALL SELECT model, 'f1_weighted', f1_weighted FROM c
UNION ALL SELECT model, 'f1_macro', f1_macro FROM c
UNION ALL SELECT model, 'rmse', rmse FROM r UNION ALL SELECT model, 'mae', mae FROM r""")
def g12_metrics_long(spark, sf):
    return G.metrics_long(_cls(spark, sf), "classification").unionByName(
        G.metrics_long(_reg(spark, sf), "regression"))


@query("g13_quality_band", f"""WITH c AS ({_CLS_METRICS_SQL} SELECT * FROM m), r AS ({_REG_METRICS_SQL} SELECT * FROM m)
SELECT 'classification' AS task, model, {_band_sql('classification')} AS band FROM c
UNION ALL SELECT 'regression', model, {_band_sql('regression')} FROM r""")
def g13_quality_band(spark, sf):
    return union_all([G.leaderboard(m, t).select(F.lit(t).alias("task"), "model", "band")
                      for t, m in (("classification", _cls(spark, sf)), ("regression", _reg(spark, sf)))])


_SIZES = ["region", "nation", "supplier", "customer", "orders"]


@query("g14_small_data", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) < 200 AS small_data FROM {t}" for t in _SIZES))
def g14_small_data(spark, sf):
    return union_all([V.load_testdata(spark, sf, t).agg(
        F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) < 200).alias("small_data")) for t in _SIZES])
