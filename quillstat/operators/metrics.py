"""Metrics, leaderboard and model choice.

Predictions arrive as rows (model, ordinal, label, prediction) for any number
of models at once, so every metric of every model is one grouped aggregate.
F1 first counts (class, support, predicted, true positives) per model with
map-side partial aggregation (classes are few), then averages per model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.functions.exprs import SMALL_DATA_ROWS

CLASSIFICATION_METRICS = ["accuracy", "f1_weighted", "f1_macro"]
REGRESSION_METRICS = ["r2", "rmse", "mae"]


def _r(c: Column, digits: int) -> Column:
    return F.round(c, digits) + F.lit(0.0)


def class_counts(preds: DataFrame, group: list[str]) -> DataFrame:
    """Per (group, class): support, predicted count and true positives.

    Classes are those seen in the truth **or** in the predictions.
    """
    hit = (F.col("label") == F.col("prediction")).cast("int")
    stacked = preds.select(*group, F.explode(F.array(
        F.struct(F.col("label").cast("string").alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"), hit.alias("hit")),
        F.struct(F.col("prediction").cast("string").alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("hit")),
    )).alias("e")).select(*group, "e.*")
    return stacked.groupBy(*group, "cls").agg(
        F.sum("t").alias("support"), F.sum("p").alias("n_pred"), F.sum("hit").alias("tp"))


def classification_metrics(preds: DataFrame, group: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Accuracy, weighted F1 and macro F1 (zero division gives 0)."""
    group = group or ["model", "ordinal"]
    c = class_counts(preds, group)
    denom = F.col("support") + F.col("n_pred")
    f1 = F.when(denom > 0, 2.0 * F.col("tp") / denom).otherwise(F.lit(0.0))
    return (c.withColumn("f1", f1).groupBy(*group).agg(
        _r(F.sum("tp") / F.sum("support"), digits).alias("accuracy"),
        _r(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), digits).alias("f1_weighted"),
        _r(F.avg("f1"), digits).alias("f1_macro"),
        F.sum("support").alias("n_rows")))


def regression_metrics(preds: DataFrame, group: list[str] | None = None, digits: int = 4) -> DataFrame:
    """R² (constant truth: 1 if exact else 0), RMSE and MAE."""
    group = group or ["model", "ordinal"]
    e = F.col("label") - F.col("prediction")
    sse = F.sum(e * e)
    sst = F.var_pop("label") * F.count("label")
    r2 = (F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1 - sse / F.nullif(sst, F.lit(0.0))))
    return preds.groupBy(*group).agg(
        _r(r2, digits).alias("r2"), _r(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
        _r(F.avg(F.abs(e)), digits).alias("mae"), F.count(F.lit(1)).alias("n_rows"))


def quality_band(task: str) -> Column:
    """The reference's reading guide as a column."""
    if task == "classification":
        s = F.col("f1_weighted")
        return F.when(s > 0.8, "strong").when(s >= 0.6, "acceptable").otherwise("poor")
    s = F.col("r2")
    return (F.when(s > 0.8, "strong").when(s >= 0.5, "acceptable").when(s >= 0, "weak")
            .otherwise("negative"))


def leaderboard(metrics: DataFrame, task: str, data_rows: int | None = None) -> DataFrame:
    """G7 / G8 + G10 + G13 + G14: sorted by the main score, ties by insertion order.

    ``data_rows`` is the number of rows of the data set; without it the rows
    predicted stand for it.

    The window ranks models (a handful of rows), not data.
    """
    score = "f1_weighted" if task == "classification" else "r2"
    cols = CLASSIFICATION_METRICS if task == "classification" else REGRESSION_METRICS
    w = Window.orderBy(F.desc(score), F.asc("ordinal"))
    return metrics.select(
        F.row_number().over(w).cast("int").alias("position"), "model", "ordinal", *cols,
        (F.col("f1_weighted") == 1.0 if task == "classification" else F.lit(False)).alias("suspicious"),
        quality_band(task).alias("band"),
        ((F.col("n_rows") if data_rows is None else F.lit(data_rows)) < SMALL_DATA_ROWS).alias("small_data"))


def reliable(task: str) -> Column:
    """G11 rule: classification excludes F1 >= 1; regression keeps 0 <= R² <= 0.99."""
    if task == "classification":
        return F.col("f1_weighted") < 1.0
    return F.col("r2").between(0.0, 0.99)


def best_model(metrics: DataFrame, task: str) -> DataFrame:
    """Best reliable model, else best overall flagged ``trusted = false``."""
    score = "f1_weighted" if task == "classification" else "r2"
    ranked = metrics.select("model", "ordinal", F.col(score).alias("score"),
                            F.coalesce(reliable(task), F.lit(False)).alias("__ok"))
    any_ok = F.max(F.col("__ok").cast("int")).over(Window.partitionBy())
    return (ranked.withColumn("trusted", any_ok == 1)
            .orderBy(F.desc("__ok"), F.desc("score"), F.asc("ordinal")).limit(1)
            .select(F.lit(task).alias("task"), "model", "score", "trusted"))


def metrics_long(metrics: DataFrame, task: str) -> DataFrame:
    """Wide to long (model, variable, value); regression shows its two errors."""
    cols = CLASSIFICATION_METRICS if task == "classification" else ["rmse", "mae"]
    return metrics.unpivot(["model"], cols, "variable", "value")


def drop_bookkeeping(df: DataFrame, col: str = "model") -> DataFrame:
    """Entries whose name starts with '_' are bookkeeping, not models."""
    return df.where(~F.col(col).startswith("_"))
