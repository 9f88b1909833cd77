"""Result keeping: tables as parquet, fitted models, and whole analyses that another session scores with."""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession

from quillstat.operators import models as M
from quillstat.operators.boosting import Booster
from quillstat.operators.prepare import FeatureModel
from quillstat.operators.profile import ColumnInfo, DatasetInfo
from quillstat.plans.analysis import Analysis

_FOREST = {"RandomForestClassificationModel": RandomForestClassificationModel, "RandomForestRegressionModel": RandomForestRegressionModel}


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a result table (leaderboard, predictions, profile) as parquet."""
    df.write.mode(mode).parquet(path)
    return path


def save_model(model, path: str, spark: SparkSession | None = None) -> str:
    """Persist a fitted model for later scoring: boosted candidates as a table of trees, others with MLlib's writer."""
    if isinstance(model, Booster):
        model.save(path, spark or SparkSession.active())
    else:
        model.write().overwrite().save(path)
    return path


def _write_text(spark: SparkSession, path: str, body: dict) -> None:
    spark.createDataFrame([(json.dumps(body),)], "body string").coalesce(1).write.mode("overwrite").parquet(path)


def save_analysis(a: Analysis, path: str) -> str:
    """The fitted preparation, class names and every model of an analysis, as a folder that any session can read."""
    f, spark = a.features, a.features.dictionary.sparkSession
    kinds = {}
    for name, model in a.models.items():
        if isinstance(model, M.StackModel):
            save_model(model.meta, f"{path}/models/{name}", spark)
            kinds[name] = ["stack", list(model.bases)]
        else:
            save_model(model, f"{path}/models/{name}", spark)
            kinds[name] = [type(model).__name__]
    f.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    if a.label_map is not None:
        a.label_map.write.mode("overwrite").parquet(f"{path}/classes")
    _write_text(spark, f"{path}/about", {
        "task": a.task, "target": a.target, "validated_on": a.validated_on, "n_classes": a.n_classes, "classes": a.label_map is not None, "models": kinds,
        "info": [a.info.n_rows, a.info.n_cols, [c.__dict__ for c in a.info.columns.values()]],
        "features": {k: getattr(f, k) for k in ("target", "numeric", "encoded", "temporal", "dropped", "medians", "scalers", "dict_sizes", "features")}})
    return path


def load_analysis(spark: SparkSession, path: str) -> Analysis:
    """A saved analysis, ready to ``score`` tables and streams; its training rows, predictions and metrics stay behind."""
    about = json.loads(spark.read.parquet(f"{path}/about").first().body)
    n_rows, n_cols, columns = about["info"]
    info = DatasetInfo(n_rows, n_cols, {c["name"]: ColumnInfo(**c) for c in columns})
    kept = about["features"] | {"scalers": {k: tuple(v) for k, v in about["features"]["scalers"].items()}}
    models: dict = {}
    for name, (kind, *more) in sorted(about["models"].items(), key=lambda x: x[1][0] == "stack"):  # bases first
        at = f"{path}/models/{name}"
        if kind == "stack":
            models[name] = M.StackModel({b: M._wrap(models[b], b) for b in more[0]}, LogisticRegressionModel.load(at))
        else:
            models[name] = Booster.load(at, spark) if kind == "Booster" else _FOREST[kind].load(at)
    return Analysis(info, about["task"], about["target"], FeatureModel(**kept, dictionary=spark.read.parquet(f"{path}/dictionary")), None, None, None,
                    about["validated_on"], about["n_classes"], spark.read.parquet(f"{path}/classes") if about["classes"] else None, models)
