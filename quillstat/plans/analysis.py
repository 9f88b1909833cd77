"""End-to-end analysis (the reference's main path, SURVEY §3 entry 1):
profile -> task and target -> split -> fitted preparation -> candidates ->
predictions -> metrics -> leaderboard -> best model.

Everything heavy is a Spark job; the driver holds the profile (one row per
column), fitted scalars and the trees.  The assembled training/validation
rows are checkpointed to the cluster's shared checkpoint folder before the
fits, so an executor loss during training recomputes from that copy instead
of from the raw scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators import boosting as B
from quillstat.operators import explain as H
from quillstat.operators import metrics as G
from quillstat.operators import models as M
from quillstat.operators import prepare as D
from quillstat.operators import profile as P
from quillstat.session import cut_lineage


#: folds of the stack's out-of-fold probabilities
FOLDS = 3
#: rows of a cached block of the prepared table
CACHED_ROWS = 250_000


def cached_blocks(rows: int) -> int:
    """Partitions of the prepared table: those of boosting, or where blocks would be large, so many that boosting puts several together."""
    small = -(-rows // CACHED_ROWS)
    return small if small > 2 * B.tasks_for(rows) else B.tasks_for(rows)


@dataclass
class Analysis:
    info: P.DatasetInfo
    task: str
    target: str
    features: D.FeatureModel
    assembled: DataFrame          # row_key, label, is_validation, weight, features
    train: DataFrame
    val: DataFrame
    validated_on: str
    n_classes: int
    label_map: DataFrame | None
    models: dict = field(default_factory=dict)
    predictions: DataFrame | None = None
    metrics: DataFrame | None = None
    stack_predictions: DataFrame | None = None

    def leaderboard(self) -> DataFrame:
        return G.leaderboard(self.metrics, self.task, self.info.n_rows)

    def best(self) -> DataFrame:
        return G.best_model(self.metrics, self.task)

    def score(self, df: DataFrame, model: str) -> DataFrame:
        """I4: score new rows (a scenario table, a stream) through the same fitted
        preparation and model."""
        missing = [c for c in self.info.columns if c not in df.columns and c != self.target]
        for c in missing:  # unset inputs are missing values, imputed like any other
            kind = self.info.columns[c].physical_type
            df = df.withColumn(c, F.lit(None).cast(kind))
        x = self.features.transform(df)
        x = VectorAssembler(inputCols=self.features.features, outputCol="features",
                            handleInvalid="keep").transform(x)
        return self.decoded(self.models[model].transform(x))

    def decoded(self, scored: DataFrame) -> DataFrame:
        """Adds ``predicted_class``, the original value of a class number (classification only)."""
        if self.label_map is None or "prediction" not in scored.columns:
            return scored
        names = self.label_map.select(F.col("label").alias("prediction"), F.col("value").alias("predicted_class"))
        return scored.join(names, "prediction", "left")

    def draws(self, orders: int = 4, background: int = 4) -> list[H.Draw]:
        """Orders and training rows for explanations from samples."""
        return H.draws(H.background_rows(self.train, background), len(self.features.features), orders)

    def contributions(self, model: str, rows: DataFrame | None = None, orders: int = 4, background: int = 4) -> DataFrame:
        """H1: tree SHAP of a fitted model (default: of the validation rows); numbered classes get their original values.

        H2: the stack is explained from samples, by the probabilities of its classes.
        """
        rows, feats = self.val if rows is None else rows, self.features.features
        if isinstance(self.models[model], M.StackModel):
            taken = self.draws(orders, background)
            out = H.sampled_contributions(rows, "row_key", feats, H.model_score(self.models[model]), [str(k) for k in range(self.n_classes)],
                                          taken, tasks=B.tasks_for(rows.count() * len(taken) * (len(feats) + 1)))
        else:
            out = H.tree_contributions(rows, "row_key", feats, H.ensemble_arrays(self.models[model]))
        if self.label_map is None:
            return out
        names = self.label_map.select(F.col("label").cast("int").cast("string").alias("class"), F.col("value").cast("string").alias("__name"))
        return out.join(names, "class", "left").select("row_key", F.coalesce("__name", "class").alias("class"), "feature", "contribution")


def prepare_training(df: DataFrame, target: str, task: str | None = None, keys: list[str] | None = None,
                     fit_scope: str = "train", exact_split: bool = False, checkpoint: bool = True,
                     max_features: int | None = None) -> Analysis:
    """B/D/E steps up to the assembled, split, weighted training rows."""
    prof = P.profile(df, distinct="hybrid")   # exact wherever a decision depends on it
    info = P.collect_info(prof)
    if task is None:
        choice = P.default_choice(prof).first()
        task = choice["task"] if choice else "regression"
    rows = df.withColumn("row_key", D.row_key(df, keys)).where(F.col(f"`{target}`").isNotNull())
    if task == "classification":
        n_hint = info.columns[target].n_unique if target in info.columns else None
        rows, label_map = D.encode_target(rows, target, "label", n_hint)
    else:
        rows, label_map = rows.withColumn("label", F.col(f"`{target}`").cast("double")), None
    split_keys = ["row_key"]
    rows, _ = D.split(rows, "label" if task == "classification" else None, split_keys,
                      stratify=task == "classification", exact=exact_split)
    # the preparation is fitted in several passes (dictionaries, medians,
    # scalers); keep the keyed, split input for them instead of rescanning
    # (as objects: a block on disk is read back piece by piece, not as one buffer of its size)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    fit_rows = rows.where(~F.col("is_validation")) if fit_scope == "train" else rows
    fm = D.fit_features(df, info, target, fit_rows=fit_rows)
    feats = fm.features[:max_features] if max_features else fm.features       # E5: first n features
    fm.features = feats
    x = fm.transform(rows)
    x = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep").transform(x)
    x = x.select("row_key", "label", "is_validation", "features")
    n_classes = 0
    if task == "classification":
        x, kept = D.relabel_from_train(x, "label", n_hint=n_hint)               # E9 + E10
        # one map from the classes that were trained on to their numbers
        label_map = label_map.join(kept, "label").select("value", F.col("train_label").alias("label"))
        if n_hint is not None and n_hint <= D.CLASS_TABLE_ROWS:   # read by every later join: kept as rows, not scanned for again
            label_map = D.class_table(df.sparkSession.createDataFrame(label_map.collect(), label_map.schema), n_hint)
        x = x.withColumn("label", F.col("train_label")).drop("train_label")
        # Weights from the training rows' class counts (a table of at most
        # 20 rows), joined to every row in one pass; validation rows weigh 1
        w = D.class_weights(x.where(~F.col("is_validation")), "label").select("label", F.col("weight").alias("__w"))
        x = (x.join(F.broadcast(w), "label", "left")
             .withColumn("weight", F.when(F.col("is_validation"), F.lit(1.0)).otherwise(F.col("__w")))
             .drop("__w"))
    else:
        x = x.withColumn("weight", F.lit(1.0))
    # the checkpoint cuts lineage (a lost block is re-read from the shared
    # folder, not recomputed from the scan); the persisted copy serves the
    # repeated passes of the candidate fits from memory
    # partitions follow the number of rows, not the cores: a cached block, which may go
    # from one executor to another as a whole, does not grow with them
    x = x.repartition(cached_blocks(info.n_rows), "row_key")
    x = (cut_lineage(x) if checkpoint else x).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    rows.unpersist()
    if task == "classification":
        n_classes = x.where(~F.col("is_validation")).select("label").distinct().count()
    train, val, on_train = D.validation_or_train(x)                             # E11
    return Analysis(info, task, target, fm, x, train, val, "train" if on_train else "validation",
                    n_classes, label_map)


def run(df: DataFrame, target: str, task: str | None = None, keys: list[str] | None = None,
        params: M.TreeParams | None = None, candidates: list[M.Candidate] | None = None,
        stack: bool = True, **kw) -> Analysis:
    """The whole analysis; returns fitted models, predictions and metrics."""
    return fit(prepare_training(df, target, task, keys, **kw), params, candidates, stack)


def fit(a: Analysis, params: M.TreeParams | None = None, candidates: list[M.Candidate] | None = None, stack: bool = True) -> Analysis:
    """Train the candidates (and, for classes, the stack) of a prepared analysis that it does not hold yet; one pass trains them side by side."""
    params = params or M.TreeParams()
    cands = candidates or (M.CLASSIFICATION_CANDIDATES if a.task == "classification" else M.REGRESSION_CANDIDATES)
    k = max(a.n_classes, 2)
    stack = stack and a.task == "classification" and a.n_classes >= 2
    fresh = [c for c in cands if c.name not in a.models]
    folds = FOLDS if stack and "stacking" not in a.models else 0
    models = M.fit_models(cands if folds else fresh, a.train, params, k, folds, full=bool(fresh)) if fresh or folds else {}
    a.models = {**a.models, **{c.name: models[c.name] for c in fresh}}
    # scored once: the leaderboard and every later reader take the written predictions
    if fresh:
        new = cut_lineage(M.predictions_of(fresh, a.models, a.val))
        a.predictions = new if a.predictions is None else a.predictions.unionByName(new)
    if folds:
        a.models["stacking"], scored = M.stacking(cands, a.train, a.val, params, k, FOLDS, fitted={**models, **a.models})
        a.stack_predictions = cut_lineage(scored)
        a.predictions = a.predictions.unionByName(
            a.stack_predictions.select(F.lit("stacking").alias("model"), F.lit(len(cands)).alias("ordinal"), "row_key", "label", "prediction"))
    a.metrics = G.classification_metrics(a.predictions) if a.task == "classification" else G.regression_metrics(a.predictions)
    return a
