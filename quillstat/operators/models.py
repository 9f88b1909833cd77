"""Candidate models.

The reference's three vendor boosting libraries are re-expressed by growth
policy on this library's distributed histogram boosting (``boosting``):

=============================  ======================================================
candidate                      trees (100, depth 7, rate 0.03)
=============================  ======================================================
boosted_trees                  level-wise; row 0.8, column 0.7, L1 0.1, L2 1, least child
                               hessian 3 and gamma 0.1 (regression: 1 and 0)
boosted_trees_balanced         leaf-wise, 31 leaves, balanced class weights, min 20 rows
                               per leaf, row 0.8, column 0.7, L1 0.1, L2 1
boosted_trees_min20            the same for regression
symmetric_trees                one split for a whole level, L2 3; depth 6 for regression
random_forest                  MLlib's forest, on demand
stacking (classification)      logistic regression (1000 iterations, balanced weights)
                               on out-of-fold base probabilities
=============================  ======================================================

Beyond two classes a round grows one tree for each class from one pass (softmax).
Boosted candidates, and the fold models of the stack, are trained side by side in
the same jobs over one cached table; folds are weights.  The driver holds
histograms and fitted trees, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.operators import boosting as B

SEED = 42


@dataclass
class TreeParams:
    """Defaults are the reference's (100 trees, depth 7, rate 0.03)."""
    n_trees: int = 100
    max_depth: int = 7
    step_size: float = 0.03
    subsample: float = 0.8
    column_share: float = 0.7
    l1: float = 0.1
    l2: float = 1.0
    symmetric_l2: float = 3.0
    gamma: float = 0.1
    max_leaves: int = 31
    max_bins: int = 64
    checkpoint_interval: int = 10


@dataclass
class Candidate:
    name: str
    kind: str
    ordinal: int
    task: str
    max_train_rows: int | None = None   # F11: cap the training rows (by key order)
    weighted: bool = False


CLASSIFICATION_CANDIDATES = [
    Candidate("boosted_trees", "boosted_trees", 0, "classification"),
    Candidate("boosted_trees_balanced", "boosted_trees_balanced", 1, "classification", weighted=True),
    Candidate("symmetric_trees", "symmetric_trees", 2, "classification"),
]
REGRESSION_CANDIDATES = [
    Candidate("boosted_trees", "boosted_trees", 0, "regression"),
    Candidate("boosted_trees_min20", "boosted_trees_min20", 1, "regression"),
    Candidate("symmetric_trees", "symmetric_trees", 2, "regression"),
]


def spec(c: Candidate, p: TreeParams, n_classes: int = 2, fold: int | None = None) -> B.Spec:
    """What a candidate asks of the boosting."""
    regression = c.task == "regression"
    objective = "squared" if regression else "logistic" if n_classes <= 2 else "softmax"
    common = dict(name=c.name if fold is None else f"{c.name}#{fold}", objective=objective, classes=n_classes if objective == "softmax" else 1,
                  rounds=p.n_trees, max_depth=p.max_depth, rate=p.step_size, weighted=c.weighted, fold=fold, seed=SEED)
    drawn = dict(row_share=p.subsample, column_share=p.column_share, l1=p.l1, l2=p.l2)
    if c.kind == "boosted_trees":
        return B.Spec(**common, **drawn, min_child_hessian=1.0 if regression else 3.0, gamma=0.0 if regression else p.gamma)
    if c.kind in ("boosted_trees_balanced", "boosted_trees_min20"):
        return B.Spec(**common, **drawn, policy="leaf", max_leaves=p.max_leaves, min_child_rows=20, min_child_hessian=1e-3)
    if c.kind == "symmetric_trees":
        depth = min(p.max_depth, 6) if regression else p.max_depth
        return B.Spec(**{**common, "max_depth": depth}, policy="symmetric", l2=p.symmetric_l2)
    raise ValueError(f"unknown candidate {c}")


def forest(c: Candidate, p: TreeParams):
    """MLlib's random forest; every split sees all features."""
    kind = RandomForestClassifier if c.task == "classification" else RandomForestRegressor
    return kind(featuresCol="features", labelCol="label", numTrees=p.n_trees, maxDepth=p.max_depth if c.task == "classification" else min(p.max_depth, 6),
                seed=SEED, featureSubsetStrategy="all", checkpointInterval=p.checkpoint_interval)


# ---------------------------------------------------------------------------
# Fitting and scoring
# ---------------------------------------------------------------------------

def cap_rows(train: DataFrame, n: int | None, key: str = "row_key") -> DataFrame:
    """the first ``n`` training rows by key (a top-k, not a sample)."""
    return train if n is None else train.orderBy(key).limit(n)


def fit_models(cands: list[Candidate], train: DataFrame, p: TreeParams, n_classes: int = 2, folds: int = 0, full: bool = True) -> dict[str, object]:
    """Fit candidates, all boosted ones side by side; with ``folds`` also, as ``name#fold``, each without one fold.

    Candidates with a row cap, and MLlib's forests, are fitted by themselves.
    """
    models: dict[str, object] = {}
    wanted = ([None] if full else []) + list(range(folds))
    together = [spec(c, p, n_classes, f) for c in cands if c.kind != "random_forest" and c.max_train_rows is None for f in wanted]
    width = train.select("features").first()
    width = width[0].size if width else 0

    def boosted(rows: DataFrame, specs: list[B.Spec]) -> None:
        if specs:
            models.update(B.fit(rows, specs, width, p.max_bins, p.checkpoint_interval))
    keyed = train.withColumn("fold", fold_of(F.col("row_key"), max(folds, 1)))
    boosted(keyed, together)
    for c in cands:
        if c.kind == "random_forest":
            for f in wanted:
                models[c.name if f is None else f"{c.name}#{f}"] = forest(c, p).fit(keyed if f is None else keyed.where(F.col("fold") != f))
        elif c.max_train_rows is not None:
            boosted(cap_rows(keyed, c.max_train_rows).repartition(B.tasks_for(c.max_train_rows), "row_key"), [spec(c, p, n_classes, f) for f in wanted])
    return models


def predict(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """F7 + F8: prediction (and probability for classifiers) per row."""
    scored = model.transform(df)
    cols = [*keep, "prediction"]
    if "probability" in scored.columns:
        cols.append("probability")
    return scored.select(*cols)


def predictions_of(cands: list[Candidate], models: dict, val: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Predictions (model, ordinal, keep..., prediction) of some fitted candidates."""
    keep = keep or ["row_key", "label"]
    fitted = {f"__{c.ordinal}_{c.name}": models[c.name] for c in cands}
    if B.together(list(fitted.values())):   # one pass over the rows
        each = [F.struct(F.lit(c.name).alias("model"), F.lit(c.ordinal).alias("ordinal"), m.prediction(n).alias("prediction")) for c, (n, m) in zip(cands, fitted.items())]
        return B.with_outputs(fitted, val).select(*keep, F.inline(F.array(*each))).select("model", "ordinal", *keep, "prediction")
    out = None
    for c in cands:
        rows = predict(models[c.name], val, keep).select(F.lit(c.name).alias("model"), F.lit(c.ordinal).alias("ordinal"), *keep, "prediction")
        out = rows if out is None else out.unionByName(rows)
    return out


def fit_all(cands: list[Candidate], train: DataFrame, val: DataFrame, p: TreeParams,
            n_classes: int = 2, keep: list[str] | None = None) -> tuple[dict, DataFrame]:
    """Fit every candidate; return (models, predictions (model, ordinal, keep..., prediction))."""
    models = fit_models(cands, train, p, n_classes)
    return models, predictions_of(cands, models, val, keep)


# ---------------------------------------------------------------------------
# F9 + F10: stacking on out-of-fold probabilities
# ---------------------------------------------------------------------------

def fold_of(key: Column, k: int) -> Column:
    """Deterministic fold id from the row key (every row used; no sampling)."""
    return F.pmod(F.xxhash64(key), F.lit(k)).cast("int")


def base_probability_columns(scorers: dict, df: DataFrame, keep: list[str]) -> DataFrame:
    """every base model's class probabilities side by side on the same
    rows (no join; boosted models read them together, others in a chain), then one assembled ``meta`` vector.

    ``scorers`` map a name to an object whose ``transform`` adds ``p_<name>``.
    """
    names = [f"p_{name}" for name in scorers]
    models = [getattr(m, "model", None) for m in scorers.values()]
    if B.together(models) and all(m.spec.objective != "squared" for m in models):
        out = B.with_outputs({f"__{n}": m for n, m in zip(names, models)}, df)
        parts = [F.col(f"__{n}") for n in names]
        return out.select(*keep, *[array_to_vector(p).alias(n) for p, n in zip(parts, names)], array_to_vector(F.flatten(F.array(*parts))).alias("meta"))
    out = df
    for m in scorers.values():
        out = m.transform(out)
    parts = [vector_to_array(F.col(n)) for n in names]
    return out.select(*keep, *names, array_to_vector(F.flatten(F.array(*parts))).alias("meta"))


def _wrap(model, name: str):
    return _Scorer(model, name)


@dataclass
class _Scorer:
    """Adds a base model's class probabilities as ``p_<name>``."""
    model: object
    name: str

    def transform(self, df: DataFrame) -> DataFrame:
        if isinstance(self.model, B.Booster):
            return self.model.transform(df, f"__pred_{self.name}", f"p_{self.name}").drop(f"__pred_{self.name}")
        m = self.model.copy()
        m.setProbabilityCol(f"p_{self.name}").setRawPredictionCol(f"__raw_{self.name}").setPredictionCol(f"__pred_{self.name}")
        return m.transform(df).drop(f"__raw_{self.name}", f"__pred_{self.name}")


def stacking(cands: list[Candidate], train: DataFrame, val: DataFrame, p: TreeParams, n_classes: int,
             folds: int = 3, keep: list[str] | None = None,
             fitted: dict | None = None) -> tuple[StackModel, DataFrame]:
    """balanced logistic regression on out-of-fold base probabilities.

    Each fold's base models are fitted on the other folds and score the
    held-out fold, so the meta model never sees in-sample probabilities.  The
    validation rows are scored by base models fitted on all training rows.
    ``fitted``: models at hand, among them fold models as ``fit_models`` names them.
    """
    keep = keep or ["row_key", "label"]
    models = dict(fitted or {})
    if any(f"{c.name}#{f}" not in models for c in cands for f in range(folds)):
        models |= fit_models(cands, train, p, n_classes, folds, full=any(c.name not in models for c in cands))
    held = train.withColumn("__fold", fold_of(F.col("row_key"), folds))
    meta_train = None
    for f in range(folds):
        ms = {c.name: _wrap(models[f"{c.name}#{f}"], c.name) for c in cands}
        rows = base_probability_columns(ms, held.where(F.col("__fold") == f), keep + ["weight"])
        meta_train = rows if meta_train is None else meta_train.unionByName(rows)
    lr = LogisticRegression(featuresCol="meta", labelCol="label", weightCol="weight", maxIter=1000)
    meta = lr.fit(meta_train)
    full = {c.name: _wrap(models[c.name], c.name) for c in cands}
    stack = StackModel(full, meta, keep)
    return stack, meta.transform(base_probability_columns(full, val, keep)).select(*keep, "prediction", "probability")


@dataclass
class StackModel:
    """The stack scores new rows through its own base models (no 200-wide input)."""
    bases: dict
    meta: object
    keep: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [c for c in df.columns if c != "features"]
        return self.meta.transform(base_probability_columns(self.bases, df, keep))
