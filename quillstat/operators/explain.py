"""Explanation.

Contributions are a long table (row_key, class, feature, contribution).  Every
aggregate over it (importance, ranking) is a grouped aggregate keyed by
feature, so it scales with rows x features without a driver step.

* ``linear_contributions``: exact Shapley values of a linear score with
  independent features, coef * (x - mean) (H2's linear path);
* ``tree_contributions``: path-dependent tree SHAP for MLlib tree ensembles,
  one set of contributions per class, computed for whole Arrow batches with
  ``mapInArrow`` (H1); trees travel as small path arrays;
* ``sampled_contributions``: Shapley values of any model that scores a feature
  vector (H2), from a table of coalitions scored in bulk; the stack is
  explained this way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.operators.boosting import tasks_for

EXPLAINABLE_KINDS = ("boosted_trees", "boosted_trees_balanced", "boosted_trees_min20", "symmetric_trees", "random_forest")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def stack_features(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Rows (row_key, feature, value): one row per (row, feature)."""
    return df.select(F.col(key).alias("row_key"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), _q(f).cast("double").alias("value")) for f in features])).alias("e")
    ).select("row_key", "e.feature", "e.value")


def centroid_coefficients(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """A nearest-centroid linear score: coefficient = class mean of the
    standardised feature.  Rows (class, feature, coef); classes x features."""
    means = df.groupBy(F.col(label).cast("string").alias("class")).agg(
        *[F.avg(_q(f).cast("double")).alias(f) for f in features])
    return means.unpivot(["class"], features, "feature", "coef")


def linear_contributions(df: DataFrame, key: str, features: list[str], coef: DataFrame,
                         means: dict[str, float]) -> DataFrame:
    """H2 (linear): contribution = coef[class, feature] * (x - mean[feature]).

    ``coef`` has one row per (class, feature) and is broadcast.
    """
    centre = F.create_map(*[x for f in features for x in (F.lit(f), F.lit(float(means[f])))])
    long = stack_features(df, key, features)
    return (long.join(F.broadcast(coef), "feature")
            .select("row_key", "class", "feature",
                    (F.col("coef") * (F.col("value") - F.element_at(centre, F.col("feature")))).alias("contribution")))


# ---------------------------------------------------------------------------
# H2: sampled Shapley values of any model
# ---------------------------------------------------------------------------

#: rows that stand for unknown features; they are held as numbers on the driver
MAX_BACKGROUND = 1000


@dataclass
class Draw:
    """An order in which features become known, and the values that stand for those unknown."""
    order: list[int]
    background: list[float]


def background_rows(rows: DataFrame, n: int, key: str = "row_key", vector_col: str = "features") -> list[list[float]]:
    """The ``n`` feature vectors of smallest key hash (ties by vector): at most MAX_BACKGROUND rows, the same on every run."""
    if not 1 <= n <= MAX_BACKGROUND:
        raise ValueError(f"a background has 1 to {MAX_BACKGROUND} rows, not {n}")
    x = vector_to_array(vector_col)
    top = rows.select(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("h"), x.alias("x")).orderBy("h", "x").limit(n)
    return [list(r.x) for r in top.collect()]


def draws(background: list[list[float]], n_features: int, orders: int, seed: int = 42) -> list[Draw]:
    """``orders`` random orders and the reverse of each (a feature known late in one is known early in the other);
    every order goes with a background row, in turn, until every row has been met equally often."""
    rng = np.random.default_rng(seed)
    out = []
    while background and (len(out) < 2 * orders or len(out) % (2 * len(background))):
        order = rng.permutation(n_features).tolist()
        row = background[len(out) // 2 % len(background)]
        out += [Draw(order, row), Draw(order[::-1], row)]
    return out


def sampled_contributions(rows: DataFrame, key: str, features: list[str], score: Callable[[DataFrame], DataFrame], classes: list[str],
                          taken: list[Draw], vector_col: str = "features", tasks: int | None = None) -> DataFrame:
    """H2 (any model): long rows (row_key, class, feature, contribution) plus a ``__base`` row per row_key and class.

    ``score`` adds an array column ``score`` with one number for each of
    ``classes`` to a table with a feature vector (and the same as the array
    column ``__known``, for scores that are sums of columns).  For each row and draw the
    features become known one by one in the draw's order, unknown ones taking
    the background's value; all these coalitions are one table, scored in bulk.
    A feature's contribution is the mean change of the score when it becomes
    known, so contributions and base (the background's mean score) sum to the
    row's score exactly, and for all orders they are the Shapley values.

    Each coalition counts with a plus for the feature known last and with a
    minus for the one known next: one sum for each feature and class, grouped
    by row.  Partial sums meet in the task that made the coalitions, so one
    line for each row is shuffled.  The work is rows x draws x (features + 1) scores;
    ``tasks`` spreads the rows over so many before it.
    Rows of equal key and features are explained once; a null key is a key.
    """
    d = len(features)
    if any(sorted(t.order) != list(range(d)) or len(t.background) != d for t in taken) or not taken:
        raise ValueError("a draw needs an order of all features and a background value for each")
    steps = [(t, step) for t in taken for step in range(d + 1)]
    # each coalition is a number; what belongs to it stands in literal lists, -1 is the base or none
    last, following = ([t.order[step] if 0 <= step < d else -1 for t, step in ((t, step + by) for t, step in steps)] for by in (-1, 0))

    def of_step(values, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("__step"))
    known = [F.when(of_step([t.order.index(j) < step for t, step in steps], "boolean"), F.get(F.col("__x"), F.lit(j)))
             .otherwise(of_step([float(t.background[j]) for t, _ in steps], "double")) for j in range(d)]
    whole = rows if tasks is None else rows.repartition(tasks)
    coalitions = (whole.select(F.col(key).cast("string").alias("row_key"), vector_to_array(vector_col).alias("__x"))
                  .select("*", F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("__step"))
                  .select("row_key", "__x", of_step(last, "int").alias("__last"), of_step(following, "int").alias("__next"),
                          F.when(F.col("__x").isNotNull(), F.array(*known).cast("array<double>")).alias("__known"))
                  .withColumn(vector_col, array_to_vector("__known")))
    values = [F.get("score", F.lit(k)).cast("double").alias(f"v{k}") for k in range(len(classes))]
    scored = score(coalitions).select("row_key", "__x", "__last", "__next", *values)
    # the sums of the features, then the base
    signed = [[F.sum(F.when(F.col("__last") == j, F.col(f"v{k}")).when(F.col("__next") == j, -F.col(f"v{k}")) if j >= 0 else
                     F.when(F.col("__last") == j, F.col(f"v{k}"))).alias(f"s{k}_{j}") for k in range(len(classes))] for j in [*range(d), -1]]
    sums = (scored.groupBy("row_key", "__x")
            .agg(F.count(F.when(F.col("__last") == -1, 1)).alias("n"),   # the draws, for each of the equal rows
                 *[c for cols in signed for c in cols]))
    return sums.select("row_key", F.inline(F.array(*[F.struct(F.lit(c).alias("class"), F.lit(name).alias("feature"), (F.col(f"s{k}_{j}") / F.col("n")).alias("contribution"))
                                                     for name, j in [*zip(features, range(d)), ("__base", -1)] for k, c in enumerate(classes)])))


def model_score(model) -> Callable[[DataFrame], DataFrame]:
    """What ``sampled_contributions`` asks of a fitted model: class probabilities, or the prediction where there are none."""
    def score(df: DataFrame) -> DataFrame:
        kept = df.columns
        out = model.transform(df)
        value = vector_to_array("probability") if "probability" in out.columns else F.array("prediction")
        return out.select(*[c for c in kept if c in out.columns], value.alias("score"))
    return score


def feature_importance(contrib: DataFrame) -> DataFrame:
    """H3: mean absolute contribution per feature over rows and classes."""
    return contrib.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))


def rank_importance(imp: DataFrame) -> DataFrame:
    """H4: descending importance (ties by name); ranks features, not rows."""
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))
    return imp.withColumn("position", F.row_number().over(w).cast("int"))


def top_features(imp: DataFrame, n: int) -> DataFrame:
    """H8: the n most important features (20 for the chart, 5 for the facts)."""
    return rank_importance(imp).where(F.col("position") <= n)


def feature_dictionary(spark, names: list[str]) -> DataFrame:
    """H6: positional names f_i -> column name (one row per feature)."""
    return spark.createDataFrame([(f"f_{i}", n) for i, n in enumerate(names)], "feature string, name string")


def map_feature_names(contrib_or_imp: DataFrame, dictionary: DataFrame) -> DataFrame:
    """H6: replace positional names by column names (broadcast join); others kept."""
    return (contrib_or_imp.join(F.broadcast(dictionary), "feature", "left")
            .withColumn("feature", F.coalesce(F.col("name"), F.col("feature"))).drop("name"))


def drop_padding(df: DataFrame, genuine: list[str] | None = None) -> DataFrame:
    """H7: padding (pad_*) and unmapped positional (f_*) names are removed.

    ``genuine``: the data's own column names; those stay whatever they begin with.
    """
    own = F.col("feature").isin(genuine) if genuine else F.lit(False)
    return df.where(own | (~F.col("feature").startswith("pad_") & ~F.col("feature").startswith("f_")))


def explainable(kinds: list[str]) -> list[str]:
    """H9: models explained by their trees; others are explained from samples, if a background is given."""
    return [k for k in kinds if k in EXPLAINABLE_KINDS]


def explain_models(spark, models: dict, kinds: dict, rows: DataFrame, key: str, features: list[str],
                   taken: list[Draw] | None = None, classes: list[str] | None = None):
    """H1 + H2 + H5 + H9 over a set of fitted models.

    Returns (contributions of every explained model with a ``model`` column,
    status table (model, status, message)).  Tree ensembles are explained by
    their trees (margins); with ``taken`` any other model, the stack before all,
    by sampled Shapley values of its ``classes``' probabilities or its
    prediction.  A model that is not explainable or whose explanation fails
    gets a status row instead of silent zeros.
    """
    parts, status = [], []
    for name, model in models.items():
        if kinds.get(name) not in EXPLAINABLE_KINDS or not any(hasattr(model, x) for x in ("trees", "rootNode", "models")):
            if not taken or not hasattr(model, "transform"):
                status.append((name, "skipped", "not a tree ensemble"))
                continue
            tasks = tasks_for(rows.count() * len(taken) * (len(features) + 1))
            try:
                parts.append(sampled_contributions(rows, key, features, model_score(model), classes or ["prediction"], taken, tasks=tasks)
                             .select(F.lit(name).alias("model"), "*"))
            except Exception as e:  # noqa: BLE001  reported, not hidden
                status.append((name, "failed", f"{type(e).__name__}: {e}"[:300]))
                continue
            status.append((name, "explained", f"sampled, {len(taken)} draws"))
            continue
        try:
            trees = ensemble_arrays(model)
        except Exception as e:  # noqa: BLE001  reported, not hidden
            status.append((name, "failed", f"{type(e).__name__}: {e}"[:300]))
            continue
        parts.append(tree_contributions(rows, key, features, trees).select(F.lit(name).alias("model"), "*"))
        status.append((name, "explained", ""))
    contrib = None
    for p in parts:
        contrib = p if contrib is None else contrib.unionByName(p)
    return contrib, spark.createDataFrame(status, "model string, status string, message string")


# ---------------------------------------------------------------------------
# H1: path-dependent tree SHAP on MLlib tree ensembles
# ---------------------------------------------------------------------------

def ensemble_arrays(model) -> list[dict]:
    """Flatten a tree ensemble (or a single tree) into node arrays; boosted candidates hold them already.

    For each tree: arrays ``feature`` (-1 at leaves), ``threshold``, ``left``,
    ``right``, ``cover`` (training instances) and ``value``, one column for each
    output named in ``outputs``, and the tree weight.  Outputs:

    * regressors and binary boosting: the margin;
    * a forest of two classes: the share of class 1;
    * a forest of more classes: the share of each class, named by its number;
    * boosting of more classes: the margin of each class, named by its number.

    Only continuous splits are used (features are assembled doubles).
    """
    if hasattr(model, "arrays"):
        return model.arrays()
    trees = model.trees if hasattr(model, "trees") else [model]
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0]
    if type(model).__name__.startswith("RandomForest"):  # a forest averages its trees; boosting sums weighted margins
        weights = [1.0 / len(trees)] * len(trees)
    by_class = type(model).__name__ in ("RandomForestClassificationModel", "DecisionTreeClassificationModel")
    classes = model.numClasses if by_class else 0
    outputs = [str(c) for c in range(classes)] if classes > 2 else [None]
    out = []
    for tree, w in zip(trees, weights):
        feature, threshold, left, right, value, cover = [], [], [], [], [], []

        def walk(node) -> int:
            idx = len(feature)
            feature.append(-1)
            threshold.append(0.0)
            left.append(-1)
            right.append(-1)
            calculator = node.impurityStats()
            if by_class:
                stats = np.array(list(calculator.stats()), float)
                share = stats / max(stats.sum(), 1e-300)
                value.append(share if classes > 2 else share[1:2] if len(share) > 1 else np.zeros(1))
            else:
                value.append(np.array([float(node.prediction())]))
            cover.append(float(calculator.count()))
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                feature[idx] = int(split.featureIndex())
                threshold[idx] = float(split.threshold())
                left[idx] = walk(node.leftChild())
                right[idx] = walk(node.rightChild())
            return idx

        walk(tree._java_obj.rootNode())
        out.append({"feature": np.array(feature), "threshold": np.array(threshold), "left": np.array(left), "right": np.array(right),
                    "value": np.array(value), "cover": np.array(cover), "weight": float(w), "outputs": outputs})
    return out


def leaf_paths(t: dict, n_features: int) -> dict:
    """What a batch needs of one tree, per leaf (rows) and distinct feature of its path (columns, padded).

    ``below`` and ``above``: a row agrees with the path in this feature if it is <= below and not <= above (nan: no bound);
    ``keep``: the share of training rows that go the path's way where the feature is not known;
    ``spread``: matrix from (leaf, feature) to (output, feature), leaf values and tree weight included;
    ``cuts``: the tree's distinct questions (feature, threshold).
    """
    found, cuts = [], set()

    def go(j, path):
        if t["feature"][j] < 0:
            found.append((j, path))
            return
        f, cut = int(t["feature"][j]), t["threshold"][j]
        cuts.add((f, float(cut)))
        for child, is_left in ((t["left"][j], True), (t["right"][j], False)):
            below, above, keep = path.get(f, (np.inf, -np.inf, 1.0))
            keep *= t["cover"][child] / t["cover"][j]
            go(child, {**path, f: (min(below, cut), above, keep) if is_left else (below, max(above, cut), keep)})

    go(0, {})
    width = max(1, max(len(p) for _, p in found))
    shape = (len(found), width)
    feature, keep = np.zeros(shape, int), np.ones(shape)
    below, above, used = np.full(shape, np.inf), np.full(shape, -np.inf), np.zeros(shape, bool)
    for i, (_, path) in enumerate(found):
        for k, (f, (b, a, z)) in enumerate(path.items()):
            feature[i, k], below[i, k], above[i, k], keep[i, k], used[i, k] = f, b, a, z, True
    value = t["value"][[j for j, _ in found]] * t["weight"]
    k = value.shape[1]
    spread = np.zeros((*shape, k, n_features))
    row, col = np.nonzero(used)
    spread[row, col, :, feature[row, col]] = value[row]
    return {"feature": feature, "below": np.where(np.isfinite(below), below, np.inf), "above": np.where(np.isfinite(above), above, np.nan), "keep": keep, "used": used, "spread": spread.reshape(-1, k * n_features), "base": value.T @ keep.prod(axis=1), "outputs": t["outputs"], "cuts": sorted(cuts)}


def bin_rows(x: np.ndarray, trees: list[dict]) -> tuple[list[np.ndarray], np.ndarray]:
    """All thresholds that the trees (of ``leaf_paths``) have for each feature, and the rows' places among them (features x rows)."""
    asked = [sorted({c for t in trees for g, c in t["cuts"] if g == f}) for f in range(x.shape[1])]
    cuts = [np.array(c, float) for c in asked]
    return cuts, np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]) if cuts else np.zeros((0, len(x)), np.intp)   # nan: above every cut


def shap_batch(x: np.ndarray, leaf: dict, binned: tuple[list[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Path-dependent Shapley values (Lundberg et al., 2018) of one tree for all rows of ``x``: (rows, outputs, features).

    A leaf pays its value times the product over its path's features of 1 or 0 (known:
    the row agrees or not) or the kept share (unknown).  The Shapley weights are a beta
    integral, so a feature's share is (agrees - keep) times the integral over t in (0, 1)
    of the product of keep (1 - t) + agrees t over the other features: a polynomial, for
    which Gauss-Legendre points give the exact value.
    """
    leaves, width = leaf["feature"].shape
    k = leaf["spread"].shape[1]
    if (few := len(leaf["cuts"])) <= FEW_CUTS and 2 * few <= leaves:   # a symmetric tree: rows that answer its few questions alike are paid alike
        code = sum(((~(x[:, f] <= cut)).astype(np.intp) << i for i, (f, cut) in enumerate(leaf["cuts"])), np.zeros(len(x), np.intp))
        first = np.full(1 << few, -1)
        first[code[::-1]] = np.arange(len(x))[::-1]
        kinds = np.flatnonzero(first >= 0)
        if 2 * len(kinds) <= len(x):
            first[kinds], rows = np.arange(len(kinds)), first[kinds]
            return _shap(x[rows], leaf, None).take(first[code], axis=0)
    return _shap(x, leaf, binned)


def _shap(x: np.ndarray, leaf: dict, binned: tuple[list[np.ndarray], np.ndarray] | None) -> np.ndarray:
    leaves, width = leaf["feature"].shape
    k = leaf["spread"].shape[1]
    out = np.zeros((len(x), k))
    if width <= 8 and 2 ** width <= len(x) and 8 * 2 ** width * leaves * k <= PATTERN_BYTES:
        # what a leaf pays is told by which features of its path agree: every such pattern is worked out once
        patterns = (np.arange(2 ** width)[:, None, None] >> np.arange(width) & 1).astype(bool)
        shares = _shares(np.broadcast_to(patterns, (2 ** width, leaves, width)), leaf)
        gets = np.flatnonzero(leaf["spread"].any(axis=0))
        paid = np.ascontiguousarray(shares.transpose(1, 0, 2)) @ leaf["spread"][:, gets].reshape(leaves, width, len(gets))
        cuts, bins = bin_rows(x, [leaf]) if binned is None else binned
        base, tables = _pattern_tables(leaf, cuts)
        for lo in range(0, len(x), PATTERN_ROWS):
            pattern = np.repeat(base[None, :], len(x[lo:lo + PATTERN_ROWS]), 0)
            for f, table in tables:
                pattern |= table.take(bins[f, lo:lo + PATTERN_ROWS], axis=0)
            own = np.ascontiguousarray(pattern.T)
            total, part = np.zeros((len(pattern), len(gets))), np.empty((len(pattern), len(gets)))
            for pays, which in zip(paid, own):
                total += pays.take(which, axis=0, out=part, mode="clip")   # no pattern lies outside
            out[lo:lo + PATTERN_ROWS, gets] = total
    else:
        for lo in range(0, len(x), SHAP_ROWS):
            agrees = _agrees(x[lo:lo + SHAP_ROWS], leaf)
            out[lo:lo + SHAP_ROWS] = _shares(agrees, leaf).reshape(len(agrees), -1) @ leaf["spread"]
    return out.reshape(len(x), len(leaf["outputs"]), -1)


def _pattern_tables(leaf: dict, cuts: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """By a feature's bin, the bits it adds to each leaf's pattern; and the bits of what a path does not use, which are set."""
    leaves, width = leaf["feature"].shape
    bit = 1 << np.arange(width)
    base = (~leaf["used"] @ bit).astype(np.uint8)
    tables = []
    for f in np.unique(leaf["feature"][leaf["used"]]).tolist():
        rep = np.append(cuts[f], np.inf)[:, None]   # the upper end of each bin answers for it
        at, column = np.nonzero(leaf["used"] & (leaf["feature"] == f))
        table = np.zeros((len(rep), leaves), np.uint8)
        table[:, at] = ((rep <= leaf["below"][at, column]) > (rep <= leaf["above"][at, column])) * bit[column]
        tables.append((f, table))
    return base, tables


def _agrees(x: np.ndarray, leaf: dict) -> np.ndarray:
    """Whether a row agrees with a leaf's path in each of its features: (rows, leaves, path); a nan lies right of every cut."""
    at = np.where(np.isnan(x), np.inf, x)[:, leaf["feature"]]
    return (at <= leaf["below"]) > (at <= leaf["above"])


def _shares(agrees: np.ndarray, leaf: dict) -> np.ndarray:
    """Each path feature's share of a leaf's value: (rows, leaves, path)."""
    agrees = np.where(leaf["used"], agrees, True).astype(float)
    points, weights = np.polynomial.legendre.leggauss(agrees.shape[2] // 2 + 1)
    integral = np.zeros_like(agrees)
    for p, w in zip((points + 1) / 2, weights / 2):
        part = leaf["keep"] * (1 - p) + agrees * p
        integral += w * part.prod(axis=2, keepdims=True) / part
    return (agrees - leaf["keep"]) * integral


#: rows evaluated at once: bounds the (rows, leaves, path) arrays
SHAP_ROWS = 256
#: rows whose patterns are held at once, and rows for which trees' tables are worked out once
PATTERN_ROWS, BATCH_ROWS = 4_096, 32_768
#: trees of at most so many distinct questions are paid by the answers
FEW_CUTS = 10
#: what all patterns of a tree's leaves pay is worked out once for a batch if it takes no more than this
PATTERN_BYTES = 16 << 20


def tree_contributions(df: DataFrame, key: str, features: list[str], trees: list[dict],
                       vector_col: str = "features", label: str = "margin") -> DataFrame:
    """H1: tree SHAP of every output of the ensemble, long rows (row_key, class,
    feature, contribution) plus a ``__base`` row per row_key and class.

    Runs per Arrow batch in Python workers (``mapInArrow``); the path arrays
    are captured in the closure (bounded by leaves x depth).  Additivity holds:
    the contributions and the base of a class sum to that output of the
    ensemble.  ``label`` names the class of an ensemble with one output.
    """
    names = [*features, "__base"]
    width = len(features)
    leaves = [leaf_paths(t, width) for t in trees]
    classes = list(dict.fromkeys(o for t in leaves for o in t["outputs"]))
    number = {c: i for i, c in enumerate(classes)}
    base = np.zeros(len(classes))
    for t in leaves:
        base[[number[o] for o in t["outputs"]]] += t["base"]
    shown = [label if c is None else c for c in classes]
    src = df.select(F.col(key).cast("string").alias("row_key"), vector_to_array(F.col(vector_col)).alias("x"))

    def paid(x: np.ndarray) -> np.ndarray:
        phi = np.empty((len(x), len(classes), width + 1))
        phi[:, :, :width], phi[:, :, width] = 0.0, base
        binned = bin_rows(x, leaves)
        for t in leaves:
            phi[:, [number[o] for o in t["outputs"]], :width] += shap_batch(x, t, binned)
        return phi

    def together(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BATCH_ROWS:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        said = pa.array([str(c) for c in shown]), pa.array(names)
        for rows in together(batches):
            x = pc.list_flatten(rows.column(1)).to_numpy(zero_copy_only=False).astype(float).reshape(rows.num_rows, width)
            phi = paid(x)
            for lo in range(0, len(x), PATTERN_ROWS):
                part = phi[lo:lo + PATTERN_ROWS]
                at = np.arange(part.size)
                yield pa.RecordBatch.from_arrays([rows.column(0).combine_chunks().take(pa.array(lo + at // part[0].size)), said[0].take(pa.array(at // (width + 1) % len(classes))),
                                                  said[1].take(pa.array(at % (width + 1))), pa.array(part.ravel())], names=["row_key", "class", "feature", "contribution"])

    return src.mapInArrow(run, "row_key string, class string, feature string, contribution double")
