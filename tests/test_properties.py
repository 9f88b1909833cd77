"""Property tests: splits, ranks, medians, probabilities, SHAP additivity."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillstat.operators import eda as E
from quillstat.operators import explain as H
from quillstat.operators import prepare as D
from quillstat.operators import profile as P
from quillstat.operators import ranking as R
from quillstat.plans import views as V


def test_hash_split_disjoint_complete_and_stable(spark, small_dir):
    li = V.load_testdata(spark, small_dir, "lineitem")
    a = D.hash_split(li, ["l_orderkey", "l_linenumber"])
    b = D.hash_split(li.repartition(7), ["l_orderkey", "l_linenumber"])
    key = F.concat_ws("|", "l_orderkey", "l_linenumber")
    from collections import Counter
    sa = Counter(tuple(r) for r in a.select(key, "is_validation").collect())
    sb = Counter(tuple(r) for r in b.select(key, "is_validation").collect())
    assert sa == sb and sum(sa.values()) == li.count()
    # rows with the same key always fall on the same side
    assert len({k for k, _ in sa}) == len(sa)
    share = sum(n for (k, v), n in sa.items() if v) / sum(sa.values())
    assert 0.17 < share < 0.23


def test_exact_stratified_split_per_class(spark, small_dir):
    t = V.lineitem_targets(spark, small_dir)
    out = D.stratified_split(t, "qty_band", ["l_orderkey", "l_linenumber"])
    for r in out.groupBy("qty_band").agg(F.count(F.lit(1)).alias("n"),
                                         F.sum(F.col("is_validation").cast("int")).alias("v")).collect():
        assert r["v"] == -(-r["n"] * 2 // 10)   # ceil(0.2 n)


def test_global_rank_matches_sort(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("v")).repartition(5)
    got = [r["rank0"] for r in R.global_rank(df, ["v"]).orderBy("v").collect()]
    assert got == list(range(5000))


@pytest.mark.parametrize("values", [[2, 4, 6, 9], [5], [1, 1, 1, 7], list(range(1001))])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert R.exact_medians(df, ["x"], max_band=10)["x"] == float(np.median(values))


def test_exact_median_with_narrowing(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(size=20001)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert abs(R.exact_medians(df, ["x"], accuracy=100, max_band=500)["x"] - float(np.median(vals))) < 1e-12


def test_profile_invariant_to_row_order(spark, small_dir):
    o = V.relation(spark, small_dir, "orders")
    a = sorted(map(tuple, P.profile(o).collect()))
    b = sorted(map(tuple, P.profile(o.orderBy(F.rand(5))).collect()))
    assert a == b


def test_tree_shap_additivity(spark, small_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    t = V.lineitem_targets(spark, small_dir)
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    # the table's (orderkey, linenumber) is not unique, so number the rows
    x = (VectorAssembler(inputCols=feats, outputCol="features").transform(t)
         .withColumn("row_key", F.monotonically_increasing_id().cast("string")).persist())
    model = GBTRegressor(labelCol="net_price", maxIter=4, maxDepth=3, seed=1).fit(x)
    trees = H.ensemble_arrays(model)
    contrib = H.tree_contributions(x, "row_key", feats, trees)
    sums = {r["row_key"]: r["s"] for r in contrib.groupBy("row_key").agg(F.sum("contribution").alias("s")).collect()}
    preds = {r["row_key"]: r["prediction"] for r in model.transform(x).select("row_key", "prediction").collect()}
    assert all(abs(sums[k] - preds[k]) < 1e-6 * max(1.0, abs(preds[k])) for k in preds)


def test_probabilities_sum_to_one(spark, small_dir):
    from pyspark.ml.functions import vector_to_array
    from quillstat.operators import models as M
    from quillstat.plans import analysis as A
    df = V.lineitem_targets(spark, small_dir).drop("net_price", "is_big")
    a = A.run(df, "qty_band", "classification", keys=["l_orderkey", "l_linenumber"],
              params=M.TreeParams(n_trees=2, max_depth=3), stack=False)
    for name in ("boosted_trees", "symmetric_trees"):
        s = a.models[name].transform(a.val).select(F.aggregate(vector_to_array("probability"), F.lit(0.0),
                                                               lambda acc, v: acc + v).alias("s"))
        assert s.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    board = a.leaderboard().collect()
    assert len(board) == 3 and all(r["f1_weighted"] > 0.8 for r in board)


def test_hybrid_profile_keeps_decisions(spark, small_dir):
    from quillstat.plans import views as V2
    for t in ("lineitem_messy", "orders", "documents"):
        rel = V2.relation(spark, small_dir, t)
        exact = {r["column_name"]: r for r in P.profile(rel).collect()}
        hybrid = {r["column_name"]: r for r in P.profile(rel, distinct="hybrid").collect()}
        for c, r in exact.items():
            assert hybrid[c]["semantic_type"] == r["semantic_type"], (t, c)
            if r["n_unique"] <= 80:
                assert hybrid[c]["n_unique"] == r["n_unique"], (t, c)
        fe = {r["column_name"]: (r["classification_target"], r["regression_target"])
              for r in P.target_flags(P.profile(rel)).collect()}
        fh = {r["column_name"]: (r["classification_target"], r["regression_target"])
              for r in P.target_flags(P.profile(rel, distinct="hybrid")).collect()}
        assert fe == fh


def test_pruned_samples_equal_full(spark, small_dir):
    from quillstat.plans import views as V2
    rel = V2.relation(spark, small_dir, "lineitem_messy")
    full = sorted(map(tuple, P.sample_values(rel, prune_rows=None).collect()))
    pruned = sorted(map(tuple, P.sample_values(rel, prune_rows=50, prune_min_bytes=0).collect()))
    assert full == pruned


def test_forest_shap_additivity(spark, small_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    t = V.lineitem_targets(spark, small_dir)
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    x = (VectorAssembler(inputCols=feats, outputCol="features").transform(t)
         .withColumn("row_key", F.monotonically_increasing_id().cast("string")).limit(300).persist())
    model = RandomForestRegressor(labelCol="net_price", numTrees=3, maxDepth=3, seed=1).fit(x)
    contrib = H.tree_contributions(x, "row_key", feats, H.ensemble_arrays(model))
    sums = {r["row_key"]: r["s"] for r in contrib.groupBy("row_key").agg(F.sum("contribution").alias("s")).collect()}
    preds = {r["row_key"]: r["prediction"] for r in model.transform(x).select("row_key", "prediction").collect()}
    assert all(abs(sums[k] - preds[k]) < 1e-6 * max(1.0, abs(preds[k])) for k in preds)


def test_contributions_of_every_class(spark, small_dir):
    """Three classes, level-wise and symmetric trees: per class the contributions and the base give that class's output."""
    from pyspark.ml.functions import vector_to_array

    from quillstat.operators import models as M
    from quillstat.plans import analysis as A
    df = V.lineitem_targets(spark, small_dir).drop("net_price", "is_big")
    a = A.run(df, "qty_band", "classification", keys=["l_orderkey", "l_linenumber"], params=M.TreeParams(n_trees=2, max_depth=3), stack=False)
    value = {int(r["label"]): str(r["value"]) for r in a.label_map.collect()}
    assert len(value) == a.n_classes > 2
    rows = a.val.dropDuplicates(["row_key"]).persist()
    for name in ("boosted_trees", "symmetric_trees"):
        got = {(r["row_key"], r["class"]): r["s"] for r in a.contributions(name, rows).groupBy("row_key", "class").agg(F.sum("contribution").alias("s")).collect()}
        want = {}
        for r in rows.select("row_key", vector_to_array("features").alias("x")).collect():
            for c, m in enumerate(a.models[name].margins(np.array([r["x"]]))[0]):
                want[r["row_key"], value[c]] = m
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_shap_is_the_shapley_value():
    """A small tree against the sum over all orders of its features, NaN and repeated features included."""
    from itertools import permutations
    t = {"feature": np.array([0, 1, -1, 0, -1, -1, 2, -1, -1]), "threshold": np.array([0.5, 0.0, 0, 0.2, 0, 0, 1.0, 0, 0]),
         "left": np.array([1, 2, -1, 4, -1, -1, 7, -1, -1]), "right": np.array([6, 3, -1, 5, -1, -1, 8, -1, -1]),
         "value": np.array([[0.0], [0], [3], [0], [-1], [5], [0], [2], [7]]), "cover": np.array([20.0, 12, 5, 7, 3, 4, 8, 6, 2]),
         "weight": 0.5, "outputs": [None]}

    def pays(x, known, j=0):
        f = t["feature"][j]
        if f < 0:
            return t["value"][j, 0] * t["weight"]
        left, right = t["left"][j], t["right"][j]
        if f in known:
            return pays(x, known, left if x[f] <= t["threshold"][j] else right)
        return sum(t["cover"][c] / t["cover"][j] * pays(x, known, c) for c in (left, right))

    x = np.array([[0.1, 1.0, 0.0], [0.3, -1.0, 2.0], [0.4, 0.5, 1.0], [0.9, 0.0, 3.0], [np.nan, np.nan, np.nan], [0.2, 7.0, np.inf]])
    leaf = H.leaf_paths(t, 3)
    got = H.shap_batch(x, leaf)[:, 0]
    orders = list(permutations(range(3)))
    for i, row in enumerate(x):
        want = np.zeros(3)
        for order in orders:
            for k, f in enumerate(order):
                want[f] += (pays(row, order[:k + 1]) - pays(row, order[:k])) / len(orders)
        assert np.allclose(got[i], want) and np.isclose(leaf["base"][0], pays(row, ()))


def test_explain_status_reports_skips(spark, small_dir):
    from quillstat.operators import models as M
    from quillstat.plans import analysis as A
    df = V.lineitem_targets(spark, small_dir).drop("net_price", "qty_band")
    a = A.run(df, "is_big", "classification", keys=["l_orderkey", "l_linenumber"],
              params=M.TreeParams(n_trees=2, max_depth=3), stack=True)
    kinds = {c.name: c.kind for c in M.CLASSIFICATION_CANDIDATES}
    _, status = H.explain_models(spark, a.models, kinds, a.val, "row_key", a.features.features)
    got = {r["model"]: r["status"] for r in status.collect()}
    assert got["stacking"] == "skipped" and got["boosted_trees"] == "explained"
    assert H.explainable(["boosted_trees", "stacking"]) == ["boosted_trees"]
    # with draws the stack is explained too; its contributions and base sum to its probabilities
    contrib, status = H.explain_models(spark, a.models, kinds, a.val, "row_key", a.features.features, a.draws(1, 1), ["0", "1"])
    assert {(r["model"], r["status"]) for r in status.collect()} == {(m, "explained") for m in a.models}
    sums = {(r["row_key"], r["class"]): r["p"] for r in contrib.where("model = 'stacking'").groupBy("row_key", "class").agg(F.sum("contribution").alias("p")).collect()}
    want = a.models["stacking"].transform(a.val).select("row_key", vector_to_array("probability").alias("p")).collect()
    assert set(sums) == {(r.row_key, str(k)) for r in want for k in (0, 1)}
    single = [r for r in want if sum(o.row_key == r.row_key for o in want) == 1]   # row keys repeat in lineitem
    assert single and all(abs(sums[(r.row_key, str(k))] - r.p[k]) < 1e-9 for r in single for k in (0, 1))
    # an analysis names the classes by their own values
    named = a.contributions("stacking", orders=1, background=2)
    assert {r["class"] for r in named.select("class").distinct().collect()} == {str(r["value"]) for r in a.label_map.collect()}


def test_sampled_contributions_equal_brute_force(spark):
    """A score with interactions: all orders of four features give the Shapley values, for repeated rows, null keys and missing values too."""
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((12, 4)), 2)
    x[5], x[6] = x[4], np.nan
    keys = [str(i) for i in range(4)] + ["4", "4", "6", None] + ["same"] * 4
    rows = spark.createDataFrame([(k, Vectors.dense(v.tolist())) for k, v in zip(keys, x)], ["row_key", "features"]).repartition(3)
    back = [[0.5, -1.0, 2.0, 0.0], [1.0, 1.0, -0.5, 0.25]]

    def value(v):
        v = np.nan_to_num(np.asarray(v, float), nan=7.0)
        return np.array([v[0] * v[1] + np.exp(v[2]) * (v[3] > 0), v[0] - v[1] * v[2] * v[3]])

    def score(df):
        z = F.transform(vector_to_array("features"), lambda c: F.when(F.isnan(c), 7.0).otherwise(c))
        return (df.withColumn("__z", z).withColumn("score", F.array(
            F.col("__z")[0] * F.col("__z")[1] + F.exp(F.col("__z")[2]) * F.when(F.col("__z")[3] > 0, 1.0).otherwise(0.0),
            F.col("__z")[0] - F.col("__z")[1] * F.col("__z")[2] * F.col("__z")[3])).drop("__z"))

    orders = list(permutations(range(4)))
    taken = [H.Draw(list(o), b) for o in orders for b in back]
    names = ["a", "b", "__base_", "d"]
    got = {}
    for r in H.sampled_contributions(rows, "row_key", names, score, ["u", "v"], taken, tasks=2).collect():
        got.setdefault((r.row_key, r["class"], r.feature), []).append(r.contribution)
    distinct = {(k, tuple(np.nan_to_num(v, nan=7.0))) for k, v in zip(keys, x)}
    assert sum(map(len, got.values())) == len(distinct) * 2 * 5
    for k, v in distinct:
        want = np.zeros((2, 5))
        want[:, 4] = np.mean([value(b) for b in back], axis=0)
        for o in orders:
            for b in back:
                at = np.array(b)
                for j in o:
                    before = value(at)
                    at[j] = v[j]
                    want[:, j] += (value(at) - before) / len(taken)
        for c, cls in enumerate(["u", "v"]):
            for j, f in enumerate([*names, "__base"]):
                assert any(abs(p - want[c, j]) < 1e-9 for p in got[(k, cls, f)])
    empty = H.sampled_contributions(rows.limit(0), "row_key", names, score, ["u", "v"], taken)
    assert empty.count() == 0 and empty.columns == ["row_key", "class", "feature", "contribution"]


def test_sampled_contributions_shuffle_a_line_for_each_row(spark):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame([(str(i), Vectors.dense(rng.standard_normal(4).tolist())) for i in range(60)], ["row_key", "features"]).repartition(2)
    taken = H.draws([[0.0] * 4, [1.0] * 4], 4, orders=2)
    out = H.sampled_contributions(rows, "row_key", ["a", "b", "c", "d"], lambda df: df.withColumn("score", F.array(F.aggregate("__known", F.lit(0.0), lambda a, v: a + v))), ["u"], taken)
    assert len(out.collect()) == 60 * 5
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_to_vector" not in plan and plan.count("Generate explode") == 1 and "Aggregate [row_key" in plan and "at#" not in plan


def test_sliders_count_distinct_values_roughly(spark, small_dir, monkeypatch):
    """Only the types are asked for, so no exact count of every column is shuffled."""
    from quillstat.plans import catalog_hij as C
    asked, profile = [], C.P.profile
    monkeypatch.setattr(C.P, "profile", lambda df, distinct="exact", **kw: asked.append(distinct) or profile(df, distinct, **kw))
    assert C.i2_first_sliders(spark, small_dir).count() == 12 and asked == ["hybrid"]


@pytest.mark.parametrize("depth", [2, 5, 7])
def test_shap_by_patterns_equals_shap_by_rows(depth):
    """Many rows take what each pattern pays from a table, few work it out; a tree's values and its base sum to its leaf."""
    rng, n = np.random.default_rng(depth), 2 ** (depth + 1) - 1
    i = np.arange(n)
    inner = i < 2 ** depth - 1
    tree = {"feature": np.where(inner, rng.integers(0, 9, n), -1), "threshold": rng.standard_normal(n), "left": np.where(inner, 2 * i + 1, -1), "right": np.where(inner, 2 * i + 2, -1),
            "value": rng.standard_normal((n, 1)), "cover": 2.0 ** (depth - np.floor(np.log2(i + 1))), "weight": 1.0, "outputs": [None]}
    leaf = H.leaf_paths(tree, 9)
    x = rng.standard_normal((700, 9))
    x[:3] = [np.nan] * 9, [np.inf] * 9, [-np.inf] * 9
    asked, shares = [], H._shares
    H._shares = lambda agrees, leaf: asked.append(len(agrees)) or shares(agrees, leaf)
    try:
        many = H.shap_batch(x, leaf)
        assert asked == [2 ** leaf["feature"].shape[1]]     # once for the batch, whatever its rows
    finally:
        H._shares = shares
    few = np.concatenate([H.shap_batch(x[k:k + 1], leaf) for k in range(len(x))])
    assert np.allclose(many, few, atol=1e-12)
    at = np.zeros(len(x), int)
    for _ in range(depth):
        at = np.where(x[np.arange(len(x)), tree["feature"][at]] <= tree["threshold"][at], tree["left"][at], tree["right"][at])
    assert np.allclose(many.sum(axis=(1, 2)) + leaf["base"], tree["value"][at, 0])


def test_shap_of_a_symmetric_tree_is_paid_by_answers(monkeypatch):
    """Rows that answer a symmetric tree's few questions alike are paid once; a tree without a split pays nothing."""
    rng, depth = np.random.default_rng(4), 6
    i = np.arange(2 ** (depth + 1) - 1)
    level, inner = np.floor(np.log2(i + 1)).astype(int), i < 2 ** depth - 1
    asked = [(2, 0.5), (0, -0.3), (2, -0.1), (4, 0.0), (1, 1.0), (0, 0.7), (0, 0.0)]
    tree = {"feature": np.where(inner, np.array([f for f, _ in asked])[level], -1), "threshold": np.array([c for _, c in asked])[level], "left": np.where(inner, 2 * i + 1, -1),
            "right": np.where(inner, 2 * i + 2, -1), "value": rng.standard_normal((len(i), 1)), "cover": 2.0 ** (depth - level), "weight": 0.5, "outputs": [None]}
    leaf = H.leaf_paths(tree, 5)
    x = rng.standard_normal((500, 5))
    x[:3] = [np.nan] * 5, [np.inf] * 5, [-np.inf] * 5
    few = np.concatenate([H.shap_batch(x[k:k + 1], leaf) for k in range(len(x))])
    paid, shap = [], H._shap
    monkeypatch.setattr(H, "_shap", lambda x, *a: paid.append(len(x)) or shap(x, *a))
    assert np.allclose(H.shap_batch(x, leaf, H.bin_rows(x, [leaf])), few, atol=1e-12) and len(paid) == 1 and paid[0] <= 2 ** depth
    stump = H.leaf_paths({"feature": np.array([-1]), "threshold": np.zeros(1), "left": np.array([-1]), "right": np.array([-1]), "value": np.ones((1, 1)), "cover": np.ones(1), "weight": 1.0, "outputs": [None]}, 5)
    assert (H.shap_batch(x, stump) == 0).all() and H.shap_batch(x, stump).shape == (500, 1, 5)


def test_shap_rows_of_many_batches(spark):
    """Batches are put together for the trees' tables; keys, also null ones, stay with their rows."""
    from pyspark.ml.linalg import Vectors
    t = {"feature": np.array([1, -1, 0, -1, -1]), "threshold": np.array([0.0, 0, 1.0, 0, 0]), "left": np.array([1, -1, 3, -1, -1]), "right": np.array([2, -1, 4, -1, -1]),
         "value": np.array([[0.0], [2], [0], [-1], [4]]), "cover": np.array([9.0, 4, 5, 3, 2]), "weight": 1.0, "outputs": [None]}
    rows = [(None if i == 7 else str(i), Vectors.dense([float(i % 3), float(i % 5 - 2)])) for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = H.tree_contributions(spark.createDataFrame(rows, ["k", "features"]).repartition(2), "k", ["a", "b"], [t, t]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 900 and {(r["class"], r.feature) for r in got} == {("margin", "a"), ("margin", "b"), ("margin", "__base")}
    total = {}
    for r in got:
        total[r.row_key] = total.get(r.row_key, 0.0) + r.contribution
    for key, v in rows:
        want = 2 * (2 if v[1] <= 0 else -1 if v[0] <= 1 else 4)
        assert abs(total[key] - want) < 1e-9


def test_draws_meet_every_background_row(spark):
    back = [[float(i)] * 3 for i in range(5)]
    taken = H.draws(back, 3, orders=2)
    assert {tuple(t.background) for t in taken} == {tuple(b) for b in back} and len(taken) == 10
    assert all(a.order == b.order[::-1] and a.background == b.background for a, b in zip(taken[::2], taken[1::2]))
    rows = spark.createDataFrame([(str(i), Vectors.dense([float(i)])) for i in range(20)], ["row_key", "features"])
    assert H.background_rows(rows, 4) == H.background_rows(rows.repartition(5), 4) and len(H.background_rows(rows, 4)) == 4
    assert H.draws([], 3, orders=2) == []
    with pytest.raises(ValueError):
        H.background_rows(rows, H.MAX_BACKGROUND + 1)
    with pytest.raises(ValueError):
        H.sampled_contributions(rows, "row_key", ["a"], lambda df: df, ["u"], [])


def test_rebalance_keeps_rows_and_interpolates(spark, small_dir):
    from quillstat.operators import protocol as K
    t = V.lineitem_targets(spark, small_dir).withColumn("row_key", F.concat_ws("|", "l_orderkey", "l_linenumber"))
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = K.rebalance(t, "is_big", "row_key", feats)
    counts = {(r["is_big"], r["synthetic"]): r["count"] for r in out.groupBy("is_big", "synthetic").count().collect()}
    assert counts[(0, False)] + counts[(1, False)] == t.count()          # every original row kept
    minority = 0 if counts[(0, False)] < counts[(1, False)] else 1
    total_min = counts[(minority, False)] + counts.get((minority, True), 0)
    assert abs(total_min - counts[(1 - minority, False)]) <= 0.05 * counts[(1 - minority, False)]
    lo_hi = t.where(F.col("is_big") == minority).agg(*[F.min(f) for f in feats], *[F.max(f) for f in feats]).first()
    syn = out.where("synthetic").agg(*[F.min(f) for f in feats], *[F.max(f) for f in feats]).first()
    for i in range(len(feats)):
        assert syn[i] >= lo_hi[i] - 1e-9 and syn[len(feats) + i] <= lo_hi[len(feats) + i] + 1e-9


def test_neighbours_in_class_are_the_true_ones(spark):
    """On 5,000 rows of three classes: at least 90% of the true five nearest are found; identical rows meet in bounded blocks."""
    from quillstat.operators import protocol as K
    rng = np.random.default_rng(3)
    x = rng.standard_normal((5000, 4))
    cls = rng.choice(["a", "b", "c"], 5000, p=[0.7, 0.29, 0.01])
    df = spark.createDataFrame([(str(c), i, v.tolist()) for i, (c, v) in enumerate(zip(cls, x))], "c string, i long, x array<double>")
    found = {r["row"]: {e["row"] for e in r["near"]} for r in K.nearest_in_class(df, "c", "i", "x").collect()}
    hit = 0
    for c in "abc":
        own = np.flatnonzero(cls == c)
        d = ((x[own][:, None] - x[own][None]) ** 2).sum(axis=2)
        np.fill_diagonal(d, np.inf)
        for i, js in zip(own, np.argsort(d, axis=1)[:, :5]):
            assert len(found[i]) == 5 and i not in found[i] and all(cls[j] == c for j in found[i])
            hit += len(found[i] & set(own[js].tolist()))
    assert hit >= 0.9 * 5 * 5000
    same = spark.range(3000).select(F.lit("s").alias("c"), F.col("id").alias("i"), F.array(*[F.lit(1.0)] * 4).alias("x"))
    near = K.nearest_in_class(same, "c", "i", "x", block_rows=100).collect()
    assert len(near) == 3000 and all(len(r["near"]) == 5 and all(e["distance"] == 0 for e in r["near"]) for r in near)


def test_rebalance_edges(spark):
    """Nulls, a row alone in its class, repeated keys, many classes, an empty table."""
    from quillstat.operators import protocol as K
    schema = "k string, y string, a double, b double"
    rows = [(f"m{i}", "big", float(i), 1.0) for i in range(20)] + [("one", "single", 5.0, None)] + [("r", "twice", 1.0, 2.0)] * 2 + [("n", None, 0.0, 0.0)]
    out = K.rebalance(spark.createDataFrame(rows, schema), "y", "k", ["a", "b"]).collect()
    n = {(y, s): sum(1 for r in out if r["y"] == y and r["synthetic"] == s) for y in ("big", "single", "twice", None) for s in (False, True)}
    assert n == {("big", False): 20, ("big", True): 0, ("single", False): 1, ("single", True): 19, ("twice", False): 2, ("twice", True): 18,
                 (None, False): 1, (None, True): 0}
    assert all(r["a"] == 5.0 and r["b"] is None for r in out if r["y"] == "single")
    assert K.rebalance(spark.createDataFrame([], schema), "y", "k", ["a", "b"]).count() == 0


def test_decode_is_the_inverse_of_encode_and_features_are_padded(spark):
    from quillstat.operators import prepare as D
    df = spark.createDataFrame([("1", "x", None), ("2", None, "q"), ("3", "y", "q")], "k string, a string, b string")
    d = D.fit_dictionary(df, ["a", "b"], "missing")
    codes = D.encode(df, d, ["a", "b"], {"a": 3, "b": 2}, "missing")
    back = {r["k"]: (r["a"], r["b"]) for r in D.decode(codes, d, ["a", "b"]).collect()}
    assert back == {"1": ("x", "missing"), "2": ("missing", "q"), "3": ("y", "q")}
    wide = D.align_features(codes, ["b", "a"], 4, keep=["k"])
    assert wide.columns == ["k", "f_0", "f_1", "f_2", "f_3"] and {(r["f_2"], r["f_3"]) for r in wide.collect()} == {(0.0, 0.0)}
    assert D.align_features(codes, ["b", "a"], 1).columns == ["f_0"]


def test_model_queries_fit_the_default_size():
    from quillstat.operators import models as M
    from quillstat.plans import catalog_fk
    assert catalog_fk.QUERY_PARAMS == M.TreeParams() and (M.TreeParams().n_trees, M.TreeParams().max_depth) == (100, 7)


def test_correlation_of_pairs_constant_on_shared_rows(spark):
    """NULL where a column does not vary over the pair's shared rows, though it does elsewhere; a tiny but real variance counts."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(4000):
        line = float(i % 7 + 1)
        tiny = 1e6 + (1e-4 if i % 2 else 0.0)
        rows.append((line, 0.01 * (i % 9) if line == 3.0 else None, tiny if line == 2.0 else 1e6 + 50 * rng.standard_normal(), float(i % 2) if line == 2.0 else None))
    df = spark.createDataFrame(rows, "line double, sparse double, wide double, marker double").repartition(5)
    got = {(r.col_x, r.col_y): r.r for r in E.correlation(df, df.columns).collect()}
    assert got["line", "sparse"] is None and got["sparse", "line"] is None and got["line", "marker"] is None
    assert got["wide", "marker"] == 1.0 == got["marker", "wide"] and got["sparse", "sparse"] == 1.0 and got["sparse", "marker"] is None
