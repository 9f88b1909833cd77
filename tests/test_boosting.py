"""Histogram boosting against brute force on small tables."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quillstat.operators import boosting as B


def table(spark, n=500, seed=1, features=4, bad=False):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, features)), 1)
    y = (x[:, 0] > 0.3) * 2.0 + x[:, 1] * (x[:, 2] > 0) + rng.standard_normal(n) * 0.1
    rows = [(str(i), float(y[i]), float(1 + i % 3), i % 3, Vectors.dense(x[i].tolist())) for i in range(n)]
    if bad:
        rows += [(None, 0.5, 1.0, 0, Vectors.dense([float("nan")] * features)), ("x", 1.0, 0.0, 1, Vectors.dense([1e300] * features))]
    return spark.createDataFrame(rows, ["row_key", "label", "weight", "fold", "features"]).repartition(3, "row_key"), x, y


def tree_by_hand(spec, x, g, h, depth=0):
    """The best split over all distinct values, recursively: (feature, threshold, left, right) or a leaf's value."""
    def shrunk(v):
        return math.copysign(max(abs(v) - spec.l1, 0), v)

    def score(rows):
        return shrunk(g[rows].sum()) ** 2 / (h[rows].sum() + spec.l2)
    best = (1e-12, None)
    if depth < spec.max_depth:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                if min(h[left].sum(), h[~left].sum()) < spec.min_child_hessian:
                    continue
                gain = (score(left) + score(~left) - score(np.ones(len(x), bool))) / 2 - spec.gamma
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
    if best[1] is None:
        return -spec.rate * shrunk(g.sum()) / (h.sum() + spec.l2)
    f, cut = best[1]
    left = x[:, f] <= cut
    return (f, cut, tree_by_hand(spec, x[left], g[left], h[left], depth + 1), tree_by_hand(spec, x[~left], g[~left], h[~left], depth + 1))


def as_nested(t, i=0):
    if t.feature[i] < 0:
        return float(t.value[i])
    return (int(t.feature[i]), float(t.threshold[i]), as_nested(t, t.left[i]), as_nested(t, t.right[i]))


def close(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a[0] == b[0] and math.isclose(a[1], b[1]) and close(a[2], b[2]) and close(a[3], b[3])


def test_splits_equal_brute_force(spark):
    df, x, y = table(spark)
    spec = B.Spec("s", "squared", rounds=3, max_depth=3, rate=0.5, l1=0.7, l2=2.0, gamma=0.4, min_child_hessian=9.0)
    yes = B.Spec("c", "logistic", rounds=2, max_depth=3, rate=0.5, l1=0.2, l2=1.0, gamma=0.1, min_child_hessian=3.0, weighted=True)
    squared = B.fit(df, [spec], 4, max_bins=255, local_rows=0)["s"]
    margin = np.full(len(y), y.mean())
    for t in squared.trees[0]:
        want = tree_by_hand(spec, x, margin - y, np.ones(len(y)))
        assert close(as_nested(t), want) and isinstance(want, tuple)
        margin += t.value[t.of_values(x)]
    z, w = (y > 0.5).astype(float), 1.0 + np.arange(len(y)) % 3
    logistic = B.fit(df.withColumn("label", (F.col("label") > 0.5).cast("double")), [yes], 4, max_bins=255)["c"]
    share = (z * w).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    for t in logistic.trees[0]:
        p = 1 / (1 + np.exp(-margin))
        assert close(as_nested(t), tree_by_hand(yes, x, w * (p - z), w * p * (1 - p)))
        margin += t.value[t.of_values(x)]


def test_side_by_side_equals_alone_and_partitions_do_not_matter(spark):
    df, x, y = table(spark, bad=True)
    specs = [B.Spec("a", "squared", rounds=4, max_depth=4, row_share=0.8, column_share=0.5, fold=1), B.Spec("b", "squared", policy="leaf", rounds=3, max_leaves=6, min_child_rows=20),
             B.Spec("c", "squared", policy="symmetric", rounds=5, max_depth=3, l2=3.0)]
    both = B.fit(df, specs, 4, checkpoint_interval=2)
    for local_rows in (0, 120):  # all nodes by levels, and small ones in tasks of their own
        other = B.fit(df, specs, 4, local_rows=local_rows)
        assert all(np.allclose(other[s.name].margins(x), both[s.name].margins(x)) and [t.levels for t in other[s.name].trees[0]] == [t.levels for t in both[s.name].trees[0]] for s in specs)
    for s in specs:
        alone = B.fit(df.repartition(1), [s], 4, checkpoint_interval=50)[s.name]
        assert np.allclose(alone.margins(x), both[s.name].margins(x)) and len(alone.trees[0]) == s.rounds
    # the held-out fold is not learned from: other labels there change nothing
    moved = B.fit(df.withColumn("label", F.when(F.col("fold") == 1, 99.0).otherwise(F.col("label"))), specs[:1], 4)["a"]
    assert np.allclose(moved.margins(x), both["a"].margins(x))
    rows = {r.row_key: r.prediction for r in both["a"].transform(df).select("row_key", "prediction").collect()}
    want = both["a"].margins(x)[:, 0]
    assert len(rows) == 502 and all(math.isclose(rows[str(i)], want[i], rel_tol=1e-9) for i in range(500)) and all(math.isfinite(v) for v in rows.values())


def test_leaf_wise_growth(spark):
    df, x, y = table(spark)
    base = dict(objective="squared", rounds=1, max_depth=4, rate=1.0, l2=1e-9)
    got = B.fit(df, [B.Spec("level", **base), B.Spec("all", policy="leaf", max_leaves=16, **base), B.Spec("some", policy="leaf", max_leaves=8, **base),
                     B.Spec("flat", **{**base, "max_depth": 3})], 4)
    loss = {n: float(((m.margins(x)[:, 0] - y) ** 2).mean()) for n, m in got.items()}
    leaves = {n: int((m.trees[0][0].feature < 0).sum()) for n, m in got.items()}
    assert math.isclose(loss["all"], loss["level"]) and leaves["all"] == leaves["level"]
    assert leaves["some"] == 8 == leaves["flat"] and loss["some"] <= loss["flat"]


def test_symmetric_scores_are_native_and_equal_the_walk(spark):
    df, x, y = table(spark, bad=True)
    model = B.fit(df, [B.Spec("s", "squared", policy="symmetric", rounds=6, max_depth=4, l2=3.0)], 4)["s"]
    for t in model.trees[0]:
        assert 1 <= len(t.levels) <= 4 and len(t.feature) == 2 ** (len(t.levels) + 1) - 1
    out = model.transform(df)
    assert "Python" not in out._jdf.queryExecution().toString()
    got = {r.row_key: r.prediction for r in out.select("row_key", "prediction").collect()}
    assert all(math.isclose(got[str(i)], v, rel_tol=1e-12) for i, v in enumerate(model.margins(x)[:, 0]))
    assert math.isclose(got[None], model.margins(np.full((1, 4), np.nan))[0, 0])


def test_symmetric_scores_are_compiled(spark):
    """No function over arrays is walked for each row and tree: 100 trees of depth 7 score 20,000 rows."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((200, 3))
    x[:3] = [np.nan] * 3, [np.inf] * 3, [-np.inf] * 3
    forest = []
    for _ in range(100):
        levels = [(int(rng.integers(3)), 0) for _ in range(7)]
        deep = np.array([d for d in range(8) for _ in range(2 ** d)])
        cuts = np.array([*rng.standard_normal(7), 0.0])
        inner, node = deep < 7, np.arange(255)
        forest.append(B.Tree(np.where(inner, np.array([f for f, _ in levels] + [-1])[deep], -1), np.zeros(255, int), np.where(inner, 2 * node + 1, -1), np.where(inner, 2 * node + 2, -1),
                             rng.standard_normal(255), np.ones(255), cuts[deep], levels))
    model = B.Booster(B.Spec("s", "squared", policy="symmetric"), 3, np.array([0.25]), [forest])
    df = spark.createDataFrame([(i, Vectors.dense(v.tolist())) for i, v in enumerate(x)], ["i", "features"]).crossJoin(spark.range(100).select(F.col("id").alias("copy")))
    out = model.transform(df)
    assert "lambda" not in out._jdf.queryExecution().toString()
    want = model.margins(x)[:, 0]
    rows = out.select("i", "prediction").collect()
    assert len(rows) == 20_000 and all(math.isclose(r.prediction, want[r.i], rel_tol=1e-12, abs_tol=1e-12) for r in rows)
    assert B._double(math.inf) == "double('inf')" and B._double(-0.5) == "-0.5D"


@pytest.mark.parametrize("policy", ["level", "leaf", "symmetric"])
def test_softmax_of_three_classes(spark, tmp_path, policy):
    from pyspark.ml.functions import vector_to_array
    df, x, y = table(spark)
    label = np.digitize(y, [0.0, 1.5]).astype(float)
    df = df.withColumn("label", F.when(F.col("label") < 0, 0.0).when(F.col("label") < 1.5, 1.0).otherwise(2.0))
    model = B.fit(df, [B.Spec("m", "softmax", classes=3, policy=policy, rounds=15, max_depth=4, rate=0.3, weighted=True)], 4)["m"]
    rows = model.transform(df).select("row_key", "prediction", vector_to_array("probability").alias("p")).collect()
    assert all(math.isclose(sum(r.p), 1) and min(r.p) > 0 and r.prediction == int(np.argmax(r.p)) for r in rows)
    assert np.mean([r.prediction == label[int(r.row_key)] for r in rows]) > 0.9
    model.save(str(tmp_path / "m"), spark)
    again = B.Booster.load(str(tmp_path / "m"), spark)
    assert np.array_equal(again.margins(x), model.margins(x))
    assert {(r.row_key, tuple(r.p)) for r in rows} == {(r.row_key, tuple(r.p)) for r in again.transform(df).select("row_key", vector_to_array("probability").alias("p")).collect()}


def test_nothing_to_learn(spark):
    df, x, y = table(spark, 40)
    same = df.withColumn("label", F.lit(3.0))
    got = B.fit(same, [B.Spec("s", "squared", rounds=2), B.Spec("l", "squared", policy="leaf", rounds=2), B.Spec("y", "squared", policy="symmetric", rounds=2)], 4)
    assert all(np.allclose(m.margins(x), 3.0) for m in got.values())
    assert all(r.prediction == 3.0 for r in got["y"].transform(df).collect())
    none = B.fit(df.where("false"), [B.Spec("s", "squared", rounds=2)], 4)["s"]
    assert np.allclose(none.margins(x), 0.0)
    assert B.tasks_for(0) == 1 and B.tasks_for(48_000) == 4 and B.tasks_for(10**9) < 10**9 / 90_000


def test_large_tables_send_no_rows(spark, monkeypatch):
    """Above ``LOCAL_TABLE_ROWS`` the sums of all levels meet, and no node's rows; the trees are the same."""
    df, x, _ = table(spark)
    spec = B.Spec("m", "squared", rounds=3, max_depth=4, rate=0.3)
    near = B.fit(df, [spec], 4, local_rows=100)["m"]
    monkeypatch.setattr(B, "LOCAL_TABLE_ROWS", 200)
    monkeypatch.setattr(B, "_rows_of", lambda *a: pytest.fail("rows were sent"))
    far = B.fit(df, [spec], 4, local_rows=100)["m"]
    assert all(close(as_nested(a), as_nested(b)) for a, b in zip(near.trees[0], far.trees[0]))


def test_rows_step_down_together():
    tree = B.Tree(np.array([1, -1, 0, -1, -1]), np.array([2, 0, 5, 0, 0]), np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1]), np.arange(5.0), np.ones(5))
    bins = np.random.default_rng(3).integers(0, 9, (2, 200)).astype(np.uint8)
    want = np.where(bins[1] <= 2, 1, np.where(bins[0] <= 5, 3, 4))
    assert tree.depth() == 2 and (tree.of_bins(bins) == want).all()
    assert (B.Tree(*(np.array([v]) for v in (-1, 0, -1, -1)), np.zeros(1), np.ones(1)).of_bins(bins) == 0).all()


def test_jobs_start_few_tasks_and_send_no_empty_bins():
    """A job starts a dozen tasks for 3.6 million rows, and sums are as long as the features have bins."""
    assert B.tasks_for(3_600_000) == 12 and B.tasks_for(216_000_000) < 300
    rng = np.random.default_rng(5)
    widths, allowed, count = [3, 64, 7], np.array([True, False, True]), 4
    bins = np.stack([rng.integers(0, w, 300) for w in widths]).astype(np.uint8)
    rows = np.flatnonzero(rng.random(300) < 0.5)
    place, g, h = rng.integers(0, count, len(rows)), rng.standard_normal(len(rows)), rng.random(len(rows))
    for hessian in (h, None):
        total = np.zeros(B._size(count, widths, allowed))
        assert len(total) == 3 * count * (3 + 7)
        B._add_sums(total, bins, rows, place, g, hessian, count, widths, allowed)
        got = B._spread(total, count, widths, allowed)
        want = np.zeros((count, 3, 64, 3))
        for f in (0, 2):
            np.add.at(want, (place, f, bins[f, rows]), np.stack([g, np.ones(len(rows)) if hessian is None else h, np.ones(len(rows))], 1))
        assert np.allclose(got, want)


def random_tree(rng, leaves, features, cuts):
    """A tree grown by splitting leaves at random; a cut's threshold is twice its number."""
    feature, cut, left, right, open_ = [-1], [0], [-1], [-1], [0]
    while len(open_) < leaves:
        i = open_.pop(int(rng.integers(len(open_))))
        feature[i], cut[i], left[i], right[i] = int(rng.integers(features)), int(rng.integers(cuts)), len(feature), len(feature) + 1
        open_ += [left[i], right[i]]
        for a, v in ((feature, -1), (cut, 0), (left, -1), (right, -1)):
            a += [v, v]
    n = len(feature)
    return B.Tree(*map(np.array, (feature, cut, left, right)), rng.standard_normal(n), np.ones(n), 2.0 * np.array(cut))


def test_rows_find_their_leaf_by_masks(monkeypatch):
    """Trees are not walked row by row: rows are binned once, and a leaf is found by what each feature leaves open."""
    rng = np.random.default_rng(8)
    forest = [random_tree(rng, k, 3, 50) for k in (1, 2, 31, 64, 65, 128, 200, 300)]
    x = np.concatenate([rng.integers(-1, 102, (9_000, 3)).astype(float), [[np.nan] * 3, [np.inf] * 3, [-np.inf] * 3, [0.0, np.nan, 98.0]]])
    want = np.full(len(x), 0.5)
    for t in forest:
        want += t.value[t.of_values(x)]
    bins = np.clip(np.ceil(np.where(np.isnan(x), np.inf, x) / 2), 0, 50).T   # at most the cut if the value is at most the threshold
    for kind in (np.uint8, np.intp):
        for t in forest:
            assert (t.of_bins(bins.astype(kind)) == t.of_values(x)).all()
    monkeypatch.setattr(B.Tree, "of_values", lambda *a: pytest.fail("a row was walked"))
    got = B.Booster(B.Spec("m", "squared"), 3, np.array([0.5]), [forest]).margins(x)[:, 0]
    assert (got == want).all()
    assert B.Booster(B.Spec("m", "squared"), 3, np.array([0.5]), [forest]).margins(x[:0]).shape == (0, 1)
    assert (B.Booster(B.Spec("m", "squared"), 0, np.array([0.5]), [[]]).margins(np.zeros((4, 0))) == 0.5).all()


def test_features_are_summed_and_looked_up_in_groups(spark, monkeypatch):
    """A row is added to the sums once for a group of features, and finds its leaf by one look for a group; sums and leaves are those of the single features."""
    rng = np.random.default_rng(11)
    layout = B.Layout([64, 7, 50, 64, 11, 9, 3, 2, 7, 12, 31])
    assert len(layout.groups) == 4 and max(layout.sizes) <= B.GROUP_CODES and sorted(sum(layout.groups, [])) == list(range(11))
    assert B.Layout([5000, 2, 300]).groups and B.Layout([70_000]).dtype == np.uint32 and B.Layout([]).groups == [] and len(B.Layout([64] * 200).groups) == 200
    bins = np.stack([rng.integers(0, w, 900) for w in layout.widths])
    codes = layout.codes(bins)
    assert codes.shape == (4, 900) and codes.dtype == np.uint16 and (layout.bins(codes) == bins).all()
    rows, count, allowed = np.flatnonzero(rng.random(900) < 0.5), 5, rng.random(11) < 0.7
    place, g, h = rng.integers(0, count, len(rows)), rng.standard_normal(len(rows)), rng.random(len(rows))
    for hessian in (h, None):
        want = np.zeros(B._size(count, layout.widths, allowed))
        B._add_sums(want, bins, rows, place, g, hessian, count, layout.widths, allowed)
        joint = B._Joint(count, layout, allowed)
        joint.add(codes, rows[:200], place[:200], g[:200], None if hessian is None else h[:200])
        joint.add(codes, rows[200:], place[200:], g[200:], None if hessian is None else h[200:])
        assert np.allclose(joint.total(), want)
    # a node's sums are the same numbers, to the last bit, alone and among others: a parent less its child leaves nothing where the child has all rows
    alone, among = B._Joint(1, layout, allowed), B._Joint(5, layout, allowed)
    alone.add(codes, rows, np.zeros(len(rows), int), g, h)
    among.add(codes, rows, np.full(len(rows), 3), g, h)
    assert np.array_equal(B._spread(alone.total(), 1, layout.widths, allowed)[0], B._spread(among.total(), 5, layout.widths, allowed)[3])
    for leaves in (1, 2, 64, 65, 200, 300):
        tree = random_tree(rng, leaves, 11, 2)
        nodes, found = tree.found(codes.astype(np.intp), layout)
        assert (nodes.take(found) == tree.of_bins(bins.astype(np.uint8))).all()
    df, x, _ = table(spark, 2000)
    specs = [B.Spec("a", "squared", rounds=3, max_depth=4, row_share=0.8, fold=1), B.Spec("s", "squared", policy="symmetric", rounds=3, max_depth=3), B.Spec("y", "squared", policy="leaf", rounds=2, weighted=True)]
    marked, joined = [], B._joined
    monkeypatch.setattr(B, "_joined", lambda builders, *a: (joined(builders, *a), marked.extend(b.joint for b in builders if b)))
    grouped = B.fit(df.coalesce(1), specs, 4, max_bins=4, local_rows=0)
    assert any(marked)
    monkeypatch.setattr(B, "JOINT_BYTES", 0)
    marked.clear()
    single = B.fit(df.coalesce(1), specs, 4, max_bins=4, local_rows=0)
    assert not any(marked)
    assert all(close(as_nested(a), as_nested(b)) for s in specs for a, b in zip(grouped[s.name].trees[0], single[s.name].trees[0]))


def test_blocks_hold_few_bytes_a_row():
    """Every level reads all blocks: labels and weights of few values are a byte, and features that fit into one code are two."""
    layout, n = B.Layout([64, 7, 50, 64]), 1000
    parts = (np.zeros((1, n)), np.arange(n) % 2.0, np.ones(n), np.zeros(n, np.int16), np.arange(n), np.zeros((1, n)))
    block = B._blocks(layout)([n, layout.codes(np.zeros((4, n), int)).tobytes(), *(p.tobytes() for p in parts[1:])])
    assert block.y.codes.dtype == np.uint8 and (block.y.take(np.arange(5)) == [0, 1, 0, 1, 0]).all()
    assert (B._Numbers.of(np.arange(n) / 7).take(np.arange(n)) == np.arange(n) / 7).all()
    assert sum(a.nbytes for a in (block.codes, block.y.codes, block.w.codes, block.fold, block.id, block.margin)) == n * (2 * len(layout.groups) + 1 + 1 + 2 + 8 + 8)


def test_models_are_scored_together(spark):
    """Candidates, and the base models of a stack, read each batch of rows once; their numbers are those of each alone."""
    from pyspark.ml.functions import vector_to_array

    from quillstat.operators import models as M
    df, x, y = table(spark, bad=True)
    for n_classes, label in ((2, (F.col("label") > 0.5).cast("double")), (3, F.when(F.col("label") < 0, 0.0).when(F.col("label") < 1.5, 1.0).otherwise(2.0)), (0, F.col("label"))):
        cands = M.CLASSIFICATION_CANDIDATES if n_classes else M.REGRESSION_CANDIDATES
        rows = df.withColumn("label", label)
        models = B.fit(rows, [M.spec(c, M.TreeParams(n_trees=3, max_depth=3), n_classes) for c in cands], 4)
        got = M.predictions_of(cands, models, rows)
        assert got._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("ArrowEvalPython") == 1 and got.columns == ["model", "ordinal", "row_key", "label", "prediction"]
        want = {(c.name, c.ordinal, r.row_key, r.label, r.prediction) for c in cands for r in models[c.name].transform(rows).collect()}
        assert {tuple(r) for r in got.collect()} == want and len(want) == 3 * 502
        if n_classes:
            bases = M.base_probability_columns({c.name: M._wrap(models[c.name], c.name) for c in cands}, rows, ["row_key"])
            probabilities = {(r.row_key, c.name): r.p for c in cands for r in models[c.name].transform(rows).select("row_key", vector_to_array("probability").alias("p")).collect()}
            for r in bases.select("row_key", "meta", *[vector_to_array(f"p_{c.name}").alias(c.name) for c in cands]).collect():
                each = [probabilities[r.row_key, c.name] for c in cands]
                assert [r[c.name] for c in cands] == each and list(r.meta) == sum(each, []) and len(r.meta) == 3 * n_classes


def test_cached_blocks_stay_small_and_boosting_joins_them(spark):
    """A block of the prepared table does not grow to a million rows with the table; boosting runs few tasks over many blocks."""
    from quillstat.plans import analysis as A
    assert all(A.cached_blocks(n) == B.tasks_for(n) for n in (0, 600, 60_000, 3_600_000))
    assert all(n / A.cached_blocks(n) <= 500_000 for n in (36_000_000, 216_000_000, 10**9)) and A.cached_blocks(216_000_000) == 864
    df, x, _ = table(spark, 400)
    spec = B.Spec("m", "squared", rounds=2, max_depth=3)
    tasks, summer = [], B._sums_of
    B._sums_of = lambda state, *a: tasks.append(state.getNumPartitions()) or summer(state, *a)
    try:
        many, few = (B.fit(df.repartition(k, "row_key"), [spec], 4, local_rows=0)["m"] for k in (9, 2))
    finally:
        B._sums_of = summer
    assert set(tasks) == {B.tasks_for(400), 2} and np.allclose(many.margins(x), few.margins(x))
