"""A saved analysis scores the same in another session, stack and stream included."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillstat.operators import models as M
from quillstat.plans import analysis as A
from quillstat.plans import results
from quillstat.plans import views as V
from quillstat.streaming.score import score_stream

KEYS = ["l_orderkey", "l_linenumber"]


def scores(a, df, model):
    p = [vector_to_array("probability").alias("p")] if a.task == "classification" else [F.lit(None).alias("p")]
    return sorted((tuple(r[k] for k in KEYS), r.prediction, tuple(r.p or ())) for r in a.score(df, model).select(*KEYS, "prediction", *p).collect())


def test_saved_analysis_scores_the_same(spark, small_dir, tmp_path):
    df = V.lineitem_targets(spark, small_dir).drop("net_price", "qty_band")
    a = A.run(df, "is_big", "classification", keys=KEYS, params=M.TreeParams(n_trees=2, max_depth=3), stack=True)
    results.save_analysis(a, str(tmp_path / "a"))
    other = spark.newSession()
    b = results.load_analysis(other, str(tmp_path / "a"))
    rows = V.lineitem_targets(other, small_dir).drop("net_price", "qty_band")
    assert set(b.models) == set(a.models) == {"boosted_trees", "boosted_trees_balanced", "symmetric_trees", "stacking"}
    for name in a.models:
        want = scores(a, df, name)
        assert scores(b, rows, name) == want and len(want) == df.count()
    classes = {r.predicted_class for r in b.score(rows, "stacking").select("predicted_class").distinct().collect()}
    assert classes <= {r.value for r in a.label_map.collect()} and classes
    folder = str(tmp_path / "in")
    rows.write.parquet(folder)
    stream = other.readStream.schema(rows.schema).parquet(folder)
    q = score_stream(b, stream, "stacking", keep=KEYS).writeStream.format("memory").queryName("saved_scores").outputMode("append").start()
    q.processAllAvailable()
    got = sorted((tuple(r[k] for k in KEYS), r.prediction) for r in other.table("saved_scores").collect())
    q.stop()
    assert got == [(k, p) for k, p, _ in scores(a, df, "stacking")]


def test_saved_regression(spark, small_dir, tmp_path):
    df = V.lineitem_targets(spark, small_dir).drop("is_big", "qty_band")
    cands = [M.REGRESSION_CANDIDATES[2], M.Candidate("random_forest", "random_forest", 3, "regression")]
    a = A.run(df, "net_price", "regression", keys=KEYS, params=M.TreeParams(n_trees=2, max_depth=3), candidates=cands)
    results.save_analysis(a, str(tmp_path / "r"))
    b = results.load_analysis(spark.newSession(), str(tmp_path / "r"))
    rows = V.lineitem_targets(b.features.dictionary.sparkSession, small_dir).drop("is_big", "qty_band")
    for name in ("symmetric_trees", "random_forest"):
        assert scores(b, rows, name) == scores(a, df, name)
