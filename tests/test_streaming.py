"""A fitted analysis scores a streaming DataFrame unchanged."""

import os
import tempfile

from pyspark.sql import functions as F


def test_score_stream(spark, small_dir):
    from quillstat.operators import models as M
    from quillstat.plans import analysis as A
    from quillstat.plans import views as V
    from quillstat.streaming.score import score_stream

    df = V.lineitem_targets(spark, small_dir).drop("qty_band", "is_big")
    a = A.run(df, "net_price", "regression", keys=["l_orderkey", "l_linenumber"],
              params=M.TreeParams(n_trees=2, max_depth=3), stack=False)
    src = os.path.join(tempfile.mkdtemp(prefix="quillstat-stream-"), "in")
    df.drop("net_price").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    scored = score_stream(a, stream, "boosted_trees", keep=["l_orderkey", "l_linenumber"])
    q = scored.writeStream.format("memory").queryName("scored_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    out = spark.table("scored_stream")
    assert out.count() == df.count()
    assert out.where(F.col("prediction").isNull()).count() == 0
