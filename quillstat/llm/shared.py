"""Tables in the shared folder, and connected components, for this package's operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.session import checkpoint_dir

#: numbers of rows without a doc_id of their own
SURROGATES = 1 << 62


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, lost executors cost nothing."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size on disk of the files behind a DataFrame, as Catalyst estimates it for its leaves."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): returns (node, component), component the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014), each an
    aggregation and a join; the edge table is written to the shared folder each
    round.  Nodes without edges are not returned.  Null ends are ignored.
    """
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stash(e, "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", "m")))
        e = stash(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def in_blocks(df: DataFrame, key: str, member: str, size: int, block: int) -> DataFrame:
    """Split groups into pairs of blocks, so that all pairs of a group meet without one task holding it.

    ``size`` is the column with the group's row count.  Adds ``bi``, ``bj`` (bi <= bj)
    and ``side`` (0: the row is of block bi, 1: of block bj).  A row of a group with
    k blocks is given k times; groups of at most ``block`` rows are given once.
    """
    k = F.ceil(F.col(size) / F.lit(float(block))).cast("int")
    own = F.pmod(F.xxhash64(F.col(member)), k).cast("int")
    return (df.withColumn("_k", k).withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
            .withColumn("bi", F.least("_own", "_other")).withColumn("bj", F.greatest("_own", "_other"))
            .withColumn("side", F.when(F.col("_own") == F.col("bi"), 0).otherwise(1))
            .drop("_k", "_own", "_other"))


def numbered(docs: DataFrame) -> DataFrame:
    """``doc_id``, one for each row, and ``row``, a struct of all columns: what an operator decides then holds for that row alone.

    Rows whose doc_id is null or repeated get numbers from ``SURROGATES`` up; all
    others keep theirs.  A table whose ids are sound (a scan of the ids tells) is not copied.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if docs.where("doc_id is null").limit(1).count() + repeated.limit(1).count() == 0:
        return docs.select("doc_id", row)
    rows = stash(docs.select(F.col("doc_id").cast("long").alias("own"), (F.lit(SURROGATES) + F.monotonically_increasing_id()).alias("number"), row), "numbered")
    repeated = repeated.select(F.col("doc_id").cast("long").alias("own"), F.lit(True).alias("again"))
    sound = rows.where("own is not null").join(repeated, "own", "left")
    return (sound.select(F.when(F.col("again"), F.col("number")).otherwise(F.col("own")).alias("doc_id"), "row")
            .unionByName(rows.where("own is null").select(F.col("number").alias("doc_id"), "row")))


def one_text(docs: DataFrame) -> DataFrame:
    """doc_id and text, one row per doc_id: no null doc_id, and of repeated rows the smallest text (null before any).

    Texts are only shuffled if some doc_id does repeat, which a scan of the ids tells.
    """
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count() == 0:
        return docs
    return docs.groupBy("doc_id").agg(F.min(F.struct("text")).alias("t")).select("doc_id", "t.text")
