"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and reads again as the next one's docs.
All but the last return the columns of documents; the last adds the weight and
the probability by which each kept document was sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.llm import decontaminate, jaccard, mixing, quality, secret_scan
from quillstat.llm.shared import stash
from quillstat.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(docs: DataFrame):
    """All columns as one, out of the way of an operator's own names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from all labels but the held-out fold's."""
    labels = _table(spark, sf_dir, "labels").where(~quality.held_out(0, 5))
    model = quality.train(docs, labels, "quality")
    rows = docs.select("text", _whole(docs))
    return quality.score(rows, model).where(F.col("score") >= quality.KEEP_AT).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest doc_id."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    ship_package(spark)
    return secret_scan.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by calibrated probabilities, with their weight and probability."""
    topic = ["topic"] if "topic" in docs.columns else []
    return (mixing.mix(docs.select("doc_id", "text", "lang", "source", *topic, _whole(docs))).where("_sampled")
            .select("row.*", F.col("_weight").alias("mix_weight"), F.col("_probability").alias("mix_probability")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_masking),
    ("source_mix", source_mix),
]

#: The classifier, MinHash and the forest have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
