"""Score a streaming DataFrame with a fitted analysis.

The fitted preparation is plain column expressions plus broadcast-size
dictionary joins, and the models are MLlib transformers, so the same
``Analysis.score`` applies to ``spark.readStream`` input.  Output goes to any
sink; ``foreachBatch`` gives exactly-once writes to parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def score_stream(analysis, stream: DataFrame, model: str, keep: list[str] | None = None) -> DataFrame:
    """Streaming predictions: the input columns in ``keep`` plus ``prediction``."""
    scored = analysis.score(stream, model)
    cols = (keep or []) + ["prediction"]
    if "probability" in scored.columns:
        cols.append("probability")
    return scored.select(*cols)
