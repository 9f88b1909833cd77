"""quillstat: automated tabular analytics written as Spark DataFrame jobs.

Layout
------
sources/    reading CSV / parquet, header clean-up, missing tokens, type inference
functions/  reusable column expressions (statistics, hashing, parsing)
operators/  profile, EDA, preparation, models, metrics, explanation, what-if, facts
plans/      end-to-end analysis and the query catalogue used by the driver
streaming/  scoring a streaming DataFrame with a fitted analysis
"""

from quillstat.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
