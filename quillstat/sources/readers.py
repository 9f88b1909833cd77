"""Sources: CSV or parquet scan, header clean-up, missing
tokens and physical type inference.

The reader never infers a schema by sampling on the driver: CSV is read as
text and the types are decided by one distributed aggregate (A4), so the cost
is one scan however large the file is.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions.exprs import INTEGER_PATTERN, NA_TOKENS, NUMERIC_PATTERN, nan_to_null
from quillstat.sources.quoted_csv import read_quoted_csv

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

_BOOL_TOKENS = ["True", "False", "true", "false", "TRUE", "FALSE"]


def load_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A1: CSV as text columns; no driver-side inference.

    Files are split over tasks, also if ``multiline`` allows quoted newlines
    (which takes a second scan, see ``quoted_csv``).
    """
    if multiline:
        return read_quoted_csv(spark, path)
    return spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str, format: str | None = None, multiline: bool = False) -> DataFrame:
    """A1: the same entry for CSV and parquet, then A2-A4.

    ``format`` is "csv" or "parquet"; if None, names with .csv (compressed or not, or a
    folder of that name) are CSV and all else is parquet.
    """
    kind = format or ("csv" if re.search(r"\.csv(\.(gz|bz2|zst|lz4|snappy|deflate))?/?$", path.lower()) else "parquet")
    raw = read_csv(spark, path, multiline) if kind == "csv" else spark.read.format(kind).load(path)
    return prepare_input(raw)


def strip_headers(df: DataFrame) -> DataFrame:
    """A2: trim header names; a collision after trimming is an error."""
    names = [c.strip() for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"duplicate column names after trimming: {dupes}")
    return df.toDF(*names)


def normalise_missing(df: DataFrame) -> DataFrame:
    """A3: missing tokens in text columns and float NaN become NULL."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(NA_TOKENS), c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def type_decisions(df: DataFrame) -> DataFrame:
    """A4 decisions as a DataFrame (column_name, inferred_type), one aggregate.

    Per text column the aggregate counts the non-null values and those that
    match the integer, numeric and boolean patterns (a regex guard first,
    because ``try_cast`` also accepts forms such as ``1d``).  A column becomes
    BIGINT when all values are integers and none is missing (a missing value
    turns an integer column into floats, as in pandas), DOUBLE when all are
    numeric (blanks around a number are allowed, infinities are numbers) or there is
    none, BOOLEAN when all are boolean words and none is missing, and stays
    STRING otherwise.
    """
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    n = F.count(F.lit(1))
    out = []
    for name in text_cols:
        c = F.col(f"`{name}`")
        nn = F.count(c)
        # a number's first character is a blank, sign, point or digit (all below ":") or begins
        # "inf"; an integer is a number: so most other texts are not matched, and none twice
        numeric = ((c < F.lit(":")) | c.substr(1, 1).isin("i", "I")) & c.rlike(NUMERIC_PATTERN)
        is_int = F.count(F.when(numeric & c.rlike(INTEGER_PATTERN) & c.try_cast("bigint").isNotNull(), 1))
        is_num = F.count(F.when(numeric, 1))
        is_bool = F.count(F.when(c.isin(_BOOL_TOKENS), 1))
        decision = (F.when(nn == 0, "double")
                    .when((is_int == nn) & (nn == n), "bigint")
                    .when(is_num == nn, "double")
                    .when((is_bool == nn) & (nn == n), "boolean")
                    .otherwise("string"))
        out.append(F.struct(F.lit(name).alias("column_name"), decision.alias("inferred_type")))
    if not out:
        return df.sparkSession.createDataFrame([], "column_name string, inferred_type string")
    return df.agg(F.array(*out).alias("d")).select(F.inline("d"))


def infer_types(df: DataFrame) -> DataFrame:
    """A4: cast text columns as decided by ``type_decisions`` (a few rows collected)."""
    decided = {r["column_name"]: r["inferred_type"] for r in type_decisions(df).collect()}
    casts = {}
    for name, kind in decided.items():
        c = F.col(f"`{name}`")
        if kind in ("bigint", "double"):
            casts[name] = c.cast(kind)
        elif kind == "boolean":
            casts[name] = F.lower(c) == F.lit("true")
    if not casts:
        return df
    return df.select(*[casts.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def prepare_input(df: DataFrame) -> DataFrame:
    """A2 + A3 + A4 in order."""
    return infer_types(normalise_missing(strip_headers(df)))
