"""Column expressions used by several operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
that the work stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for equal results)
# ---------------------------------------------------------------------------

# Text tokens that a CSV reader treats as missing (pandas ``read_csv`` defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Datetime layouts of the given tables' text, as the SQL twins state them: strptime
# layout and shape.  ``dates`` finds these and others without a list.
DATETIME_FORMATS = [
    ("%Y-%m-%d", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("%Y-%m-%d %H:%M:%S", r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"),
    ("%Y-%m-%dT%H:%M:%S", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"),
    ("%Y/%m/%d", r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"),
    ("%m/%d/%Y", r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"),
]

# Numeric text: blanks around, optional sign, digits with optional fraction and exponent, or infinity.
NUMERIC_PATTERN = r"^[ \t]*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))[ \t]*$"
INTEGER_PATTERN = r"^[ \t]*[+-]?[0-9]+[ \t]*$"

# Split: 20% validation, seed 42.  md5 hex below this bound is 1/5 of the space.
SPLIT_SEED = 42
SPLIT_BOUND = "33333333333333333333333333333333"

# Thresholds of the target rules and the preparation step.
MAX_CLASSES = 20
MIN_REGRESSION_DISTINCT = 10
TEXT_RATIO = 0.5
DROP_MISSING_PCT = 60.0
SMALL_DATA_ROWS = 200
HIST_BINS = 40


# ---------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------

def nan_to_null(c: Column) -> Column:
    """Float NaN becomes SQL NULL (pandas treats NaN as missing)."""
    return F.when(~F.isnan(c), c)


def corrected_skew(c: Column) -> Column:
    """Bias-corrected sample skewness (pandas ``Series.skew``).

    Spark's ``skewness`` is the population form g1; the corrected form is
    g1 * sqrt(n(n-1)) / (n-2).  Null for n < 3, 0 for a constant column.
    """
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.stddev_pop(c) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def md5_key(*cols: Column | str, seed: int = SPLIT_SEED) -> Column:
    """Row-local hash used by the split: md5 of 'k1|k2|...#seed'."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    body = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.md5(F.concat(body, F.lit(f"#{seed}")))


def in_validation(*cols: Column | str, seed: int = SPLIT_SEED) -> Column:
    """True for the 20% of rows that the hash split sends to validation."""
    return md5_key(*cols, seed=seed) < F.lit(SPLIT_BOUND)


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace including newlines (``trim`` keeps them)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")
