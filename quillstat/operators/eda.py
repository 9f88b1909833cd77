"""Exploratory statistics.

All per-column statistics of one kind are computed by one fused aggregate over
the whole table; grouped statistics (top values, histograms) stack the columns
into one (column, value) relation so that a single shuffle serves every column,
with map-side partial aggregation absorbing hot values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstat.functions.exprs import HIST_BINS, corrected_skew
from quillstat.session import ship_package


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _num(name: str) -> Column:
    return _q(name).cast("double")


def present_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Keep profiled names that are still columns of ``df`` (order of ``names``)."""
    have = set(df.columns)
    return [n for n in names if n in have]


def numeric_summary(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """C2 + C3: mean, sample std, min, max and corrected skew, rounded.

    Rows (ordinal, column_name, mean, std, min, max, skew); one aggregate pass.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = _num(c)
        aggs += [F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                 corrected_skew(x).alias(f"skew{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                     *[F.round(F.col(f"{m}{i}"), digits).alias(m) for m in ("mean", "std", "min", "max", "skew")])
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def _stack_as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    items = [F.struct(F.lit(i).alias("ordinal"), _q(c).cast("string").alias("value"))
             for i, c in enumerate(cols)]
    return df.select(F.explode(F.array(*items)).alias("e")).select("e.*").where(F.col("value").isNotNull())


def top_values(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """C4: the k most frequent values per column (ties by value), nulls excluded.

    Rows (ordinal, column_name, value_rank, value, count).  Partial counts are
    merged map-side, and the rank limit is applied per task before the shuffle
    (window-group limit), so a hot value or column costs one row per task.
    """
    names = F.array(*[F.lit(c) for c in cols])
    counts = _stack_as_text(df, cols).groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("ordinal").orderBy(F.desc("count"), F.asc("value"))
    return (counts.withColumn("value_rank", F.row_number().over(w)).where(F.col("value_rank") <= k)
            .select("ordinal", F.element_at(names, F.col("ordinal") + 1).alias("column_name"),
                    "value_rank", "value", "count"))


def value_ranges(df: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Min and max of each column, one aggregate; a few numbers for the driver."""
    row = df.agg(*[F.min(_num(c)).alias(f"a{i}") for i, c in enumerate(cols)],
                 *[F.max(_num(c)).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(cols)}


def histogram(df: DataFrame, cols: list[str], bins: int = HIST_BINS,
              ranges: dict | None = None) -> DataFrame:
    """Fixed ``bins`` equal-width bins between min and max per column.

    Rows (ordinal, column_name, bin, bin_start, bin_end, count); the maximum
    falls in the last bin; a constant column has a single bin 0.
    """
    ranges = ranges or value_ranges(df, cols)
    items = []
    for i, c in enumerate(cols):
        lo, hi = ranges[c]
        if lo is None:
            continue
        width = (hi - lo) / bins
        x = _num(c)
        b = (F.lit(0) if width == 0 else
             F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int"))
        items.append(F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                              F.when(x.isNotNull(), b).alias("bin"),
                              F.lit(float(lo)).alias("lo"), F.lit(float(width)).alias("width")))
    if not items:
        return df.sparkSession.createDataFrame([], "ordinal int, column_name string, bin int, bin_start double, bin_end double, count bigint")
    stacked = df.select(F.explode(F.array(*items)).alias("e")).select("e.*").where(F.col("bin").isNotNull())
    return (stacked.groupBy("ordinal", "column_name", "bin", "lo", "width").agg(F.count(F.lit(1)).alias("count"))
            .select("ordinal", "column_name", "bin",
                    F.round(F.col("lo") + F.col("bin") * F.col("width"), 4).alias("bin_start"),
                    F.round(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 4).alias("bin_end"),
                    "count"))


_PAIR_STATE = "i int, salt int, n array<double>, mean array<double>, other array<double>, square array<double>, cross array<double>"


def _pair_moments(x: np.ndarray) -> np.ndarray:
    """For every pair (i, j), over the rows where both have a value: count, mean of i, mean of j,
    sum of squares of i and sum of products, about these means (5 x p x p)."""
    has = ~np.isnan(x)
    first = np.where(has.any(0), x[has.argmax(0), np.arange(x.shape[1])], 0.0)
    z = np.where(has, x - first, 0.0)          # exactly 0 in a constant column
    centre = z.sum(0) / np.maximum(has.sum(0), 1)
    z, f = np.where(has, z - centre, 0.0), has.astype(np.float64)
    n, total = f.T @ f, z.T @ f
    mean = total / np.maximum(n, 1)
    about = np.where(n > 0, first[:, None] + centre[:, None] + mean, 0.0)
    raw = (z * z).T @ f
    out = np.stack([n, about, about.T, raw - total * mean, z.T @ z - total * mean.T])
    # where little of the sum of squares is left, rounding may be all of it: those pairs from their own rows
    for i, j in np.argwhere((n > 1) & (raw > 0) & (out[3] <= 1e-9 * raw)).tolist():
        both = has[:, i] & has[:, j]
        a, b = x[both, i], x[both, j]
        m = a[0] + (a - a[0]).mean()
        if (a == a[0]).all():
            m = a[0]
        cross = float(((a - m) * (b - (b[0] + (b - b[0]).mean()))).sum())
        out[1, i, j] = out[2, j, i] = m
        out[3, i, j] = float(((a - m) ** 2).sum())
        out[4, i, j] = out[4, j, i] = cross
    return out


def _merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of the rows of both (Chan, Golub and LeVeque's update)."""
    n = a[0] + b[0]
    of_b, both = b[0] / np.maximum(n, 1), a[0] * b[0] / np.maximum(n, 1)
    d, e = b[1] - a[1], b[2] - a[2]
    return np.stack([n, a[1] + d * of_b, a[2] + e * of_b, a[3] + b[3] + d * d * both, a[4] + b[4] + d * e * both])


def _moment_rows(state: dict[int, np.ndarray], salt: int) -> pa.RecordBatch:
    """One row per column i; a state is 5 x p."""
    keys = sorted(state)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), pa.array([salt] * len(keys), pa.int32())]
        + [pa.array([state[k][m] for k in keys], pa.list_(pa.float64())) for m in range(5)],
        names=[c.split()[0] for c in _PAIR_STATE.split(", ")])


def _task_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            now = _pair_moments(np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns]))
            total = now if total is None else _merge_moments(total, now)
    if total is not None:
        yield _moment_rows({i: total[:, i] for i in range(total.shape[1])}, TaskContext.get().partitionId() % 64)


def _merged_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state: dict[int, np.ndarray] = {}
    for batch in batches:
        rows = batch.to_pydict()
        for k, i in enumerate(rows["i"]):
            now = np.array([rows[m][k] for m in ("n", "mean", "other", "square", "cross")])
            state[i] = _merge_moments(state[i], now) if i in state else now
    if state:
        yield _moment_rows(state, 0)


def correlation(df: DataFrame, cols: list[str], digits: int = 3) -> DataFrame:
    """Pairwise-complete Pearson correlation of every ordered pair, long form.

    Rows (col_x, col_y, r).  One scan for any number of columns: a task sums
    the masked cross-products of its Arrow batches as matrices about the
    means and merges them as it goes, so it gives one row per column; these
    are merged in two steps (by column and salt, then by column).  A constant side
    yields NULL.  Returns nothing when fewer than two columns are given
    (reference rule).
    """
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], "col_x string, col_y string, r double")
    ship_package(spark)
    none = F.array_repeat(F.lit(0.0), len(cols))   # so that a table without rows gives its pairs too
    start = spark.range(0, len(cols), 1, 1).select(F.col("id").cast("int").alias("i"), F.lit(0).alias("salt"),
                                                   *[none.alias(m) for m in ("n", "mean", "other", "square", "cross")])
    parts = df.select(*[_num(c).alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(_task_moments, _PAIR_STATE)
    merged = (parts.unionByName(start).repartition("i", "salt").mapInArrow(_merged_moments, _PAIR_STATE)
              .repartition("i").mapInArrow(_merged_moments, _PAIR_STATE))
    square = merged.select("i", F.posexplode(F.arrays_zip("square", "cross")).alias("j", "m")).select("i", "j", "m.*")
    mirror = square.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("square").alias("square_j"))
    names = F.array(*[F.lit(c) for c in cols])
    r = F.col("cross") / F.nullif(F.sqrt("square") * F.sqrt("square_j"), F.lit(0.0))
    return (square.join(mirror, ["i", "j"])
            .select(F.element_at(names, F.col("i") + 1).alias("col_x"), F.element_at(names, F.col("j") + 1).alias("col_y"),
                    F.round(r, digits).alias("r")))


def correlation_matrix(long: DataFrame, cols: list[str]) -> DataFrame:
    """Square matrix, one row per ``col_x`` and one column per name (C6 as a table)."""
    return long.groupBy("col_x").pivot("col_y", cols).agg(F.first("r"))


def matrix_to_long(matrix: DataFrame, cols: list[str]) -> DataFrame:
    """Heatmap data (col_x, col_y, r) by unpivoting the matrix."""
    return matrix.unpivot("col_x", cols, "col_y", "r")


def nonnull_values(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """The non-null values of one column with their row keys, lazily."""
    return df.select(*keys, _q(col).alias("value")).dropna(subset=["value"])


def eda_report(prof: DataFrame, summary: DataFrame, top: DataFrame | None = None) -> DataFrame:
    """Per-column entry (type, missing, distinct) with numeric statistics and,
    if ``top`` (of ``top_values``) is given, the top values of categorical columns as an
    array of (value, count).

    All inputs hold one row per column, or k; they are broadcast.
    """
    out = (prof.select("ordinal", "column_name", "semantic_type", "missing_pct", "n_unique")
           .join(F.broadcast(summary.drop("ordinal")), "column_name", "left"))
    if top is None:
        return out
    entry = (top.groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("value_rank", "value", "count"))).alias("t"))
             .select("column_name", F.transform("t", lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count"))).alias("top_values")))
    return (out.join(F.broadcast(entry), "column_name", "left")
            .withColumn("top_values", F.when(F.col("semantic_type") == "categorical", F.col("top_values"))))
