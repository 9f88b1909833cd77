"""Exact order statistics that stay distributed.

* ``global_rank``: 0-based position of each row in a total order.  A window
  without ``partitionBy`` would pull every row into one task; instead the rows
  are range-partitioned and sorted (``orderBy``), each row takes its position
  inside its partition from ``monotonically_increasing_id`` (partition id in the
  upper bits, position in the lower 33), and a table of per-partition counts
  (one row per partition, so its size is bounded by the partition count, not
  the data) is turned into offsets and broadcast back.
* ``dense_index``: sorted distinct values numbered 0..k-1 (label encoding).
* ``exact_medians``: interpolated medians of many columns without sorting them.
  An approximate quantile pass brackets the middle ranks in a narrow value band,
  a counting pass places the band, and only the band's value counts (checked to
  be at most ``max_band`` distinct values) reach the driver.  Bands are
  narrowed again when too wide, and a band whose ends are equal (a hot value)
  answers at once.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def global_rank(df: DataFrame, order_cols: list[Column | str], rank_col: str = "rank0") -> DataFrame:
    """Add ``rank_col`` = 0-based row position in ``order_cols`` order.

    ``order_cols`` must be a total order (append a key if needed) so that a
    recomputation after executor loss assigns the same positions.
    """
    tagged = (df.orderBy(*order_cols)
              .withColumn("__mid", F.monotonically_increasing_id())
              .withColumn("__pid", F.shiftright(F.col("__mid"), _POS_BITS))
              .persist(StorageLevel.MEMORY_AND_DISK))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per partition: a single-task window here is bounded by the partition count
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(rank_col, F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_POS_MASK)))
            .drop("__mid", "__pid", "__off"))


def dense_index(df: DataFrame, col: str, index_col: str = "index") -> DataFrame:
    """Distinct non-null values of ``col`` numbered 0..k-1 in ascending order."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_rank(distinct, [F.col(col).asc()], index_col).select(col, index_col)


def exact_medians(df: DataFrame, cols: list[str], accuracy: int = 10000,
                  max_band: int = 100_000, max_rounds: int = 6) -> dict[str, float | None]:
    """Exact (interpolated, pandas/DuckDB ``median``) medians of numeric ``cols``.

    Returns a small dict for the driver.  The final step counts rows per
    distinct value inside each column's band (at most ``max_band`` distinct
    values, checked), so a band holding many copies of a few values (a hot
    value, a two-valued code) costs no more than its distinct values.
    """
    if not cols:
        return {}
    x = {c: F.col(f"`{c}`").cast("double") for c in cols}
    first = df.agg(*[F.count(x[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    state = {}
    result: dict[str, float | None] = {}
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        if n == 0:
            result[c] = None
            continue
        # target 0-based ranks; band = whole column, nothing below it yet
        state[c] = {"n": n, "r": ((n - 1) // 2, n // 2), "lo": None, "hi": None,
                    "below": 0, "inband": n, "stuck": False}
    rounds = 0
    while True:
        wide = [c for c, s in state.items()
                if s["inband"] > max_band and c not in result and not s["stuck"]]
        if not wide or rounds >= max_rounds:
            break
        rounds += 1
        # narrow each wide band with approximate quantiles taken inside it
        aggs = []
        for i, c in enumerate(wide):
            s = state[c]
            in_band = _band(x[c], s)
            m = s["inband"]
            lo_p = max(0.0, (s["r"][0] - s["below"]) / m - 2.0 / accuracy)
            hi_p = min(1.0, (s["r"][1] - s["below"]) / m + 2.0 / accuracy)
            aggs.append(F.percentile_approx(F.when(in_band, x[c]), F.array(F.lit(lo_p), F.lit(hi_p)),
                                            accuracy).alias(f"q{i}"))
        qrow = df.agg(*aggs).first()
        aggs = []
        for i, c in enumerate(wide):
            lo, hi = qrow[f"q{i}"]
            state[c]["cand"] = (lo, hi)
            aggs += [F.count(F.when(x[c] < F.lit(lo), 1)).alias(f"b{i}"),
                     F.count(F.when(x[c].between(F.lit(lo), F.lit(hi)), 1)).alias(f"m{i}")]
        crow = df.agg(*aggs).first()
        for i, c in enumerate(wide):
            s = state[c]
            lo, hi = s["cand"]
            below, inband = crow[f"b{i}"], crow[f"m{i}"]
            if below <= s["r"][0] and s["r"][1] < below + inband:
                s["stuck"] = inband >= s["inband"]        # no progress: few distinct values
                s.update(lo=lo, hi=hi, below=below, inband=inband)
                if lo == hi:  # every value in the band is the same: a hot value
                    result[c] = float(lo)
            else:  # bracket missed (should not happen); widen the accuracy
                accuracy *= 4
    pending = [c for c in state if c not in result]
    if not pending:
        return result
    items = [F.struct(F.lit(i).alias("k"), F.when(_band(x[c], state[c]), x[c]).alias("v"))
             for i, c in enumerate(pending)]
    counts = (df.select(F.explode(F.array(*items)).alias("e")).select("e.*").where(F.col("v").isNotNull())
              .groupBy("k", "v").agg(F.count(F.lit(1)).alias("cnt")))
    bound = max_band * len(pending)
    got = counts.limit(bound + 1).collect()
    if len(got) > bound:  # a band that would not narrow: halve the range of values instead
        for c in pending:
            a, b = (_select_by_bisection(df, x[c], state[c], r) for r in state[c]["r"])
            result[c] = None if math.isnan(a + b) else (a + b) / 2.0
        return result
    by_col: dict[int, list] = {}
    for r in got:
        by_col.setdefault(r["k"], []).append((r["v"], r["cnt"]))
    for i, c in enumerate(pending):
        s = state[c]
        vals = sorted(by_col.get(i, []))
        a = _value_at(vals, s["r"][0] - s["below"])
        b = _value_at(vals, s["r"][1] - s["below"])
        result[c] = None if a is None or b is None or math.isnan(a + b) else (a + b) / 2.0
    return result


def _select_by_bisection(df: DataFrame, c: Column, s: dict, rank: int) -> float:
    """The value at 0-based ``rank``: the range is halved by counting passes, so any
    number of distinct values takes constant memory."""
    lo, hi = (float(v) for v in df.agg(F.min(F.when(_band(c, s), c)), F.max(F.when(_band(c, s), c))).first())
    while lo < hi:
        mid = lo + (hi - lo) / 2.0
        if not lo <= mid < hi:
            mid = lo
        row = df.agg(F.count(F.when(c <= F.lit(mid), 1)), F.max(F.when(c <= F.lit(mid), c)), F.min(F.when(c > F.lit(mid), c))).first()
        lo, hi = (lo, float(row[1])) if row[0] > rank else (float(row[2]), hi)
    return lo


def _value_at(sorted_counts: list, rank: int) -> float | None:
    """Value at 0-based ``rank`` in a sorted list of (value, count)."""
    seen = 0
    for v, cnt in sorted_counts:
        seen += cnt
        if rank < seen:
            return v
    return None


def _band(c: Column, s: dict) -> Column:
    if s["lo"] is None:
        return c.isNotNull()
    return c.between(F.lit(s["lo"]), F.lit(s["hi"]))
