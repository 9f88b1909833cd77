"""Profile: per-column statistics, semantic types, suggested
tasks and targets.

``profile`` computes everything per column in one fused aggregate (counts,
datetime-parse counts), exact distinct counts column by column, and returns a long DataFrame with one
row per column.  Values for the samples come from a second job that
deduplicates map-side and keeps the k smallest values per column with a
window-group limit, so no column's values are ever gathered in one place.
The profile is small (one row per column) and is the only thing collected to
the driver, where it decides which preparation steps apply.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstat.functions import dates
from quillstat.session import estimated_bytes
from quillstat.functions.exprs import (
    MAX_CLASSES, MIN_REGRESSION_DISTINCT, SMALL_DATA_ROWS, TEXT_RATIO,
)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType, T.BooleanType)
TEMPORAL_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)

PROFILE_SCHEMA = ("ordinal", "column_name", "physical_type", "semantic_type", "n_rows",
                  "n_missing", "missing_pct", "n_unique", "distinct_ratio")


def physical_kind(dt: T.DataType) -> str:
    if isinstance(dt, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dt, TEMPORAL_TYPES):
        return "temporal"
    if isinstance(dt, T.StringType):
        return "string"
    raise TypeError(f"cannot profile a column of type {dt.simpleString()}; "
                    "only numbers, text, dates and timestamps are supported")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns the B2 rule calls numeric.  The rule decides 'numeric' from the
    physical type alone, so this needs the schema only, not a profile job."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def _as_value(name: str, dt: T.DataType) -> Column:
    c = _q(name)
    return c.cast("int") if isinstance(dt, T.BooleanType) else c


def _distinct_key(name: str, dt: T.DataType) -> Column:
    """What an exact distinct count shuffles: long texts go as their digest."""
    v = _as_value(name, dt)
    return F.when(F.length(v) > 32, F.concat(F.lit("md5:"), F.md5(v))).otherwise(v) if isinstance(dt, T.StringType) else v


def profile(df: DataFrame, distinct: str = "exact", rsd: float = 0.02) -> DataFrame:
    """One row per column.

    Columns: ordinal, column_name, physical_type, semantic_type, n_rows,
    n_missing, missing_pct (2 dp), n_unique (nulls excluded), distinct_ratio.

    ``distinct``:
      * ``"exact"`` (default): ``count(distinct)`` of every column, each in an
        aggregate of its own over that column (deduplicated map-side);
      * ``"approx"``: HyperLogLog (``approx_count_distinct``) only;
      * ``"hybrid"`` (the scale path): HyperLogLog first, then an exact count
        only for columns whose estimate lies within its error of a decision
        threshold (2, 10 and 20 values, half the row count); other columns keep
        the estimate, which changes no type or target decision;
      * ``"none"``: row and missing counts only; n_unique, distinct_ratio and
        semantic_type are null.
    """
    fields = df.schema.fields
    kinds = [physical_kind(f.dataType) for f in fields]
    approx_cols = set(range(len(fields))) if distinct in ("approx", "hybrid") else set()
    # Exact distinct counts stand apart, and so does the reading of dates, so that
    # no column passes through the per-row work of another.
    plain, cut, layouts = [F.count(F.lit(1)).alias("__n")], [], []
    for i, (f, kind) in enumerate(zip(fields, kinds)):
        v = _as_value(f.name, f.dataType)
        plain.append(F.count(v).alias(f"nn{i}"))
        if i in approx_cols:
            plain.append(F.approx_count_distinct(v, rsd).alias(f"nu{i}"))
        if kind == "string" and distinct != "none":
            cut.append(dates.pieces(v).alias(f"__pieces{i}"))
            layouts.extend(dates.layout_counts(F.col(f"__pieces{i}"), f"dt{i}"))
    plain_df = df.agg(*plain)
    if cut:   # only texts go through Python: each side is one row
        plain_df = plain_df.crossJoin(F.broadcast(df.select(*cut).agg(*layouts)))
    if distinct == "hybrid":
        # the one-row result stands as a literal, so deciding which columns need
        # an exact count costs no extra pass over the data
        row = plain_df.first()
        plain_df = df.sparkSession.createDataFrame([row], plain_df.schema)
        exact_cols = _borderline(row, len(fields), rsd)
    elif distinct in ("approx", "none"):
        exact_cols = set()
    else:
        exact_cols = set(range(len(fields)))
    base_rows = []
    for i, (f, kind) in enumerate(zip(fields, kinds)):
        parsed = dates.dates_of_one_layout(f"dt{i}") if kind == "string" and distinct != "none" else F.lit(None).cast("bigint")
        base_rows.append(F.struct(F.lit(i).alias("ordinal"), F.col("__n").alias("n"), F.col(f"nn{i}").alias("nn"),
                                  parsed.alias("parsed"),
                                  (F.col(f"nu{i}") if i in approx_cols else F.lit(None).cast("bigint")).alias("nu_approx")))
    base = plain_df.select(F.inline(F.array(*base_rows)))
    if exact_cols:
        order = sorted(exact_cols)
        # one narrow aggregate a column, which reads that column alone: several distinct
        # counts in one aggregate repeat each row, all columns wide, once per column
        exact = None
        for i in order:
            one = df.agg(F.count_distinct(_distinct_key(fields[i].name, fields[i].dataType)).alias("nu_exact")).select(F.lit(i).alias("ordinal"), "nu_exact")
            exact = one if exact is None else exact.unionAll(one)
        base = base.join(F.broadcast(exact), "ordinal", "left")   # one row per column on each side
    else:
        base = base.withColumn("nu_exact", F.lit(None).cast("bigint"))

    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    kinds_col = F.array(*[F.lit(k) for k in kinds])
    kind = F.element_at(kinds_col, F.col("ordinal") + 1)
    n, nn = F.col("n"), F.col("nn")
    nu = F.coalesce(F.col("nu_exact"), F.col("nu_approx"))
    ratio = nu / F.greatest(n, F.lit(1))
    semantic = F.lit(None).cast("string") if distinct == "none" else (
                F.when(kind == "numeric", "numeric")
                .when((kind == "temporal") | ((kind == "string") & (F.col("parsed") == nn)), "datetime")
                .when(ratio > TEXT_RATIO, "text")
                .otherwise("categorical"))
    return base.select(
        F.col("ordinal").cast("int").alias("ordinal"), F.element_at(names, F.col("ordinal") + 1).alias("column_name"),
        F.element_at(types, F.col("ordinal") + 1).alias("physical_type"),
        semantic.alias("semantic_type"), n.alias("n_rows"), (n - nn).alias("n_missing"),
        F.round(F.lit(100.0) * (n - nn) / F.greatest(n, F.lit(1)), 2).alias("missing_pct"),
        nu.cast("bigint").alias("n_unique"), ratio.cast("double").alias("distinct_ratio"),
    )


def _borderline(row, n_cols: int, rsd: float) -> set[int]:
    """Columns whose HyperLogLog estimate is within 4 standard errors of a
    decision threshold (or small enough to count exactly for free); only
    these get an exact distinct count."""
    n = row["__n"]
    thresholds = [2, MIN_REGRESSION_DISTINCT, MAX_CLASSES, TEXT_RATIO * n]
    out = set()
    for i in range(n_cols):
        est = row[f"nu{i}"]
        if est <= 4 * MAX_CLASSES or any(abs(est - t) <= 4 * rsd * max(est, t) + 1 for t in thresholds):
            out.add(i)
    return out


PRUNE_MIN_BYTES = 1 << 30


_LAST_PLACE = (1 << 63) - 1


def _order_of_last(head: DataFrame, items: list[Column], k: int) -> DataFrame:
    """For every column of which ``head`` holds k values: (ordinal, f, b), the byte range by which k of them were seen.

    Ranges, not places in them, are compared: the number of a place depends on how a scan packs ranges into tasks.
    """
    order = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    values = (head.select(order.alias("o"), F.explode(F.array(*items)).alias("e")).select("o", "e.ordinal", "e.sample_value")
              .where(F.col("sample_value").isNotNull()).groupBy("ordinal", "sample_value").agg(F.min("o").alias("o")))
    rank = F.row_number().over(Window.partitionBy("ordinal").orderBy("o", "sample_value"))
    return values.withColumn("n", rank).where(F.col("n") == k).select("ordinal", "o.f", "o.b")


def sample_values(df: DataFrame, k: int = 5, prune_rows: int | None = 100_000,
                  order_col: str | None = None, prune_min_bytes: int = PRUNE_MIN_BYTES,
                  file_order: bool = False) -> DataFrame:
    """The k smallest distinct non-null values of every column.

    Rows (ordinal, column_name, sample_rank, sample_value STRING).  All columns
    are stacked into one (ordinal, typed value) relation; the aggregate dedups
    map-side, and ``row_number() <= k`` is planned as a window-group limit that
    keeps k rows per column in each task before the shuffle.

    ``order_col``: when the input carries a row order (a line number, an
    ingestion time), the samples are instead the first k distinct values in
    that order, as the reference shows them: each value keeps its smallest
    order (map-side ``min``) and the same rank limit applies.

    ``file_order``: the same in the order of the files themselves, for a table
    read from files and only projected or filtered since: by file name, then the
    byte range read, then the place in it.  The k-th first value of any subset
    of rows is no earlier than the true one, so the first rows of the first file
    bound which rows can matter, column by column, before anything is shuffled.

    ``prune_rows``: the k-th smallest distinct value of *any* subset of rows is
    an upper bound of the true k-th smallest, so the bound taken from the first
    ``prune_rows`` rows filters the stacked relation before its shuffle; the
    result is exact and whole, only the shuffle of high-cardinality columns
    shrinks from all their distinct values to a handful.  The extra bounding
    job is spent only when Catalyst estimates the input above
    ``prune_min_bytes``.
    """
    items = []
    for i, f in enumerate(df.schema.fields):
        kind = physical_kind(f.dataType)
        v = _as_value(f.name, f.dataType)
        items.append(F.struct(
            F.lit(i).alias("ordinal"),
            (v.cast("double") if kind == "numeric" else F.lit(None).cast("double")).alias("d"),
            (v.cast("timestamp") if kind == "temporal" else F.lit(None).cast("timestamp")).alias("t"),
            (v if kind == "string" else F.lit(None).cast("string")).alias("s"),
            v.cast("string").alias("sample_value"),
        ))
    names = F.array(*[F.lit(f.name) for f in df.schema.fields])
    if order_col is not None or file_order:
        if file_order and order_col is not None:
            raise ValueError("order_col and file_order exclude each other")
        items = [it for it, f in zip(items, df.schema.fields) if f.name != order_col]
        order = (F.col(f"`{order_col}`") if order_col is not None else
                 F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("place")))
        w = Window.partitionBy("ordinal").orderBy("__first", "d", "t", "s")

        def first_seen(frame: DataFrame, bounds: dict | None = None) -> DataFrame:
            seen = (frame.select(order.alias("__o"), *frame.columns).select("__o", F.explode(F.array(*items)).alias("e"))
                    .select("__o", "e.*").where(F.col("sample_value").isNotNull()))
            if bounds:
                seen = seen.where(F.coalesce(F.col("__o") <= F.create_map(*[x for i, o in bounds.items() for x in (F.lit(i), o)])[F.col("ordinal")], F.lit(True)))
            firsts = seen.groupBy("ordinal", "d", "t", "s", "sample_value").agg(F.min("__o").alias("__first"))
            return firsts.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= k)

        bounds = {}
        if file_order and prune_rows and df.inputFiles():
            name = min(df.inputFiles()).rsplit("/", 1)[-1]
            head = df.where(F.col("_metadata.file_path").endswith(name)).limit(prune_rows)
            bounds = {r["ordinal"]: F.struct(F.lit(r["f"]).alias("file_path"), F.lit(r["b"]).cast("long").alias("file_block_start"), F.lit(_LAST_PLACE).cast("long").alias("place"))
                      for r in _order_of_last(head, items, k).collect()}
        return (first_seen(df, bounds)
                .select("ordinal", F.element_at(names, F.col("ordinal") + 1).alias("column_name"),
                        "sample_rank", "sample_value"))

    def stack(frame: DataFrame) -> DataFrame:
        return (frame.select(F.explode(F.array(*items)).alias("e")).select("e.*")
                .where(F.col("sample_value").isNotNull()).distinct())

    def smallest(stacked: DataFrame) -> DataFrame:
        w = Window.partitionBy("ordinal").orderBy("d", "t", "s")
        return stacked.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= k)

    stacked = stack(df)
    if prune_rows and estimated_bytes(df) >= prune_min_bytes:
        bounds = {r["ordinal"]: r for r in smallest(stack(df.limit(prune_rows)))
                  .where(F.col("sample_rank") == k).collect()}
        if bounds:
            keep = None
            for i, b in bounds.items():   # value <= bound for the bounded columns
                le = ((F.col("d") <= F.lit(b["d"])) if b["d"] is not None else
                      (F.col("t") <= F.lit(b["t"])) if b["t"] is not None else (F.col("s") <= F.lit(b["s"])))
                keep = (F.when(F.col("ordinal") == i, le) if keep is None
                        else keep.when(F.col("ordinal") == i, le))
            keep = keep.otherwise(F.lit(True))
            stacked = (df.select(F.explode(F.array(*items)).alias("e")).select("e.*")
                       .where(F.col("sample_value").isNotNull() & keep).distinct())
    return (smallest(stacked)
            .select("ordinal", F.element_at(names, F.col("ordinal") + 1).alias("column_name"),
                    "sample_rank", "sample_value"))


def with_samples(prof: DataFrame, samples: DataFrame) -> DataFrame:
    """Attach ``sample_values ARRAY<STRING>`` (ordered) to the profile rows."""
    arr = (samples.groupBy("ordinal")
           .agg(F.sort_array(F.collect_list(F.struct("sample_rank", "sample_value"))).alias("__s"))
           .select("ordinal", F.col("__s.sample_value").alias("sample_values")))
    return prof.join(F.broadcast(arr), "ordinal", "left").orderBy("ordinal")


# ---------------------------------------------------------------------------
# Target rules
# ---------------------------------------------------------------------------

def id_excluded(name: Column) -> Column:
    """Reference rule, substring 'id' anywhere or the name 'index'."""
    low = F.lower(name)
    return low.contains("id") | (low == "index")


def target_flags(prof: DataFrame) -> DataFrame:
    """Per-column target eligibility used by B7 and B8."""
    st, nu = F.col("semantic_type"), F.col("n_unique")
    ok = ~id_excluded(F.col("column_name"))
    clf = ok & (((st == "categorical") & nu.between(2, MAX_CLASSES)) |
                ((st == "numeric") & (nu <= MAX_CLASSES)))
    return prof.select(
        "*",
        clf.alias("classification_target"),
        (ok & (st == "numeric") & (nu > 2)).alias("regression_suggested"),
        (ok & (st == "numeric") & (nu > MIN_REGRESSION_DISTINCT)).alias("regression_target"),
    )


def suggest_tasks(prof: DataFrame) -> DataFrame:
    """Tasks in fixed order; classification/regression only when a target exists."""
    fl = target_flags(prof).agg(
        F.max(F.col("classification_target").cast("int")).alias("c"),
        F.max(F.col("regression_suggested").cast("int")).alias("r"))
    tasks = F.array(
        F.struct(F.lit(1).alias("position"), F.lit("anomaly_detection").alias("task"), F.lit(True).alias("on")),
        F.struct(F.lit(2).alias("position"), F.lit("clustering").alias("task"), F.lit(True).alias("on")),
        F.struct(F.lit(3).alias("position"), F.lit("classification").alias("task"), F.coalesce(F.col("c") == 1, F.lit(False)).alias("on")),
        F.struct(F.lit(4).alias("position"), F.lit("regression").alias("task"), F.coalesce(F.col("r") == 1, F.lit(False)).alias("on")),
    )
    return fl.select(F.inline(tasks)).where("on").select(F.col("position").cast("int"), "task")


def suggested_targets(prof: DataFrame) -> DataFrame:
    """B7 + B10: classification targets then regression ones, first occurrence kept.

    The un-partitioned windows in this section rank profile rows (one per
    column of the input), never data rows.
    """
    fl = target_flags(prof)
    both = (fl.where("classification_target").select("column_name", F.lit(0).alias("lst"), "ordinal")
            .unionByName(fl.where("regression_suggested").select("column_name", F.lit(1).alias("lst"), "ordinal")))
    first = both.groupBy("column_name").agg(F.min(F.struct("lst", "ordinal")).alias("k"))
    return first.select("column_name", F.row_number().over(Window.orderBy("k")).cast("int").alias("position"))


def targets_for_task(prof: DataFrame, task: str) -> DataFrame:
    """Eligible target columns for one task, in column order."""
    flag = {"classification": "classification_target", "regression": "regression_target"}[task]
    return (target_flags(prof).where(flag)
            .select("column_name", F.row_number().over(Window.orderBy("ordinal")).cast("int").alias("position")))


def target_advice(prof: DataFrame) -> DataFrame:
    """Allowed tasks (classification/regression) and the advice per target."""
    fl = target_flags(prof)
    clf = fl.where("classification_target").select(
        F.lit("classification").alias("task"), "ordinal", "column_name", "n_unique",
        F.when(F.col("n_unique") == 2, "binary").otherwise(
            F.format_string("%d classes", F.col("n_unique"))).alias("advice"))
    reg = fl.where("regression_target").select(
        F.lit("regression").alias("task"), "ordinal", "column_name", "n_unique",
        F.format_string("continuous with %d unique values", F.col("n_unique")).alias("advice"))
    return clf.unionByName(reg)


def default_choice(prof: DataFrame) -> DataFrame:
    """First allowed task, first target of that task."""
    tasks = suggest_tasks(prof).where(F.col("task").isin("classification", "regression"))
    first_task = tasks.orderBy("position").limit(1)
    fl = target_flags(prof)
    cand = (fl.where("classification_target").select(F.lit("classification").alias("task"), "ordinal", "column_name")
            .unionByName(fl.where("regression_target").select(F.lit("regression").alias("task"), "ordinal", "column_name")))
    return (first_task.join(cand, "task")
            .orderBy("ordinal").limit(1).select("task", F.col("column_name").alias("target")))


def table_summary(prof: DataFrame, n_cols: int | None = None) -> DataFrame:
    """B1 + B12: rows, columns, suggested-task count, mean missing percent (1 dp)."""
    fl = target_flags(prof)
    n_tasks = (F.lit(2) + F.coalesce(F.max(F.col("classification_target").cast("int")), F.lit(0))
               + F.coalesce(F.max(F.col("regression_suggested").cast("int")), F.lit(0)))
    return fl.agg(F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_cols"),
                  n_tasks.cast("bigint").alias("n_tasks"),
                  F.round(F.avg("missing_pct"), 1).alias("missing_pct"))


def column_summary(prof_with_samples: DataFrame) -> DataFrame:
    """Overview table with the first three samples joined by ', '."""
    return prof_with_samples.select(
        "ordinal", "column_name", "semantic_type", "missing_pct", "n_unique",
        F.concat_ws(", ", F.slice(F.coalesce("sample_values", F.array().cast("array<string>")), 1, 3)).alias("sample"))


# ---------------------------------------------------------------------------
# Driver-side view of the small profile
# ---------------------------------------------------------------------------

@dataclass
class ColumnInfo:
    ordinal: int
    name: str
    semantic_type: str
    missing_pct: float
    n_unique: int
    physical_type: str


@dataclass
class DatasetInfo:
    n_rows: int
    n_cols: int
    columns: dict[str, ColumnInfo] = field(default_factory=dict)

    @property
    def small_data(self) -> bool:
        return self.n_rows < SMALL_DATA_ROWS

    def of_type(self, semantic: str) -> list[str]:
        return [c.name for c in self.columns.values() if c.semantic_type == semantic]


def collect_info(prof: DataFrame) -> DatasetInfo:
    """Collect the profile (one row per column) into a driver-side dataclass."""
    rows = prof.orderBy("ordinal").collect()
    cols = {r["column_name"]: ColumnInfo(r["ordinal"], r["column_name"], r["semantic_type"],
                                         r["missing_pct"], r["n_unique"], r["physical_type"])
            for r in rows}
    n_rows = rows[0]["n_rows"] if rows else 0
    return DatasetInfo(n_rows=n_rows, n_cols=len(rows), columns=cols)
